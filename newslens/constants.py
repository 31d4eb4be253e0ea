"""Changing any of them changes results."""

# Text cleaning: each match of one of these, tried in this order, becomes a blank.
MENTION = r"@[A-Za-z0-9]+"
NOT_PLAIN = r"[^0-9A-Za-z \t]"
URL = r"\w+://\S+"
NULL_TEXT = "None"  # what a missing text reads as, before lower-casing

# Histogram widths: bins 0..5 for both sentiment axes, 0..10 for both user axes.
TEXT_BINS = 6
USER_BINS = 11
TEXT_WIDTH = 12
USER_WIDTH = 23
VECTOR_WIDTH = 36

# Time format of an account's creation, after its weekday ("Wed ") is cut off.
CREATED_AT_FORMAT = "MMM dd HH:mm:ss Z yyyy"

# Training.
TRAINING_CAP = 10460
TEST_SHARE = 0.2
SEED = 3
FOREST_TREES = 100

# Voters, in voting order. Key in the verdict's model_result; key in the accuracy map.
# The linear SGD-style model votes but is listed in neither map.
VOTERS = ("knn", "lr", "decisionTree", "randomForest", "naiveBayes", "sgd", "xgb")
ACCURACY_KEY = {
    "knn": "knn",
    "lr": "logisticRegression",
    "decisionTree": "decisionTree",
    "randomForest": "randomForest",
    "naiveBayes": "naiveBayes",
    "xgb": "XGB",
}
UNREPORTED = ("sgd",)
FAKE = "fake"
REAL = "real"
MISSING_LABEL = "nan"

# Columns of the stored tables, in file order.
POST_COLUMNS = (
    "link", "date", "text", "tweet_id", "username", "retweets",
    "favorites", "mentions", "hashtags", "geo", "permalink",
)
USER_COLUMNS = (
    "tweetid", "userid", "user_name", "screen_name", "followers_count",
    "friends_count", "listed_count", "created_at", "favourites_count",
    "verified", "statuses_count", "default_profile", "default_profile_image",
)

# Least number of partitions for a line-oriented text scan.
TEXT_SCAN_PARTITIONS = 2000
