"""DuckDB SQL that states, over the same tables, what each query must return."""

from __future__ import annotations

RAW_POSTS = """
base AS (
  SELECT d.doc_id, d.source, d.lang, d.text, e.ts, e.user_id, e.value,
         CASE WHEN e.event_type IN ('click', 'view') THEN CAST(floor(e.value) AS INT) END AS rt
  FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id),
copies AS (
  SELECT 'https://' || source || '.example/' || lang AS link, rt AS retweets, * FROM base
  UNION ALL
  SELECT 'https://story.example/' || CAST(doc_id // 4 AS VARCHAR), rt, * FROM base
  UNION ALL
  SELECT 'https://' || lang || '.example/', rt, * FROM base WHERE doc_id % 3 = 0
  UNION ALL
  SELECT 'https://' || source || '.example/' || lang, rt + 1, * FROM base WHERE doc_id % 5 = 0),
raw_posts AS (
  SELECT link, ts AS date, text, CAST(doc_id AS VARCHAR) AS tweet_id,
         'user' || CAST(user_id AS VARCHAR) AS username, retweets,
         CAST(floor(value * 2) AS INT) AS favorites, CAST(NULL AS VARCHAR) AS mentions,
         '#' || source AS hashtags, CAST(NULL AS VARCHAR) AS geo,
         'https://posts.example/' || CAST(doc_id AS VARCHAR) AS permalink
  FROM copies),
posts AS (SELECT link, tweet_id, text, retweets FROM raw_posts)
"""

EVENT_USERS = """
event_users AS (
  SELECT e.event_id, e.ts, e.user_id, c.c_name,
         CAST(floor(e.value * 10) AS BIGINT) AS followers,
         CAST(c.c_nationkey AS BIGINT) * 10 AS friends,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k,
         e.event_type = 'purchase' AS is_verified,
         e.event_id % 7 <> 0 AS has_user
  FROM events e JOIN customer c ON e.user_id = c.c_custkey)
"""

STATUS_COUNT = "CASE WHEN event_id % 2 = 0 THEN k % 20 ELSE k * 2 END"

USERS = f"""{EVENT_USERS},
users AS (
  SELECT CAST(event_id AS VARCHAR) AS tweetid, followers AS followers_count,
         CASE WHEN event_id % 11 <> 0 THEN friends END AS friends_count,
         CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS INT) AS account_age,
         is_verified AS verified, {STATUS_COUNT} AS statuses_count
  FROM event_users WHERE has_user),
repeated_users AS (
  SELECT * FROM users
  UNION ALL
  SELECT tweetid, followers_count + 1, friends_count, account_age, verified, statuses_count
  FROM users WHERE CAST(tweetid AS BIGINT) % 13 = 0)
"""

DEDUPED_POSTS = """
deduped_posts AS (
  SELECT link, tweet_id, text, retweets FROM posts
  QUALIFY row_number() OVER (PARTITION BY link, tweet_id
    ORDER BY retweets NULLS FIRST, md5(text) NULLS FIRST) = 1)
"""

DEDUPED_USERS = """
deduped_users AS (
  SELECT * FROM repeated_users
  QUALIFY row_number() OVER (PARTITION BY tweetid
    ORDER BY followers_count NULLS FIRST, friends_count NULLS FIRST, account_age NULLS FIRST,
             verified NULLS FIRST, statuses_count NULLS FIRST) = 1)
"""

LEXICON = """
lexicon AS (
  SELECT * FROM (VALUES ('the', 25, 50), ('of', -50, 25), ('and', 100, 100), ('to', -100, 75),
                        ('in', 0, 0), ('le', 75, 100), ('der', -25, 50)) AS t(word, pol, sub))
"""

CLEAN = r"""trim(regexp_replace(regexp_replace(lower(coalesce({text}, 'None')),
  '(@[A-Za-z0-9]+)|([^0-9A-Za-z \t])|(\w+://\S+)', ' ', 'g'), '[ \t]+', ' ', 'g'))"""

SCORES = f"""{LEXICON},
cleaned AS (SELECT link, tweet_id, retweets, {CLEAN.format(text="text")} AS clean
            FROM deduped_posts),
tokens AS (SELECT link, tweet_id, unnest(string_split(clean, ' ')) AS word FROM cleaned),
sums AS (
  SELECT t.link, t.tweet_id, sum(l.pol) AS pol, sum(l.sub) AS sub, count(l.word) AS n
  FROM tokens t LEFT JOIN lexicon l ON l.word = t.word GROUP BY 1, 2),
scores AS (
  SELECT c.link, c.tweet_id, c.retweets,
         CASE WHEN s.n > 0 THEN CAST(s.pol AS DOUBLE) / (s.n * 100) ELSE 0.0 END AS polarity,
         CASE WHEN s.n > 0 THEN CAST(s.sub AS DOUBLE) / (s.n * 100) ELSE 0.0 END AS subjectivity
  FROM cleaned c JOIN sums s ON s.link = c.link AND s.tweet_id = c.tweet_id),
binned AS (
  SELECT *, CAST(trunc((polarity + 1) * 2.5) AS INT) AS sentiment_bin,
         CAST(trunc(subjectivity * 5) AS INT) AS subjectivity_bin FROM scores)
"""

# Phrases with modifiers: known phrases by place, folded in order, the longest first at one place.
_STATE = ("next", "until", "by_pol", "by_sub", "s_pol", "s_sub", "found")


def _state(*values: str) -> str:
    own = ", ".join(f"'{n}': CAST({v} AS BIGINT)" for n, v in zip(_STATE, values, strict=True))
    return "{'pos': CAST(0 AS BIGINT), 'n': CAST(0 AS BIGINT), 'modifies': false, 'pol': CAST(0 AS BIGINT), 'sub': CAST(0 AS BIGINT), " + own + "}"


def _scaled(value: str, factor: str, least: int, most: int) -> str:
    factor = f"CASE WHEN s.until = h.pos THEN s.{factor} ELSE 100 END"
    product = f"(h.{value} * {factor})"
    return f"greatest({least}, least({most}, ({product} - {product} % 100) // 100))"


_FOLD = f"""CASE WHEN h.pos < s.next THEN s
  WHEN h.modifies THEN {_state("h.pos + h.n", "h.pos + h.n", _scaled("pol", "by_pol", -1000, 1000),
                               _scaled("sub", "by_sub", -1000, 1000), "s.s_pol", "s.s_sub", "s.found")}
  ELSE {_state("h.pos + h.n", "-1", "100", "100", "s.s_pol + " + _scaled("pol", "by_pol", -100, 100),
               "s.s_sub + " + _scaled("sub", "by_sub", 0, 100), "s.found + 1")} END"""

CONTEXT_SCORES = f"""
phrases AS (
  SELECT * FROM (VALUES
    ('the', 25, 50, false), ('and', 100, 100, false), ('in', 0, 0, false), ('le', 75, 100, false),
    ('der', -25, 50, false), ('la', 35, 15, false), ('of the', -75, 65, false), ('in the', 45, 35, false),
    ('and to the', -95, 85, false), ('of', -50, 100, true), ('to', 130, 130, true), ('de', 33, 77, true),
    ('que', -100, 60, true)) AS t(phrase, pol, sub, modifies)),
cleaned AS (SELECT link, tweet_id, retweets, {CLEAN.format(text="text")} AS clean FROM deduped_posts),
split AS (SELECT link, tweet_id, list_filter(string_split(clean, ' '), lambda w: w <> '') AS ws FROM cleaned),
placed AS (SELECT link, tweet_id, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM split),
ahead AS (
  SELECT *, lead(w) OVER places AS w1, lead(w, 2) OVER places AS w2 FROM placed
  WINDOW places AS (PARTITION BY link, tweet_id ORDER BY pos)),
grams AS (
  SELECT link, tweet_id, pos, 1 AS n, w AS phrase FROM ahead
  UNION ALL SELECT link, tweet_id, pos, 2, w || ' ' || w1 FROM ahead WHERE w1 IS NOT NULL
  UNION ALL SELECT link, tweet_id, pos, 3, w || ' ' || w1 || ' ' || w2 FROM ahead WHERE w2 IS NOT NULL),
hits AS (
  SELECT link, tweet_id, list({{'pos': pos, 'n': CAST(n AS BIGINT), 'modifies': modifies, 'pol': CAST(pol AS BIGINT),
    'sub': CAST(sub AS BIGINT), {", ".join(f"'{n}': CAST(0 AS BIGINT)" for n in _STATE)}}} ORDER BY pos, n DESC) AS hits
  FROM grams JOIN phrases USING (phrase) GROUP BY link, tweet_id),
folded AS (
  SELECT link, tweet_id, list_reduce(list_prepend({_state("0", "-1", "100", "100", "0", "0", "0")}, hits),
    lambda s, h: {_FOLD}) AS s FROM hits),
scores AS (
  SELECT c.link, c.tweet_id, c.retweets,
         CASE WHEN s.found > 0 THEN CAST(s.s_pol AS DOUBLE) / (s.found * 100) ELSE 0.0 END AS polarity,
         CASE WHEN s.found > 0 THEN CAST(s.s_sub AS DOUBLE) / (s.found * 100) ELSE 0.0 END AS subjectivity
  FROM cleaned c LEFT JOIN folded f ON f.link = c.link AND f.tweet_id = c.tweet_id),
binned AS (
  SELECT *, CAST(trunc((polarity + 1) * 2.5) AS INT) AS sentiment_bin,
         CAST(trunc(subjectivity * 5) AS INT) AS subjectivity_bin FROM scores)
"""

JOINED = """
joined AS (
  SELECT p.link, p.tweet_id, coalesce(u.followers_count, 0) AS followers_count,
         coalesce(u.friends_count, 0) AS friends_count,
         coalesce(u.account_age, 0) AS account_age, coalesce(u.verified, false) AS verified,
         coalesce(u.statuses_count, 0) AS statuses_count
  FROM deduped_posts p JOIN deduped_users u ON u.tweetid = p.tweet_id)
"""


def _user_bins(divisor: str) -> str:
    return f"""
ratios AS (
  SELECT *, CAST(followers_count AS DOUBLE) / (1 + friends_count) AS follower_ratio,
         CAST(statuses_count AS DOUBLE) / (1 + {divisor}) AS activity FROM joined),
user_bins AS (
  SELECT *, CAST(least(10, trunc(follower_ratio * 2)) AS INT) AS ratio_bin,
         CAST(least(10, trunc(activity)) AS INT) AS activity_bin FROM ratios)
"""


COMPAT = _user_bins("CAST(verified AS INT)")
BY_AGE = _user_bins("account_age")


def _counts(column: str, bins: int, prefix: str, start: int = 0) -> str:
    return ",\n".join(
        f"CAST(count(*) FILTER (WHERE {column} = {i}) AS BIGINT) AS {prefix}_{start + i}"
        for i in range(bins)
    )


TEXT_COLUMNS = (
    _counts("sentiment_bin", 6, "text") + ",\n" + _counts("subjectivity_bin", 6, "text", 6)
)
USER_COLUMNS = _counts("ratio_bin", 11, "user") + ",\n" + _counts("activity_bin", 11, "user", 11)
VERIFIED_GROUPS = """CAST(count(DISTINCT CASE WHEN verified THEN ratio_bin * 11 + activity_bin END)
  AS BIGINT) AS user_22"""
VERIFIED_COUNT = "CAST(count(*) FILTER (WHERE verified) AS BIGINT) AS user_22"

VECTORS = f"""
text_hist AS (SELECT link, {TEXT_COLUMNS},
                     CAST(sum(coalesce(retweets, 0)) AS BIGINT) AS retweets
              FROM binned GROUP BY link),
user_hist AS (SELECT link, {USER_COLUMNS}, {VERIFIED_GROUPS} FROM user_bins GROUP BY link),
vectors AS (SELECT * FROM text_hist JOIN user_hist USING (link))
"""
_VECTOR_ITEMS = [f"text_{i}" for i in range(12)] + [f"user_{i}" for i in range(23)] + ["retweets"]
VECTOR_LIST = "[" + ", ".join(_VECTOR_ITEMS) + "]"

LABELS = """
docs_rated AS (
  SELECT d.doc_id, d.source, d.lang, l.quality
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
news_labels AS (
  SELECT 'https://' || source || '.example/' || lang AS news_url,
         CASE WHEN min(doc_id) % 3 = 0 THEN 'fake' ELSE 'real' END AS credibility
  FROM docs_rated GROUP BY source, lang
  UNION ALL
  SELECT 'https://story.example/' || CAST(doc_id // 4 AS VARCHAR),
         CASE min(quality) WHEN 0 THEN 'fake' WHEN 1 THEN 'real' END
  FROM docs_rated GROUP BY doc_id // 4)
"""

LABELED = f"""{LABELS},
labeled AS (
  SELECT n.news_url AS link, n.credibility AS label, v.* EXCLUDE (link)
  FROM news_labels n JOIN vectors v ON v.link = n.news_url WHERE n.credibility IS NOT NULL)
"""

HASH = "CAST('0x' || substr(md5('3:' || {key}), 1, 8) AS BIGINT)"
IS_TEST = HASH + " < 858993459.2"

STATUS_USERS = f"""{EVENT_USERS},
status_users AS (
  SELECT CAST(event_id AS VARCHAR) AS tweetid, user_id AS userid, c_name AS user_name,
         lower(c_name) AS screen_name, followers AS followers_count, friends AS friends_count,
         event_id % 5 AS listed_count,
         strftime(ts, '%a %b %d %H:%M:%S +0000 %Y') AS created_at, k * 3 AS favourites_count,
         is_verified AS verified, {STATUS_COUNT} AS statuses_count,
         event_id % 4 = 0 AS default_profile, event_id % 9 = 0 AS default_profile_image
  FROM event_users WHERE has_user)
"""

PREDICTIONS = """
predictions AS (
  SELECT 'link/' || CAST(v.vec_id AS VARCHAR) AS link, m.model,
         CASE WHEN (v.vec_id * 7 + v.label * m.k) % 5 < 2 THEN 'fake' ELSE 'real' END AS prediction
  FROM embeddings v CROSS JOIN (VALUES ('knn', 1), ('lr', 2), ('decisionTree', 3),
    ('randomForest', 4), ('naiveBayes', 6), ('sgd', 7), ('xgb', 8)) AS m(model, k)),
votes AS (
  SELECT link, CAST(count(*) FILTER (WHERE prediction = 'fake') AS BIGINT) AS fake_votes,
         CAST(count(*) FILTER (WHERE prediction = 'real') AS BIGINT) AS real_votes
  FROM predictions GROUP BY link),
verdicts AS (
  SELECT *, CASE WHEN fake_votes > real_votes THEN 'fake' ELSE 'real' END AS credibility
  FROM votes)
"""

KNN = f"""
vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CAST(label AS VARCHAR) AS label,
                   {IS_TEST.format(key="CAST(vec_id AS VARCHAR)")} AS is_test FROM embeddings),
pairs AS (
  SELECT q.vec_id, q.label, t.vec_id AS near_id, t.label AS near_label,
         list_sum(list_transform(list_zip(q.v, t.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))
           AS distance
  FROM vectors q JOIN vectors t ON q.is_test AND NOT t.is_test),
nearest AS (
  SELECT vec_id, label, near_label AS prediction FROM pairs
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, near_id) = 1)
"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(part.strip().rstrip(",") for part in parts) + "\n" + select


POSTS_TO_BINS = (RAW_POSTS, DEDUPED_POSTS, SCORES)
POSTS_TO_JOIN = (RAW_POSTS, USERS, DEDUPED_POSTS, DEDUPED_USERS, JOINED)
ALL_FEATURES = (RAW_POSTS, USERS, DEDUPED_POSTS, SCORES, DEDUPED_USERS, JOINED, COMPAT, VECTORS)
PARITY_COLUMNS = "link, " + ", ".join(_VECTOR_ITEMS)


# Labelled links by side of the split; the rows asked about are the held-out ones, or all links.
# ceil(0.2 n) rows in all, each label's part by largest remainder, the first in hash order.
QUOTAS = """
sizes AS (SELECT label, count(*) AS n FROM {rows} GROUP BY label),
dealt AS (SELECT label, n, CAST(ceil(sum(n) OVER () * 0.2) AS BIGINT) AS wanted, sum(n) OVER () AS total FROM sizes),
parts AS (SELECT *, n * wanted // total AS floor_, n * wanted % total AS rest FROM dealt),
quotas AS (SELECT label, floor_ + CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
  <= wanted - sum(floor_) OVER () THEN 1 ELSE 0 END AS quota FROM parts)
"""
STRATIFIED = (
    "row_number() OVER (PARTITION BY label ORDER BY " + HASH.format(key="link") + ", link) <= quota"
)
SIDES = f"""{QUOTAS.format(rows="labeled")},
sides AS (SELECT link, label, {VECTOR_LIST} AS x, {STRATIFIED} AS is_test
          FROM labeled JOIN quotas USING (label)),
train AS (SELECT link, label, x FROM sides WHERE NOT is_test)
"""
SCORED = """SELECT g.link, n.prediction AS knn, g.prediction AS naiveBayes,
  CAST(n.prediction = 'fake' AS BIGINT) + CAST(g.prediction = 'fake' AS BIGINT) AS fake_votes,
  CAST(n.prediction = 'real' AS BIGINT) + CAST(g.prediction = 'real' AS BIGINT) AS real_votes,
  CASE WHEN n.prediction = 'fake' AND g.prediction = 'fake' THEN 'fake' ELSE 'real' END
    AS credibility
  FROM gaussian g JOIN nearest_link n ON n.link = g.link"""
# Every right model gives these rows their label.
MARGIN = f"""
margin AS (SELECT 'e' || event_id AS link, CASE WHEN event_id % 3 = 0 THEN 'fake' ELSE 'real' END AS label FROM events),
{QUOTAS.format(rows="margin")},
margin_test AS (SELECT link, label FROM margin JOIN quotas USING (label) QUALIFY {STRATIFIED})
"""
# One row in eleven has the other label; a right model gives all rows of a field the label of most.
OVERLAP = f"""
overlap_fields AS (SELECT 'e' || event_id AS link, event_id % 11 = 0 AS odd,
  (event_id % 6 < 2) <> (event_id // 6 % 6 < 4) AS fake FROM events),
overlap AS (SELECT link, CASE WHEN fake <> odd THEN 'fake' ELSE 'real' END AS label,
  CASE WHEN fake THEN 'fake' ELSE 'real' END AS prediction FROM overlap_fields),
{QUOTAS.format(rows="overlap")},
overlap_test AS (SELECT link, label, prediction FROM overlap JOIN quotas USING (label) QUALIFY {STRATIFIED})
"""
# One row in eleven has the other label; the plane through the middle is the best one can do.
PLANE = f"""
plane_sides AS (SELECT 'e' || event_id AS link, event_id % 11 = 0 AS odd,
  event_id % 6 * 2 + event_id // 6 % 6 * 2 + event_id // 36 % 6 * 2 - 15 > 0 AS fake FROM events),
plane AS (SELECT link, CASE WHEN fake <> odd THEN 'fake' ELSE 'real' END AS label,
  CASE WHEN fake THEN 'fake' ELSE 'real' END AS prediction FROM plane_sides),
{QUOTAS.format(rows="plane")},
plane_test AS (SELECT link, label, prediction FROM plane JOIN quotas USING (label) QUALIFY {STRATIFIED})
"""
MODELS = "(SELECT unnest(['knn', 'lr', 'decisionTree', 'randomForest', 'naiveBayes', 'sgd', 'xgb']) AS model)"
HELD_OUT = "asked AS (SELECT link, label, x FROM sides WHERE is_test)"
ALL_LINKS = f"""
asked AS (SELECT link, CAST(NULL AS VARCHAR) AS label, {VECTOR_LIST} AS x FROM vectors)
"""

# Gaussian naive Bayes over the 36 features: mean and variance per class, every variance raised
# by 1e-9 of the largest feature variance, then the class of the highest log-likelihood.
GAUSSIAN = """
train_items AS (SELECT label, unnest(range(36)) AS j, CAST(unnest(x) AS DOUBLE) AS v FROM train),
asked_items AS (SELECT link, label, unnest(range(36)) AS j, CAST(unnest(x) AS DOUBLE) AS v
                FROM asked),
spread AS (SELECT max(var) AS widest FROM (
  SELECT avg(v * v) - avg(v) * avg(v) AS var FROM train_items GROUP BY j)),
params AS (
  SELECT label, j, avg(v) AS mean, avg(v * v) - avg(v) * avg(v) + 1e-9 * any_value(widest) AS var
  FROM train_items, spread GROUP BY label, j),
priors AS (
  SELECT label, ln(count(*)) - ln(sum(count(*)) OVER ()) AS prior
  FROM train GROUP BY label),
likelihoods AS (
  SELECT i.link, i.label, p.label AS class,
         any_value(r.prior) - sum(ln(p.var)) / 2 - sum((i.v - p.mean) ** 2 / p.var) / 2 AS ll
  FROM asked_items i JOIN params p ON p.j = i.j JOIN priors r ON r.label = p.label
  GROUP BY 1, 2, 3),
gaussian AS (
  SELECT link, label, arg_max(class, ll) AS prediction FROM likelihoods GROUP BY 1, 2)
"""

# Nearest labelled link by squared distance, the smaller link on ties; repeats of a vector
# cannot matter, as the smallest link among them wins either way.
NEAREST_LINK = """
link_pairs AS (
  SELECT q.link, q.label, t.link AS near_link, t.label AS near_label,
         list_sum(list_transform(list_zip(q.x, t.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))
           AS distance
  FROM asked q CROSS JOIN train t),
nearest_link AS (
  SELECT link, label, near_label AS prediction FROM link_pairs
  QUALIFY row_number() OVER (PARTITION BY link ORDER BY distance, near_link) = 1)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "clean_text": "SELECT doc_id, " + CLEAN.format(text="text") + " AS clean FROM documents",
        "posts_prepared": _with(
            RAW_POSTS, select="SELECT link, tweet_id, text, retweets FROM posts"
        ),
        "users_prepared": _with(
            USERS,
            select="""SELECT tweetid, CAST(followers_count AS INT) AS followers_count,
              CAST(friends_count AS INT) AS friends_count, CAST(account_age AS INT) AS account_age,
              verified, CAST(statuses_count AS INT) AS statuses_count FROM users""",
        ),
        "dedupe_posts": _with(RAW_POSTS, DEDUPED_POSTS, select="SELECT * FROM deduped_posts"),
        "dedupe_users": _with(USERS, DEDUPED_USERS, select="SELECT * FROM deduped_users"),
        "sentiment_scores": _with(
            *POSTS_TO_BINS, select="SELECT link, tweet_id, polarity, subjectivity FROM binned"
        ),
        "sentiment_context": _with(
            RAW_POSTS, DEDUPED_POSTS, CONTEXT_SCORES,
            select="SELECT link, tweet_id, polarity, subjectivity FROM binned",
        ),
        "feature_vector_context": _with(
            RAW_POSTS, USERS, DEDUPED_POSTS, CONTEXT_SCORES, DEDUPED_USERS, JOINED, COMPAT, VECTORS,
            select=f"SELECT {PARITY_COLUMNS} FROM vectors",
        ),
        "sentiment_bins": _with(
            *POSTS_TO_BINS,
            select="SELECT link, tweet_id, sentiment_bin, subjectivity_bin FROM binned",
        ),
        "sentiment_groups": _with(
            *POSTS_TO_BINS,
            select="""SELECT link, sentiment_bin, subjectivity_bin,
              CAST(count(*) AS BIGINT) AS posts FROM binned GROUP BY 1, 2, 3""",
        ),
        "text_histogram": _with(
            *POSTS_TO_BINS, select=f"SELECT link, {TEXT_COLUMNS} FROM binned GROUP BY link"
        ),
        "retweet_total": _with(
            RAW_POSTS,
            DEDUPED_POSTS,
            select="""SELECT link, CAST(sum(coalesce(retweets, 0)) AS BIGINT) AS retweets
              FROM deduped_posts GROUP BY link""",
        ),
        "join_posts_users": _with(*POSTS_TO_JOIN, select="SELECT * FROM joined"),
        "user_ratios": _with(
            *POSTS_TO_JOIN,
            COMPAT,
            select="SELECT link, tweet_id, verified, follower_ratio, activity FROM user_bins",
        ),
        "user_bins": _with(
            *POSTS_TO_JOIN,
            COMPAT,
            select="""SELECT link, tweet_id, CAST(verified AS INT) AS verified, ratio_bin,
              activity_bin FROM user_bins""",
        ),
        "user_groups": _with(
            *POSTS_TO_JOIN,
            COMPAT,
            select="""SELECT link, CAST(verified AS INT) AS verified, ratio_bin, activity_bin,
              CAST(count(*) AS BIGINT) AS posts FROM user_bins GROUP BY 1, 2, 3, 4""",
        ),
        "user_histogram_compat": _with(
            *POSTS_TO_JOIN,
            COMPAT,
            select=f"SELECT link, {USER_COLUMNS}, {VERIFIED_GROUPS} FROM user_bins GROUP BY link",
        ),
        "user_histogram_by_age": _with(
            *POSTS_TO_JOIN,
            BY_AGE,
            select=f"SELECT link, {USER_COLUMNS}, {VERIFIED_COUNT} FROM user_bins GROUP BY link",
        ),
        "verified_share": _with(
            *POSTS_TO_JOIN,
            select="""SELECT link, CAST(count(*) FILTER (WHERE verified) AS BIGINT) AS verified,
              CAST(count(*) AS BIGINT) AS authors, avg(CAST(verified AS DOUBLE)) AS share
              FROM joined GROUP BY link""",
        ),
        "feature_vector": _with(*ALL_FEATURES, select=f"SELECT {PARITY_COLUMNS} FROM vectors"),
        "feature_vector_spread": _with(
            *ALL_FEATURES, select=f"SELECT {PARITY_COLUMNS} FROM vectors"
        ),
        "merge_arrays": _with(
            *POSTS_TO_BINS,
            select=f"""SELECT split_part(link, '/', 3) AS host, {TEXT_COLUMNS}
              FROM binned GROUP BY 1""",
        ),
        "posts_for_links": _with(
            RAW_POSTS,
            LABELS,
            select="""SELECT * FROM posts WHERE link IN (
              SELECT news_url FROM news_labels WHERE credibility = 'fake')""",
        ),
        "lookup_users": _with(
            RAW_POSTS,
            STATUS_USERS,
            select="SELECT * FROM status_users WHERE tweetid IN (SELECT tweet_id FROM posts)",
        ),
        "flatten_status": _with(
            STATUS_USERS,
            select="""SELECT CAST(e.event_id AS VARCHAR) AS tweetid, s.* EXCLUDE (tweetid)
              FROM event_users e LEFT JOIN status_users s
                ON s.tweetid = CAST(e.event_id AS VARCHAR)""",
        ),
        "account_age": _with(
            EVENT_USERS,
            select="""SELECT CAST(event_id AS VARCHAR) AS tweetid,
              CAST(floor((epoch(TIMESTAMP '2024-02-01 00:00:00')
                - epoch(date_trunc('second', ts))) / 86400) AS BIGINT) AS account_age
              FROM event_users WHERE has_user""",
        ),
        "parse_int_list": _with(
            *POSTS_TO_BINS, select=f"SELECT link, {TEXT_COLUMNS} FROM binned GROUP BY link"
        ),
        "csv_posts_roundtrip": _with(
            RAW_POSTS,
            select=f"""SELECT * REPLACE ({CLEAN.format(text="text")} AS text,
              strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date) FROM raw_posts""",
        ),
        "csv_users_roundtrip": _with(STATUS_USERS, select="SELECT * FROM status_users"),
        "csv_features_roundtrip": _with(
            *ALL_FEATURES, select=f"SELECT {PARITY_COLUMNS} FROM vectors"
        ),
        "feature_store": _with(
            *ALL_FEATURES, LABELED, select=f"SELECT {PARITY_COLUMNS}, label FROM labeled"
        ),
        "posts_for_links_late": _with(
            RAW_POSTS,
            LABELS,
            select="""SELECT * FROM posts WHERE link IN (
              SELECT news_url FROM news_labels WHERE credibility = 'fake')""",
        ),
        "labels_scan": _with(
            LABELS,
            select="""SELECT news_url, coalesce(credibility, 'nan') AS credibility
              FROM news_labels""",
        ),
        "text_scan": """SELECT
            CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS lines,
            CAST(sum(length(replace(text, chr(10), ''))) AS BIGINT) AS chars FROM documents""",
        "union_sources": _with(
            RAW_POSTS,
            USERS,
            select="""SELECT source, tweet_id, CAST(count(*) AS BIGINT) AS n FROM (
              SELECT 'news' AS source, tweet_id FROM posts
              UNION ALL SELECT 'users', tweetid FROM repeated_users) GROUP BY 1, 2""",
        ),
        "labeled_features": _with(
            *ALL_FEATURES, LABELED, select=f"SELECT {PARITY_COLUMNS}, label FROM labeled"
        ),
        "stratified_split": _with(
            *ALL_FEATURES, LABELED, SIDES, select="SELECT link, label, is_test FROM sides"
        ),
        "hash_split": _with(
            *ALL_FEATURES,
            LABELED,
            select=f"SELECT link, label, {IS_TEST.format(key='link')} AS is_test FROM labeled",
        ),
        "training_cap": _with(
            *ALL_FEATURES,
            LABELED,
            select=f"""SELECT link, label FROM labeled
              ORDER BY {HASH.format(key='link')}, link LIMIT 100""",
        ),
        "knn_1": _with(KNN, select="SELECT vec_id, label, prediction FROM nearest"),
        "model_accuracy": _with(
            KNN,
            select="""SELECT 'knn' AS model, avg(CAST(prediction = label AS DOUBLE)) AS accuracy
              FROM nearest""",
        ),
        "majority_vote": _with(PREDICTIONS, select="SELECT * FROM verdicts"),
        "verdict": _with(
            PREDICTIONS,
            select="""SELECT v.*, m.* EXCLUDE (link) FROM verdicts v JOIN (
              SELECT link,
                max(prediction) FILTER (WHERE model = 'knn') AS knn,
                max(prediction) FILTER (WHERE model = 'lr') AS lr,
                max(prediction) FILTER (WHERE model = 'decisionTree') AS decisionTree,
                max(prediction) FILTER (WHERE model = 'randomForest') AS randomForest,
                max(prediction) FILTER (WHERE model = 'naiveBayes') AS naiveBayes,
                max(prediction) FILTER (WHERE model = 'xgb') AS xgb
              FROM predictions GROUP BY link) m ON m.link = v.link""",
        ),
        "predict_gaussian_nb": _with(
            *ALL_FEATURES, LABELED, SIDES, HELD_OUT, GAUSSIAN, select="SELECT * FROM gaussian"
        ),
        "predict_knn": _with(
            *ALL_FEATURES,
            LABELED,
            SIDES,
            HELD_OUT,
            NEAREST_LINK,
            select="SELECT * FROM nearest_link",
        ),
        "hold_out_accuracy": _with(
            *ALL_FEATURES,
            LABELED,
            SIDES,
            HELD_OUT,
            GAUSSIAN,
            select="""SELECT 'naiveBayes' AS model,
              avg(CAST(prediction = label AS DOUBLE)) AS accuracy FROM gaussian""",
        ),
        "score_links_for": _with(
            *ALL_FEATURES,
            LABELED,
            SIDES,
            ALL_LINKS,
            GAUSSIAN,
            NEAREST_LINK,
            select=SCORED
            + " WHERE g.link IN (SELECT news_url FROM news_labels WHERE credibility = 'fake')",
        ),
        "margin_tree": _with(MARGIN, select="SELECT link, label, label AS prediction FROM margin_test"),
        "margin_forest": _with(MARGIN, select="SELECT link, label, label AS prediction FROM margin_test"),
        "margin_logistic": _with(MARGIN, select="SELECT link, label, label AS prediction FROM margin_test"),
        "margin_linear_svc": _with(MARGIN, select="SELECT link, label, label AS prediction FROM margin_test"),
        "margin_gbt": _with(MARGIN, select="SELECT link, label, label AS prediction FROM margin_test"),
        "overlap_tree": _with(OVERLAP, select="SELECT * FROM overlap_test"),
        "overlap_forest": _with(OVERLAP, select="SELECT * FROM overlap_test"),
        "overlap_gbt": _with(OVERLAP, select="SELECT * FROM overlap_test"),
        "plane_linear_sgd": _with(PLANE, select="SELECT * FROM plane_test"),
        "margin_all_predictions": _with(
            MARGIN,
            select=f"SELECT link, label, model, label AS prediction FROM margin_test, {MODELS}",
        ),
        "margin_accuracy_table": f"SELECT model, 1.0::DOUBLE AS accuracy, model <> 'sgd' AS reported FROM {MODELS}",
        "margin_verdicts": _with(
            MARGIN,
            select="""SELECT link, label AS credibility,
              CASE WHEN label = 'fake' THEN 7 ELSE 0 END::BIGINT AS fake_votes,
              CASE WHEN label = 'real' THEN 7 ELSE 0 END::BIGINT AS real_votes,
              label AS knn, label AS lr, label AS "decisionTree", label AS "randomForest",
              label AS "naiveBayes", label AS xgb FROM margin""",
        ),
        "csv_prepared_users_roundtrip": _with(
            STATUS_USERS,
            select="""SELECT u.* EXCLUDE (created_at),
              CAST(floor((epoch(TIMESTAMP '2024-02-01 00:00:00')
                - epoch(date_trunc('second', e.ts))) / 86400) AS INT) AS account_age
              FROM status_users u JOIN event_users e ON u.tweetid = CAST(e.event_id AS VARCHAR)""",
        ),
        "score_links_knn_nb": _with(
            *ALL_FEATURES,
            LABELED,
            SIDES,
            ALL_LINKS,
            GAUSSIAN,
            NEAREST_LINK,
            select=SCORED,
        ),
    }
