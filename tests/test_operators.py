from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from newslens.functions.lexicon import lexicon_table
from newslens.operators import accounts, histograms, nearest, sampling, skew, votes
from newslens.operators.dedupe import dedupe_posts, dedupe_users
from newslens.operators.labels import label_features
from newslens.operators.nearest import fit_nearest
from newslens.operators.sentiment import score_sentiment
from newslens.plans.features import assemble, link_features

POSTS = "link string, tweet_id string, text string, retweets int"
USERS = (
    "tweetid string, followers_count int, friends_count int, account_age int, "
    "verified boolean, statuses_count int"
)
LEXICON = [("good", 50, 60), ("bad", -50, 60), ("fact", 0, 0), ("perfect", 100, 100)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made_posts(seed=0, n=300):
    rng = random.Random(seed)
    words = ["good", "bad", "fact", "perfect", "x", "@a", "http://u.v/w"]
    out = []
    for _ in range(n):
        tweet = "hot" if rng.random() < 0.35 else f"t{rng.randrange(60)}"
        link = "viral" if rng.random() < 0.35 else f"l{rng.randrange(40)}"
        text = None if rng.random() < 0.1 else " ".join(rng.choices(words, k=rng.randrange(6)))
        out.append((link, tweet, text, rng.choice([None, 0, 1, 7])))
    return out


def made_users(seed=0):
    rng = random.Random(seed)
    ids = ["hot", *[f"t{i}" for i in range(0, 60, 2)]]
    return [
        (i, rng.choice([None, 0, 3, 90]), rng.choice([None, 0, 4]), rng.choice([None, 2, 9]),
         rng.choice([None, True, False]), rng.choice([None, 1, 12]))
        for i in ids for _ in range(rng.choice([1, 1, 2]))
    ]


def model_features(posts, users, age=False):
    """The feature rules once more, row by row in plain Python."""
    low = lambda v: (v is not None, v if v is not None else 0)
    import hashlib

    digest = lambda t: "" if t is None else hashlib.md5(t.encode()).hexdigest()
    kept = {}
    for link, tweet, text, retweets in posts:
        rank = (low(retweets), (text is not None, digest(text)))
        if (link, tweet) not in kept or rank < kept[link, tweet][0]:
            kept[link, tweet] = (rank, text, retweets)
    people = {}
    for tweet, *fields in users:
        rank = tuple(low(f) for f in fields)
        if tweet not in people or rank < people[tweet][0]:
            people[tweet] = (rank, [f or 0 for f in fields])
    scores = {w: (p, s) for w, p, s in LEXICON}
    text_bins = defaultdict(lambda: [0] * 12)
    user_bins = defaultdict(lambda: [0] * 22)
    groups, totals = defaultdict(set), Counter()
    for (link, tweet), (_, text, retweets) in kept.items():
        found = [scores[w] for w in (text or "none").split() if w in scores]
        p = sum(f[0] for f in found) / (100 * len(found)) if found else 0.0
        s = sum(f[1] for f in found) / (100 * len(found)) if found else 0.0
        text_bins[link][int((p + 1) * 2.5)] += 1
        text_bins[link][6 + int(s * 5)] += 1
        totals[link] += retweets or 0
        if tweet in people:
            followers, friends, days, verified, statuses = people[tweet][1]
            ratio = min(10, int(followers / (1 + friends) * 2))
            level = min(10, int(statuses / (1 + (days if age else int(verified)))))
            user_bins[link][ratio] += 1
            user_bins[link][11 + level] += 1
            if verified:
                groups[link].add((ratio, level))
    return sorted(
        (link, text_bins[link] + user_bins[link] + [len(groups[link]), totals[link]])
        for link in user_bins
    )


@pytest.fixture
def tables(spark):
    def make(posts, users):
        return (
            spark.createDataFrame(posts, POSTS).repartition(5),
            spark.createDataFrame(users, USERS).repartition(3),
            lexicon_table(spark, LEXICON),
        )

    return make


@pytest.mark.parametrize("activity", ["compat", "age"])
def test_features_equal_row_by_row_model(tables, activity):
    posts, users = made_posts(), made_users()
    got = assemble(link_features(*tables(posts, users), activity=activity)).collect()
    assert sorted((r.link, r.features) for r in got) == model_features(
        posts, users, activity == "age"
    )


def test_features_without_any_broadcast_and_with_hot_keys(tables, no_broadcast):
    posts, users = made_posts(1), made_users(1)
    got = assemble(link_features(*tables(posts, users), piece_rows=5)).collect()
    assert sorted((r.link, r.features) for r in got) == model_features(posts, users)


def test_order_and_partitions_change_nothing(spark, tables):
    posts, users = made_posts(2), made_users(2)
    first = rows(assemble(link_features(*tables(posts, users))))
    random.Random(9).shuffle(posts)
    random.Random(9).shuffle(users)
    p, u, lex = tables(posts, users)
    assert rows(assemble(link_features(p.repartition(1), u.repartition(7), lex))) == first


def test_bins_add_up(tables):
    p, u, lex = tables(made_posts(3), made_users(3))
    joined = {r.link: r.n for r in accounts.join_posts_users(p, u).groupBy("link").agg(
        F.count("*").alias("n")).collect()}
    kept = {r.link: r.n for r in dedupe_posts(p).groupBy("link").agg(
        F.count("*").alias("n")).collect()}
    for r in link_features(p, u, lex).collect():
        assert sum(r.textFeatures) == 2 * kept[r.link]
        assert sum(r.userFeatures[:11]) == sum(r.userFeatures[11:22]) == joined[r.link]


def test_no_user_no_link(tables):
    posts = [("a", "1", "good", 1), ("a", "2", "bad", None), ("b", "9", "good", 3)]
    users = [("1", 10, 0, 5, True, 9)]
    assert rows(link_features(*tables(posts, users)).select("link")) == [("a",)]
    assert rows(link_features(*tables([], users))) == []


def test_post_under_two_links_counts_its_author_twice(tables):
    posts = [("a", "1", "good", 1), ("b", "1", "good", 1), ("a", "2", "good", 1)]
    p, u, _ = tables(posts, [("1", 10, 0, 5, None, 9)])
    got = accounts.join_posts_users(p, u).select("link", "tweet_id", "verified")
    assert rows(got) == [("a", "1", False), ("b", "1", False)]


def test_verified_slot(tables):
    posts = [("a", str(i), "x", 0) for i in range(4)]
    users = [("0", 0, 0, 0, True, 1), ("1", 0, 0, 0, True, 1), ("2", 9, 0, 0, True, 30),
             ("3", 9, 0, 0, False, 30)]
    p, u, lex = tables(posts, users)
    slots = {
        mode: link_features(p, u, lex, verified=mode).first().userFeatures[22]
        for mode in histograms.VERIFIED_MODES
    }
    assert slots == {"groups": 2, "count": 3}
    share = histograms.verified_share(accounts.join_posts_users(p, u)).first()
    assert (share.verified, share.authors, share.share) == (3, 4, 0.75)


def test_all_verified_pairs_are_told_apart(spark):
    pairs = [("a", r, s, True) for r in range(11) for s in range(11)] * 2
    df = spark.createDataFrame(pairs, "link string, ratio_bin int, activity_bin int, verified boolean")
    assert histograms.user_histogram(df).first().userFeatures[22] == 121


def test_unknown_modes_are_refused(tables):
    p, u, lex = tables(made_posts(n=3), made_users())
    with pytest.raises(ValueError):
        link_features(p, u, lex, activity="other")
    with pytest.raises(ValueError):
        link_features(p, u, lex, verified="other")


def test_dedupe_keeps_the_same_row_always(spark):
    posts = [("a", "1", "z", None), ("a", "1", "y", 0), ("a", "1", None, None), ("b", "1", "y", 2)]
    df = spark.createDataFrame(posts, POSTS)
    assert rows(dedupe_posts(df.repartition(4))) == [("a", "1", None, None), ("b", "1", "y", 2)]
    users = [("1", 5, 1, 1, True, 1), ("1", 4, 9, 9, True, 9), ("2", None, 1, 1, None, 1)]
    got = rows(dedupe_users(spark.createDataFrame(users, USERS).repartition(4)))
    assert got == [("1", 4, 9, 9, True, 9), ("2", None, 1, 1, None, 1)]


def test_scores(spark):
    texts = [("1", "good bad good"), ("2", "nothing here"), ("3", None), ("4", "")]
    df = spark.createDataFrame(texts, "id string, text string")
    got = rows(score_sentiment(df, lexicon_table(spark, LEXICON), ["id"]))
    assert got == [("1", 50 / 300, 180 / 300), ("2", 0.0, 0.0), ("3", 0.0, 0.0), ("4", 0.0, 0.0)]


def test_scores_of_repeated_rows_and_shuffled_lexicon(spark, no_broadcast):
    texts = [("1", "good bad good good")] * 50 + [("2", "bad x")] * 3
    df = spark.createDataFrame(texts, "id string, text string")
    got = rows(score_sentiment(df, lexicon_table(spark, LEXICON), ["id"]))
    assert got == [("1", 0.25, 0.6), ("2", -0.5, 0.6)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join(spark, no_broadcast, how):
    big = [("hot", i) for i in range(400)] + [(f"k{i % 50}", i) for i in range(100)] + [(None, 1)]
    small = [("hot", "H")] + [(f"k{i}", f"v{i}") for i in range(0, 50, 2)]
    b = spark.createDataFrame(big, "key string, n int").repartition(4)
    s = spark.createDataFrame(small, "key string, v string")
    got = skew.spread_join(b, s, "key", ["n"], how=how, piece_rows=10)
    assert got.columns == ["key", "n", "v"]
    lookup = dict(small)
    want = [(k, n, lookup.get(k)) for k, n in big if how == "left" or k in lookup]
    assert rows(got) == sorted(want, key=repr)
    hot = skew.hot_keys(b, "key", 10).collect()
    assert [(r.key, r.pieces) for r in hot] == [("hot", 40)]


def test_spread_join_refuses_other_kinds(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        skew.spread_join(df, df, "id", ["id"], how="right")


@pytest.mark.parametrize("piece_rows", [3, 1_000_000])
def test_labels_multiply_and_spread(spark, no_broadcast, piece_rows):
    labels = [("hot", "fake")] * 20 + [("hot", "real")] + [("a", "real"), ("a", None), ("z", "fake")]
    vectors = spark.createDataFrame(
        [("hot", [1]), ("a", [2]), ("other", [3])], "link string, features array<bigint>"
    )
    table = spark.createDataFrame(labels, "news_url string, credibility string").repartition(3)
    got = Counter(
        (r.link, r.label, tuple(r.features))
        for r in label_features(vectors, table, piece_rows=piece_rows).collect()
    )
    want = {("hot", "fake", (1,)): 20, ("hot", "real", (1,)): 1, ("a", "real", (2,)): 1}
    assert got == want
    kept = label_features(vectors, table, keep_missing=True)
    assert rows(kept.where("link = 'a'").select("label")) == [("nan",), ("real",)]


def split_sides(df):
    return {r.link: r.is_test for r in df.collect()}


def test_split(spark):
    data = [(f"l{i}", "fake" if i % 4 == 0 else "real") for i in range(2000)]
    df = spark.createDataFrame(data, "link string, label string")
    sides = split_sides(sampling.hash_split(df))
    assert 0.17 < sum(sides.values()) / 2000 < 0.23
    assert split_sides(sampling.hash_split(df.repartition(7))) == sides
    exact = sampling.stratified_split(df)
    counts = {(r.label, r.is_test): r["count"] for r in exact.groupBy("label", "is_test").count().collect()}
    assert counts == {("fake", True): 100, ("fake", False): 400,
                      ("real", True): 300, ("real", False): 1200}
    assert split_sides(sampling.stratified_split(df.repartition(5))) == split_sides(exact)


def test_split_rounds_in_total_and_takes_any_number_of_labels(spark):
    data = [(f"l{i}", f"c{i % 1500}") for i in range(3007)] + [(f"n{i}", None) for i in range(10)]
    df = spark.createDataFrame(data, "link string, label string")
    sides = sampling.stratified_split(df).groupBy("label").agg(
        F.count_if("is_test").alias("test"), F.count("*").alias("n")
    ).collect()
    assert sum(r.test for r in sides) == 604
    assert all(abs(r.test - r.n * 604 / 3017) < 1 for r in sides)
    assert sampling.stratified_split(df.limit(0)).count() == 0


def test_split_keeps_repeats_together(spark):
    data = [("hot", "fake")] * 500 + [(f"l{i}", "fake") for i in range(500)]
    df = spark.createDataFrame(data, "link string, label string").repartition(6)
    sides = sampling.stratified_split(df).groupBy("link").agg(
        F.count_distinct("is_test").alias("sides")
    )
    assert sides.where("sides > 1").count() == 0


def test_cap(spark):
    data = [(f"l{i}", "real") for i in range(50)]
    df = spark.createDataFrame(data, "link string, label string").repartition(4)
    capped = sampling.cap_rows(df, 20)
    assert capped.count() == 20
    assert rows(sampling.cap_rows(df.repartition(9), 20)) == rows(capped)
    assert set(rows(sampling.cap_rows(df, 10))) < set(rows(capped))
    assert sampling.cap_rows(df, 500).count() == 50
    assert sampling.cap_rows(df.limit(0), 5).count() == 0


@pytest.mark.parametrize("n", [1, 30, 60, 95, 99])
def test_cap_inside_repeats(spark, n):
    data = [("hot", "fake")] * 60 + [("hot", "real")] * 5 + [(f"l{i}", "real") for i in range(34)]
    df = spark.createDataFrame(data, "link string, label string").repartition(4)
    assert sampling.cap_rows(df, n).count() == n
    assert rows(sampling.cap_rows(df.repartition(2), n)) == rows(sampling.cap_rows(df, n))


def brute_force(train, queries):
    out = {}
    for key, vector in queries:
        best = min(train, key=lambda r: (sum((a - b) ** 2 for a, b in zip(r[1], vector)), r[0]))
        out[key] = best[2]
    return out


def test_nearest_equals_brute_force(spark):
    rng = random.Random(5)
    vec = lambda: [rng.randrange(6) for _ in range(5)]
    train = [(i, vec(), f"c{i % 7}") for i in range(300)]
    train += [(1000 + i, [9, 9, 9, 9, 9], f"c{i % 7}") for i in range(200)]
    queries = [(f"q{i}", vec()) for i in range(250)] + [(f"h{i}", [9, 9, 9, 9, 8]) for i in range(120)]
    schema = "id bigint, features array<bigint>, label string"
    rows_ = [*train, (5000, None, "c1")]
    model = fit_nearest(spark.createDataFrame(rows_, schema))
    asked = spark.createDataFrame([*queries, ("none", None)], "link string, features array<bigint>").repartition(4)
    got = {r.link: r.prediction for r in model.predict(asked).collect()}
    assert got == brute_force(train, queries) | {"none": None}


def test_nearest_on_real_valued_vectors(spark):
    rng = random.Random(6)
    train = [(i, [rng.gauss(0, 1) for _ in range(8)], f"c{i}") for i in range(400)]
    queries = [(f"q{i}", [rng.gauss(0, 2) for _ in range(8)]) for i in range(150)]
    schema = "id bigint, features array<double>, label string"
    asked = spark.createDataFrame(queries, "link string, features array<double>")
    model = fit_nearest(spark.createDataFrame(train, schema))
    got = {r.link: r.prediction for r in model.predict(asked).collect()}
    assert got == brute_force(train, queries)
    few = fit_nearest(spark.createDataFrame(train, schema), max_train_rows=40)
    assert few.train.count() == 40
    empty = fit_nearest(spark.createDataFrame([], schema))
    assert {r.prediction for r in empty.predict(asked).collect()} == {None}


def test_nearest_of_a_large_table_meets_in_blocks(spark, monkeypatch):
    """The same labels as from the table that every worker holds, whatever the vectors hold."""
    rng = random.Random(7)
    vec = lambda: [float(rng.randrange(5)) for _ in range(4)]
    train = [(2**60 + i, vec(), f"c{i}") for i in range(300)] + [(None, [9.0, 9.0, 9.0, 9.5], "null id"), (7, [8.0] * 4, None)]
    asked = [(f"q{i}", [x + rng.choice([0, 0, 0.5]) for x in vec()]) for i in range(200)]
    asked += [("hot", [9.0] * 4)] * 30 + [("none", None), ("far", [8.5, 8.0, 8.0, 8.0]), ("odd", [float("nan"), 0.0, 0.0, 0.0])]
    schema = "id bigint, features array<double>, label string"
    queries = spark.createDataFrame(asked, "link string, features array<double>")
    for more in ([], [(2**61 + 1, [float("nan"), 1.0, 1.0, 1.0], "odd"), (2**61, [1.0, float("nan"), 1.0, 1.0], "first odd")]):
        model = fit_nearest(spark.createDataFrame(train + more, schema))
        table = sorted(model.predict(queries).select("link", "prediction").collect(), key=repr)
        assert "MapInArrow" not in model.predict(queries)._jdf.queryExecution().toString()
        with monkeypatch.context() as small:
            small.setattr(nearest, "TABLE_ROWS", 20)
            small.setattr(nearest, "BLOCK_ROWS", 50)
            blocks = model.predict(queries)
            assert blocks.columns == ["link", "features", "prediction"]
            assert sorted(blocks.select("link", "prediction").collect(), key=repr) == table


def made_votes(spark, counts):
    data = [
        (link, model, label)
        for link, labels in counts.items()
        for model, label in zip(["knn", "lr", "decisionTree", "randomForest", "naiveBayes", "sgd", "xgb"], labels)
    ]
    return spark.createDataFrame(data, "link string, model string, prediction string")


def test_votes(spark):
    counts = {
        "a": ["fake"] * 4 + ["real"] * 3,
        "b": ["fake"] * 3 + ["real"] * 4,
        "c": ["fake", "real"] + ["nan"] * 5,
    }
    got = {r.link: r for r in votes.majority_vote(made_votes(spark, counts)).collect()}
    assert {k: (r.credibility, r.fake_votes, r.real_votes) for k, r in got.items()} == {
        "a": ("fake", 4, 3), "b": ("real", 3, 4), "c": ("real", 1, 1),
    }


def test_verdict_maps_and_both_forms_agree(spark):
    counts = {"a": ["fake"] * 4 + ["real"] * 3, "b": ["real"] * 7}
    long = made_votes(spark, counts)
    accuracy = {"knn": 0.5, "lr": 0.75, "sgd": 0.1, "xgb": 1.0}
    wide = long.groupBy("link").agg(
        F.map_from_entries(F.collect_list(F.struct("model", "prediction"))).alias("predictions")
    )
    for got in (votes.verdict(long, accuracy), votes.verdict_of_row(wide, accuracy)):
        by_link = {r.link: r for r in got.collect()}
        assert by_link["a"].credibility == "fake" and by_link["b"].credibility == "real"
        assert by_link["a"].model_result == {
            "knn": "fake", "lr": "fake", "decisionTree": "fake", "randomForest": "fake",
            "naiveBayes": "real", "xgb": "real",
        }
        assert by_link["a"].accuracy == {"knn": 0.5, "logisticRegression": 0.75, "XGB": 1.0}
        assert got.columns == [
            "link", "credibility", "fake_votes", "real_votes", "model_result", "accuracy"
        ]


def test_accuracy(spark):
    data = [("m", "a", "a"), ("m", "b", "a"), ("n", "a", "a")]
    df = spark.createDataFrame(data, "model string, prediction string, label string")
    assert rows(votes.model_accuracy(df)) == [("m", 0.5), ("n", 1.0)]
