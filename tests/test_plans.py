"""What the physical plans must look like, whatever the data."""

from __future__ import annotations

import re

import pytest

from newslens import fixtures as X
from newslens import queries as Q
from newslens.operators import histograms
from newslens.operators.accounts import binned_users
from newslens.operators.sampling import cap_rows
from newslens.operators.skew import fits_broadcast
from newslens.plans.features import link_features, scored_posts
from newslens.sources.lookups import lookup_statuses, maybe_wanted, posts_for_links, statuses_with_user
from newslens.sources.readers import read_feature_store, read_lines
from newslens.sources.writers import write_feature_store


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["feature_vector", "text_histogram", "user_histogram_compat", "labeled_features", "verdict",
     "flatten_status", "stratified_split", "clean_text"],
)
def test_no_python_and_no_pairwise_join(spark, sf_dir, name):
    text = plan(Q.queries()[name](spark, sf_dir))
    assert not re.search("Python|Pandas|Arrow", text)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)


def test_texts_are_never_shuffled(spark, tmp_path, sf_dir):
    """Posts stored as a table: between scan and vector, no exchange carries the text."""
    path = str(tmp_path / "posts")
    X.posts(spark, sf_dir).write.parquet(path)
    posts = spark.read.parquet(path)
    df = histograms.text_histogram(scored_posts(posts, X.lexicon(spark)))
    text_ids = set(re.findall(r"\btext#\d+", plan(df)))
    for line in plan(df).splitlines():
        if "Exchange hashpartitioning" in line:
            assert not any(i in line for i in text_ids)
    assert plan(df).count("Exchange hashpartitioning") == 3
    scan = next(line for line in plan(df).splitlines() if "FileScan" in line)
    assert "ReadSchema: struct<link:string,tweet_id:string,text:string,retweets:int>" in scan


def test_one_scan_of_each_table(spark, tmp_path, sf_dir):
    posts_path, users_path = str(tmp_path / "posts"), str(tmp_path / "users")
    X.posts(spark, sf_dir).write.parquet(posts_path)
    X.users(spark, sf_dir).write.parquet(users_path)
    posts, users = spark.read.parquet(posts_path), spark.read.parquet(users_path)
    text = plan(link_features(posts, users, X.lexicon(spark)))
    assert text.count("FileScan") == 2
    assert "account_age" in text and "BroadcastHashJoin" in text


def test_large_users_meet_posts_without_broadcast(spark, sf_dir, no_broadcast):
    users = binned_users(X.users(spark, sf_dir))
    assert not fits_broadcast(users)
    text = plan(link_features(X.posts(spark, sf_dir), X.users(spark, sf_dir), X.lexicon(spark)))
    joins = [line for line in text.splitlines() if "Join" in line]
    assert "SortMergeJoin" in joins[0] and "_piece" in joins[0]


def test_spread_users_take_two_scans_and_few_shuffles(spark, tmp_path, sf_dir):
    posts_path, users_path = str(tmp_path / "posts"), str(tmp_path / "users")
    X.posts(spark, sf_dir).write.parquet(posts_path)
    X.users(spark, sf_dir).write.parquet(users_path)
    posts, users = spark.read.parquet(posts_path), spark.read.parquet(users_path)
    text = plan(link_features(posts, users, X.lexicon(spark), spread=True))
    scans = [line for line in text.splitlines() if "FileScan" in line and str(tmp_path) in line]
    assert len(scans) == 2
    assert text.count("Exchange hashpartitioning") <= 6


def test_links_filter_is_a_broadcast_semi_join_when_small(spark, sf_dir):
    posts = X.posts(spark, sf_dir)
    links = X.lexicon(spark).selectExpr("word AS link")
    assert "LeftSemi" in plan(posts_for_links(posts, links))
    assert "BroadcastHashJoin [link" in plan(posts_for_links(posts, links))


def test_statuses_are_parsed_once(spark):
    raw = spark.createDataFrame([("{}",)], "status string")
    text = plan(statuses_with_user(raw).where("tweetid IS NOT NULL AND userid > 5"))
    assert len(re.findall("from_json", text)) == 1


def test_keep_first_of_scored_posts_is_hashed(spark, tmp_path, sf_dir):
    path = str(tmp_path / "posts")
    X.posts(spark, sf_dir).write.parquet(path)
    text = plan(histograms.text_histogram(scored_posts(spark.read.parquet(path), X.lexicon(spark))))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_lines_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(20000).selectExpr("CAST(id AS STRING)").coalesce(1).write.text(path)
    lines = read_lines(spark, path, min_partitions=12)
    assert lines.rdd.getNumPartitions() >= 12
    assert "Exchange" not in plan(lines) and lines.count() == 20000
    assert read_lines(spark, path, 1).count() == 20000


def test_row_cap_is_one_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(5000).selectExpr("CAST(id AS STRING) AS link", "id AS v").write.parquet(path)
    text = plan(cap_rows(spark.read.parquet(path), 7))
    assert text.count("FileScan") == 1 and "TakeOrderedAndProject" in text


def test_late_texts_pass_a_filter_before_the_shuffle(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "posts")
    spark.range(20000).selectExpr("CONCAT('l', id) AS link", "REPEAT('x', 50) AS text").write.parquet(path)
    posts = spark.read.parquet(path)
    links = spark.range(0, 20000, 100).selectExpr("CONCAT('l', id) AS link")
    text = plan(posts_for_links(posts, links))
    assert text.index("SortMergeJoin") < text.index("BroadcastHashJoin [_piece")
    assert posts_for_links(posts, links).count() == 200
    # Of the posts that the join shuffles all but a few belong.
    assert 200 <= maybe_wanted(posts, links, "link").count() <= 210


def test_bodies_are_parsed_after_the_join(spark):
    raw = spark.createDataFrame([('{"id": 5, "user": {"id": 1}}',)], "status string")
    ids = spark.createDataFrame([(5,), (6,)], "id long")
    text = plan(lookup_statuses(raw, ids))
    assert text.index("from_json") < text.index("LeftSemi") < text.rindex("get_json_object")


def test_stored_features_stay_in_their_buckets(spark, sf_dir, no_broadcast):
    features = Q.features(spark, sf_dir)
    write_feature_store(features, "stored_features", 16)
    try:
        stored = read_feature_store(spark, "stored_features")
        labels = X.labels(spark, sf_dir)
        joined = stored.join(labels, stored["link"] == labels["news_url"])
        text = plan(joined)
        scan = text[: text.index("stored_features")]
        assert "SortMergeJoin" in text and "Exchange" not in scan
        key = lambda r: r.link
        assert sorted(stored.collect(), key=key) == sorted(features.select(*stored.columns).collect(), key=key)
    finally:
        spark.sql("DROP TABLE stored_features")
