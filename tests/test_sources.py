from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from newslens import session
from newslens.schemas import POST_SCHEMA, USER_SCHEMA
from newslens.sources import lookups, readers, tables, writers


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


POST = dict(
    link="www.x.y/z", date=dt.datetime(2020, 4, 1, 12, 30, 1, 250), text="Hi @a, 5!", tweet_id="17",
    username='q"u,o', retweets=3, favorites=None, mentions=None, hashtags="#a", geo="",
    permalink="p",
)


def test_posts_roundtrip(spark, tmp_path):
    posts = [POST, {**POST, "link": " padded ", "text": "!!", "retweets": None, "tweet_id": "18"}]
    df = spark.createDataFrame([tuple(p[f.name] for f in POST_SCHEMA) for p in posts], POST_SCHEMA)
    path = str(tmp_path / "posts")
    writers.write_posts(df, path)
    back = readers.read_posts(spark, f"{path}/*.csv")
    assert back.schema == POST_SCHEMA
    got = {r.tweet_id: r for r in back.collect()}
    assert got["17"].text == "hi 5" and got["18"].text == ""
    assert got["17"].username == 'q"u,o' and got["17"].date == POST["date"]
    assert got["18"].link == " padded " and got["18"].retweets is None


def test_posts_with_index_and_byte_order_mark(spark, tmp_path):
    head = ",link,date,text,tweet_id,username,retweets,favorites,mentions,hashtags,geo,permalink"
    line = "0,u.v,2020-01-02 03:04:05+00:00,some text,12345678901234567890,n,4.0,5,,#h,,p"
    (tmp_path / "one.csv").write_text("\ufeff" + head + "\n" + line + "\n", encoding="utf-8")
    (tmp_path / "two.csv").write_text("\ufeff" + head + "\n" + line + "\n", encoding="utf-8")
    got = readers.read_posts(spark, str(tmp_path / "*.csv")).collect()
    assert len(got) == 2
    assert got[0].tweet_id == "12345678901234567890" and got[0].retweets == 4
    assert got[0].date == dt.datetime(2020, 1, 2, 3, 4, 5)


def test_mark_right_before_a_used_column(spark, tmp_path):
    (tmp_path / "l.csv").write_text("\ufeffnews_url,credibility\nu,fake\nv,\n", encoding="utf-8")
    path = str(tmp_path / "l.csv")
    assert rows(readers.read_labels(spark, path)) == [("u", "fake")]
    assert rows(readers.read_labels(spark, path, keep_missing=True)) == [("u", "fake"), ("v", "nan")]


def test_labels_with_line_breaks_in_other_columns(spark, tmp_path):
    text = 'title,credibility,news_url\n"a\nb, ""c""",real,u\n'
    (tmp_path / "l.csv").write_text(text)
    assert rows(readers.read_labels(spark, str(tmp_path / "l.csv"))) == [("u", "real")]


def test_users_roundtrip_and_prepare(spark, tmp_path):
    user = ("9", 2**40, "n", "s", 10, 20, 1, "Wed Oct 10 20:19:24 +0000 2018", 2, True, 30, False, None)
    df = spark.createDataFrame([user], USER_SCHEMA)
    path = str(tmp_path / "users")
    writers.write_users(df, path)
    back = readers.read_users(spark, f"{path}/*.csv")
    assert back.schema == USER_SCHEMA and rows(back) == [user]
    aged = tables.with_account_age(back, F.lit("2018-10-12 20:19:23").cast("timestamp"))
    assert rows(tables.prepare_users(aged)) == [("9", 10, 20, 1, True, 30)]
    prepared = str(tmp_path / "prepared")
    writers.write_users(aged, prepared)
    header = spark.read.option("header", True).csv(prepared).columns
    assert header[7] == "account_age" and len(header) == 13


def test_features_file_by_position(spark, tmp_path):
    text = ',link,textFeatures,retweets,userFeatures\n0,u,"[1, 2]",7,"[3,,4]"\n'
    (tmp_path / "f.csv").write_text(text)
    assert rows(readers.read_features(spark, str(tmp_path / "f.csv"))) == [("u", [1, 2], 7, [3, 4])]


def test_features_roundtrip(spark, tmp_path):
    data = [("u", [1, 2], 7, [3, 4]), ("v", [0, 0], 0, [0, 5])]
    schema = "link string, textFeatures array<bigint>, retweets bigint, userFeatures array<bigint>"
    path = str(tmp_path / "features")
    writers.write_features(spark.createDataFrame(data, schema), path)
    assert rows(readers.read_features(spark, f"{path}/*.csv")) == data


def test_lines_keep_a_partition_floor(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n\nthree")
    lines = readers.read_lines(spark, str(tmp_path / "a.txt"), min_partitions=6)
    assert lines.rdd.getNumPartitions() == 6 and lines.count() == 4
    assert readers.read_lines(spark, str(tmp_path / "a.txt"), 1).count() == lines.count()


def statuses(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs] + [("{bad",)], "status string")


def test_statuses(spark):
    raw = statuses(spark, {"id": 5, "user": {"id": 1, "name": "n", "verified": True}}, {"id": 6})
    flat = {r.tweetid: r for r in lookups.flatten_status(raw).collect()}
    assert flat["5"].user_name == "n" and flat["5"].verified and flat["5"].friends_count is None
    assert flat["6"].userid is None
    assert lookups.flatten_status(raw).columns == [f.name for f in USER_SCHEMA]
    ids = spark.createDataFrame([(5,), (5,), (6,), (7,)], "tweet_id bigint")
    assert [r.tweetid for r in lookups.lookup_statuses(raw, ids).collect()] == ["5"]


@pytest.mark.parametrize("broadcast", [True, False])
def test_posts_for_links(spark, request, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    posts = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2")], "link string, tweet_id string")
    links = spark.createDataFrame([("a",), ("a",), ("A",)], "link string")
    assert rows(lookups.posts_for_links(posts, links)) == [("a", "1"), ("a", "1")]


class Cluster:
    """What `shared_dir` asks of a session, for one that runs on a cluster."""

    master = "spark://host:7077"
    applicationId = "app-1"

    def __init__(self, **conf):
        self.values = conf
        self.sparkContext = self.conf = self

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_shared_folder_is_the_one_the_cluster_names():
    named = Cluster(**{session.CHECKPOINT_DIR: "s3a://shared/dir/"})
    assert session.shared_dir(named) == "s3a://shared/dir"
    assert session.fresh_path(named, "x").startswith("s3a://shared/dir/newslens-app-1/x-")
    with pytest.raises(RuntimeError):
        session.shared_dir(Cluster())


def test_written_tables_keep_their_rows(spark):
    back = session.written(spark.range(3), "numbers")
    assert back.count() == 3 and session.shared_dir(spark) in back.inputFiles()[0]


def test_cluster_settings():
    small = session.cluster_settings(1 << 20, 16)
    large = session.cluster_settings(8 << 40, 4000)
    assert small["spark.sql.shuffle.partitions"] == "32"
    assert large["spark.sql.shuffle.partitions"] == str(8 << 13)
