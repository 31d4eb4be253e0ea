"""File scans. Types come from the schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens import constants as C
from newslens.functions.arrays import parse_int_list
from newslens.schemas import POST_SCHEMA, PREPARED_USER_SCHEMA, USER_SCHEMA

_BOM = "\ufeff"
# Stands for a missing value while a line is parsed; no text holds it. With it, an empty field is
# null and a quoted empty one is an empty text, as the writers have them.
_MISSING = "\u0000"


def _csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns as text, named by the header, with quotes doubled inside quoted fields."""
    scan = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", _MISSING)
        .option("multiLine", multi_line)
        .csv(path)
    )
    return scan.toDF(*[c.replace(_BOM, "") for c in scan.columns])


def _typed(scan: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of `schema`, found by name, so an index column in the file does no harm."""
    casts = []
    for field in schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.IntegralType):
            value = value.try_cast("double").try_cast(field.dataType)
            if isinstance(field.dataType, T.LongType):
                value = F.coalesce(F.col(field.name).try_cast(field.dataType), value)
        else:
            value = value.try_cast(field.dataType)
        casts.append(value.alias(field.name))
    return scan.select(*casts)


def read_posts(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Posts from CSV files under `path`, which may be a glob.

    `multi_line` admits line breaks inside texts, at the price that a file is one task; files
    of `write_posts` do not need it.
    """
    return _typed(_csv(spark, path, multi_line), POST_SCHEMA)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """User snapshots from CSV files under `path`, which may be a glob.

    Raw files have created_at, prepared ones account_age in its place; the header decides.
    """
    scan = _csv(spark, path)
    prepared = "account_age" in scan.columns
    return _typed(scan, PREPARED_USER_SCHEMA if prepared else USER_SCHEMA)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Feature rows: columns are taken by position, the lists parsed from their text."""
    scan = _csv(spark, path)
    named = scan.toDF("index", "link", "text_list", "retweets", "user_list", *scan.columns[5:])
    return named.select(
        "link",
        parse_int_list("text_list").alias("textFeatures"),
        F.col("retweets").cast("bigint").alias("retweets"),
        parse_int_list("user_list").alias("userFeatures"),
    )


def read_feature_store(spark: SparkSession, table: str) -> DataFrame:
    """Feature rows of `write_feature_store`; Spark knows their buckets."""
    return spark.table(table).select("link", "textFeatures", "retweets", "userFeatures")


def _breaks_in_fields(spark: SparkSession, path: str) -> bool:
    """Whether a line ends inside a quoted field, which leaves it an odd number of quotes."""
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_labels(
    spark: SparkSession, path: str, keep_missing: bool = False, multi_line: bool | None = None
) -> DataFrame:
    """(news_url, credibility) as text. Rows without a label are dropped, or kept as `nan`.

    `multi_line` admits line breaks inside other columns, at the price that a file is one task.
    None looks for such breaks first, in one pass over the lines, so that other files stay split.
    """
    if multi_line is None:
        multi_line = _breaks_in_fields(spark, path)
    scan = _csv(spark, path, multi_line).select(
        F.nullif(F.col("news_url"), F.lit("")).alias("news_url"),
        F.nullif(F.col("credibility"), F.lit("")).alias("credibility"),
    )
    if keep_missing:
        return scan.fillna(C.MISSING_LABEL, ["news_url", "credibility"])
    return scan.where(F.col("credibility").isNotNull())


def read_lines(
    spark: SparkSession, path: str, min_partitions: int = C.TEXT_SCAN_PARTITIONS
) -> DataFrame:
    """Lines of text files, read by at least `min_partitions` tasks; no line is shuffled.

    The files are cut to fit: a scan takes its split size from the session that it was made by, so this
    one is made by a session of its own. Files that cannot be cut (gzip) stay one task each, and
    files of less than `min_partitions` bytes give fewer tasks. Splits are whole bytes, so small files may give a few
    too many, which are read together.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.minPartitionNum", str(min_partitions))
    own.conf.set("spark.sql.files.openCostInBytes", "1")
    lines = own.read.text(path)
    found = lines.rdd.getNumPartitions()
    return lines.coalesce(min_partitions) if min_partitions < found < 2 * min_partitions else lines
