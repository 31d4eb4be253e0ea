"""Reading the given tables, and shapes that the operators share."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of words that are cut by bytes: space, and 0x09 to 0x0D.
_SPACE = re.compile(rb"[\x20\x09-\x0d]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(name: str = "text") -> Column:
    """The UTF-8 bytes of a text; a null text is an empty one."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def held_out(doc_id: str | Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves `fold`; null ids are never held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds == fold, F.lit(False))


def arrow_type(schema: str) -> pa.Schema:
    """Arrow's form of a DDL schema of plain columns."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
        "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
        "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    }
    fields = (part.strip().split(" ") for part in schema.split(","))
    return pa.schema([(name, kinds[kind]) for name, kind in fields])
