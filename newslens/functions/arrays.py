"""Integer lists: parsing, printing, packing and adding up."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_int_list(text: Column | str) -> Column:
    """`"[1, 2,,3]"` to [1, 2, 3]: outer characters dropped, empty items skipped."""
    text = _col(text)
    items = F.split(F.substring(text, F.lit(2), F.length(text) - 2), ",")
    return F.transform(
        F.filter(items, lambda item: item != ""),
        lambda item: F.trim(item).cast("bigint"),
    )


def print_int_list(values: Column | str) -> Column:
    """[1, 2, 3] to `"[1, 2, 3]"`."""
    joined = F.array_join(F.transform(_col(values), lambda v: v.cast("string")), ", ")
    return F.concat(F.lit("["), joined, F.lit("]"))


def add_arrays(a: Column | str, b: Column | str) -> Column:
    """Element-wise sum of two arrays of the same width."""
    return F.zip_with(_col(a), _col(b), lambda x, y: x + y)


def bin_counts(widths: dict[str, int], *more: str) -> Column:
    """Aggregate: for each bin column one count per bin, then `more`, packed as one array.

    Each count is an aggregate of its own, so no array takes part in the shuffle. Stated as SQL
    text, which the JVM parses in one call.
    """
    counts = [
        f"count(CASE WHEN {name} = {i} THEN 1 END)"
        for name, width in widths.items()
        for i in range(width)
    ]
    return F.expr(f"array({', '.join([*counts, *more])})")


def sum_arrays(values: str, width: int) -> Column:
    """Aggregate: element-wise total of a group's arrays of `width` integers."""
    return F.expr(f"array({', '.join(f'sum({values}[{i}])' for i in range(width))})")


def spread_array(values: Column | str, width: int, prefix: str) -> Iterable[Column]:
    """One column per element: prefix_0 .. prefix_<width-1>."""
    return [_col(values)[i].alias(f"{prefix}_{i}") for i in range(width)]
