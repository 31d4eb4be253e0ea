from __future__ import annotations

import datetime as dt
import re

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newslens.functions import arrays, text, users
from newslens.functions.lexicon import default_lexicon


def values(spark, rows, schema, *columns):
    """Rows of `columns` evaluated over `rows`, in their order."""
    numbered = [(i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, f"_i int, {schema}")
    picked = df.select("_i", *[c.alias(f"c{i}") for i, c in enumerate(columns)]).collect()
    return [tuple(r)[1:] for r in sorted(picked, key=lambda r: r[0])]


CLEAN_CASES = [
    ("Hi @bob http://a.b/c?d=1 x", "hi x"),
    ("a_b://c d", "d"),
    ("aé://zz q", "q"),
    (None, "none"),
    ("", ""),
    ("!?", ""),
    ("tab\tq\nz", "tab q z"),
    ("@bob://x y", "x y"),
    ("@bob_x://y z", "z"),
    ("mail a@b.c now", "mail a c now"),
    ("http://", "http"),
    ("ÀB İx K", "b i x k"),
    ("See HTTPS://A.B\u00a0C D", "see c d"),
    ("_@@a @ b", "b"),
    ("İ://x y", "i x y"),
    ("²://x y", "x y"),
]


def test_clean_cases(spark):
    got = values(spark, [(t,) for t, _ in CLEAN_CASES], "t string", text.clean_text("t"))
    assert [g[0] for g in got] == [expected for _, expected in CLEAN_CASES]


def model_clean(value):
    """The cleaning rule, stated with Python's own regular expressions."""
    noise = re.compile(r"@[A-Za-z0-9]+|[^0-9A-Za-z \t]|\w+://\S+")
    return " ".join(noise.sub(" ", str(value).lower()).split())


PIECES = st.sampled_from(
    ["http://", "://", "@", "_", "a", "B7", " ", "\t", "\n", "é", "ß", "İ", "日", "²", "\u0301", "\x1d", ".", "/", ":", "x1"]
)


@settings(
    max_examples=6,
    deadline=None,
    phases=[Phase.generate],
    suppress_health_check=list(HealthCheck),
)
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=80, max_size=200))
def test_clean_equals_python_model(spark, texts):
    got = values(spark, [(t,) for t in texts], "t string", text.clean_text("t"), text.words("t"))
    for value, (cleaned, found) in zip(texts, got):
        assert cleaned == model_clean(value), value
        assert [w for w in found if w] == cleaned.split(), value


def test_clean_is_idempotent(spark):
    texts = [(t,) for t, _ in CLEAN_CASES]
    once = text.clean_text("t")
    assert all(a == b for a, b in values(spark, texts, "t string", once, text.clean_text(once)))


def test_long_unbroken_run_is_not_quadratic(spark):
    got = values(spark, [("a" * 400_000 + " http://b c",)], "t string", text.clean_text("t"))
    assert got == [("a" * 400_000 + " c",)]


@pytest.mark.parametrize("polarity,expected", [(-1.0, 0), (0.0, 2), (0.99, 4), (1.0, 5)])
def test_sentiment_bin(spark, polarity, expected):
    assert values(spark, [(polarity,)], "p double", text.sentiment_bin("p")) == [(expected,)]


@pytest.mark.parametrize("subjectivity,expected", [(0.0, 0), (0.2, 1), (0.99, 4), (1.0, 5)])
def test_subjectivity_bin(spark, subjectivity, expected):
    got = values(spark, [(subjectivity,)], "s double", text.subjectivity_bin("s"))
    assert got == [(expected,)]


@pytest.mark.parametrize(
    "followers,friends,expected",
    [(10, 0, 10), (3, 1, 3), (0, 5, 0), (7, -1, 0), (-5, 0, 0), (2**62, 0, 10)],
)
def test_ratio_bin(spark, followers, friends, expected):
    ratio = users.follower_ratio("a", "b")
    got = values(spark, [(followers, friends)], "a bigint, b bigint", users.ratio_bin(ratio))
    assert got == [(expected,)]


@pytest.mark.parametrize("divisor,expected", [(0, 9), (1, 4), (2, 3)])
def test_activity_bin(spark, divisor, expected):
    level = users.activity("a", "b")
    got = values(spark, [(9, divisor)], "a bigint, b bigint", users.activity_bin(level))
    assert got == [(expected,)]


@pytest.mark.parametrize(
    "as_of,expected",
    [
        (dt.datetime(2018, 10, 12, 20, 19, 23), 1),
        (dt.datetime(2018, 10, 12, 20, 19, 24), 2),
        (dt.datetime(2018, 10, 10, 20, 19, 23), -1),
    ],
)
def test_account_age(spark, as_of, expected):
    moment = F.lit(as_of.isoformat(sep=" ")).cast("timestamp")
    rows = [("Wed Oct 10 20:19:24 +0000 2018",), ("garbage",), (None,)]
    got = values(spark, rows, "c string", users.account_age("c", moment))
    assert got == [(expected,), (None,), (None,)]


def test_lenient_int(spark):
    rows = [("12",), ("12.7",), ("-3.9",), ("x",), ("",), (None,), ("9e30",)]
    got = values(spark, rows, "v string", users.lenient_int("v"))
    assert [g[0] for g in got] == [12, 12, -3, None, None, None, None]


def test_int_lists(spark):
    rows = [("[1, 2,,3]",), ("[]",), ("[-7]",), ("[ 4 ,5 ]",), (None,)]
    got = values(spark, rows, "t string", arrays.parse_int_list("t"))
    assert [g[0] for g in got] == [[1, 2, 3], [], [-7], [4, 5], None]


def test_lists_print_and_parse_back(spark):
    rows = [([1, 2, 3],), ([],), ([-5],)]
    got = values(
        spark, rows, "v array<bigint>",
        arrays.print_int_list("v"), arrays.parse_int_list(arrays.print_int_list("v")),
    )
    assert got == [("[1, 2, 3]", [1, 2, 3]), ("[]", []), ("[-5]", [-5])]


def test_add_arrays(spark):
    rows = [([1, 2], [10, 20])]
    got = values(spark, rows, "a array<int>, b array<int>", arrays.add_arrays("a", "b"))
    assert got == [([11, 22],)]


def test_default_lexicon(spark):
    rows = default_lexicon(spark).collect()
    assert len({r.word for r in rows}) == len(rows)
    assert "none" not in {r.word for r in rows}
    assert all(-100 <= r.pol <= 100 and 0 <= r["sub"] <= 100 for r in rows)
    assert all(r.word == model_clean(r.word) for r in rows)
