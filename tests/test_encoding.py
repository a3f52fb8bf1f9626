from __future__ import annotations

from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from aerolag.operators import encoding
from aerolag.operators.encoding import frequency_encode, row_count, value_counts


def encoded(df, **options):
    rows = frequency_encode(df, "c", "f", **options).select("k", "c", "f").collect()
    return sorted((row["k"], row["c"], row["f"]) for row in rows)


def expected(values):
    counts = Counter(values)
    return sorted((k, c, counts[c] / len(values)) for k, c in enumerate(values) if c is not None)


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "k int, c string")


@pytest.mark.parametrize("hot_keys", [1, 3, 1000])
def test_both_joins_agree_with_a_hot_value(spark, monkeypatch, hot_keys):
    monkeypatch.setattr(encoding, "HOT_KEYS", hot_keys)
    values = ["hot"] * 40 + [f"v{i}" for i in range(50)] + ["w"] * 9 + [None] * 21
    df = frame(spark, values).repartition(3)
    assert encoded(df) == expected(values)
    assert encoded(df, broadcast_bytes=0) == expected(values)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.sampled_from(["a", "b", "c", "", None]), min_size=1, max_size=30))
def test_shares_add_up(spark, values):
    rows = encoded(frame(spark, values))
    assert rows == expected(values)
    shares = {c: Fraction(Counter(values)[c], len(values)) for _, c, _ in rows}
    assert sum(shares.values()) == 1 - Fraction(values.count(None), len(values))


def test_empty_input(spark):
    empty = spark.createDataFrame([], "k int, c string")
    assert encoded(empty) == []
    assert encoded(empty, broadcast_bytes=-1) == []


def test_a_hot_value_too_long_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(encoding, "HOT_VALUE_BYTES", 2)
    values = ["long"] * 20 + ["x"] * 20 + [f"v{i}" for i in range(10)]
    assert encoded(frame(spark, values), broadcast_bytes=0) == expected(values)


def test_counts_keep_the_null_group(spark):
    df = frame(spark, ["a", None, "a", None, None])
    assert {row["c"]: row["n"] for row in value_counts(df, "c", "n").collect()} == {"a": 2, None: 3}
    assert row_count(df, "n").first()["n"] == 5
