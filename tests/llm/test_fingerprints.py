"""Operator 13: edited texts against slices, likeness against the generalised Jaccard similarity."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from aerolag.llm.fingerprints import SAMPLES, TERM_LENGTH, document_fingerprints, fingerprints, likeness
from llm.cases import documents, texts

WORDS = re.compile(rf"[^\x20\x09-\x0D]{{1,{TERM_LENGTH}}}")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def jaccard(a: str, b: str) -> float:
    x, y = (Counter(WORDS.findall(t.translate(LOWER))) for t in (a, b))
    larger = sum((x | y).values())
    return sum((x & y).values()) / larger if larger else 1.0


def edited(text: str, following: str) -> str:
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


@pytest.fixture(scope="module")
def found(spark):
    return {row.doc_id: row for row in document_fingerprints(documents(spark)).collect()}


@pytest.fixture(scope="module")
def expected():
    order = sorted(((i, t or "") for i, t in texts()), reverse=True)
    return {i: (t, edited(t, n), n) for (i, t), (_, n) in zip(order, order[1:] + order[:1])}


def test_edited_texts(found, expected):
    assert set(found) == set(expected)
    for i, (text, changed, _) in expected.items():
        assert found[i].n_chars == len(text)
        assert found[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()


def test_likeness_is_near_the_similarity(found, expected):
    # One likeness has a standard deviation of at most 0.0625; the mean of many is much closer.
    off = []
    for i, (text, changed, following) in expected.items():
        for got, other in ((found[i].near_edited, changed), (found[i].near_next, following)):
            off.append(got - jaccard(text, other))
    assert max(abs(x) for x in off) < 0.25
    assert abs(sum(off) / len(off)) < 0.02


def test_equal_texts_have_equal_fingerprints(found):
    assert found[20].fingerprint == found[21].fingerprint == found[23].fingerprint
    assert found[31].fingerprint == found[32].fingerprint
    assert found[28].fingerprint == found[29].fingerprint == found[30].fingerprint == ""
    assert found[29].near_next == 1.0 and found[31].near_next == 0.0
    assert all(len(row.fingerprint) in (0, 4 * SAMPLES) for row in found.values())


def test_weights_count(spark):
    """The collision rate over many pairs is the generalised Jaccard similarity, not that of the sets."""
    pairs = 300
    rows = [(p, t, 1 + t % 7, 1 + (t * 3) % 5 if t % 4 else 0) for p in range(pairs) for t in range(20)]
    smaller = sum(min(a, b) for p, _, a, b in rows if p == 0)
    larger = sum(max(a, b) for p, _, a, b in rows if p == 0)
    words = spark.createDataFrame(rows, "p long, t long, a long, b long").withColumn("t", F.xxhash64("p", "t"))
    words = words.withColumn("n", F.expr("sum(a) over (partition by p)")).withColumn("m", F.expr("sum(b) over (partition by p)"))
    prints = fingerprints(words, ["p"], "t", {"a": ("n", "x"), "b": ("m", "y")})
    mean = prints.agg(F.avg(likeness(F.col("x"), F.col("y")))).first()[0]
    # 19,200 samples: the standard deviation of their mean is below 0.004.
    assert mean == pytest.approx(smaller / larger, abs=0.015)


def test_blocks_of_hopeless_bids_leave_the_rest(spark):
    words = spark.createDataFrame([(1, 5, 1, 10**9)], "p long, t long, a long, n long")
    row = fingerprints(words, ["p"], "t", {"a": ("n", "x")}).first()
    assert len(row.x) == 4 * SAMPLES


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (1, "x y"), (None, "p q r"), (None, None), (2, "k l m n o p")]
    got = document_fingerprints(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    same = [row for row in got if row.doc_id == 1 and row.n_chars == 11]
    assert len(same) == 3 and len({row.fingerprint for row in same}) == 1
    own = hashlib.sha256(edited("a b c d e f", "a b c d e f").encode()).hexdigest()
    assert sorted(row.edited_sha256 == own for row in same) == [False, True, True]
    assert [row.near_next for row in same].count(1.0) >= 2
    assert sum(row.doc_id is None for row in got) == 2


def test_one_document_and_none(spark):
    (row,) = document_fingerprints(documents(spark, [(7, "one two three four")])).collect()
    assert row.near_next == 1.0 and row.n_chars == 18
    empty = document_fingerprints(documents(spark, []))
    assert empty.collect() == []
    assert empty.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_no_python_in_the_plan(spark):
    plan = document_fingerprints(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan
