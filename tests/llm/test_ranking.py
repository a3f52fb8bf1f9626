"""Operator 11 against scores computed one by one."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from aerolag.llm import ranking as R
from aerolag.llm.ranking import BEST, Items, Search, Stratum, ranked_search, terms_of
from llm.cases import documents, texts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(c.total() for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    out = []
    for item_id, text in set(items):
        scored = []
        for doc_id, c in counts:
            m = 100 - 90 + (90 * c.total() * n_docs) // length
            score = 0
            for term in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scored)[:BEST], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, term string, block int")
    got = ranked_search(documents(spark, docs), asked, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def items_of(docs, rng):
    words = [w for _, t in docs for w in (t or "").split()]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))) for i in range(40)]


def test_terms():
    for _, text in texts():
        assert [t.decode() for t in terms_of((text or "").encode())] == terms(text)
    every = "".join(map(chr, range(300)))
    assert [t.decode() for t in terms_of(every.encode())] == terms(every)


def test_same_as_one_by_one(spark):
    docs = texts()
    items = items_of(docs, random.Random(3)) + [(100, None), (101, ""), (102, "!!"), (None, "one two"), (103, "NAÏVE Café")]
    items += [(103, "one"), (104, "one two"), (104, "one two"), (105, "nowhere")]
    assert found(spark, docs, items) == expected(docs, items)


def test_ties_repeated_rows_and_null_ids(spark):
    docs = [(5, "a b c"), (5, "a b c"), (None, "a b c"), (3, "c b a"), (None, "x"), (4, None), (4, "")]
    docs += [(i, "a a b") for i in range(30, 10, -1)]
    items = [(1, "a"), (2, "b a"), (3, "x y"), (4, "c")]
    assert found(spark, docs, items) == expected(docs, items)


def test_small_strata_and_blocks(spark, monkeypatch):
    """The same with the items in many blocks."""
    docs = texts()
    items = items_of(docs, random.Random(4))
    assert found(spark, docs, items, block_bytes=1500) == expected(docs, items)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, " ")]])
def test_no_documents(spark, rows):
    assert found(spark, rows, [(1, "a")]) == []


def test_no_items(spark):
    assert found(spark, texts(), []) == []


def stratum(docs, vocabulary, m):
    rows = pa.table(
        {
            "doc_id": pa.array([i for i, _ in docs], pa.int64()),
            "terms": pa.array([[vocabulary[t] for t in c] for _, c in docs], pa.list_(pa.int32())),
            "tfs": pa.array([list(c.values()) for _, c in docs], pa.list_(pa.int32())),
        }
    )
    names = ["m", "doc_ids", "terms", "tfs", "documents"]
    values = dict(zip(names, R._stratum(m, rows)))
    return Stratum({name: values[name][0].values for name in names[1:]}, m, len(vocabulary))


def test_bounds_hold_and_spare_visits():
    rng = random.Random(5)
    words = [f"w{i}".encode() for i in range(60)]
    items = Items.of(pa.array(range(8)), [" ".join(f"w{rng.randrange(60)}" for _ in range(6)) for _ in range(8)])
    known = dict(items.vocabulary)
    strata = []
    for number in range(200):
        docs = [(number * 9 + i, Counter(rng.choice(words) for _ in range(12))) for i in range(9)]
        docs = [(i, Counter({t: f for t, f in c.items() if t in known})) for i, c in docs]
        strata.append(stratum(docs, known, 10 + 9 * number))
    weights = np.array([rng.randrange(100, 9000) for _ in known], np.int64)
    search = Search(items, weights)
    every = [[] for _ in range(8)]
    for s in strata:
        scores = s.scores(items.pair_item, items.pair_term, weights[items.pair_term], 8)
        assert (scores.max(axis=1) <= search.bounds(s)).all()
        for item in range(8):
            every[item] += [(int(v), n) for v, n in zip(scores[item], s.names.to_pylist()) if v > 0]
    search.visit_all(strata)
    assert search.best == [sorted(rows, key=lambda r: (-r[0], r[1]))[:BEST] for rows in every]
    assert 0 < search.visits < 8 * len(strata) / 2


def test_portions_are_whole(monkeypatch):
    monkeypatch.setattr(R, "CELLS", 3)
    items = Items.of(pa.array([0, 1, 2]), ["a b c", "b", "c a"])
    docs = [(i, Counter({b"a": 1 + i, b"b": 2})) for i in range(7)] + [(9, Counter({b"c": 4}))]
    search = Search(items, np.array([5, 7, 11]))
    search.visit_all([stratum(docs, items.vocabulary, 40)])
    monkeypatch.setattr(R, "CELLS", 10**6)
    whole = Search(items, np.array([5, 7, 11]))
    whole.visit_all([stratum(docs, items.vocabulary, 40)])
    assert search.best == whole.best and all(search.best)
