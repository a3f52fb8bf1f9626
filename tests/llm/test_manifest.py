"""Operator 12 against a plain Merkle tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from aerolag.llm import manifest as M
from aerolag.llm.manifest import build_manifest, document_manifest, folded, proofs
from llm.cases import SCHEMA

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    doc_id, lang, source, n_chars = row
    values = [doc_id, source, lang, n_chars, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    """The root, and for every digest its siblings (before, after) level by level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for path, place in zip(paths, at):
            first = place - place % 3
            path.append(("".join(digests[first:place]), "".join(digests[place + 1 : first + 3])))
        at = [place // 3 for place in at]
        digests = [sha("".join(digests[i : i + 3])) for i in range(0, len(digests), 3)]
    return digests[0], paths


def expected(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        row = (doc_id, lang, source, n_chars)
        bare = None if text is None else text.replace("\n", "")
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        groups.setdefault(source, []).append((doc_id, leaf(row, text), leaf(row, bare) if tampered else leaf(row, text)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = [tree([r[1] for r in groups[name]]) for name in names]
    root, tops = tree([subroot for subroot, _ in trees])
    out = []
    for name, (subroot, paths), top in zip(names, trees, tops):
        for (doc_id, digest, tampered), path in zip(groups[name], paths):
            node = tampered
            for before, after in path + top:
                node = sha(before + node + after)
            siblings = "".join(before + after for before, after in path + top)
            out.append((doc_id, digest, subroot, root, sha(siblings), node, node == root))
    return out


def documents(spark, rows):
    full = [(i, t, lang, s, n, "a", "b", "c", "d", 2, 3, 1) for i, t, lang, s, n in rows]
    return spark.createDataFrame(full, SCHEMA)


def check(spark, rows):
    found = document_manifest(documents(spark, rows))
    assert found.columns == COLUMNS
    order = lambda row: tuple((v is not None, v) for v in row if v is not None or True)
    key = lambda row: [str(v) for v in row]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected(rows), key=key)
    return found


def text(i):
    return (None, "", "one\ntwo\n", "naïve\n日本 \U0001f600", "x" * 50_000 + "\n", "no line end")[i % 6]


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [28], [1, 1], [1, 5, 1, 30], [1] * 11, [90, 1, 4, 10]])
def test_trees_of_all_shapes(spark, sizes):
    ids = iter(range(10_000))
    rows = [(next(ids), text(i), ("en", None)[i % 2], f"s{g:02}", i) for g, n in enumerate(sizes) for i in range(n)]
    check(spark, rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, "a\nb", None, None, None), (None, "a\nb", None, None, None), (3, "c", "en", None, 1), (3, "d\n", "en", None, 1)]
    rows += [(5, "e\n", "fr", "", 2)] * 40 + [(i, text(i), "fr", "é", 3) for i in range(12)] + [(7, None, "de", "z", None)]
    found = check(spark, rows)
    # Deleted line ends show wherever there were any, and nowhere else.
    for row in found.filter("doc_id is null").collect():
        assert row.verified


def test_tampering_shows(spark):
    rows = [(i, "line\nline", "en", "s", 9) for i in range(30)]
    found = {row.doc_id: row.verified for row in document_manifest(documents(spark, rows)).collect()}
    assert found == {i: zlib.crc32(str(i).encode()) % 2 == 1 for i in range(30)}


def test_no_rows(spark):
    found = document_manifest(documents(spark, []))
    assert found.columns == COLUMNS and found.collect() == []


def test_many_groups_and_unbroadcast_joins(spark, monkeypatch):
    """The same through shuffled joins only, with stretches of few places."""
    monkeypatch.setattr(M, "STRETCH", 7)
    monkeypatch.setattr("aerolag.llm.tables.BROADCAST_BYTES", -1)
    check(spark, [(i, text(i), "en", f"s{i % 5 if i < 60 else i}", i) for i in range(150)])


def test_general_rows(spark):
    """Digests of any kind of rows; every path leads to the root."""
    rows = spark.range(200).select(
        (F.col("id") % 3).cast("string").alias("group"), F.col("id").alias("order"),
        F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), F.struct("id").alias("row"),
    )
    built = build_manifest(rows)
    ends = proofs(built).select("row.id", folded(F.col("digest"), F.col("path")).alias("end")).collect()
    assert len({row.id for row in ends}) == 200
    assert {bytes(row.end) for row in ends} == {built.root}
