"""What operators hold in memory, and what they do with damaged or very large input."""

import random
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aerolag.llm import caches, language, shingles
from aerolag.llm.language import GRAMS_KEPT, Letters, grams
from aerolag.llm.warc import read_pages, write_archives
from aerolag.storage import scratch_path
from llm.cases import documents, texts


def plain_bundle(text):
    """The bundle with plain loops over letters."""
    signs = np.random.default_rng(language.SEED).integers(0, 2, (language.SYMBOLS, language.DIMENSIONS)) * 2 - 1
    total = np.zeros(language.DIMENSIONS)
    for code in grams(text).tolist():
        a, b, c = code // language.SYMBOLS**2, code // language.SYMBOLS % language.SYMBOLS, code % language.SYMBOLS
        total += np.roll(signs[a], 2) * np.roll(signs[b], 1) * signs[c]
    return total


@pytest.mark.parametrize("kept", [0, 5, GRAMS_KEPT])
def test_bundles_against_plain_loops(kept):
    letters = Letters(kept=kept) if kept else Letters(kept=1)
    for _, text in texts():
        if text and len(text) < 3000:
            codes, counts = np.unique(grams(text), return_counts=True)
            if len(codes):
                assert letters.bundle(codes, counts) == pytest.approx(plain_bundle(text))


def test_predictions_against_plain_loops(spark):
    rows = [(i, t) for i, t in texts() if i is not None]
    docs = documents(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "xx").when(F.col("doc_id") % 3 == 1, "yy"))
    known = {}
    for row in docs.select("doc_id", "text", "lang", language.held_out().alias("out")).collect():
        if row.lang and row.text and not row.out and len(grams(row.text)):
            known.setdefault(row.lang, np.zeros(language.DIMENSIONS))
            known[row.lang] += plain_bundle(row.text) / len(grams(row.text))
    known = {lang: v / np.linalg.norm(v) for lang, v in known.items()}
    for row in language.identify_documents(docs).collect():
        text = dict(rows)[row.doc_id]
        if not text or not len(grams(text)):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        bundle = plain_bundle(text)
        cosines = {lang: float(v @ bundle / np.linalg.norm(bundle)) for lang, v in known.items()}
        best = max(sorted(cosines), key=lambda lang: round(cosines[lang], 9))
        assert row.lang_pred == best
        assert row.score == pytest.approx(max(0.0, cosines[best]), abs=1e-4)


def test_a_script_of_many_ngrams_stays_bounded():
    """200,000 distinct trigrams, in learning and in prediction, below 300 MB."""
    rng = random.Random(8)
    pages = ["".join(chr(0x4E00 + rng.randrange(6000)) for _ in range(10_000)) for _ in range(40)]
    assert len(np.unique(np.concatenate([grams(p) for p in pages]))) > 150_000
    batch = pa.RecordBatch.from_pydict({"text": pages, "lang": [f"l{i % 9}" for i in range(40)]})
    tracemalloc.start()
    found = list(language._bundles_of_task(iter([batch])))
    letters = Letters()
    for page in pages:
        letters.bundle(*np.unique(grams(page), return_counts=True))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 9 and peak < 300_000_000


def test_shares_are_bundled_in_parts(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"text": [t for _, t in texts()], "lang": ["a"] * len(texts())})
    whole = [row["bundle"] for b in language._bundles_of_task(iter([batch])) for row in b.to_pylist()]
    monkeypatch.setattr(language, "SHARES_HELD", 50)
    parts = [row["bundle"] for b in language._bundles_of_task(iter([batch])) for row in b.to_pylist()]
    assert len(whole) == len(parts) == 1 and parts[0] == pytest.approx(whole[0], abs=1e-4)


def test_workers_let_go_of_other_operators_stores():
    shingles.shingle_set("one two three four five six")
    caches.begin("first")
    shingles.shingle_set("one two three four five six")
    caches.begin("first")
    assert len(shingles._hashes) == 6
    caches.begin("second")
    assert len(shingles._hashes) == 0


def pages_frame(spark, rows):
    return spark.createDataFrame([(i, "http://h/" + str(i), h, "clash") for i, h in rows], "page_id long, url string, html string, digest string")


def test_pages_of_all_sizes_come_back(spark):
    big = "é" * 25_000_000
    rows = [(i, f"<p>{i}</p>" * (i * 40 + 1)) for i in range(12)] + [(50, "x" * 200_000), (51, "y" * 3_000_000), (52, big), (53, None), (None, "n" * 2000)]
    rows += [(60, "x" * 200_000), (61, "n" * 2000)]
    path = scratch_path(spark, "warc")
    write_archives(pages_frame(spark, rows), path)
    files = [p for p in Path(path).rglob("part-*")]
    assert {p.parent.name for p in files} == {f"class-{i}" for i in range(4)}
    found = {row.page_id: row for row in read_pages(spark, path, spark.range(1).schema["id"].dataType).collect()}
    assert {i: found[i].payload_bytes for i, _ in rows} == {i: len((h or "").encode()) for i, h in rows}
    assert (found[50].record_type, found[50].refers_to, found[60].record_type) == ("revisit", 60, "response")
    assert (found[None].record_type, found[None].refers_to) == ("revisit", 61)


def test_no_html_is_shuffled(spark):
    from aerolag.llm.warc import archive_rows

    rows = archive_rows(pages_frame(spark, [(i, "same" * 500) for i in range(9)]))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_damage_is_written_down(spark):
    path = scratch_path(spark, "warc")
    write_archives(pages_frame(spark, [(i, f"<p>page {i}</p>" * 20) for i in range(40)]).coalesce(1), path)
    (file,) = [p for p in Path(path).rglob("part-*")]
    data = bytearray(file.read_bytes())
    places = [data.index(b"<p>page 9<"), data.index(b"<p>page 21<")]
    for place in places:
        data[place] ^= 0xFF
    file.write_bytes(data)
    (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.warns(UserWarning, match="quarantined"):
        found = read_pages(spark, path, spark.range(1).schema["id"].dataType).collect()
    assert 36 <= len(found) < 40
    gaps = spark.read.parquet(f"{path}-gaps").collect()
    assert sum(g.offset <= place < g.offset + g.length for g in gaps for place in places) == 2
    covered = sum(g.length for g in gaps)
    assert 0 < covered < len(data) / 8


def test_texts_that_share_a_class_are_told_apart(spark):
    from aerolag.llm.repeats import _classes

    rows = documents(spark, [(i, f"text {i % 6}") for i in range(12)]).withColumn("n_bytes", F.octet_length("text").cast("long"))
    used = []

    def hashed(seed):
        used.append(seed)
        return F.xxhash64("text", F.lit(seed)) % (2 if seed < 2 else 10**15)

    known, about = _classes(rows.select("doc_id", "text", "n_bytes"), hashed)
    assert used == [0, 1, 2] and about.count() == 12
    assert known.select("cls", "text").distinct().count() == known.select("cls").distinct().count() == 6


@pytest.mark.parametrize("windows", [10, 3000, 200_000])
def test_shift_tables_grow_with_the_benchmark(windows):
    """Random words are skipped by more than half a window on average, whatever the number of windows."""
    from aerolag.llm.decontamination import Patterns

    rng = np.random.default_rng(windows)
    patterns = Patterns(10, rng.integers(0, 50_000, (windows, 10)))
    text = rng.integers(0, 50_000, 20_000)
    shifts = patterns.shift[patterns.codes(text, np.arange(9, len(text)))]
    assert shifts.mean() > 5
    assert patterns.shift.nbytes <= 4 << 23
