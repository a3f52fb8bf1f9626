"""What the operators leave on disk and how often they call what is costly."""

from __future__ import annotations

import pickle
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from aerolag.llm import components, jaccard, repeats
from aerolag.llm.shingles import shingle_set
from aerolag.llm.tokenizing import Encoder
from aerolag.storage import stage
from llm.cases import documents


def test_counted_shingles_are_packed_and_unpacked():
    random = np.random.default_rng(4)
    for n in (1, jaccard.PACKED_FROM - 1, jaccard.PACKED_FROM, 70_000):
        low = random.integers(0, 1 << jaccard.COUNTED_BITS, n).astype("<u4")
        low[: n // 4] = low[0]
        low.sort()
        part = jaccard._packed(low)
        assert np.array_equal(jaccard._unpacked(part), low)
    assert len(part) < 2.2 * n


@pytest.mark.parametrize("total", [0, 4000, 1 << 24])
def test_the_driver_holds_marks_packed(spark, total):
    """Marks of few shingles take few bytes on the driver, and no shingle that occurs again lacks its mark."""
    texts = [" ".join(f"w{k}" for k in range(i * 20, i * 20 + 60)) for i in range(60)]
    texts += [f"{' '.join(f'h{k}' for k in range(9))} x{i}" for i in range(jaccard.HEAVY)]
    marks = jaccard.repeated_shingles(documents(spark, list(enumerate(texts))).select("text"), total)
    assert len(pickle.dumps(marks)) < 200_000
    counts = Counter(f for text in texts for f in shingle_set(text).tolist())
    again = np.array([f for f, n in counts.items() if n >= 2], dtype=np.uint64)
    heavy = np.array([f for f, n in counts.items() if n >= jaccard.HEAVY], dtype=np.uint64)
    once = np.array([f for f, n in counts.items() if n == 1], dtype=np.uint64)
    assert len(heavy) and marks.of(marks.again(), again).all() and marks.of(marks.heavy(), heavy).all()
    if total:
        assert marks.of(marks.again(), once).mean() < 0.1 and marks.of(marks.heavy(), once).mean() < 0.1


def test_a_stage_leaves_no_shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        files = blocks.getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    before = shuffled()
    rows = spark.range(10_000).withColumn("k", F.col("id") % 97).repartition(3, "k").groupBy("k").count()
    assert stage(rows, "counted").count() == 97
    left = {name.split("_")[1] for name in shuffled() - before}
    # The count above shuffles on its own; the two shuffles of the staged rows are gone.
    assert len(left) <= 1


def test_words_are_encoded_in_few_texts(monkeypatch):
    words = ["".join(chr(97 + (i // 26**p) % 26) for p in range(4)) for i in range(1000)]
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"), True)
    texts = []
    encode = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda some: texts.extend(some) or encode(some))
    (ids,) = encoder.encode(pa.array([" ".join(words)]))
    assert len(texts) <= 6
    assert ids.tolist() == [*encoder.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, 0]


def staged_of(monkeypatch, module):
    """What ``module`` stages from now on, as (name, rows to write, rows written)."""
    staged = []

    def noted(df, name):
        staged.append((name, df, stage(df, name)))
        return staged[-1][2]

    monkeypatch.setattr(module, "stage", noted)
    return staged


def test_few_edges_are_written_by_one_task(spark, monkeypatch):
    staged = staged_of(monkeypatch, components)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        links = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
        found = components.connected_components(links).agg(F.count("*"), F.max("component")).first()
    finally:
        spark.conf.unset(setting)
    assert tuple(found) == (200, 0)
    assert len(staged) > 3 and {len(written.inputFiles()) for _, _, written in staged[1:]} == {1}


def test_runs_are_counted_without_a_sort(spark, monkeypatch):
    staged = staged_of(monkeypatch, repeats)
    text = "".join(chr(97 + (i * i) % 23) for i in range(500))
    docs = documents(spark, [(1, text), (2, f"{text} more"), (3, "x" * 450), (4, "short")])
    found = {row.doc_id: row.n_removed for row in repeats.remove_repeats(docs).collect()}
    (keys,) = [df for name, df, _ in staged if name == "repeated-keys"]
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert found == {1: 500, 2: 500, 3: 450, 4: 0}
