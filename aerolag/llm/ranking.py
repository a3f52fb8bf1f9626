"""Ranked lexical search over an index in strata of equal length.

A document's score depends on its length through a small integer, the normaliser m. Documents of one m form
a stratum; a row of the index is a stratum, or a part of a large one, with the postings of every term by
descending tf. All postings of a term and tf in a stratum have one impact, which is computed once. The
largest tf of each term bounds what an item can score in a stratum: strata are visited by descending bound, and
not at all by items whose bound is below the tenth score they have already.

Items are searched in blocks of bounded size; each task keeps the best documents of its strata, and Spark the
best of all tasks. Scores are integers throughout.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolag.llm.tables import map_arrow, slices, small_side
from aerolag.storage import stage

#: Results of an item.
BEST = 10
#: UTF-8 bytes of the items that are searched at a time. One larger item is a block of its own.
BLOCK_BYTES = 4 * 1024 * 1024
#: Postings and documents in a row of the index, at most (one longer document is a row of its own).
STRATUM_POSTINGS = 100_000
STRATUM_DOCUMENTS = 4096
#: Postings that a task of the index gets, on average.
TASK_POSTINGS = 4_000_000
#: Strata that are put in order at a time, fewer for items of many terms.
STRATA_AT_A_TIME = 64
#: Scores computed at a time.
CELLS = 2_000_000

#: Every byte but digits, letters and those of non-ASCII characters ends a term; A-Z is lower-cased.
_TERM_BYTES = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Items:
    """Items and their terms by number, as pairs in the order of the items."""

    names: pa.Array
    vocabulary: dict[bytes, int]
    pair_item: np.ndarray
    pair_term: np.ndarray

    @staticmethod
    def of(names: pa.Array, texts: list[str | None]) -> Items:
        vocabulary: dict[bytes, int] = {}
        pair_item, pair_term = [], []
        for item, text in enumerate(texts):
            for term in dict.fromkeys(terms_of((text or "").encode())):
                pair_item.append(item)
                pair_term.append(vocabulary.setdefault(term, len(vocabulary)))
        return Items(names, vocabulary, np.array(pair_item, np.int64), np.array(pair_term, np.int64))


def term_counts(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document (doc_id, text) with a term: doc_id, n (terms with repeats), and the vocabulary's terms with tf."""
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, sizes, lengths, found, tfs = [], [], [], [], []
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                counts = Counter(terms_of(text or b""))
                if not counts:
                    continue
                known = [(vocabulary[term], tf) for term, tf in counts.items() if term in vocabulary]
                kept.append(i)
                sizes.append(counts.total())
                lengths.append(len(known))
                found += [term for term, _ in known]
                tfs += [tf for _, tf in known]
            offsets = pa.array(np.cumsum([0, *lengths]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(kept, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_arrow(rows, count, f"doc_id {id_type}, n long, terms array<int>, tfs array<int>")


def _stratum(m: int, rows: pa.Table) -> list[pa.Array]:
    """One row of the index from documents of one ``m``."""
    lengths = rows.column("terms").combine_chunks().value_lengths().to_numpy()
    terms = rows.column("terms").combine_chunks().flatten().to_numpy().astype(np.int64)
    tfs = rows.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
    documents = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((documents, -tfs, terms))
    one = pa.array([0, len(terms)], pa.int32())
    names = rows.column("doc_id").combine_chunks()
    return [
        pa.array([m], pa.int64()),
        pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
        *[pa.ListArray.from_arrays(one, pa.array(values[order], pa.int32())) for values in (terms, tfs, documents)],
    ]


def stratified_index(counts: DataFrame, documents: int, length: int) -> DataFrame:
    """The strata of ``counts``, of ``documents`` documents with ``length`` terms in all.

    Neighbouring strata go to one task up to ``TASK_POSTINGS``, larger ones to several, by the documents' hash:
    long documents hold most of the postings, so tasks of as many documents each would be uneven. A task cuts its rows
    where m changes and at a size. A row has m, the documents and the postings by term and descending tf.
    """
    if not documents:
        m = F.lit(0).cast("long")
    else:
        m = F.expr(f"10 + (90 * n * {documents}L) div {length}L")
    names = ["m", "doc_ids", "terms", "tfs", "documents"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        held_m, held_documents, held_postings = None, 0, 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(_stratum(held_m, pa.concat_tables(held)), names)

        for batch in slices(batches, 1024):
            ms = batch.column("m").to_numpy()
            postings = np.cumsum(batch.column("terms").value_lengths().to_numpy().astype(np.int64))
            whole, start = pa.Table.from_batches([batch]), 0
            while start < len(ms):
                if held and (
                    ms[start] != held_m or held_documents >= STRATUM_DOCUMENTS or held_postings >= STRATUM_POSTINGS
                ):
                    yield row()
                    held, held_documents, held_postings = [], 0, 0
                held_m = int(ms[start])
                # Up to the next m, or to where the row is full.
                before = int(postings[start - 1]) if start else 0
                end = min(
                    int(np.searchsorted(ms, held_m, side="right")),
                    start + STRATUM_DOCUMENTS - held_documents,
                    int(np.searchsorted(postings, before + STRATUM_POSTINGS - held_postings)) + 1,
                )
                held.append(whole.slice(start, end - start))
                held_documents += end - start
                held_postings += int(postings[end - 1]) - before
                start = end
        if held:
            yield row()

    rows = counts.select("doc_id", "n", "terms", "tfs", m.alias("m"))
    strata = rows.groupBy("m").agg(F.sum(F.size("terms") + F.lit(1)).alias("postings"))
    # As many rows as there are different lengths, up to the factor of m.
    earlier = Window.orderBy("m").rowsBetween(Window.unboundedPreceding, -1)
    strata = strata.withColumn("before", F.coalesce(F.sum("postings").over(earlier), F.lit(0)))
    strata = stage(strata, "strata-sizes")
    total = strata.agg(F.coalesce(F.sum("postings"), F.lit(0))).first()[0]
    cores = counts.sparkSession.sparkContext.defaultParallelism
    share = max(1, min(TASK_POSTINGS, -(-total // (4 * cores))))
    first = F.floor(F.col("before") / share)
    parts = F.ceil(F.col("postings") / share)
    spread = F.pmod(F.xxhash64("doc_id", "n", "terms", "tfs"), parts)
    placed = rows.join(small_side(strata), "m").withColumn("task", first + spread)
    dealt = placed.repartition(-(-total // share) + 1, "task").sortWithinPartitions("m")
    id_type = counts.schema["doc_id"].dataType.simpleString()
    schema = f"m long, doc_ids array<{id_type}>, terms array<int>, tfs array<int>, documents array<int>"
    return map_arrow(dealt.select("doc_id", "terms", "tfs", "m"), build, schema)


class Stratum:
    """A row of the index, with the impact of every run of equal term and tf."""

    def __init__(self, row: dict[str, pa.Array], m: int, vocabulary: int):
        self.names = row["doc_ids"]
        terms = row["terms"].to_numpy().astype(np.int64)
        tfs = row["tfs"].to_numpy().astype(np.int64)
        self.documents = row["documents"].to_numpy()
        runs = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1])][: len(terms)])
        impacts = 1_000_000_000 * tfs[runs] // (1000 * tfs[runs] + 8 * m)
        self.impacts = np.repeat(impacts, np.diff(np.r_[runs, len(terms)]))
        firsts = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]][: len(terms)])
        self.starts, self.sizes = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, np.int64)
        self.starts[terms[firsts]] = firsts
        self.sizes[terms[firsts]] = np.diff(np.r_[firsts, len(terms)])
        # Postings of a term begin with its largest tf.
        self.peaks = np.zeros(vocabulary, np.int64)
        self.peaks[terms[firsts]] = self.impacts[firsts]

    def scores(self, items: np.ndarray, terms: np.ndarray, weights: np.ndarray, count: int) -> np.ndarray:
        """Scores of ``count`` items (rows) for all documents, of the pairs of items and terms."""
        sizes = self.sizes[terms]
        ends = np.cumsum(sizes)
        places = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[terms] - ends + sizes, sizes)
        cells = np.repeat(items, sizes) * len(self.names) + self.documents[places]
        # Sums of integers below 2 ** 53 are exact.
        values = np.repeat(weights, sizes) * self.impacts[places]
        return np.bincount(cells, values, count * len(self.names)).reshape(count, len(self.names)).astype(np.int64)


def _order_of(score: int, name: object) -> tuple:
    return (-score, name is None, 0 if name is None else name)


class Search:
    """The best documents of each item in the strata visited so far."""

    def __init__(self, items: Items, weights: np.ndarray):
        self.items, self.weights = items, weights
        count = len(items.names)
        self.best: list[list[tuple[int, object]]] = [[] for _ in range(count)]
        self.least = np.ones(count, np.int64)
        self.pair_start = np.searchsorted(items.pair_item, np.arange(count + 1))
        self.pair_weight = weights[items.pair_term]
        self.visits = 0

    def bounds(self, stratum: Stratum) -> np.ndarray:
        """What each item can score in the stratum at most."""
        values = self.pair_weight * stratum.peaks[self.items.pair_term]
        return np.bincount(self.items.pair_item, values, len(self.best)).astype(np.int64)

    def visit_all(self, strata: list[Stratum]) -> None:
        """Visit strata by descending bound, each by the items that can still gain from it."""
        bounds = [self.bounds(stratum) for stratum in strata]
        for at in sorted(range(len(strata)), key=lambda i: -int(bounds[i].max(initial=0))):
            active = np.flatnonzero(bounds[at] >= self.least)
            self.visits += len(active)
            step = max(1, CELLS // max(1, len(strata[at].names)))
            for start in range(0, len(active), step):
                self._visit(strata[at], active[start : start + step])

    def _visit(self, stratum: Stratum, active: np.ndarray) -> None:
        starts, ends = self.pair_start[active], self.pair_start[active + 1]
        sizes = ends - starts
        pairs = np.arange(int(sizes.sum())) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
        local = np.repeat(np.arange(len(active)), sizes)
        terms = self.items.pair_term[pairs]
        present = stratum.sizes[terms] > 0
        local, terms, weights = local[present], terms[present], self.pair_weight[pairs][present]
        for begin, end, low, high in self._portions(stratum, local, terms, len(active)):
            scores = stratum.scores(local[begin:end] - low, terms[begin:end], weights[begin:end], high - low)
            gains = np.flatnonzero(scores.max(axis=1) >= self.least[active[low:high]])
            for row in gains:
                self._merge(int(active[low + row]), scores[row], stratum.names)

    @staticmethod
    def _portions(stratum: Stratum, local: np.ndarray, terms: np.ndarray, count: int) -> Iterator[tuple[int, int, int, int]]:
        """Ranges of pairs and items with at most ``CELLS`` postings, or one item's."""
        upto = np.searchsorted(local, np.arange(count + 1))
        total = np.r_[0, np.cumsum(stratum.sizes[terms])][upto]
        low = 0
        while low < count:
            high = max(low + 1, int(np.searchsorted(total, total[low] + CELLS, side="right")) - 1)
            yield int(upto[low]), int(upto[high]), low, high
            low = high

    def _merge(self, item: int, scores: np.ndarray, names: pa.Array) -> None:
        places = np.flatnonzero(scores >= self.least[item])
        if len(places) > 4 * BEST:
            # Ties with the tenth stay, as doc_ids decide.
            tenth = np.partition(scores[places], len(places) - BEST)[len(places) - BEST]
            places = places[scores[places] >= tenth]
        found = zip(scores[places].tolist(), names.take(pa.array(places)).to_pylist())
        best = sorted([*self.best[item], *found], key=lambda pair: _order_of(*pair))[:BEST]
        self.best[item] = best
        if len(best) == BEST:
            self.least[item] = best[-1][0]


def search_index(index: DataFrame, items: Items, weights: np.ndarray, block: int) -> DataFrame:
    """Each task's best documents for each item: block, item, item_id, doc_id, score."""
    id_type = index.schema["doc_ids"].dataType.elementType
    names, kind = items.names, pa.int64()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, doc_type = Search(items, weights), None
        for batch in slices(batches, max(1, min(STRATA_AT_A_TIME, CELLS // (len(weights) + 1)))):
            doc_type = batch.column("doc_ids").type.value_type
            ms = batch.column("m").to_pylist()
            rows = [{name: batch.column(name)[i].values for name in ("doc_ids", "terms", "tfs", "documents")} for i in range(len(ms))]
            state.visit_all([Stratum(row, m, len(weights)) for row, m in zip(rows, ms)])
        found = [(i, score, name) for i, best in enumerate(state.best) for score, name in best]
        if found:
            numbers = pa.array([i for i, _, _ in found], kind)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(found), block), kind),
                    numbers,
                    names.take(numbers),
                    pa.array([name for _, _, name in found], doc_type),
                    pa.array([score for _, score, _ in found], kind),
                ],
                ["block", "item", "item_id", "doc_id", "score"],
            )

    item_type = {"int64": "long", "int32": "int"}.get(str(names.type), "string")
    schema = f"block long, item long, item_id {item_type}, doc_id {id_type.simpleString()}, score long"
    return map_arrow(index, search, schema)


def term_weights(frequencies: dict[int, int], size: int, documents: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of terms 0 to ``size``."""
    ratio = lambda df: (2 * documents + 2) / (2 * df + 1)
    return np.array([math.floor(1000 * math.log(ratio(frequencies.get(i, 0)))) for i in range(size)], np.int64)


def ranked_search(documents: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``BEST`` documents (doc_id, text) of each item (item_id, text): item_id, rank, doc_id, score.

    Every row is a document of its own, also where ids repeat or are null. Equal rows of ``items`` are one item;
    items of one id, or none, and different texts are ranked each on their own. Items and documents without
    a term, null and empty texts among them, are in no result. Equal scores go by ascending doc_id, nulls last.
    """
    spark = documents.sparkSession
    texts = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 64
    total = texts.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    numbered = texts.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    numbered = stage(numbered.repartition("block") if blocks > 1 else numbered, "items")
    found = []
    for block in range(blocks):
        rows = numbered.filter(F.col("block") == block).select("item_id", "text").toArrow()
        asked = Items.of(rows.column("item_id").combine_chunks(), rows.column("text").to_pylist())
        counts = stage(term_counts(documents, asked.vocabulary), "term-counts")
        sums = counts.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
        seen = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
        weights = term_weights({row["term"]: row["df"] for row in seen}, len(asked.vocabulary), sums["documents"])
        index = stage(stratified_index(counts, sums["documents"], sums["length"]), "strata")
        found.append(search_index(index, asked, weights, block))
    every = stage(reduce(DataFrame.unionByName, found), "best-of-tasks")
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= BEST)
    return best.select("item_id", "rank", "doc_id", "score")
