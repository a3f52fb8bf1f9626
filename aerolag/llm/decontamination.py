"""Benchmark decontamination by Wu-Manber search over words.

The patterns are the benchmark's windows of ten words (an item of fewer words is one window). A text
is a row of word numbers. For the block of up to three words that ends at the place looked at, a shift
table tells how far the search can skip because no pattern can end sooner. Where the shift is zero, the
block's bucket gives the patterns that end in it, and comparing them word by word confirms an
occurrence. Many places of a batch of texts are looked at in one step, each going on with its own shift.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.llm.tables import map_arrow, slices
from aerolag.storage import remove, scratch_path, stage

WINDOW_WORDS = 10
BLOCK_WORDS = 3
#: Places of a shift table: the power of two above so many a block, within bounds (4 bytes each). Few blocks
#: share a place then, so most of the table still shifts by the whole length.
PLACES_PER_BLOCK, TABLE_SIZES = 4, (1 << 14, 1 << 23)
STRETCH = 512
#: So much benchmark text is searched for at a time.
BENCHMARK_BLOCK_BYTES = 4 * 1024 * 1024

_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Words of a text: runs of digits, letters and characters beyond ASCII, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split()


class Patterns:
    """The windows of one length with their shift table and suffix buckets."""

    def __init__(self, length: int, windows: np.ndarray):
        self.length, self.windows = length, windows
        self.block = min(BLOCK_WORDS, length)
        wanted = PLACES_PER_BLOCK * len(windows) * (length - self.block + 1)
        self.size = 1 << int(np.clip(wanted, *TABLE_SIZES) - 1).bit_length()
        self.shift = np.full(self.size, length - self.block + 1, dtype=np.int32)
        for end in range(self.block - 1, length):
            codes = self.codes(windows, np.full(len(windows), end), by_row=True)
            np.minimum.at(self.shift, codes, length - 1 - end)
        last = self.codes(windows, np.full(len(windows), length - 1), by_row=True)
        self.order = np.argsort(last, kind="stable")
        self.bucket = last[self.order]

    def codes(self, numbers: np.ndarray, ends: np.ndarray, by_row: bool = False) -> np.ndarray:
        """Table places of the blocks that end at ``ends``."""
        code = np.zeros(len(ends), dtype=np.uint64)
        for back in range(self.block):
            at = ends - back
            word = numbers[np.arange(len(ends)), at] if by_row else numbers[at]
            code = (code ^ word.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        return (code & np.uint64(self.size - 1)).astype(np.int64)

    def search(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends and window numbers of all occurrences."""
        starts = np.arange(self.length - 1, len(numbers), STRETCH)
        at, stop = starts, np.minimum(starts + STRETCH, len(numbers))
        ends, found = [], []
        while len(at):
            codes = self.codes(numbers, at)
            step = self.shift[codes]
            hit = step == 0
            if hit.any():
                where, code = at[hit], codes[hit]
                low, high = np.searchsorted(self.bucket, code), np.searchsorted(self.bucket, code, "right")
                size = high - low
                where = np.repeat(where, size)
                entry = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
                window = self.order[entry]
                for place in range(self.length):
                    same = numbers[where - self.length + 1 + place] == self.windows[window, place]
                    where, window = where[same], window[same]
                ends.append(where)
                found.append(window)
            at = at + np.maximum(step, 1)
            left = at < stop
            at, stop = at[left], stop[left]
        if not ends:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return np.concatenate(ends), np.concatenate(found)


class Benchmark:
    """Windows of some items, by length, and the items each window is in."""

    def __init__(self, items: list[tuple[str | None, str | None]]):
        self.number: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str | None]] = {}
        for item, text in items:
            numbers = [self.number.setdefault(word, len(self.number) + 1) for word in words(text)]
            length = min(WINDOW_WORDS, len(numbers))
            for start in range(len(numbers) - length + 1 if length else 0):
                windows.setdefault(tuple(numbers[start : start + length]), set()).add(item)
        self.patterns, self.items = [], []
        for length in sorted({len(window) for window in windows}):
            chosen = [window for window in windows if len(window) == length]
            self.patterns.append(Patterns(length, np.array(chosen, dtype=np.int64)))
            self.items.append([list(windows[window]) for window in chosen])

    def search(self, texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str | None]]]:
        """For each text the word spans that occurrences start and end at (exclusive), and the items."""
        numbers = [np.fromiter(map(self.number.get, text, repeat(0)), np.int64, len(text)) for text in texts]
        # A zero, which no pattern holds, after each text keeps occurrences inside.
        starts = np.cumsum([0] + [len(part) + 1 for part in numbers])
        joined = np.zeros(starts[-1], dtype=np.int64)
        for start, part in zip(starts, numbers):
            joined[start : start + len(part)] = part
        out = [([], set()) for _ in texts]
        for patterns, items in zip(self.patterns, self.items):
            ends, found = patterns.search(joined)
            owner = np.searchsorted(starts, ends, "right") - 1
            for text, end, window in zip(owner.tolist(), (ends - starts[owner]).tolist(), found.tolist()):
                out[text][0].append((end + 1 - patterns.length, end + 1))
                out[text][1].update(items[window])
        return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _search_block(documents: DataFrame, shared: Broadcast) -> DataFrame:
    """Add what one block of the benchmark finds to the columns ``_n_words``, ``_spans``, ``_items``."""
    kept = [name for name in documents.columns if name not in ("_n_words", "_spans", "_items")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmark = Benchmark(shared.value)
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in slices(batches):
            texts = [words(text) for text in batch.column("_text").to_pylist()]
            spans, items = batch.column("_spans").to_pylist(), batch.column("_items").to_pylist()
            for i, (more, found) in enumerate(benchmark.search(texts)):
                spans[i] = _merged([(s["start"], s["end"]) for s in spans[i]] + more)
                items[i] = sorted(found.union(items[i]), key=lambda item: (item is None, item))
            spans = [[{"start": s, "end": e} for s, e in row] for row in spans]
            columns = [batch.column(name) for name in kept]
            columns += [pa.array(map(len, texts), pa.int64()), pa.array(spans, spans_type), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "_n_words", "_spans", "_items"])

    fields = ", ".join(f"`{name}` {documents.schema[name].dataType.simpleString()}" for name in kept)
    return map_arrow(
        documents, search, f"{fields}, _n_words long, _spans array<struct<start:int,end:int>>, _items array<string>"
    )


def find_benchmark(documents: DataFrame, benchmark: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of every document with n_words, spans (word places) and items (ids as sorted strings) found in it.

    A null or empty text has no words. Items without words are not searched for; several rows of one item
    count as one. Items without an id are searched for like any other and are one null, the last, in items.
    An empty benchmark finds nothing.

    A benchmark beyond ``BENCHMARK_BLOCK_BYTES`` is written down in blocks of about that size, by a hash of item
    and text. Each is searched for in a pass of its own, which writes down what is found so far; the driver
    and the executors then drop the block, so they hold one at a time, and the folder of the pass before goes.
    """
    spark = documents.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    items = items.filter("text IS NOT NULL").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BENCHMARK_BLOCK_BYTES))
    # The columns kept are packed under one name, so that no given name clashes with those added here.
    found = documents.select(
        F.struct(*columns).alias("_row"),
        F.col("text").cast("string").alias("_text"),
        F.lit(0).cast("long").alias("_n_words"),
        F.expr("CAST(array() AS array<struct<start:int,end:int>>)").alias("_spans"),
        F.expr("CAST(array() AS array<string>)").alias("_items"),
    )
    if blocks == 1:
        found = _search_block(found, spark.sparkContext.broadcast([tuple(row) for row in items.collect()]))
    else:
        path, written = scratch_path(spark, "benchmark"), None
        numbered = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)).cast("int"))
        numbered.repartition("block").write.partitionBy("block").parquet(path)
        numbered = spark.read.schema(numbered.schema).parquet(path)
        for block in range(blocks):
            part = numbered.filter(F.col("block") == block).select("item", "text").collect()
            shared = spark.sparkContext.broadcast([tuple(row) for row in part])
            before, written = written, scratch_path(spark, "found")
            found = stage(_search_block(found, shared), "found", written)
            shared.destroy()
            if before:
                remove(spark, before)
        remove(spark, path)
    return found.select(*[F.col(f"_row.`{name}`") for name in columns], F.col("_n_words").alias("n_words"), F.col("_spans").alias("spans"), F.col("_items").alias("items"))


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document.

    Items without an id count as one in n_items; items_sha256 is taken over the ids there are.
    """
    found = find_benchmark(documents, benchmark, ["doc_id"])
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
