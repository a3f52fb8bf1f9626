"""Removal of byte strings that occur more than once, by interval expansion on a Burrows-Wheeler transform.

Every string of ``LENGTH`` bytes holds one smallest fingerprint among its substrings of ``KEY_BYTES``
bytes, so equal strings have equal keys. Consecutive strings whose key stands at the same place form a
run, and the bytes they cover its context; no run holds one string twice. Keys that occur once are done with; the contexts of the others meet by key, equal
ones as one.

There the contexts are joined to one text with an own mark after each, their suffixes sorted and the
transform taken. Breadth-first, all intervals of strings of length l are extended by the characters
before them; where an extended interval ends and no common prefix is known yet, it is l. After
``LENGTH`` rounds, suffixes with no known common prefix share at least ``LENGTH`` bytes, and these starts
are the repeated ones.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.llm.tables import map_arrow, slices, small_side, sorted_groups
from aerolag.storage import stage

LENGTH = 400
KEY_BYTES = 200
#: Bytes fingerprinted at a time, and bytes of contexts one transform is taken of, about.
PIECE_BYTES = 1 << 20
CHUNK_BYTES = 96 * 1024
#: Contexts of one key that one transform is taken of; with more, every two blocks meet.
KEY_BLOCK = 1024
#: Contexts a task of transforms gets, about.
TASK_CONTEXTS = 10_000
REMEMBERED = 200_000

_rng = np.random.default_rng(4)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(0, 1 << 62)) * 4 + 3


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base % (1 << 64), dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_BASE, PIECE_BYTES + 4 * LENGTH)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), PIECE_BYTES + 4 * LENGTH)


def fingerprints(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit fingerprint of every substring of ``length`` bytes."""
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[data] * _UP[: len(data)], dtype=np.uint64)])
    values = (sums[length:] - sums[:-length]) * _DOWN[: len(data) - length + 1]
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return values ^ (values >> np.uint64(29))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive values."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    from_left = np.minimum.accumulate(rows, axis=1).ravel()
    from_right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(from_right[:count], from_left[width - 1 : width - 1 + count])


def runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, key, first start and number of starts of all runs; the texts take about a piece together."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if len(data) < LENGTH:
        return (np.empty(0, dtype=np.int64),) * 4
    prints = fingerprints(data, KEY_BYTES)
    keys = sliding_minimum(prints, LENGTH - KEY_BYTES + 1)
    # Where the string before began with its key, the key of this one stands farther on.
    moved = np.concatenate([[True], prints[: len(keys) - 1] == keys[:-1]])
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(keys)]
    starts = np.flatnonzero(np.arange(len(keys)) + LENGTH <= (begins + sizes)[owner])
    if not len(starts):
        return (np.empty(0, dtype=np.int64),) * 4
    key, text = keys[starts], owner[starts]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (text[1:] != text[:-1])])
    first = np.flatnonzero(new | moved[starts])
    count = np.diff(np.append(first, len(starts)))
    return text[first], key[first].astype(np.int64), (starts - begins[text])[first], count


def _suffix_array(symbols: np.ndarray, depth_wanted: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth_wanted`` symbols."""
    size = len(symbols)
    bits = int(symbols.max() + 1).bit_length()
    depth = max(1, 62 // bits)
    padded = np.concatenate([symbols + 1, np.zeros(depth, dtype=np.int64)])
    code = np.zeros(size, dtype=np.int64)
    for ahead in range(depth):
        code = (code << bits) | padded[ahead : ahead + size]
    order = np.argsort(code, kind="stable")
    sorted_code = code[order]
    first = np.concatenate([[True], sorted_code[1:] != sorted_code[:-1]])
    rank = np.empty(size + 1, dtype=np.int64)
    rank[size] = -1
    # A rank is the place where the group of suffixes not told apart yet begins.
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(size), 0))
    while depth < depth_wanted:
        alone = first & np.append(first[1:], True)
        places = np.flatnonzero(~alone)
        if not len(places):
            break
        open_ones = order[places]
        code = rank[open_ones] * (size + 1) + rank[np.minimum(open_ones + depth, size)] + 1
        by_code = np.argsort(code, kind="stable")
        code = code[by_code]
        order[places] = open_ones[by_code]
        new = np.concatenate([[True], code[1:] != code[:-1]])
        first[places] |= new
        rank[order] = np.maximum.accumulate(np.where(first, np.arange(size), 0))
        depth *= 2
    return order


def repeated_starts(contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each context the starts of its strings of ``length`` bytes that start somewhere else too."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    ends = np.cumsum(sizes + 1) - 1
    size = int(ends[-1]) + 1 if len(contexts) else 0
    if not size:
        return []
    symbols = np.zeros(size, dtype=np.int64)
    inside = np.ones(size, dtype=bool)
    inside[ends] = False
    symbols[inside] = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    symbols[ends] = 256 + np.arange(len(contexts))
    order = _suffix_array(symbols, length)
    place = np.empty(size, dtype=np.int64)
    place[order] = np.arange(size)
    transform = symbols[order - 1]
    before = place[order - 1]

    known = np.zeros(size + 1, dtype=bool)
    low, high = np.array([0]), np.array([size])
    for _ in range(length):
        if not len(low):
            break
        widths = high - low
        interval = np.repeat(np.arange(len(low)), widths)
        rows = np.repeat(low - np.cumsum(widths) + widths, widths) + np.arange(widths.sum())
        # Rows of one interval with one character before them are the rows of the extended interval.
        code = interval * (256 + len(contexts)) + transform[rows]
        by_code = np.argsort(code, kind="stable")
        code, into = code[by_code], before[rows[by_code]]
        cuts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        low = np.minimum.reduceat(into, cuts)
        high = low + np.diff(np.append(cuts, len(code)))
        new = ~known[high]
        low, high = low[new], high[new]
        known[high] = True
    shared = ~known[1:size]
    twice = np.zeros(size, dtype=bool)
    twice[1:] |= shared
    twice[:-1] |= shared
    starts = np.sort(order[twice])
    owner = np.searchsorted(ends, starts)
    begins = ends - sizes
    return [starts[owner == number] - begins[number] for number in range(len(contexts))] if len(starts) else [starts] * len(contexts)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans as maximal spans in order."""
    if not len(starts):
        return starts, ends
    by_start = np.argsort(starts, kind="stable")
    starts, ends = starts[by_start], np.maximum.accumulate(ends[by_start])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    return starts[new], ends[last]


def find_runs(texts: DataFrame) -> DataFrame:
    """Runs of the distinct texts (cls, text): cls, key, start, starts. A text may come once a task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[int, int, bytes]] = []

        def send() -> pa.RecordBatch | None:
            text, key, start, count = runs([part for _, _, part in held])
            cls, offset = (np.array([h[x] for h in held], dtype=np.int64) for x in (0, 1))
            return pa.RecordBatch.from_pydict({"cls": cls[text], "key": key, "start": start + offset[text], "starts": count})

        size = 0
        for batch in slices(batches):
            for cls, text in zip(batch.column("cls").to_pylist(), batch.column("text").to_pylist()):
                if cls in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(cls)
                data = text.encode("utf-8", "surrogatepass")
                for at in range(0, max(0, len(data) - LENGTH + 1), PIECE_BYTES):
                    part = data[at : at + PIECE_BYTES + LENGTH - 1]
                    if held and size + len(part) > PIECE_BYTES:
                        yield send()
                        held, size = [], 0
                    held.append((cls, at, part))
                    size += len(part)
        if held:
            yield send()

    return map_arrow(texts, read, "cls long, key long, start long, starts long")


def _contexts(involved: DataFrame) -> DataFrame:
    """The contexts of listed runs: key, cls, start, ctx, print (a fingerprint of ctx)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            rows, held = [], 0
            for cls, text, listed in zip(*(batch.column(name).to_pylist() for name in ("cls", "text", "listed"))):
                data = text.encode("utf-8", "surrogatepass")
                for run in listed:
                    rows.append((run["key"], cls, run["start"], data[run["start"] : run["start"] + run["starts"] + LENGTH - 1]))
                    held += len(rows[-1][3])
                if held > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["key", "cls", "start", "ctx"])
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["key", "cls", "start", "ctx"])

    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    found = map_arrow(involved.select("cls", "text", "listed"), read, "key long, cls long, start long, ctx binary")
    return found.withColumn("print", F.xxhash64("ctx"))


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For sorted contexts (key, i, j, print, ctx): the spans of each that repeated strings cover."""
    held: list[tuple[int, int, bytes]] = []

    def send() -> pa.RecordBatch | None:
        rows = []
        for (key, mark, _), starts in zip(held, repeated_starts([ctx for _, _, ctx in held])):
            low, high = merged(starts, starts + LENGTH)
            rows += [(key, mark, a, b) for a, b in zip(low.tolist(), high.tolist())]
        if not rows:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["key", "print", "low", "high"])

    size = 0
    for (key, _, _), group in sorted_groups(batches, ["key", "i", "j"]):
        ctxs = group.column("ctx").to_pylist()
        more = sum(map(len, ctxs))
        if held and size + more > CHUNK_BYTES:
            if (out := send()) is not None:
                yield out
            held, size = [], 0
        held += [(key, mark, ctx) for mark, ctx in zip(group.column("print").to_pylist(), ctxs)]
        size += more
    if held and (out := send()) is not None:
        yield out


def repeated_spans(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For texts (cls, text; equal texts have one cls): stored texts with runs to look at, and spans (cls, low, high).

    The spans cover every byte of a distinct text that a repeated string covers, those repeated only
    by copies of the whole text left out.
    """
    found = stage(find_runs(texts), "runs")
    # Of numbers, not of structs: those are summed up in place, without a sort of all runs.
    ends = [end(name).alias(f"{way}_{name}") for name in ("cls", "start") for way, end in (("low", F.min), ("high", F.max))]
    again = found.groupBy("key").agg(*ends).filter("low_cls < high_cls OR low_start < high_start").select("key")
    # Dealt by place after the join, so that a key of very many runs is no task of its own.
    again = small_side(stage(again, "repeated-keys"))
    found = found.join(again, "key").repartition("cls", "key", "start").distinct()
    listed = stage(found.groupBy("cls").agg(F.collect_list(F.struct("key", "start", "starts")).alias("listed")), "listed-runs")
    # While few texts are concerned, the others are left out before texts are shuffled.
    concerned = small_side(listed.select("cls"))
    once = texts.join(concerned, "cls", "left_semi").dropDuplicates(["cls"])
    involved = stage(once.join(listed, "cls").select("cls", "text", "listed"), "texts-with-runs")

    contexts = _contexts(involved)
    distinct = stage(contexts.groupBy("key", "print").agg(F.first("ctx").alias("ctx"), F.count("*").alias("n")), "contexts")
    groups = distinct.groupBy("key").agg(F.count("*").alias("contexts")).filter("contexts > 1")
    groups = groups.select("key", F.ceil(F.col("contexts") / KEY_BLOCK).alias("blocks"))
    together = distinct.join(groups, "key").withColumn("block", F.pmod("print", "blocks"))
    together = together.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    together = together.select("key", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "print", "ctx")
    # By a count: sorting suffixes takes time, and adaptive execution would join tasks by their few bytes.
    cores = texts.sparkSession.sparkContext.defaultParallelism
    tasks = max(4 * cores, -(-distinct.count() // TASK_CONTEXTS))
    dealt = together.repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    covered = map_arrow(dealt, _covered, "key long, print long, low long, high long")
    whole = distinct.filter("n > 1").select("key", "print", F.lit(0).cast("long").alias("low"), F.length("ctx").cast("long").alias("high"))
    spans = stage(covered.unionByName(whole), "covered")

    occurrence = F.explode("listed").alias("run")
    occurrences = contexts.select("cls", "key", "start", "print")
    placed = occurrences.join(spans, ["key", "print"])
    return involved, placed.select("cls", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))


def _classes(rows: DataFrame, hashed: Callable[[int], Column] = lambda seed: F.xxhash64("text", F.lit(seed))) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``cls``, equal for equal texts and them only, and what is known of each row without its text.

    The class is a 64-bit hash. Texts of one class and different SHA-256 are looked for, and while there are any,
    all rows are hashed with another seed.
    """
    sha = F.sha2(F.col("text").cast("binary"), 256).alias("sha")
    for seed in itertools.count():
        known = rows.withColumn("cls", hashed(seed))
        about = stage(known.select("doc_id", "cls", "n_bytes", sha), "documents")
        other = F.xxhash64("sha")
        mixed = about.groupBy("cls").agg(F.min(other).alias("low"), F.max(other).alias("high")).filter("low < high")
        if mixed.isEmpty():
            return known, about


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document (doc_id, text).

    A null text is empty, and nothing of a text below ``LENGTH`` bytes is removed. Rows are
    documents of their own whatever their doc_id; of equal texts of at least ``LENGTH`` bytes nothing
    is kept.
    """
    rows = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    rows, about = _classes(rows)
    involved, spans = repeated_spans(rows.filter(F.col("n_bytes") >= LENGTH).select("cls", "text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            out = []
            for cls, text, spans in zip(*(batch.column(name).to_pylist() for name in ("cls", "text", "spans"))):
                data = text.encode("utf-8", "surrogatepass")
                low = np.fromiter((s["low"] for s in spans), np.int64, len(spans))
                high = np.fromiter((s["high"] for s in spans), np.int64, len(spans))
                low, high = merged(low, high)
                kept = hashlib.sha256()
                at = 0
                for a, b in zip(low.tolist(), high.tolist()):
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                out.append((cls, int((high - low).sum()), len(low), kept.hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["cls", "n_removed", "n_spans", "kept_sha256"])

    of_text = spans.groupBy("cls").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    cut = map_arrow(involved.select("cls", "text").join(of_text, "cls"), read, "cls long, n_removed long, n_spans long, kept_sha256 string")
    copies = about.groupBy("cls").agg(F.count("*").alias("copies"))
    changed = copies.join(cut, "cls", "left").filter("copies > 1 OR n_removed > 0")
    joined = about.join(changed, "cls", "left")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    zero = F.lit(0).cast("long")
    return joined.select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
