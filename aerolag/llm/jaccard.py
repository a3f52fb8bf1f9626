"""Set similarity join of documents by the Jaccard coefficient of their word shingles.

Documents with equal sets form one class. Each class lists the shingles of its prefix, so that two
similar classes share a list: shingles in a rare-first order, of n of them the first n - ceil(0.75 n) + 1.

The lists are skipped through by the relations between sets. The first class of a list is compared with
its other members, which gives exact overlaps and, by the links found, components; members of one
component need no further answer. For the others the answers derive from those of the first class r:
with the shingles of r that x and y each hold as bits, and the few others that occur again listed, the
overlap of x and y is that of the bits and of the lists, and the sets themselves are not read again. The
members are taken in blocks by the place their shingle has in them, and two blocks are skipped together
where what is left behind those places cannot reach the overlap that the blocks' sizes ask for.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.llm.components import connected_components
from aerolag.llm.shingles import set_key, shingle_set
from aerolag.llm.tables import map_arrow, slices, small_side, sorted_groups
from aerolag.storage import stage

#: Two sets link when LINK[1] * intersection >= LINK[0] * union.
LINK = (75, 100)
#: A shingle in so many classes comes last in the order.
HEAVY = 32
#: Largest size of the two bitmaps of shingles that occur again and that are heavy, in bits as a power of two,
#: and bits for each shingle below it.
BITMAP_BITS = 27
BITS_A_SHINGLE = 16
#: Shingles counted in one task, about.
COUNTED_AT_ONCE = 1 << 22
#: Leading bits a shingle is counted by, within the bucket they begin with.
COUNTED_BITS = 28
#: Fewer shingles than this are sent as they are.
PACKED_FROM = 512
#: Shingles a task gathers before it sends them to be counted.
GATHERED = 1 << 21
#: Sets a task remembers, so that copies are worked on once.
REMEMBERED = 200_000
#: Members of a list, or comparisons with one set, that one task takes at a time.
LIST_BLOCK = 2048
#: Members of a list that are skipped together.
SKIP_BLOCK = 256


def _links(overlap: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether sets of ``size`` elements in all (both sizes added) and ``overlap`` in common link."""
    return LINK[1] * overlap >= LINK[0] * (size - overlap)


def set_members(documents: DataFrame, names: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``names``, n_shingles and set_key (null for an empty set) of every document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *map(batch.column, names), pa.array(map(len, sets), pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                ],
                [*names, "n_shingles", "set_key"],
            )

    kept = ", ".join(f"`{name}` {documents.schema[name].dataType.simpleString()}" for name in names)
    return map_arrow(documents, read, f"{kept}, n_shingles long, set_key long")


def _new_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, str]]:
    """Key, fingerprints and text of the sets of a task, copies left out as far as they are remembered."""
    seen: set[int] = set()
    for batch in slices(batches):
        for text in batch.column("text").to_pylist():
            fingerprints = shingle_set(text)
            if len(fingerprints) and (key := set_key(fingerprints)) not in seen:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(key)
                yield key, fingerprints, text


def _packed(low: np.ndarray) -> bytes:
    """Sorted numbers of ``COUNTED_BITS`` bits: the lower 16 of each, the upper ones as gaps in a bitmap."""
    if len(low) < PACKED_FROM:
        return struct.pack("<I", len(low)) + low.astype("<u4").tobytes()
    bits = np.zeros(len(low) + (1 << (COUNTED_BITS - 16)), dtype=bool)
    bits[(low >> 16).astype(np.int64) + np.arange(len(low))] = True
    return struct.pack("<I", len(low)) + low.astype("<u2").tobytes() + np.packbits(bits).tobytes()


def _unpacked(part: bytes) -> np.ndarray:
    """The numbers that ``_packed`` wrote."""
    (n,) = struct.unpack_from("<I", part)
    if n < PACKED_FROM:
        return np.frombuffer(part, "<u4", n, 4)
    marked = np.flatnonzero(np.unpackbits(np.frombuffer(part, np.uint8, offset=4 + 2 * n)))
    return ((marked - np.arange(n)) << 16).astype("<u4") | np.frombuffer(part, "<u2", n, 4)


class Marks:
    """Two bitmaps over the leading bits of fingerprints: those that occur again, and the heavy ones.

    The driver holds them as the parts that tasks have compressed, (first byte, again, heavy), and a task unpacks
    what it looks up. Marks are shared by fingerprints with equal leading bits, so a mark may say too much but
    never too little; the order of shingles they define is exact for any marks.
    """

    def __init__(self, bits: int, parts: list[tuple[int, bytes, bytes]]):
        self.bits, self.parts = bits, parts

    def _unpacked(self, column: int) -> np.ndarray:
        bitmap = np.zeros(1 << (self.bits - 3), dtype=np.uint8)
        for part in self.parts:
            some = np.frombuffer(zlib.decompress(part[column]), np.uint8)
            bitmap[part[0] : part[0] + len(some)] |= some
        return bitmap

    def again(self) -> np.ndarray:
        return self._unpacked(1)

    def heavy(self) -> np.ndarray:
        return self._unpacked(2)

    def of(self, bitmap: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
        """The marks (0 or 1) of ``fingerprints`` in a bitmap that was unpacked."""
        place = (fingerprints >> np.uint64(64 - self.bits)).astype(np.int64)
        return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1


def repeated_shingles(documents: DataFrame, total: int) -> Marks:
    """The marks of all shingles of ``documents`` (text).

    Counts cover every set. ``total`` bounds the shingles and sets how many tasks count and how large the bitmaps are.
    """
    bits = min(BITMAP_BITS, max(16, (BITS_A_SHINGLE * total).bit_length()))
    buckets = min(bits - 3, max(4, (total // COUNTED_AT_ONCE).bit_length()))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def send() -> pa.RecordBatch:
            all_of = np.sort(np.concatenate(held))
            low = ((all_of << np.uint64(buckets)) >> np.uint64(64 - COUNTED_BITS)).astype("<u4")
            edges = np.searchsorted(all_of, np.arange(1 << buckets, dtype=np.uint64) << np.uint64(64 - buckets))
            edges = [*edges.tolist(), len(all_of)]
            parts = [(b, _packed(low[edges[b] : edges[b + 1]])) for b in range(1 << buckets) if edges[b] < edges[b + 1]]
            return pa.RecordBatch.from_pydict({"bucket": [p[0] for p in parts], "part": [p[1] for p in parts]})

        for _, fingerprints, _ in _new_sets(batches):
            held.append(fingerprints)
            size += len(fingerprints)
            if size >= GATHERED:
                yield send()
                held, size = [], 0
        if held:
            yield send()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def marks(bucket: int, parts: list[bytes]) -> pa.RecordBatch:
            low = np.sort(np.concatenate([_unpacked(part) for part in parts]))
            starts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
            counts = np.diff(np.append(starts, len(low)))
            whole = (np.uint64(bucket) << np.uint64(COUNTED_BITS)) | low[starts].astype(np.uint64)
            place = whole >> np.uint64(COUNTED_BITS + buckets - bits)
            first = (bucket << bits) >> buckets
            last = ((bucket + 1) << bits) >> buckets
            marked = np.zeros((2, last - first), dtype=bool)
            marked[0, (place[counts >= 2]).astype(np.int64) - first] = True
            marked[1, (place[counts >= HEAVY]).astype(np.int64) - first] = True
            again, heavy = (zlib.compress(np.packbits(row, bitorder="little"), 1) for row in marked)
            return pa.RecordBatch.from_pydict({"first": [first // 8], "again": [again], "heavy": [heavy]})

        bucket, parts = None, []
        for batch in slices(batches, 16):
            for at, part in zip(batch.column("bucket").to_pylist(), batch.column("part").to_pylist()):
                if parts and at != bucket:
                    yield marks(bucket, parts)
                    parts = []
                bucket = at
                parts.append(part)
        if parts:
            yield marks(bucket, parts)

    gathered = map_arrow(documents.select("text"), gather, "bucket long, part binary")
    sorted_parts = gathered.repartition("bucket").sortWithinPartitions("bucket")
    # Written down, so that what was shuffled goes at once.
    marked = stage(map_arrow(sorted_parts, count, "first long, again binary, heavy binary"), "marks")
    return Marks(bits, [(row["first"], bytes(row["again"]), bytes(row["heavy"])) for row in marked.toLocalIterator()])


def prefixes(documents: DataFrame, shared: Broadcast[Marks]) -> DataFrame:
    """set_key, size, text, and the shingles of the prefix that may occur again with their places.

    Sets whose prefix holds no such shingle are similar to none and left out. A set may come once a task.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        again, heavy = marks.again(), marks.heavy()
        rows, held = [], 0

        def send() -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), types)],
                ["set_key", "size", "text", "shingles", "places"],
            )

        for key, fingerprints, text in _new_sets(batches):
            level = marks.of(again, fingerprints) + marks.of(heavy, fingerprints)
            size = len(fingerprints)
            length = size - -(-LINK[0] * size // LINK[1]) + 1
            if np.count_nonzero(level == 0) >= length:
                continue
            order = np.argsort(level, kind="stable")[:length]
            chosen = np.flatnonzero(level[order] > 0)
            rows.append((key, size, text, fingerprints[order[chosen]].astype(np.int64), chosen.astype(np.int32)))
            held += len(text) + 12 * len(chosen)
            if held > 4_000_000:
                yield send()
                rows, held = [], 0
        if rows:
            yield send()

    return map_arrow(
        documents.select("text"), read, "set_key long, size long, text string, shingles array<long>, places array<int>"
    )


def compare(pairs: DataFrame, texts: DataFrame, shared: Broadcast[Marks]) -> DataFrame:
    """Exact answers for pairs (a, b) of set keys: a, b, size_a, size_b, overlap, bits, others.

    ``bits`` marks the shingles of a that b holds, in order; ``others`` lists those of b that a lacks
    and that may occur again. All comparisons with one ``a`` are dealt to tasks of about
    ``LIST_BLOCK``, to each of which its text comes once; the others pass by it one at a time.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / LIST_BLOCK).alias("parts"))
    dealt = pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part"))
    one_of_each = texts.select("set_key", "text").dropDuplicates(["set_key"])
    others = dealt.join(one_of_each, dealt["b"] == one_of_each["set_key"]).select("a", "part", "b", "text")
    firsts = dealt.select("a", "part").distinct().join(one_of_each, F.col("a") == one_of_each["set_key"])
    firsts = firsts.select("a", "part", F.lit(None).cast("long").alias("b"), "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        again = marks.again()
        types = [pa.int64()] * 5 + [pa.binary()] * 2
        first = np.empty(0, dtype=np.uint64)
        for batch in slices(batches):
            rows = []
            for a, b, text in zip(*(batch.column(name).to_pylist() for name in ("a", "b", "text"))):
                if b is None:
                    first = shingle_set(text)
                    continue
                other = shingle_set(text)
                at = np.minimum(np.searchsorted(first, other), len(first) - 1)
                common = first[at] == other
                bits = np.zeros(len(first), dtype=bool)
                bits[at[common]] = True
                rest = other[~common]
                rest = rest[marks.of(again, rest) > 0]
                rows.append((a, b, len(first), len(other), int(common.sum()), np.packbits(bits).tobytes(), rest.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), types)],
                    ["a", "b", "size_a", "size_b", "overlap", "bits", "others"],
                )

    together = others.unionByName(firsts).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return map_arrow(together, read, "a long, b long, size_a long, size_b long, overlap long, bits binary, others binary")


class _Members:
    """Members of one list as arrays, in blocks of falling reach."""

    def __init__(self, group: pa.Table, chosen: np.ndarray):
        group = group.take(pa.array(chosen))
        left = group.column("left").to_numpy()
        order = np.argsort(-left, kind="stable")
        group = group.take(pa.array(order))
        self.key, self.label, self.size = (group.column(name).to_numpy() for name in ("b", "label", "size"))
        self.left = left[order]
        self.bits = np.frombuffer(b"".join(group.column("bits").to_pylist()), np.uint8).reshape(len(order), -1)
        self.others = [np.frombuffer(others, np.uint64) for others in group.column("others").to_pylist()]
        self.more = np.fromiter(map(len, self.others), np.int64, len(order))
        self.starts = range(0, len(order), SKIP_BLOCK)
        self.smallest = [self.size[start : start + SKIP_BLOCK].min() for start in self.starts]


def _settle(mine: _Members, theirs: _Members, labels: dict[int, int]) -> list[tuple[int, int]]:
    """Links that connect what all links between ``mine`` and ``theirs`` connect, from derived answers."""

    def name(label: int) -> int:
        while labels.setdefault(label, label) != label:
            label = labels[label]
        return label

    out = []
    for row in range(len(mine.key)):
        block = row // SKIP_BLOCK
        for place, start in enumerate(theirs.starts):
            if mine is theirs and place < block:
                continue
            # Blocks by place: what is left in either bounds the overlap of any pair of them.
            if not _links(min(mine.left[row], theirs.left[start]), mine.size[row] + theirs.smallest[place]):
                continue
            end = min(start + SKIP_BLOCK, len(theirs.key))
            first = max(start, row + 1) if mine is theirs else start
            if first >= end:
                continue
            some = slice(first, end)
            sizes = mine.size[row] + theirs.size[some]
            common = np.bitwise_count(mine.bits[row] & theirs.bits[some]).sum(axis=1, dtype=np.int64)
            possible = _links(common + np.minimum(mine.more[row], theirs.more[some]), sizes) & (theirs.label[some] != mine.label[row])
            for at in np.flatnonzero(possible).tolist():
                one, other = name(int(mine.label[row])), name(int(theirs.label[first + at]))
                if one == other:
                    continue
                overlap = common[at]
                if mine.more[row] and theirs.more[first + at]:
                    overlap = overlap + len(np.intersect1d(mine.others[row], theirs.others[first + at], assume_unique=True))
                if _links(overlap, sizes[at]):
                    labels[max(one, other)] = min(one, other)
                    out.append((int(mine.key[row]), int(theirs.key[first + at])))
    return out


def _derived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For sorted parts of lists (first, i, j, block, b, ...): links (a, b) over their components."""
    for (_, i, j), group in sorted_groups(batches, ["first", "i", "j"]):
        block = group.column("block").to_numpy()
        mine, theirs = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if not len(mine) or not len(theirs):
            continue
        one = _Members(group, mine)
        links = _settle(one, one if i == j else _Members(group, theirs), {})
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*links)], ["a", "b"])


def set_links(documents: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) between set keys whose components are those of all links of ``documents`` (text)."""
    total = members.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    shared = documents.sparkSession.sparkContext.broadcast(repeated_shingles(documents, total))
    listed = stage(prefixes(documents, shared), "prefixes")
    entry = F.explode(F.arrays_zip("shingles", "places")).alias("entry")
    entries = listed.select("set_key", "size", entry).select(
        "set_key", F.col("entry.shingles").alias("shingle"), (F.col("size") - F.col("entry.places")).alias("left")
    )
    lists = entries.groupBy("shingle").agg(F.min("set_key").alias("first"), F.max("set_key").alias("last"))
    lists = lists.filter("first < last").select("shingle", "first")
    in_lists = entries.join(lists, "shingle").filter("set_key <> first")
    in_lists = stage(in_lists.groupBy("first", "set_key").agg(F.max("left").alias("left")), "lists")

    # The first class of each list against its others: exact answers.
    pairs = in_lists.select(F.col("first").alias("a"), F.col("set_key").alias("b"))
    answers = stage(compare(pairs, listed, shared), "answers")
    # Nothing looks up marks any more; their memory goes now, not when the driver's is next collected.
    shared.destroy()
    is_link = F.expr(f"{LINK[1]} * overlap >= {LINK[0]} * (size_a + size_b - overlap)")
    known = stage(connected_components(answers.filter(is_link).select("a", "b")), "components")

    # Lists over several components: what follows from those answers.
    # Which members are left follows from narrow rows; the wide answers are joined last.
    placed = in_lists.withColumnRenamed("set_key", "b")
    label = F.coalesce("component", "b").alias("label")
    placed = placed.join(known, placed["b"] == known["node"], "left").select(*placed.columns, label)
    mixed = placed.groupBy("first").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
    mixed = mixed.filter("low < high").select("first", F.ceil(F.col("n") / LIST_BLOCK).alias("blocks"))
    rest = stage(placed.join(mixed, "first").withColumn("block", F.pmod(F.xxhash64("b"), "blocks")), "mixed")
    wide = answers.select(F.col("a").alias("first"), "b", F.col("size_b").alias("size"), "bits", "others")
    spread = wide.join(small_side(rest), ["first", "b"])
    spread = spread.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    spread = spread.select(
        "first", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "b", "label", "size", "left", "bits", "others"
    )
    dealt = spread.repartition("first", "i", "j").sortWithinPartitions("first", "i", "j")
    chains = known.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return chains.unionByName(map_arrow(dealt, _derived, "a long, b long"))


def _classes(rows: DataFrame, members: DataFrame, least: Column) -> DataFrame:
    """set_key, least (of its members) and label of every set; sets that links join have one label."""
    known = connected_components(set_links(rows, members))
    classes = members.filter("set_key IS NOT NULL").groupBy("set_key").agg(F.min(least).alias("least"))
    label = F.coalesce("component", "set_key").alias("label")
    return classes.join(known, classes["set_key"] == known["node"], "left").select("set_key", "least", label)


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document (doc_id, text).

    ``component_id`` is the smallest doc_id that links lead to, the document's own included. A null or
    empty text, or one of white space, has no shingles, links with nothing and is its own component. Rows
    of one doc_id are documents of their own with the same id; a null doc_id is never the smallest, so
    a component of such rows alone has none.
    """
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    members = stage(set_members(rows), "members")
    classes = _classes(rows, members, F.col("doc_id"))
    smallest = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    named = classes.join(smallest, "label").select("set_key", "component_id")
    with_set = members.filter("set_key IS NOT NULL").join(named, "set_key").select("doc_id", "n_shingles", "component_id")
    without = members.filter("set_key IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return with_set.unionByName(without)


def superfluous(documents: DataFrame) -> DataFrame:
    """row_key of all documents (row_key, doc_id, text) but one of each group of near-duplicates.

    The one with the smallest doc_id is not listed, of several the one with the smallest row_key; a
    null doc_id comes last. A document without shingles is a group of its own. Row keys are distinct and the
    same in every reading of ``documents``.
    """
    rows = documents.select("row_key", "doc_id", F.col("text").cast("string").alias("text"))
    members = stage(set_members(rows, ("row_key", "doc_id")), "members")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")
    stays = _classes(rows, members, order).groupBy("label").agg(F.min("least").alias("least"))
    stays = stays.select(F.col("least.row_key").alias("row_key"))
    return members.filter("set_key IS NOT NULL").select("row_key").join(stays, "row_key", "left_anti")
