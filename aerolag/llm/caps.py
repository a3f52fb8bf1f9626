"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; its cap holds the unit vectors whose product with it exceeds a threshold. The
directions form random product codes: the space is rotated and split into parts, each with a small
codebook of random directions, and every combination of one direction a part is a filter. A vector's
filters are found by list decoding: part by part, a combination begun is kept only while the best that
the remaining parts can add still reaches the threshold. Two vectors are compared where they share a
filter, and a pair counts only in the smallest filter it shares.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.llm import caches
from aerolag.llm.components import connected_components
from aerolag.llm.tables import map_arrow, slices, small_side, sorted_groups
from aerolag.storage import stage

MIN_COSINE = 0.95
#: Vectors of one filter that are compared as one block.
FILTER_BLOCK = 2048
#: Random pairs the threshold is measured on.
TRIAL_PAIRS = 1000


@dataclass(frozen=True)
class Filters:
    """Codes: how many, parts of each, directions a part, and the threshold in standard deviations of a random product.

    Where random pairs of the smallest cosine share a filter less often than ``recall``, as in few
    dimensions, the threshold is lowered to what they need.
    """

    codes: int = 6
    parts: int = 2
    directions: int = 128
    threshold: float = 3.25
    seed: int = 1
    recall: float = 0.998
    min_cosine: float = MIN_COSINE


class Decoder:
    """The codes for vectors of some number of dimensions."""

    def __init__(self, dimensions: int, filters: Filters):
        self.filters, self.dimensions = filters, dimensions
        parts = min(filters.parts, dimensions)
        self.limit = filters.threshold * np.sqrt(parts / dimensions)
        self.codes = []
        for code in range(filters.codes):
            rng = np.random.default_rng([filters.seed, dimensions, code])
            rotation = np.linalg.qr(rng.normal(size=(dimensions, dimensions)))[0]
            books = []
            for columns in np.array_split(np.arange(dimensions), parts):
                book = rng.normal(size=(len(columns), filters.directions))
                books.append(rotation[:, columns] @ (book / np.linalg.norm(book, axis=0)))
            self.codes.append(books)
        self.limit = min(self.limit, self._needed())

    def _needed(self) -> float:
        """The highest threshold at which ``recall`` of random pairs of the smallest cosine share a filter."""
        rng, cosine = np.random.default_rng(self.filters.seed), self.filters.min_cosine
        one, other = rng.normal(size=(2, TRIAL_PAIRS, self.dimensions))
        one /= np.linalg.norm(one, axis=1)[:, None]
        if self.dimensions > 1:
            other -= (other * one).sum(axis=1)[:, None] * one
            other /= np.linalg.norm(other, axis=1)[:, None]
            other = cosine * one + np.sqrt(1 - cosine**2) * other
        else:
            other = one
        best = np.full(TRIAL_PAIRS, -np.inf)
        for books in self.codes:
            products = [(one @ book, other @ book) for book in books]
            for pair in range(TRIAL_PAIRS):
                sums = [functools.reduce(np.add.outer, [product[side][pair] for product in products]) for side in (0, 1)]
                best[pair] = max(best[pair], np.minimum(*sums).max())
        return float(np.floor(np.quantile(best, 1 - self.filters.recall) * 1e6) / 1e6)

    def decode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All filters of unit vectors: row numbers and filter numbers, sorted by row."""
        rows_of, filters_of = [], []
        for number, books in enumerate(self.codes):
            products = [units @ book for book in books]
            best = [product.max(axis=1) for product in products]
            rows = np.arange(len(units))
            chosen, reached = np.full(len(units), number, dtype=np.int64), np.zeros(len(units))
            for part, product in enumerate(products):
                more = sum(best[part + 1 :], np.zeros(len(units)))
                sums = reached[:, None] + product[rows]
                kept, direction = np.nonzero(sums + more[rows][:, None] >= self.limit)
                reached = sums[kept, direction]
                chosen = chosen[kept] * self.filters.directions + direction
                rows = rows[kept]
            rows_of.append(rows)
            filters_of.append(chosen)
        rows, chosen = np.concatenate(rows_of), np.concatenate(filters_of)
        order = np.lexsort([chosen, rows])
        return rows[order], chosen[order] + (self.dimensions << 44)


@functools.lru_cache(maxsize=16)
def _decoder(dimensions: int, filters: Filters) -> Decoder:
    return Decoder(dimensions, filters)


caches.drops(_decoder.cache_clear)


def _units(vectors: list[bytes]) -> np.ndarray:
    matrix = np.frombuffer(b"".join(vectors), dtype=np.float64).reshape(len(vectors), -1)
    matrix = matrix / np.abs(matrix).max(axis=1)[:, None]
    return matrix / np.linalg.norm(matrix, axis=1)[:, None]


def _forest(count: int, one: np.ndarray, other: np.ndarray) -> list[tuple[int, int]]:
    """Some of the pairs that connect what all of them connect."""
    root = list(range(count))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(one.tolist(), other.tolist()):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def capped(classes: DataFrame, filters: Filters, with_vectors: bool) -> DataFrame:
    """(filter, key) of every filter of every vector; on demand with copies and vector."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            vectors = np.array(batch.column("vector").to_pylist(), dtype=object)
            sizes = np.fromiter(map(len, vectors), np.int64, len(vectors)) // 8
            for size in np.unique(sizes).tolist():
                of_size = np.flatnonzero(sizes == size)
                rows, found = _decoder(size, filters).decode(_units(vectors[of_size].tolist()))
                taken = batch.take(pa.array(of_size[rows]))
                columns = [pa.array(found), taken.column("key")]
                columns += [taken.column("copies"), taken.column("vector")] if with_vectors else []
                yield pa.RecordBatch.from_arrays(columns, ["filter", "key", "copies", "vector"][: len(columns)])

    schema = "filter long, key long" + (", copies long, vector binary" if with_vectors else "")
    return map_arrow(classes.select("key", "copies", "vector"), read, schema)


def link_classes(classes: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """Links between stored classes (key, copies, vector): key, other (some that connect), n (copies linked).

    Each row adds ``n`` to the links of ``key`` and may tie it to ``other``. A filter with many vectors
    is compared block by block, each pair of blocks by one task.
    """
    sizes = capped(classes, filters, False).groupBy("filter").agg(F.count("*").alias("n"))
    hot = stage(sizes.filter(F.col("n") > FILTER_BLOCK).select("filter", F.ceil(F.col("n") / FILTER_BLOCK).alias("blocks")), "hot-filters")
    rows = capped(classes, filters, True).join(small_side(hot), "filter", "left")
    rows = rows.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key"), "blocks"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("filter", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "key", "copies", "vector")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def send() -> pa.RecordBatch:
            columns = [pa.array(column, pa.int64()) for column in zip(*out)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["key", "other", "n"])

        for (at, i, j), group in sorted_groups(batches, ["filter", "i", "j"]):
            if group.num_rows < 2:
                continue
            units = _units(group.column("vector").to_pylist())
            block = group.column("block").to_numpy()
            mine, theirs = np.flatnonzero(block == i), np.flatnonzero(block == j)
            one, other = np.nonzero(units[mine] @ units[theirs].T >= filters.min_cosine)
            one, other = mine[one], theirs[other]
            if i == j:
                one, other = one[one < other], other[one < other]
            if not len(one):
                continue
            size = units.shape[1]
            involved, place = np.unique(np.concatenate([one, other]), return_inverse=True)
            rows_of, found = _decoder(size, filters).decode(units[involved])
            cuts = np.searchsorted(rows_of, np.arange(len(involved) + 1))
            shared = [found[a:b][: np.searchsorted(found[a:b], at)] for a, b in zip(cuts[:-1], cuts[1:])]
            smaller = [set(part.tolist()) for part in shared]
            pairs = zip(place[: len(one)].tolist(), place[len(one) :].tolist())
            first = np.array([smaller[a].isdisjoint(smaller[b]) for a, b in pairs])
            one, other = one[first], other[first]
            if not len(one):
                continue
            keys, copies = group.column("key").to_numpy(), group.column("copies").to_numpy()
            n = np.bincount(one, copies[other], len(keys)) + np.bincount(other, copies[one], len(keys))
            linked = np.flatnonzero(n)
            out += [(key, None, count) for key, count in zip(keys[linked].tolist(), n[linked].astype(np.int64).tolist())]
            out += [(int(keys[a]), int(keys[b]), 0) for a, b in _forest(len(keys), one, other)]
            if len(out) > 50_000:
                yield send()
        if out:
            yield send()

    dealt = rows.repartition("filter", "i", "j").sortWithinPartitions("filter", "i", "j")
    return map_arrow(dealt, read, "key long, other long, n long")


def near_duplicate_vectors(embeddings: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``embeddings`` (vec_id, embedding).

    Equal vectors are compared as one and counted as many. A vector that is null, empty or zero, or
    holds a null or non-finite number, links with nothing, nor do vectors of different lengths. Rows that
    share a vec_id are vectors of their own; a null vec_id is never the smallest of its component.
    """
    value = F.col("embedding").cast("array<double>")
    good = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0)
    rows = embeddings.select("vec_id", "embedding", F.coalesce(good, F.lit(False)).alias("good"))
    linked = rows.filter("good").select("vec_id", "embedding")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            vectors = [np.array(vector, dtype=np.float64).tobytes() for vector in batch.column("embedding").to_pylist()]
            columns = [batch.column("least"), batch.column("copies"), batch.column("embedding"), pa.array(vectors, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["least", "copies", "embedding", "vector"])

    types = {name: embeddings.schema[name].dataType.simpleString() for name in ("vec_id", "embedding")}
    copies = linked.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    packed = map_arrow(copies.select("least", "copies", "embedding"), pack, f"least {types['vec_id']}, copies long, embedding {types['embedding']}, vector binary")
    classes = stage(packed.withColumn("key", F.monotonically_increasing_id()), "vector-classes")
    links = stage(link_classes(classes, filters), "vector-links")

    known = connected_components(links.filter("other IS NOT NULL").select(F.col("key").alias("a"), F.col("other").alias("b")))
    counts = links.groupBy("key").agg(F.sum("n").alias("n"))
    named = classes.select("key", "least", "copies").join(counts, "key", "left").join(known, F.col("key") == F.col("node"), "left")
    named = named.select("key", "least", F.coalesce("component", "key").alias("label"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    named = stage(named, "vector-labels")
    smallest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    labels = named.join(smallest, "label").select("key", "n_links", "component_id")
    by_vector = classes.select("key", "embedding").join(labels, "key").select("embedding", "n_links", "component_id")
    members = linked.join(by_vector, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    everything = members.unionByName(alone)
    return everything.select("*", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
