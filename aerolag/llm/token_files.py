"""Token ids as directly addressable codes, written to files and read back.

Ids are split into bytes, lowest first. Level 0 holds the lowest byte of every id; a bitmap marks the
ids that go on, whose next bytes form level 1, and so on. A directory per bitmap counts the marks before
every block of 512, so the place of any id's next byte is one look-up and one count away, and any id
or range can be read without decoding what lies before it.

A file is a table Spark writes: each row a segment with its place in the order (part, number), the
documents in it with their lengths, and the codes of their ids.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolag.llm.tables import BATCH_ROWS, map_arrow, slices
from aerolag.llm.tokenizing import crc_of_ids, encoder
from aerolag.storage import scratch_path

MAGIC = b"DAC1"
BLOCK_BITS = 512
SEGMENT_IDS = 1 << 18
SEGMENT_DOCUMENTS = 4096
ROW_GROUP_BYTES = 16 * 1024 * 1024


def encode_codes(ids: np.ndarray) -> bytes:
    """The codes of ``ids`` (unsigned, up to 32 bits)."""
    rest = np.asarray(ids, dtype=np.uint32)
    out = []
    while True:
        goes_on = rest > 0xFF
        bits = np.packbits(goes_on, bitorder="little").tobytes()
        bits += bytes(-len(bits) % (BLOCK_BITS // 8))
        marks = np.unpackbits(np.frombuffer(bits, np.uint8)).reshape(-1, BLOCK_BITS).sum(axis=1, dtype=np.uint32)
        before = np.concatenate([[0], np.cumsum(marks)]).astype("<u4")
        out.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits + before.tobytes())
        rest = rest[goes_on] >> 8
        if not len(rest):
            return MAGIC + struct.pack("<B", len(out)) + b"".join(out)


class Codes:
    """Reads ids from what ``encode_codes`` wrote."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.levels, at = [], 5
        for _ in range(data[4]):
            (size,) = struct.unpack_from("<Q", data, at)
            blocks = -(-size // BLOCK_BITS)
            chunks = np.frombuffer(data, np.uint8, size, at + 8)
            bits = np.frombuffer(data, np.uint8, blocks * BLOCK_BITS // 8, at + 8 + size)
            before = np.frombuffer(data, "<u4", blocks + 1, at + 8 + size + len(bits))
            at += 8 + size + len(bits) + before.nbytes
            self.levels.append((chunks, bits, before))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, level: int, place: int) -> int:
        """Marks before ``place``."""
        _, bits, before = self.levels[level]
        block, inside = divmod(place, BLOCK_BITS)
        if not inside:
            return int(before[block])
        some = np.unpackbits(bits[block * BLOCK_BITS // 8 : -(-place // 8)], bitorder="little")[:inside]
        return int(before[block]) + int(some.sum())

    def __getitem__(self, place: int) -> int:
        """One id."""
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[place]) << 8 * level
            if not bits[place >> 3] >> (place & 7) & 1:
                break
            place = self._rank(level, place)
        return value

    def read(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` to ``end`` (exclusive)."""
        out = np.zeros(end - start, dtype=np.uint32)
        at = np.arange(end - start)
        for level, (chunks, bits, _) in enumerate(self.levels):
            out[at] |= chunks[start:end].astype(np.uint32) << np.uint32(8 * level)
            first = start >> 3
            marked = np.unpackbits(bits[first : -(-end // 8)], bitorder="little")[start - first * 8 : end - first * 8]
            at = at[marked.astype(bool)]
            if not len(at):
                break
            start = self._rank(level, start)
            end = start + len(at)
        return out


def write_token_files(documents: DataFrame, path: str, tokenizer: str, blank_joins: bool = True) -> None:
    """Write the ids of all documents (doc_id, text) below ``path`` in ascending doc_id order.

    A null text is the end id alone. A null doc_id comes first; rows of one doc_id are ordered by a
    hash of their text. Tasks take ranges of this order, so no number of equal ids meets in one task
    unless their texts are equal too.
    """
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = encoder(tokenizer, blank_joins)
        part, number = TaskContext.get().partitionId(), 0
        names, parts, held = [], [], 0

        def segment() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([held], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(parts)], pa.int32()), pa.concat_arrays(names)),
                    pa.array([[len(ids) for ids in parts]], pa.list_(pa.int64())),
                    pa.array([encode_codes(np.concatenate(parts))], pa.binary()),
                ],
                ["part", "number", "n_ids", "doc_ids", "lengths", "codes"],
            )

        for batch in slices(batches, BATCH_ROWS):
            for i, ids in enumerate(tokens_of.encode(batch.column("text"))):
                names.append(batch.column("doc_id").slice(i, 1))
                parts.append(ids)
                held += len(ids)
                if held >= SEGMENT_IDS or len(parts) >= SEGMENT_DOCUMENTS:
                    yield segment()
                    names, parts, held, number = [], [], 0, number + 1
        if parts:
            yield segment()

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    schema = f"part int, number int, n_ids long, doc_ids array<{id_type}>, lengths array<long>, codes binary"
    files = map_arrow(ordered.select("doc_id", "text"), write, schema)
    files.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def read_token_files(segments: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids before it in all files), n_tokens, ids_crc32.

    Only the ids of segments, counted by Spark, are summed up over the parts: one row a task that wrote.
    """
    id_type = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            codes, lengths = Codes(batch.column("codes")[0].as_py()), batch.column("lengths")[0].as_py()
            starts = np.cumsum([0, *lengths])
            crcs = [crc_of_ids(codes.read(start, end)) for start, end in zip(starts[:-1].tolist(), starts[1:].tolist())]
            n = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, batch.column("part")[0].as_py()), pa.int32()),
                    pa.array(np.full(n, batch.column("number")[0].as_py()), pa.int32()),
                    pa.array(starts[:-1], pa.int64()), batch.column("doc_ids").flatten(),
                    pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()),
                ],
                ["part", "number", "start", "doc_id", "n_tokens", "ids_crc32"],
            )

    sizes = segments.select("part", "number", "n_ids")
    in_part = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), zero).alias("earlier"))
    places = sizes.select("part", "number", F.coalesce(F.sum("n_ids").over(in_part), zero).alias("inside"))
    places = places.join(parts, "part").select("part", "number", (F.col("inside") + F.col("earlier")).alias("before"))
    stored = segments.select("part", "number", "doc_ids", "lengths", "codes")
    schema = f"part int, number int, start long, doc_id {id_type}, n_tokens long, ids_crc32 long"
    found = map_arrow(stored, read, schema).join(places, ["part", "number"])
    return found.select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def token_file_round_trip(documents: DataFrame, tokenizer: str, blank_joins: bool = True) -> DataFrame:
    """Write the documents' ids to files in the shared folder and read them back."""
    spark = documents.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(documents, path, tokenizer, blank_joins)
    return read_token_files(spark.read.parquet(path))
