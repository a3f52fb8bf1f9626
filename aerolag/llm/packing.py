"""Packing of token pieces into sequences by vector best-fit.

A sequence has three capacities: tokens, documents, and attention cost (the sum of squared lengths,
as every document attends to itself). Pieces are placed in falling order of length. Of the open
sequences that can take a piece under every capacity, the one is chosen that the weighted measure
prefers: ``norm`` takes the least residual left, ``dot`` the largest product of piece and residual.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.llm.tables import map_arrow, slices
from aerolag.llm.tokenizing import crc_of_ids, encoder
from aerolag.storage import stage

SEQUENCE_TOKENS = 2048
GROUP_PIECES = 8192


@dataclass(frozen=True)
class Capacities:
    """Limits of a sequence. The defaults for documents and attention never bind before the tokens do."""

    tokens: int = SEQUENCE_TOKENS
    documents: int = SEQUENCE_TOKENS
    attention: int = SEQUENCE_TOKENS**2


@dataclass(frozen=True)
class Measure:
    """How sequences are compared: weights of tokens, documents and attention, each as a share of its capacity."""

    kind: str = "norm"
    weights: tuple[float, float, float] = (1.0, 1e-6, 1e-3)


def best_fit(lengths: np.ndarray, capacities: Capacities = Capacities(), measure: Measure = Measure()) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; a piece over a capacity on its own is an error.

    Equal lengths are placed in the given order; of equal sequences the oldest is chosen.
    """
    lengths = np.asarray(lengths, dtype=np.int64)
    limits = np.array([capacities.tokens, capacities.documents, capacities.attention], dtype=np.float64)
    need = np.stack([lengths, np.ones_like(lengths), lengths**2], axis=1).astype(np.float64)
    if (need > limits).any():
        raise ValueError("a piece exceeds the capacity of an empty sequence")
    weights = np.array(measure.weights)
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    # Residuals of the open sequences; those that cannot take even the smallest piece are closed.
    smallest = need.min(axis=0) if len(need) else limits
    residual, number, opened = np.empty((256, 3)), np.empty(256, dtype=np.int64), 0
    made = 0
    for piece in np.argsort(-lengths, kind="stable"):
        wanted = need[piece]
        room = residual[:opened]
        fits = np.flatnonzero((room >= wanted).all(axis=1))
        if len(fits):
            share = room[fits] / limits
            if measure.kind == "dot":
                best = fits[np.argmax(share @ (weights * wanted / limits))]
            else:
                best = fits[np.argmin(((share - wanted / limits) ** 2) @ weights)]
        else:
            if opened == len(residual):
                residual, number = np.concatenate([residual, residual]), np.concatenate([number, number])
            best, opened = opened, opened + 1
            residual[best], number[best] = limits, made
            made += 1
        sequence[piece], offset[piece] = number[best], capacities.tokens - residual[best, 0]
        residual[best] -= wanted
        if (residual[best] < smallest).any():
            opened -= 1
            residual[best : opened] = residual[best + 1 : opened + 1]
            number[best : opened] = number[best + 1 : opened + 1]
    return sequence, offset


def cut_pieces(documents: DataFrame, tokenizer: str, tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """Pieces of every document: piece_key (unique), doc_id, piece, start, length, ids_crc32.

    A null or empty text is the end id alone. Only documents longer than ``tokens`` are cut.
    """
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = encoder(tokenizer, blank_joins=False)
        key = TaskContext.get().partitionId() << 36
        for batch in slices(batches, 1024):
            rows, at, crcs = [], [], []
            for i, ids in enumerate(tokens_of.encode(batch.column("text"))):
                for piece, start in enumerate(range(0, len(ids), tokens)):
                    part = ids[start : start + tokens]
                    at.append(i)
                    rows.append((key, piece, start, len(part), crc_of_ids(part)))
                    key += 1
            columns = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            names = ["piece_key", "doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([columns[0], batch.column("doc_id").take(pa.array(at)), *columns[1:]], names)

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_arrow(rows, cut, f"piece_key long, doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def pack(
    pieces: DataFrame, capacities: Capacities = Capacities(), measure: Measure = Measure(), group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """Add sequence_id and offset to stored ``pieces`` (piece_key, length, and any more columns).

    A piece that fills a sequence is one. The others are dealt at random, by a hash of their key, to
    groups of about ``group_pieces``, and each group is packed on its own, which costs at most about one
    sequence a group. No rows give no rows.
    """
    full = pieces.filter(F.col("length") == capacities.tokens)
    rest = pieces.filter(F.col("length") != capacities.tokens)
    groups = max(1, round(rest.count() / group_pieces))

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("piece_key", ignore_index=True)
        sequence, offset = best_fit(rows["length"].to_numpy(), capacities, measure)
        return pd.DataFrame({"piece_key": rows["piece_key"], "sequence_id": key[0] * 2**32 + sequence, "offset": offset})

    keyed = rest.select("piece_key", "length", F.pmod(F.xxhash64("piece_key"), F.lit(groups)).alias("_group"))
    placed = keyed.groupBy("_group").applyInPandas(one, "piece_key long, sequence_id long, offset long")
    rest = rest.join(placed, "piece_key")
    alone = full.select("*", (-1 - F.col("piece_key")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return rest.select(*pieces.columns, "sequence_id", "offset").unionByName(alone)


def pack_documents(
    documents: DataFrame, tokenizer: str, capacities: Capacities = Capacities(), measure: Measure = Measure()
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    pieces = stage(cut_pieces(documents, tokenizer, capacities.tokens), "pieces")
    return pack(pieces, capacities, measure).drop("piece_key")
