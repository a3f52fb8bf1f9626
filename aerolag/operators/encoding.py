"""Value counts and frequency encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.storage import stage

BROADCAST_BYTES = 32 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64
HOT_KEYS = 1000
HOT_VALUE_BYTES = BROADCAST_BYTES // HOT_KEYS


def value_counts(df: DataFrame, column: str, out: str) -> DataFrame:
    """Rows per value of ``column``; NULL is a group of its own."""
    return df.groupBy(column).agg(F.count("*").alias(out))


def row_count(df: DataFrame, out: str) -> DataFrame:
    """One row with the number of rows of ``df``."""
    return df.agg(F.count("*").alias(out))


def frequency_encode(
    df: DataFrame, column: str, out: str, broadcast_bytes: int = BROADCAST_BYTES, counts: DataFrame | None = None
) -> DataFrame:
    """Add the share of all rows that carry the row's value of ``column``.

    Rows with a NULL value count in the total and leave the output. The counts are
    written once: their size picks the join and their sum is the total, so the fact is
    read for one column and then once more. A small table of counts is broadcast.
    A larger one splits the rows: at most ``HOT_KEYS`` values can each hold a
    ``1/HOT_KEYS`` share, so those are broadcast and their rows never move, and only
    rows of rarer values are shuffled. A value too long for that bound is shuffled too
    and left to the skew handling of adaptive execution. ``counts`` (column, ``_n``), if given, are the counts
    of ``df``, kept from elsewhere; they spare the first pass.
    """
    counts = stage(value_counts(df, column, "_n") if counts is None else counts.select(column, "_n"), "value-counts")
    value_bytes = F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0))
    size = counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(value_bytes + ROW_OVERHEAD_BYTES), F.lit(0)).alias("bytes"),
    ).first()

    present = counts.filter(F.col(column).isNotNull())
    share = (F.col("_n").cast("double") / F.lit(size["rows"])).alias(out)
    if size["bytes"] <= broadcast_bytes:
        return df.join(F.broadcast(present.select(column, share)), column)

    is_hot = (F.col("_n") * HOT_KEYS >= size["rows"]) & (value_bytes <= HOT_VALUE_BYTES)
    hot = present.filter(is_hot).select(column, share)
    rare = present.filter(~is_hot).select(column, share)
    rare_rows = df.join(F.broadcast(hot.select(column)), column, "left_anti")
    return df.join(F.broadcast(hot), column).unionByName(
        rare_rows.join(rare.hint("merge"), column)
    )
