"""The given tables, and small helpers the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aerolag.llm import caches
from aerolag.storage import stage

SLICE_ROWS = 256
BATCH_ROWS = 2000
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
BROADCAST_BYTES = 32 * 1024 * 1024

_shipped: set[str] = set()


def map_arrow(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow``, with this package sent to the executors once for every application.

    A worker that ran another operator before lets go of what it kept for that one, and of free memory after each
    task. Batches have ``BATCH_ROWS`` rows unless the session sets another number: texts are copied several times
    on their way, so Spark's 10,000 rows of them are hundreds of megabytes.
    """
    if df.sparkSession.conf.get(_BATCH_SETTING) == _BATCH_DEFAULT:
        df.sparkSession.conf.set(_BATCH_SETTING, BATCH_ROWS)
    operator = f"{function.__module__}.{function.__qualname__}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches.begin(operator)
        yield from function(batches)
        caches.release()

    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_side(stored: DataFrame, *texts: str, row_bytes: int = 64) -> DataFrame:
    """A stored table for a join: marked for broadcast if it is below ``BROADCAST_BYTES``, else as it is.

    The size counts ``row_bytes`` a row and the bytes of the columns ``texts``.
    """
    size = F.lit(row_bytes)
    for name in texts:
        size = size + F.octet_length(name)
    total = stored.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(stored) if total <= BROADCAST_BYTES else stored


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows with their place (``position``, from 0) in ``order``, which should leave no ties.

    Tasks sort ranges of the order and write a file each; a row's place is the number of rows in earlier
    files plus its own in the file. Only one count a task is summed up in one place.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    written = stage(dealt.withColumn("_part", F.spark_partition_id()), "ranked")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = written.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = written.select("*", F.col("_metadata.row_index").alias("_row"))
    placed = placed.join(small_side(stage(before, "ranked-parts")), "_part")
    return placed.withColumn("position", F.col("_before") + F.col("_row")).drop("_part", "_before", "_row")


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most ``rows``, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def sorted_groups(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows with equal integers in ``names``, over batch borders, with those integers."""
    held: list[pa.Table] = []
    current: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(name).to_numpy() for name in names])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        whole = pa.Table.from_batches([batch])
        for start, end in zip(cuts[:-1], cuts[1:]):
            key = tuple(keys[:, start].tolist())
            if held and key != current:
                yield current, pa.concat_tables(held)
                held = []
            current = key
            held.append(whole.slice(start, end - start))
    if held:
        yield current, pa.concat_tables(held)
