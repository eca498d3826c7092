"""Structured Streaming: ordered ingest with checks, versions and snapshot changes per batch."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kedge.sources.store import PipelineError, atomic_json


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, *, format: str = "parquet", files_per_batch: int = 1) -> DataFrame:
    """Files of a folder, or a single file, as a stream, so many per batch; the pacing of an ordered source."""
    read = spark.readStream.schema(schema).format(format).option("maxFilesPerTrigger", files_per_batch)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return read.load(path)
    # a single file is the one match in its folder
    return read.option("pathGlobFilter", at.getName()).load(at.getParent().toString())


def run_to_end(df: DataFrame, sink: Callable[[DataFrame, int], None], *, checkpoint: str) -> StreamingQuery:
    """Process all there is in batches and stop. The checkpoint makes a rerun go on after the last finished batch."""
    q = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def append_once(root: str) -> Callable[[DataFrame, int], None]:
    """Sink that files each batch under its number, so a batch that is repeated replaces itself."""
    return lambda df, n: df.write.mode("overwrite").parquet(str(Path(root) / f"batch={n}"))


def checked(sink: Callable[[DataFrame, int], None], check: Callable[[DataFrame], DataFrame], what: str) -> Callable[[DataFrame, int], None]:
    """``sink`` that first fails on a batch for which ``check`` finds any row (a drifting total, a broken position)."""

    def run(df: DataFrame, n: int) -> None:
        if not check(df).isEmpty():
            raise PipelineError("protocol", f"{what} in batch {n}")
        sink(df, n)

    return run


def drifting_totals(total: str) -> Callable[[DataFrame], DataFrame]:
    """Check for ``checked``: more than one reported total in a batch."""
    return lambda df: df.agg(F.countDistinct(total).alias("n")).where("n > 1")


def steady_total(total: str, state: str) -> Callable[[DataFrame], DataFrame]:
    """Check for ``checked``: a reported total other than the first one of the stream, in whichever batch.

    The first total is kept in the file ``state``, next to the checkpoint, so a restart goes on with it.
    """

    def check(df: DataFrame) -> DataFrame:
        at = Path(state)
        seen = df.where(F.col(total).isNotNull())
        if not at.exists():
            first = seen.agg(F.min(total).alias("t")).collect()[0]["t"]
            if first is None:
                return seen.limit(0)
            atomic_json(at, {"total": first})
        return seen.where(F.col(total) != F.lit(json.loads(at.read_text())["total"]))

    return check


def windowed_counts(df: DataFrame, *, time: str, window: str, late: str, by: list[str]) -> DataFrame:
    """Event-time counts by window, closed once the watermark passes."""
    return df.withWatermark(time, late).groupBy(F.window(time, window), *by).agg(F.count("*").alias("n"))
