"""Intermediate tables in the folder all executors share.

A table written here cuts the lineage of what follows: an executor that is lost
takes nothing with it. The folder is the session's ``spark.checkpoint.dir``. Where
that is unset, a session whose executors are threads of this process gets a folder of
its own, once; on a cluster, where a local folder would lose rows, it is an error.

A table lives until ``release`` or the end of the driver. Operators that write a table a
round release the one before.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_written: list[tuple[SparkSession, str]] = []
_registered = False


def folder(spark: SparkSession) -> str:
    """The shared folder of the session, set first if the session has none and runs in this process."""
    named = spark.conf.get(_KEY, None)
    if not named:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError(f"{_KEY} must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="kedge-")
        spark.conf.set(_KEY, named)
    return named.rstrip("/")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Empty inputs keep their schema. The files go when the Python driver ends.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/kedge-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    global _registered
    if not _registered:
        atexit.register(_clean)
        _registered = True
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._kedge_table = path
    return out


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session of ``df``."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


#: Rows of a piece of a range-partitioned table.
PIECE_ROWS = 500_000


def pieces(df: DataFrame) -> int:
    """Range partitions for ``df``: as many as the session shuffles into, more if a piece would exceed ``PIECE_ROWS``."""
    return max(partitions(df), -(-df.count() // PIECE_ROWS))


def release(df: DataFrame | None = None) -> None:
    """Delete the files of a ``table`` that is not needed any more; without one, of all tables so far.

    A result that still reads one must have been computed or written before.
    """
    global _written
    gone = _written if df is None else [w for w in _written if w[1] == getattr(df, "_kedge_table", None)]
    _written = [w for w in _written if w not in gone]
    for spark, path in gone:
        try:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session may have ended before
            return


def _clean() -> None:
    release()
