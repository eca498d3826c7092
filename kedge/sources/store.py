"""Sinks and storage: content-addressed objects, version index, snapshots, locks.

What scales with data (objects, versions, manifests, checks) is DataFrame work; what is
a single decision (lock, promotion, pointer) is plain file operations on the driver, in
which the replacement of the pointer file is the commit point.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
import time
import uuid
from collections.abc import Callable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kedge.sources.records import file_hashes, table_or_empty

OBJECTS = "sha256 string, content binary, bytes bigint"
_NAME = re.compile(r"[A-Za-z0-9_.-]+")


class PipelineError(Exception):
    """A failure of kind ``transient`` (worth another attempt), ``protocol`` or ``validation``; carries no URLs or bodies."""

    def __init__(self, kind: str, message: str):
        super().__init__(message)
        self.kind = kind


def require(ok: bool, message: str) -> None:
    if not ok:
        raise PipelineError("validation", message)


def atomic_json(path: str | Path, value: object) -> None:
    """Write JSON so that readers see the old file or the new one, never a part."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f"{path.name}.{uuid.uuid4().hex}.part")
    with part.open("w", encoding="utf-8") as f:
        f.write(json.dumps(value, ensure_ascii=False, sort_keys=True, indent=2) + "\n")
        f.flush()
        os.fsync(f.fileno())
    part.replace(path)


def write_lines(df: DataFrame, path: str, *, order: list[str]) -> None:
    """JSON lines with sorted keys in a stable order, range-partitioned so that no task holds all rows."""
    df.select(*sorted(df.columns)).repartitionByRange(*order).sortWithinPartitions(*order).write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def put_objects(df: DataFrame, root: str) -> None:
    """Append the bodies of ``df.content`` that the store at ``root`` lacks, keyed by their SHA-256.

    Repeated bodies are kept once; nothing is rewritten; null bodies are left out. A body
    that is already stored is hashed again where it lies: if it was damaged, nothing is added and the call fails.
    """
    new = df.where("content is not null").select(F.sha2("content", 256).alias("sha256"), "content", F.octet_length("content").cast("bigint").alias("bytes")).dropDuplicates(["sha256"])
    there = table_or_empty(df.sparkSession, root, OBJECTS)
    held = there.join(new.select("sha256"), "sha256", "left_semi")
    require(held.where(F.sha2("content", 256) != F.col("sha256")).isEmpty(), "a stored object is damaged")
    new.join(there.select("sha256"), "sha256", "left_anti").write.mode("append").parquet(root)


def damaged_objects(spark: SparkSession, root: str) -> DataFrame:
    """Objects whose bytes don't have the hash they are filed under."""
    return table_or_empty(spark, root, OBJECTS).where(F.sha2("content", 256) != F.col("sha256")).select("sha256")


def append_versions(df: DataFrame, root: str) -> None:
    """Add media records to the version index: one row per check, never rewritten."""
    df.write.mode("append").parquet(root)


def latest_versions(versions: DataFrame, *, key: str = "url", at: str = "checked_at") -> DataFrame:
    """The last record of each key; map-side combined, so a hot key costs one row per task. Ties: the largest record."""
    rest = [c for c in versions.columns if c != key]
    return versions.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(at, *[c for c in rest if c != at])).alias("r")).select(key, "r.*")


def distinct_bytes(versions: DataFrame) -> DataFrame:
    """One row: number of distinct objects and the sum of their bytes (the largest, where records disagree)."""
    return versions.where("sha256 is not null").groupBy(F.lower("sha256").alias("sha256")).agg(F.max("bytes").alias("bytes")).agg(F.count("*").alias("objects"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def snapshot_path(root: str | Path, snapshot: str) -> Path:
    """Folder of a snapshot; ids are plain names."""
    require(bool(_NAME.fullmatch(snapshot)) and snapshot not in (".", ".."), "bad snapshot id")
    return Path(root) / "snapshots" / snapshot


def safe_output(path: str | Path, root: str | Path, protected: tuple[str, ...] = ("snapshots", "state", "media")) -> Path:
    """``path``, if it doesn't lie in a protected folder of ``root``."""
    full = Path(path).resolve()
    require(not any(full == p or p in full.parents for p in ((Path(root) / x).resolve() for x in protected)), "output lies in a protected folder")
    return full


def build_snapshot(spark: SparkSession, stage: str | Path, tables: Mapping[str, DataFrame], *, facts: Mapping[str, object]) -> dict:
    """Write the tables of a snapshot below ``stage`` and a manifest with the hash of every file."""
    stage = Path(stage)
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(str(stage / name))
    artifacts = {r.path: r.sha256 for r in file_hashes(spark, str(stage), pattern="*.parquet").select("path", "sha256").toLocalIterator()}
    manifest = {**facts, "artifacts": artifacts}
    atomic_json(stage / "manifest.json", manifest)
    return manifest


def manifest_differences(spark: SparkSession, folder: str | Path) -> DataFrame:
    """``path, problem`` (missing, unexpected, changed) of the files of a snapshot against its manifest."""
    manifest = json.loads((Path(folder) / "manifest.json").read_text())
    listed = spark.createDataFrame(list(manifest["artifacts"].items()), "path string, listed string")
    found = file_hashes(spark, str(folder), pattern="*.parquet").select("path", F.col("sha256").alias("found"))
    kind = F.when(F.col("found").isNull(), "missing").when(F.col("listed").isNull(), "unexpected").when(F.col("found") != F.col("listed"), "changed")
    return listed.join(found, "path", "full_outer").select("path", kind.alias("problem")).where("problem is not null")


def current_pointer(root: str | Path) -> dict | None:
    """The published pointer, its manifest checked; none before the first publication."""
    at = Path(root) / "state" / "current.json"
    if not at.exists():
        return None
    pointer = json.loads(at.read_text())
    manifest = snapshot_path(root, pointer["snapshot_id"]) / "manifest.json"
    require(manifest.exists() and hashlib.sha256(manifest.read_bytes()).hexdigest() == pointer["sha256"], "pointer and manifest disagree")
    return pointer


def promote(spark: SparkSession, root: str | Path, stage: str | Path, snapshot: str) -> dict:
    """Publish a staged snapshot: verify, move, verify again, replace the pointer.

    A failure before the pointer is replaced leaves the published state as it was and
    takes the moved folder back to the stage.
    """
    stage, target = Path(stage), snapshot_path(root, snapshot)
    require(not target.exists(), "snapshot exists")
    require(manifest_differences(spark, stage).isEmpty(), "staged files differ from the manifest")
    target.parent.mkdir(parents=True, exist_ok=True)
    stage.replace(target)
    try:
        require(manifest_differences(spark, target).isEmpty(), "moved files differ from the manifest")
        pointer = {"schema_version": "1.0", "snapshot_id": snapshot, "path": f"snapshots/{snapshot}", "sha256": hashlib.sha256((target / "manifest.json").read_bytes()).hexdigest()}
        atomic_json(Path(root) / "state" / "current.json", pointer)
    except BaseException:
        now = Path(root) / "state" / "current.json"
        if not (now.exists() and json.loads(now.read_text()).get("snapshot_id") == snapshot):
            target.replace(stage)
        raise
    return pointer


class WriterLock:
    """Exclusive lock file with an owner's token; a lock that is held is never taken over."""

    def __init__(self, path: str | Path):
        self.path, self.token = Path(path), uuid.uuid4().hex

    def __enter__(self) -> WriterLock:
        self.path.parent.mkdir(parents=True, exist_ok=True)
        try:
            with self.path.open("x") as f:
                f.write(self.token)
        except FileExistsError:
            raise PipelineError("validation", "another writer holds the lock") from None
        return self

    def __exit__(self, *_: object) -> None:
        if self.path.exists() and self.path.read_text() == self.token:
            self.path.unlink()


def with_retries(step: Callable[[], object], *, attempts: int = 3, sleep: Callable[[float], None] = time.sleep, failures: str | Path | None = None) -> object:
    """Run a step again after transient failures only, waiting 30, 60, ... up to 300 seconds; each failure can be recorded."""
    for n in range(1, attempts + 1):
        try:
            return step()
        except PipelineError as e:
            if failures:
                atomic_json(Path(failures) / f"{int(time.time() * 1000)}-{n}.json", {"attempt": n, "kind": e.kind, "error": str(e)})
            if e.kind != "transient" or n == attempts:
                raise
            sleep(min(300.0, 30.0 * 2 ** (n - 1)))
    return None


def discard(stage: str | Path) -> None:
    """Remove a stage that was not published."""
    shutil.rmtree(stage, ignore_errors=True)


def write_queues(df: DataFrame, root: str, queues: Mapping[str, str]) -> None:
    """Write the rows of each named condition under ``root``: one result filtered into several outputs."""
    for name, condition in queues.items():
        df.where(condition).write.mode("errorifexists").parquet(f"{root}/{name}")
