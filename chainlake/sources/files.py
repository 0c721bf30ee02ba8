"""Parquet files on any Hadoop file system: discovery, scans, the manifest of processed files, and atomic publishing."""

from __future__ import annotations

import json
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Ends of the names that a table or manifest has while it is replaced.
NEXT, OLD = ".next", ".old"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def discover(spark: SparkSession, root: str) -> list[str]:
    """All Parquet files under root, sorted; none that is hidden ("." or "_") or under a hidden folder, none if there is no root. Spark lists them, with
    tasks where there are many folders; of a folder that a stream writes, only files of finished batches."""
    if not exists(spark, root):
        return []
    fs, p = _fs(spark, root)
    base = fs.makeQualified(p).toString()
    found = spark.read.schema("none string").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(root).inputFiles()
    return sorted(map(unquote, found), key=lambda x: _plain(x).removeprefix(_plain(base)))


def _plain(path: str) -> str:
    """A local file's path without its scheme."""
    return path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:")


def scan(spark: SparkSession, files: str | list[str], root: str | None = None) -> DataFrame:
    """Files of different ages as one table: columns and nested fields by name, partition columns from root on."""
    reader = spark.read.option("mergeSchema", "true")
    return (reader.option("basePath", root) if root else reader).parquet(*([files] if isinstance(files, str) else files))


def load_manifest(spark: SparkSession, path: str) -> set[str]:
    """The processed files; none if there is no manifest. ValueError if it is not an object with a list of names."""
    path = next((x for x in (path, path + NEXT) if exists(spark, x)), "")
    if not path:
        return set()
    text = "\n".join(r.value for r in spark.read.option("wholetext", "true").text(path).collect())
    try:
        files = json.loads(text)["processed_files"]
        if not isinstance(files, list) or not all(isinstance(f, str) and f for f in files):
            raise TypeError("processed_files")
    except (ValueError, TypeError, KeyError) as e:
        raise ValueError(f"{path} is not a manifest of processed files: {e}") from e
    return set(files)


def save_manifest(spark: SparkSession, path: str, files: Iterable[str]) -> None:
    """Replace the manifest: written whole under its next name, then moved. A crash in between leaves one of the two, and load_manifest takes it."""
    fs, p = _fs(spark, path)
    _, new = _fs(spark, path + NEXT)
    if not fs.exists(p) and fs.exists(new):
        _move(fs, new, p)  # a crash left the last one there; it must not be lost while this one is written
    out = fs.create(new, True)
    out.write(bytearray(json.dumps({"processed_files": sorted(set(files))}, indent=2).encode()))
    out.close()
    fs.delete(p, False)
    _move(fs, new, p)


def manifest_entry(file: str, root: str) -> str:
    """A file's name in the manifest: below root if it is there, else its whole path."""
    return _plain(file).removeprefix(_plain(root).rstrip("/") + "/")


def unprocessed(files: Iterable[str], processed: set[str], root: str) -> list[str]:
    return [f for f in files if manifest_entry(f, root) not in processed]


def _move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"{source.toString()} can't be moved to {target.toString()}")


def _beside(path: str, end: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}{end}"


def settle(spark: SparkSession, path: str) -> None:
    """Undo what a crash of publish() left: the old table back in its place if the new one did not get there, and nothing beside it."""
    fs, p = _fs(spark, path)
    _, old = _fs(spark, _beside(path, OLD))
    _, new = _fs(spark, _beside(path, NEXT))
    if fs.exists(old) and not fs.exists(p):
        _move(fs, old, p)
    for x in (old, new):
        fs.delete(x, True)


def table(spark: SparkSession, path: str) -> DataFrame | None:
    """A published table, or None if there never was one. Between the two moves of publish(), or after a crash there, it is the old one."""
    found = next((x for x in (path, _beside(path, OLD)) if exists(spark, x)), None)
    return spark.read.parquet(found) if found else None


def publish(df: DataFrame, path: str) -> int:
    """Write df beside path and swap it in; the number of rows, counted while writing. df may read path itself. On an error the old table stays.
    The swap is two moves; whenever the driver dies, table() and settle() find the old table or the new one. One job at a time may publish a path."""
    spark = df.sparkSession
    settle(spark, path)
    fs, p = _fs(spark, path)
    _, old = _fs(spark, _beside(path, OLD))
    _, new = _fs(spark, _beside(path, NEXT))
    seen = Observation()
    try:
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(new.toString())
        if fs.exists(p):
            _move(fs, p, old)
        _move(fs, new, p)
    finally:
        settle(spark, path)
    return seen.get["rows"]
