"""Atomic truncate-and-load (K1): versioned data folders behind a pointer.

Every load writes a new folder.  Only when its row count and schema have been
checked does a manifest ``_versions/<number>.json`` appear under its final name
(one rename), and the highest number is the table.  A load that fails at any
point leaves the table as it was, readers of an older version finish on their
own files, and of two loads that race one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSIONS, DATA = "_versions", "data"


class LoadRejected(ValueError):
    """The written rows are not what was to be loaded; nothing was replaced."""


def _fs(spark: SparkSession, path: str):
    """The Hadoop path and file system of ``path`` (any scheme that Spark reads)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and modification times (milliseconds) in a folder, if it exists."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p))


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n[:-5]) for n, _ in children(spark, f"{path}/{VERSIONS}") if n.endswith(".json") and n[:-5].isdigit()]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The manifest of a version (default: the current one)."""
    known = _numbers(spark, path)
    if not known or (version is not None and version not in known):
        return None
    name = f"{path}/{VERSIONS}/{version if version is not None else max(known):020d}.json"
    return json.loads(spark.read.text(name, wholetext=True).first()[0])


def _commit(spark: SparkSession, path: str, entry: dict) -> None:
    final, fs = _fs(spark, f"{path}/{VERSIONS}/{entry['version']:020d}.json")
    staged, _ = _fs(spark, f"{path}/{VERSIONS}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(staged, False)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(staged, final):
        fs.delete(staged, False)
        raise LoadRejected(f"another load has made version {entry['version']} of {path}")


def _same(a: T.StructType, b: T.StructType) -> bool:
    return [(f.name, f.dataType.simpleString()) for f in a] == [(f.name, f.dataType.simpleString()) for f in b]


def write_checked(df: DataFrame, folder: str, check: Callable[[DataFrame], None] | None = None) -> int:
    """Writes ``df`` to a new folder and checks it there: as many rows as went
    in, the same columns, and the caller's ``check``; returns the rows."""
    spark, seen = df.sparkSession, Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    back = spark.read.parquet(folder)
    rows = back.count()
    if rows != seen.get["rows"] or not _same(back.schema, df.schema):
        raise LoadRejected(f"{rows} rows of {back.schema.simpleString()} were written, "
                           f"not {seen.get['rows']} of {df.schema.simpleString()}")
    if check is not None:
        check(back)
    return rows


def replace_table(df: DataFrame, path: str, check: Callable[[DataFrame], None] | None = None, keep: int = 2,
                  note: dict | None = None) -> int:
    """Makes ``df`` the table at ``path``; returns its version.  The newest
    ``keep`` versions stay readable, the files of older ones are deleted.
    ``note`` is kept in the manifest."""
    spark = df.sparkSession
    folder = f"{DATA}/{uuid.uuid4().hex}"
    before = max(_numbers(spark, path), default=0)
    rows = write_checked(df, f"{path}/{folder}", check)
    _commit(spark, path, {"version": before + 1, "data": folder, "rows": rows, "schema": df.schema.jsonValue(),
                          "note": note or {}})
    for old in sorted(_numbers(spark, path))[:-keep]:
        gone = manifest(spark, path, old)
        delete(spark, f"{path}/{gone['data']}")
        delete(spark, f"{path}/{VERSIONS}/{old:020d}.json")
    return before + 1


def read_table_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as its last whole load left it, or an older version that is kept."""
    entry = manifest(spark, path, version)
    if entry is None:
        raise FileNotFoundError(f"{path} has no version {version if version is not None else 'yet'}")
    return spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(f"{path}/{entry['data']}")


def table_history(spark: SparkSession, path: str) -> DataFrame:
    """``version, rows`` of the versions that are kept."""
    entries = [manifest(spark, path, n) for n in _numbers(spark, path)]
    return spark.createDataFrame([(e["version"], e["rows"]) for e in entries], "version long, rows long")


def remove_leftovers(spark: SparkSession, path: str, before_ms: int) -> list[str]:
    """Deletes data folders that no version names (loads that failed) and that
    are older than ``before_ms``; returns their names."""
    named = {manifest(spark, path, n)["data"].split("/")[-1] for n in _numbers(spark, path)}
    gone = [n for n, at in children(spark, f"{path}/{DATA}") if n not in named and at < before_ms]
    for n in gone:
        delete(spark, f"{path}/{DATA}/{n}")
    return gone


def swap_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Puts a whole new folder in the place of ``path``; the old one is deleted
    last, and put back if the new one cannot be moved."""
    new, fs = _fs(spark, staged)
    target, _ = _fs(spark, path)
    old, _ = _fs(spark, f"{path.rstrip('/')}__old_{uuid.uuid4().hex}")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"{path} cannot be replaced")
    if not fs.rename(new, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"{path} cannot be replaced")
    if had:
        fs.delete(old, True)
