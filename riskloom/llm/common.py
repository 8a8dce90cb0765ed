"""Helpers shared by the operators: written tables, file access, word caches."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return scratch_path(spark, "llm", f"{label}-{uuid.uuid4().hex}")


def written_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table in the shared checkpoint folder, read back,
    and where it is.

    Cuts the lineage: a lost executor costs a re-read, never a recomputation
    of what came before, and every later reader sees the same rows.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, label: str) -> DataFrame:
    return written_at(df, label)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a written table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def shared_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a shared folder (file, hdfs, s3, gs) and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class SharedFile:
    """Writes one file under a private name and moves it into place on close,
    so a task that runs twice leaves one whole file of either attempt."""

    def __init__(self, uri: str):
        self.uri = uri  # what manifests carry: with its scheme, for readers elsewhere
        self.fs, self.path = shared_fs(uri)
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.tmp = f"{self.path}.{uuid.uuid4().hex}.part"
        self.out = self.fs.open_output_stream(self.tmp)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Appends ``data``; returns the offset it starts at."""
        at = self.size
        self.out.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.tmp, self.path)


def open_shared(uri: str):
    """Random-access reader of a shared file."""
    fs, path = shared_fs(uri)
    return fs.open_input_file(path)


class Memo:
    """``fn_many(keys)`` remembered per key, within a bound: when ``limit``
    young entries are held they become the old generation, and what is used
    again returns from there.  Keys over ``longest`` characters are never
    kept; ``pinned`` entries always are."""

    def __init__(self, fn_many: Callable[[list], list], limit: int = 150_000, longest: int = 48,
                 pinned: dict | None = None):
        self.fn_many, self.limit, self.longest = fn_many, limit, longest
        self.pinned = pinned or {}
        self.young, self.old = dict(self.pinned), {}

    def values(self, lists: list[list]) -> list[list]:
        """For each list of keys, the values in its order."""
        if len(self.young) >= self.limit + len(self.pinned):
            self.old, self.young = self.young, dict(self.pinned)
        out = [list(map(self.young.get, keys)) for keys in lists]
        gaps = [[i for i, v in enumerate(values) if v is None] for values in out]
        need = {keys[i] for keys, at in zip(lists, gaps) for i in at}
        back = need & self.old.keys()
        self.young.update((k, self.old[k]) for k in back)
        new = list(need - back)
        if new:
            self.young.update(zip(new, self.fn_many(new)))
        for keys, values, at in zip(lists, out, gaps):
            for i in at:
                values[i] = self.young[keys[i]]
        for k in new:
            if len(k) > self.longest:
                del self.young[k]
        return out


@cache
def loaded_once(kind: type, *args):
    """One object per process and arguments (vocabularies, encoders)."""
    return kind(*args)


_work = None


def only_for(work: str) -> None:
    """Python workers serve one stage after the other.  With the first task of
    another ``work`` in a process, what ``loaded_once`` keeps for earlier ones
    goes, and freed memory returns to the system."""
    global _work
    if work == _work:
        return
    _work = work
    loaded_once.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def chunks(texts: Iterator[str], chars: int = 400_000, most: int = 256) -> Iterator[list[str]]:
    """Consecutive texts in lists of about ``chars`` characters (one text may
    be longer) and at most ``most`` texts."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= chars or len(held) >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    return df.mapInArrow(fn, schema)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type)
                                       for c, t in zip(columns, schema)], schema=schema)


def texts_of(column: pa.Array) -> Iterator[str]:
    """The column's strings one by one, null as the empty text."""
    for value in column:
        yield value.as_py() or ""


def u32(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.asarray(ids, dtype="<u4").tobytes()


def read_exactly(handle, size: int) -> bytes:
    data = handle.read(size)
    if len(data) != size:
        raise EOFError(f"wanted {size} bytes, got {len(data)}")
    return bytes(data)


__all__ = ["new_folder", "written", "written_at", "discard", "shared_fs", "SharedFile", "open_shared", "Memo", "loaded_once", "only_for", "chunks", "arrow_map",
           "batch_of", "texts_of", "u32", "read_exactly"]
