"""A bounded filter of ids, so that few wanted rows are found without moving all.

``id_filter`` is a Bloom filter in the shared folder, 16 bits an id and never
more than ``MOST_BITS`` (64 MB), whatever the number of ids.  What it lets
through by mistake an exact join removes; beyond its bound it lets more
through, and the join does more of the work.  The plan is the same at any size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import loaded_once, shared_fs, written_at

BITS_PER_ID, PROBES, MOST_BITS = 16, 4, 1 << 29


class Filter:
    """The filter's words, read once per process."""

    def __init__(self, uri: str, bits: int):
        self.bits = np.uint64(bits - 1)
        self.words = np.zeros(bits >> 6, dtype=np.uint64)
        fs, path = shared_fs(uri)
        for info in fs.get_file_info(pafs.FileSelector(path)):
            if info.path.endswith(".parquet"):
                table = pq.read_table(info.path, filesystem=fs)
                self.words[table.column("word").to_numpy()] = table.column("mask").to_numpy().view(np.uint64)

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        h = hashes.view(np.uint64)
        low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
        out = np.ones(len(h), dtype=bool)
        for k in range(PROBES):
            at = (low + np.uint64(k) * high) & self.bits
            out &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


class IdFilter:
    """Where a filter lies: true for all of its ids, and for few others.  Tasks
    test hashes (``xxhash64`` of the id) with ``passes``, queries with ``maybe``."""

    def __init__(self, path: str, bits: int):
        self.path, self.bits = path, bits

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        return loaded_once(Filter, self.path, self.bits).maybe(hashes)

    def maybe(self, column: Column) -> Column:
        @F.pandas_udf("boolean")
        def test(hashes: pd.Series) -> pd.Series:
            return pd.Series(self.passes(hashes.to_numpy(np.int64)))

        return test(F.xxhash64(column))


def id_filter(ids: DataFrame, hashed: bool = False) -> IdFilter:
    """The filter of a table of one long column (null allowed), which may hold
    hashes itself; then tasks test these."""
    own = F.col(ids.columns[0])
    bits = 1 << 12
    wanted = ids.count() * BITS_PER_ID
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    h = own if hashed else F.xxhash64(own)
    low, high = h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32).bitwiseOR(1)
    places = ids.select(F.explode(F.array(*[(low + k * high).bitwiseAND(bits - 1) for k in range(PROBES)])).alias("at"))
    words = places.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("mask"))
    return IdFilter(written_at(words, "id-filter")[1], bits)


def rows_without(docs: DataFrame, id_col: str, lost: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not in ``lost`` (one long column);
    only rows that the filter cannot clear are shuffled.  Null ids stay."""
    own = F.col(f"`{id_col}`").cast("long")
    maybe = id_filter(lost).maybe(own)
    unclear = docs.where(maybe)
    gone = lost.select(F.col(lost.columns[0]).alias("__lost")).distinct()
    exact = unclear.join(gone, unclear[f"`{id_col}`"].cast("long") == gone["__lost"], "left_anti")
    return docs.where(~maybe).unionByName(exact)
