"""Stable sharding by jump consistent hashing (operator 7), DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

# The published generator: key = key * 2862933555777941757 + 1 modulo 2**64,
# its multiplier as two 32-bit halves.
HIGH, LOW = divmod(2862933555777941757, 2**32)
M32, M16 = 2**32 - 1, 2**16 - 1
#: A key makes about ln(shards) jumps; this many cannot happen in practice, and
#: the plan fails rather than return an unfinished shard.
MOST_JUMPS = 256


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once per row."""
    return F.transform(F.array(value), then).getItem(0)


def _step(s: Column) -> Column:
    """One jump: the generator on 32-bit halves (no 64-bit overflow), then the
    next bucket ``floor((b + 1) * 2**31 / (key >> 33 + 1))``."""
    hi, lo = s["hi"], s["lo"]

    def carry(p: Column) -> Column:
        low = p["a"].bitwiseAND(M32) + F.shiftleft(p["b"].bitwiseAND(M16), 16) + F.lit(1)
        top = (F.shiftright(low, 32) + F.shiftright(p["a"], 32) + F.shiftright(p["b"], 16)
               + hi.bitwiseAND(M16) * F.lit(LOW) + F.shiftleft((F.shiftright(hi, 16) * F.lit(LOW)).bitwiseAND(M16), 16)
               + (lo * F.lit(HIGH)).bitwiseAND(M32))
        return F.struct(top.bitwiseAND(M32).alias("hi"), low.bitwiseAND(M32).alias("lo"))

    def jump(k: Column) -> Column:
        r = (F.shiftright(k["hi"], 1) + F.lit(1)).cast("double")
        return F.struct(k["hi"].alias("hi"), k["lo"].alias("lo"), s["j"].alias("b"),
                        F.floor((s["j"] + F.lit(1)).cast("double") * (F.lit(float(2**31)) / r)).cast("long").alias("j"))

    parts = F.struct((lo.bitwiseAND(M16) * F.lit(LOW)).alias("a"), (F.shiftright(lo, 16) * F.lit(LOW)).alias("b"))
    return _let(_let(parts, carry), jump)


def jump_hash(key: Column, shards: int) -> tuple[Column, Column]:
    """Shard of a 64-bit ``key`` among ``shards``, and among one more."""
    start = F.struct(F.shiftrightunsigned(key, 32).bitwiseAND(M32).alias("hi"), key.bitwiseAND(M32).alias("lo"),
                     F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))
    turns = F.sequence(F.lit(1), F.lit(min(shards, MOST_JUMPS)))
    last = F.aggregate(turns, start, lambda s, _: F.when(s["j"] < shards, _step(s)).otherwise(s))
    done = F.when(last["j"] < shards, F.raise_error(F.lit("jump hash did not finish"))).otherwise(last["b"])
    return done.cast("int"), F.when(last["j"] == shards, F.lit(shards)).otherwise(last["b"]).cast("int")


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` by the law ``key``.

    The id and the number of shards alone decide the shard; with one more
    shard, rows move only into it.  Slots are gapless from 0 per shard: rows
    are numbered within (shard, input split), a bounded group whatever the
    ids, and offset by a small table of counts.  Texts are never shuffled.

    A null id is a key of its own; rows that repeat an id share its shard and
    get slots of their own; null texts are empty (size 1, checksum 0); an
    empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.xxhash64(F.col(id_col).cast("string"))
    shard, grown = jump_hash(F.col("key"), shards)
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("key"),
                        (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"),
                        F.spark_partition_id().alias("split"))
                .select("doc_id", "size", "text_crc32", "split", shard.alias("shard"), grown.alias("grown_shard")))
    rows = written(rows, "sharded")
    counts = rows.groupBy("shard", "split").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "split", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "split").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("k", F.row_number().over(within) - 1).join(offsets, ["shard", "split"])
                .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                        (F.col("first") + F.col("k")).cast("long").alias("slot"), "grown_shard"))
