"""Training-data preparation: feature sets, class balance, exact stratified split."""

from __future__ import annotations

import uuid
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import null_ratio
from ..session import scratch_path

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def feature_columns(df: DataFrame, label_col: str = "fraud_flag", id_col: str = "booking_id") -> list[str]:
    """Dynamic feature set: every column except the label and the id."""
    return [c for c in df.columns if c not in (label_col, id_col)]


def require_columns(df: DataFrame, names) -> None:
    """Fail with the list of missing columns before anything is planned."""
    missing = [n for n in names if n not in set(df.columns)]
    if missing:
        raise ValueError(f"Missing features: {missing}")


def require_numeric(df: DataFrame, names) -> None:
    bad = [f.name for f in df.schema.fields if f.name in set(names) and not isinstance(f.dataType, NUMERIC)]
    if bad:
        raise TypeError(f"Non-numeric feature columns: {bad}")


def select_features(df: DataFrame, features, keep=()) -> DataFrame:
    """Ordered projection of the feature list (plus carried columns)."""
    require_columns(df, [*features, *keep])
    return df.select(*keep, *features)


def class_balance(df: DataFrame, label_col: str = "fraud_flag") -> DataFrame:
    """A2-A4 in one aggregation: counts, label ratio, imbalance ratio
    (n0/n1, NULL without positives) and balanced class weights n/(2*n_c)."""
    y = F.col(label_col)
    n, n1, n0 = F.count(F.lit(1)), F.count_if(y == 1), F.count_if(y == 0)
    return df.agg(
        n.alias("total_samples"),
        n1.alias("n_positive"),
        n0.alias("n_negative"),
        F.round(null_ratio(F.sum(y), n), 6).alias("fraud_ratio"),
        F.round(null_ratio(n0, n1), 6).alias("scale_pos_weight"),
        F.round(null_ratio(n, n0 * 2), 6).alias("weight_negative"),
        F.round(null_ratio(n, n1 * 2), 6).alias("weight_positive"),
    )


def class_counts(df: DataFrame, label_col: str = "fraud_flag") -> tuple[int, int]:
    """(n_negative, n_positive) — two numbers, for model parameters."""
    r = df.agg(F.count_if(F.col(label_col) == 0).alias("n0"),
               F.count_if(F.col(label_col) == 1).alias("n1")).first()
    return int(r["n0"]), int(r["n1"])


def split_hash(key_col: str, seed: int):
    """md5 of "seed:key"; a NULL key hashes as the empty text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key_col}`").cast("string"), F.lit(""))))


#: Rows that a bucket of the split holds on average, at most about so many.
ROWS_PER_SPLIT_BUCKET = 50_000


def stratified_split(df: DataFrame, label_col: str, key_col: str | None = None, test_fraction: float = 0.3,
                     seed: int = 42, out: str = "split") -> DataFrame:
    """L1: exact, reproducible, class-proportional split.

    The test set has ceil(test_fraction * n) rows; the others are shared
    among the classes by largest remainder (ties to the smaller class), in
    whole numbers throughout.  Within a class the rows first by
    md5("seed:key"), then key, are 'test'.  Copies of one key are divided
    exactly, NULL keys and NULL labels are kept (NULL is a class), and
    without ``key_col`` rows are ordered by their place in the table.

    Only class and hash of each row are written, to a table in the shared
    checkpoint folder; the source's other columns are read once, when rows
    are labelled.

    1. counts per (class, bucket), at most classes x 16^digits rows (the
       digits follow n), decide each bucket wholly 'test', wholly 'train' or
       'cut';
    2. the cut bucket of a class is counted by hash.  Of the one hash that
       straddles the cut (a key repeated however often) the rows are written
       and numbered, counted by the task that numbered them, then ranked
       within one such task's rows: no task ranks more than a bucket or a split;
    3. every other row is labelled by its hash through a join with the verdict
       table on (class, bucket), NULL-safe, which adaptive execution
       broadcasts when its measured size is small.

    Without ``key_col`` a row's only name is its place, so the numbered source
    is written whole.
    """
    if not 0.0 <= test_fraction <= 1.0:
        raise ValueError("test_fraction must be within [0, 1]")
    uid = F.monotonically_increasing_id()
    if key_col is None:
        h = F.md5(F.concat(F.lit(f"{seed}:"), F.col("_uid").cast("string")))
    else:
        # The key follows its hash, so two keys of one hash are told apart.
        h = F.concat(split_hash(key_col, seed), F.coalesce(F.col(f"`{key_col}`").cast("string"), F.lit("")))
    label = F.col(f"`{label_col}`").alias("_c")
    if key_col is None:
        rows = _table(df.select("*", uid.alias("_uid")).withColumn("_h", h)).drop("_uid")
        d = rows.select(label, "_h")
    else:
        rows = df.withColumn("_h", h)
        d = _table(rows.select(label, "_h"))
    n = d.count()
    digits = 1
    while n > ROWS_PER_SPLIT_BUCKET * 16 ** digits:
        digits += 1
    d = d.withColumn("_b", F.substring("_h", 1, digits))
    share = Fraction(str(test_fraction))
    n_test = -(-n * share.numerator // share.denominator)
    counts = d.groupBy("_c", "_b").agg(F.count(F.lit(1)).alias("_n"))
    quota = _test_quota(counts, n, n - n_test)
    buckets = _table(_cut(counts.join(quota, F.col("_c").eqNullSafe(F.col("_qc"))).select("_c", "_b", "_n", "_k"), "_b"))
    # Within the cut bucket, by hash.
    inside = _rows_of(d.select("_c", "_b", "_h"), buckets, ["_b"])
    hashes = _table(_cut(inside.groupBy("_c", "_need", "_h").agg(F.count(F.lit(1)).alias("_n"))
                         .withColumnRenamed("_need", "_k"), "_h"))

    def last(df: DataFrame, value: str, at: Column) -> DataFrame:
        return df.groupBy(F.col("_c").alias("_lc")).agg(F.max(F.when(at, F.col(value))).alias(f"_last{value}"))

    # Of each class with a cut: the last whole hash and the shared one.
    marks = (last(hashes, "_h", F.col("_status") == "test").withColumnRenamed("_lc", "_mc")
             .join(last(hashes, "_h", F.col("_status") == "cut").withColumnRenamed("_last_h", "_shared"),
                   F.col("_mc").eqNullSafe(F.col("_lc")), "left").drop("_lc"))
    verdict = _table(buckets.join(marks, F.col("_c").eqNullSafe(F.col("_mc")) & (F.col("_status") == "cut"), "left")
                     .select("_c", F.col("_b").alias("_tb"), "_status", "_last_h", "_shared"))
    j = rows.withColumn("_b", F.substring("_h", 1, digits)).join(
        verdict, F.col(f"`{label_col}`").eqNullSafe(F.col("_c")) & (F.col("_b") == F.col("_tb")), "inner")
    in_test = (F.col("_status") == "test") | ((F.col("_status") == "cut") & F.coalesce(F.col("_h") <= F.col("_last_h"), F.lit(False)))
    own = [F.col(f"`{c}`") for c in df.columns]
    split = F.when(in_test, F.lit("test")).otherwise(F.lit("train")).alias(out)
    shared = F.coalesce(F.col("_h") == F.col("_shared"), F.lit(False))
    if hashes.where("_status = 'cut'").isEmpty():  # no key is repeated across the cut
        return j.select(*own, split)
    # Rows of the shared hashes: numbered, and the first of each class taken.
    cut = hashes.where("_status = 'cut'").select(F.col("_c").alias("_hc"), F.col("_h").alias("_hh"), "_need")
    copies = _table(j.where(shared).select(*own, "_c", "_h", uid.alias("_uid"), F.shiftright(uid, 33).alias("_t")))
    tasks = _table(_cut(copies.join(cut, F.col("_c").eqNullSafe(F.col("_hc")) & (F.col("_h") == F.col("_hh")))
                        .groupBy("_c", "_need", "_t").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("_need", "_k"), "_t"))
    ranked = _rows_of(copies.select("_c", "_t", "_uid"), tasks, ["_t"])
    ranked = ranked.withColumn("_r", F.row_number().over(Window.partitionBy("_c", "_t").orderBy("_uid")))
    upto = last(tasks, "_t", F.col("_status") == "test")
    upto = upto.withColumnRenamed("_lc", "_uc").join(last(ranked, "_uid", F.col("_r") <= F.col("_need")),
                                                      F.col("_uc").eqNullSafe(F.col("_lc")), "left").drop("_lc")
    first = (F.coalesce(F.col("_t") <= F.col("_last_t"), F.lit(False))
             | F.coalesce(F.col("_uid") <= F.col("_last_uid"), F.lit(False)))
    shared_rows = copies.join(upto, F.col("_c").eqNullSafe(F.col("_uc"))).select(
        *own, F.when(first, F.lit("test")).otherwise(F.lit("train")).alias(out))
    return j.where(~shared).select(*own, split).unionByName(shared_rows)


def _table(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    path = scratch_path(df.sparkSession, "splits", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _test_quota(counts: DataFrame, n: int, n_train: int) -> DataFrame:
    """Test rows per class (``_qc``, ``_k``): the class size less its share of
    the training rows by largest remainder.  One row per class."""
    big = "decimal(38,0)"
    c = counts.groupBy(F.col("_c").alias("_qc")).agg(F.sum("_n").cast(big).alias("_nc"))
    every = Window.partitionBy()
    c = (c.withColumn("_p", F.col("_nc") * F.lit(n_train).cast("decimal(19,0)"))
         .withColumn("_rest", F.expr(f"cast(_p % cast({max(n, 1)} as {big}) as {big})"))
         .withColumn("_whole", F.expr(f"cast((_p - _rest) / cast({max(n, 1)} as {big}) as bigint)")))
    spare = F.lit(n_train) - F.sum("_whole").over(every)
    place = F.row_number().over(every.orderBy(F.desc("_rest"), F.asc_nulls_first("_qc")))
    train = F.col("_whole") + F.when(place <= spare, 1).otherwise(0)
    return c.select("_qc", (F.col("_nc").cast("long") - train).cast("long").alias("_k"))


def _cut(counts: DataFrame, key: str) -> DataFrame:
    """``counts`` (``_c``, ``key``, ``_n``, ``_k``) with ``_status`` of each
    key in order: 'test' while wholly within the first ``_k`` rows of the
    class, 'cut' for the one that straddles, then 'train'; ``_need`` is what
    the straddling one still gives."""
    before = Window.partitionBy("_c").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    d = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    status = (F.when(F.col("_before") + F.col("_n") <= F.col("_k"), "test")
              .when(F.col("_before") >= F.col("_k"), "train").otherwise("cut"))
    return d.select("_c", key, status.alias("_status"), (F.col("_k") - F.col("_before")).alias("_need"))


def _rows_of(rows: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the cut keys, with ``_need``; classes compare NULL-safe."""
    cut = verdicts.where("_status = 'cut'").select(F.col("_c").alias("_vc"), *[F.col(k).alias(f"_v{k}") for k in keys], "_need")
    same = F.col("_c").eqNullSafe(F.col("_vc"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_v{k}"))
    return rows.join(cut, same).drop("_vc", *[f"_v{k}" for k in keys])


def dataset_profile(split_df: DataFrame, n_features: int, label_col: str = "fraud_flag",
                    split_col: str = "split") -> DataFrame:
    """Total / train / test rows, feature count, label ratio — one pass."""
    n = F.count(F.lit(1))
    return split_df.agg(
        n.alias("total_samples"),
        F.count_if(F.col(split_col) == "train").alias("train_samples"),
        F.count_if(F.col(split_col) == "test").alias("test_samples"),
        F.lit(n_features).alias("n_features"),
        F.round(null_ratio(F.sum(label_col), n), 6).alias("fraud_ratio"),
    )
