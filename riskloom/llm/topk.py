"""Exact top-k inner products by norm-bucketed retrieval (operator 1).

Vectors are grouped by length class (powers of ``2 ** 0.25``) and each class is
cut into blocks of bounded size, whatever share of the rows it holds.  A first
pass gives every query a threshold: its k-th best score in one block of the
longest class.  The second pass sends a block of queries only to the blocks
whose greatest length still allows a product at or over the threshold, and
there, for each query, the local cosine threshold
``score / (|q| * longest)`` chooses the pruning: length alone when it is low, or
the query's largest coordinates as well, as many as the block's sample says are
worth it: a row stays if its product over these, plus the most that the other
coordinates of both can add, reaches the threshold.  What is left is verified
with exact integer products.  Blocks of queries and rows
meet by an equi-join on block pairs; nothing is broadcast or collected.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

EXACT = 2.0**52
#: Rows of a block on which numbers of focus coordinates are tried.
TRIED_ROWS = 64


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, v`` with ``v`` = floor(scale * component) as doubles; vectors that
    are null or hold null or non-finite components are left out."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))

    def whole(c):  # from 2**53 on a double is whole, and beyond 64 bits floor() would saturate
        y = c * F.lit(float(scale))
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)

    return (df.select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
              .where(F.col("x").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.col("id").isNotNull())
              .select("id", F.transform("x", whole).alias("v")))


def products(q: np.ndarray, rows: np.ndarray):
    """Exact integer products: in doubles where no sum can exceed 2**52, else
    with Python integers; over 64 bits is an error."""
    if not rows.size or np.abs(q).max(initial=0) * np.abs(rows).max(initial=0) * max(1, q.size) < EXACT:
        return (rows @ q).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(q, r)) for r in rows]
    if any(abs(x) >= 2**63 for x in exact):
        raise ArithmeticError("a product needs more than 64 bits")
    return np.array(exact, dtype=np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int):
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def focus_counts(dim: int) -> list[int]:
    """Numbers of focus coordinates that are tried: powers of two, and eighths of all."""
    return sorted({f for f in (*(1 << k for k in range(12)), *(dim * k // 8 for k in range(1, 8))) if 0 < f < dim})


class Block:
    """Rows of one block, longest first."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        length = np.sqrt((rows * rows).sum(axis=1))
        order = np.argsort(-length, kind="stable")
        self.ids, self.rows, self.length = ids[order], rows[order], length[order]
        self.unit = self.rows / np.maximum(self.length, 1e-300)[:, None]

    @staticmethod
    def most(u: np.ndarray, unit: np.ndarray, focus: np.ndarray) -> np.ndarray:
        """The greatest cosine that each row can have with ``u``, as far as the
        focus coordinates tell (Cauchy-Schwarz for the others)."""
        x, y = u[focus], unit[:, focus]
        rest = max(0.0, 1.0 - float(x @ x)) * np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", y, y))
        return y @ x + np.sqrt(rest) + 1e-9

    def candidates(self, q: np.ndarray, least: float) -> np.ndarray:
        """Indices of the rows whose product with ``q`` may reach ``least``
        (a little slack covers rounding)."""
        norm = float(np.sqrt(q @ q))
        if least <= 0 or norm == 0 or not len(self.ids):
            return np.arange(len(self.ids))
        slack = 1e-9 * (1 + abs(least))
        if (least - slack) / (norm * max(self.length[0], 1e-300)) > 1 + 1e-9:
            return np.empty(0, dtype=np.int64)
        keep = int(np.searchsorted(-self.length, -(least - slack) / norm, side="right"))
        if not keep:
            return np.empty(0, dtype=np.int64)
        local = (least - slack) / (norm * np.maximum(self.length[:keep], 1e-300))
        u = q / norm
        largest, dim = np.argsort(-np.abs(u), kind="stable"), len(u)
        tried = np.unique(np.linspace(0, keep - 1, min(keep, TRIED_ROWS)).astype(np.int64))
        # Expected coordinates read per row: the focus of all, and every one of what stays.
        cost, focus = dim, 0
        for f in focus_counts(dim):
            stays = float((self.most(u, self.unit[tried], largest[:f]) >= local[tried]).mean())
            if f + stays * dim < cost:
                cost, focus = f + stays * dim, f
        if not focus:
            return np.arange(keep)
        return np.flatnonzero(self.most(u, self.unit[:keep], largest[:focus]) >= local)


PAIR_OUT = "query_id long, vec_id long, score long"


def _search(k: int):
    def search(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        asks, rows = group[group["ask"]], group[~group["ask"]]
        if len(asks) and len(rows):
            block = Block(rows["id"].to_numpy(np.int64), np.array(rows["v"].tolist(), dtype=np.float64))
            for qid, v, least in zip(asks["id"], asks["v"], asks["least"]):
                q = np.asarray(v, dtype=np.float64)
                at = block.candidates(q, least)
                at = at[block.ids[at] != qid]
                s = products(q, block.rows[at])
                s, ids = best(s, block.ids[at], k)
                out += zip([int(qid)] * len(s), ids.tolist(), s.tolist())
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")
    return search


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding", block_rows: int = 4096, block_queries: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest integer
    inner products over all other rows, ties to the smaller id.

    Vectors that are null, or hold null or non-finite components, and rows
    with a null id take no part, as query or as candidate.  Vectors meet only
    vectors of the same number of components (an empty one scores 0 with
    other empty ones).  A query is not its own candidate: rows that carry its
    id are left out; repeated rows of another id each count.  Fewer than ``k``
    candidates give fewer rows; an empty table gives none.  Other columns are
    ignored.
    """
    base = written(whole_vectors(vectors, id_col, vector_col, scale)
                   .withColumn("dim", F.size("v"))
                   .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)))
                   .withColumn("cls", F.floor(F.log2(F.greatest(F.least("norm", F.lit(1e300)), F.lit(1.0))) * 4).cast("int")), "vectors")
    asked = written(whole_vectors(queries, id_col, vector_col, scale).withColumn("dim", F.size("v"))
                    .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))), "asked")
    # Blocks: (dimension, length class) cut by a hash of the row into parts of about block_rows.
    sizes = base.groupBy("dim", "cls").agg(F.count("*").alias("rows"), F.max("norm").alias("longest"))
    parts = sizes.select("dim", "cls", "longest", F.ceil(F.col("rows") / block_rows).cast("int").alias("parts"))
    salt = F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int")
    rows = base.join(parts.select("dim", "cls", "parts"), ["dim", "cls"]).select(
        "dim", "cls", salt.alias("part"), "id", "v")
    ask_parts = asked.groupBy("dim").agg(F.ceil(F.count("*") / block_queries).cast("int").alias("parts"))
    asks = written(asked.join(ask_parts, "dim").select("dim", salt.alias("qpart"), "id", "v", "norm"), "asks")

    def meet(pairs: DataFrame, thresholds: DataFrame) -> DataFrame:
        """Sends both sides of every (query block, row block) pair together."""
        left = (pairs.select("dim", "qpart", "cls", "part").join(thresholds, ["dim", "qpart"])
                .select("dim", "qpart", "cls", "part", "id", "v", "least", F.lit(True).alias("ask")))
        right = (rows.join(pairs.select("dim", "cls", "part", "qpart"), ["dim", "cls", "part"])
                 .select("dim", "qpart", "cls", "part", "id", "v", F.lit(0.0).alias("least"), F.lit(False).alias("ask")))
        return left.unionByName(right).groupBy("dim", "qpart", "cls", "part").applyInPandas(_search(k), PAIR_OUT)

    row_blocks = parts.select("dim", "cls", "longest", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    ask_blocks = ask_parts.select("dim", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("qpart"))
    first = (sizes.groupBy("dim").agg(F.max("cls").alias("cls")).withColumn("part", F.lit(0))
             .join(ask_blocks, "dim"))
    lowest = F.lit(float(-(2**63)))
    seeds = meet(first, asks.withColumn("least", lowest))
    floor_ = (seeds.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
              .where(F.col("n") >= k).select(F.col("query_id").alias("id"), F.col("least").cast("double")))
    known = written(asks.join(floor_, "id", "left")
                    .withColumn("least", F.coalesce("least", lowest)), "thresholds")
    # A block of queries meets a block of rows if any of its queries may find a row there.
    reach = known.groupBy("dim", "qpart").agg(F.min(F.col("least") / F.greatest("norm", F.lit(1e-300))).alias("reach"))
    pairs = (row_blocks.join(reach, "dim").where(F.col("longest") >= F.col("reach") - F.abs("reach") * 1e-9)
             .select("dim", "qpart", "cls", "part"))
    found = meet(pairs, known)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                 .select("query_id", "rank", "vec_id", "score"))
