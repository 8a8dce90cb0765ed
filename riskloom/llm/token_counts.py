"""Token counts by whole-token shortcut (operator 2)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, texts_of
from .segments import PieceCounts, loaded

OUT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def token_counts(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``model`` is a sentencepiece file that every machine has.  Which of its
    vocabulary strings encode alone as one token is proven once per worker
    process; pre-tokens equal to one of them count one, the rest are merged.
    One map over the whole texts, no shuffle; memory is one Arrow batch and a
    bounded cache.

    Null texts count as empty (0 bytes, 0 tokens); empty texts have 0 tokens;
    null and repeated ids give one row per input row; texts of any length are
    read whole; an empty table gives no rows; other columns are ignored.
    """
    def count(batches):
        counts = loaded(PieceCounts, model)
        for b in batches:
            yield batch_of(OUT, [b.column(0), b.column(1), list(counts.count(texts_of(b.column(2))))])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return (rows.mapInArrow(count, "id long, n_bytes long, n_tokens long")
                .select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
                        (F.col("n_tokens") > limit).alias("over_limit")))
