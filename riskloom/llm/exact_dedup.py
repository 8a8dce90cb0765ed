"""Exact duplicate removal by skew-safe combining (operator 8).

1. Local: each task keeps one winner per distinct content of what it reads.
2. Salted: local winners whose digest more than one task has are grouped by
   (digest, salt, content), so a group of copies that every task holds is
   spread over the salts.
3. Global: the salt winners are combined by (digest, content).

Full contents are compared in every stage: the content is part of each
grouping key.  Each row carries the number of its local winner, and a salted
group the numbers of its local winners, so decisions come back by number, and
one content's only once per salt; texts that only one task holds are never
shuffled.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import discard, only_for, written, written_at

#: Bytes that a task holds before it emits its winners and
#: starts anew; what this leaves apart, the later stages combine.
LOCAL_BYTES = 64 << 20
SALTS, PER_SALT = 16, 256
#: Rows taken up between two looks at the bytes held, and what a row's numbers take.
ROWS_HELD, ROW_BYTES = 1024, 300


def normalised(text: str) -> bytes:
    """Each run of space, tab, line feed, vertical tab, form feed and carriage
    return as one space, in UTF-8."""
    raw = text.encode()
    body = b" ".join(raw.split())
    if not body:
        return b" " if raw else b""
    return (b" " if raw[0] in b" \t\n\v\f\r" else b"") + body + (b" " if raw[-1] in b" \t\n\v\f\r" else b"")


def sha256(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


#: What the local stage adds to a row: its number, its local winner's number
#: and id, the rows that winner stands for, and the content's digest.
MARKS = "mine long, local long, local_id long, local_n long, digest string"


def _local(arrow: pa.Schema, digest):
    """Marks every row; the text stays only on local winners.

    Held between two flushes: per row its id, the other columns and a few
    numbers; per distinct content the text of its winner so far.  All of it
    counts towards ``LOCAL_BYTES``, so copies without end are flushed too."""
    work = uuid.uuid4().hex

    def run(batches):
        only_for(work)
        task, first = TaskContext.get().partitionId() << 40, 0
        held: list[tuple[pa.Array, pa.Array]] = []
        groups: dict[tuple[str, bytes], list] = {}
        winners: dict[tuple[str, bytes], tuple] = {}

        def flush():
            n = sum(len(ids) for ids, _ in held)
            marks: list = [None] * n
            texts: list = [None] * n
            for key, rows in groups.items():
                (null, doc_id, at), text = winners[key]
                texts[at] = text
                mark = (task + first + at, None if null else doc_id, len(rows), key[0])
                for i in rows:
                    marks[i] = (task + first + i, *mark)
            at = 0
            for ids, rest in held:
                part = slice(at, at + len(ids))
                columns = [ids, texts[part], rest, *zip(*marks[part])]
                at += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) and c.type == t.type else c.cast(t.type) if isinstance(c, pa.Array)
                     else pa.array(c, t.type) for c, t in zip(columns, arrow)], schema=arrow)

        i = size = 0
        for b in batches:
            for k in range(0, b.num_rows, ROWS_HELD):
                some = b.slice(k, ROWS_HELD)
                every = pa.array(range(some.num_rows))
                ids, rest = some.column(0).take(every), some.column(2).take(every)  # copies: the batch and its texts go
                held.append((ids, rest))
                size += ids.nbytes + rest.nbytes + ROW_BYTES * some.num_rows
                for doc_id, value in zip(ids.to_pylist(), some.column(1)):
                    text = value.as_py()
                    content = normalised(text or "")
                    key, order = (digest(content), content), (doc_id is None, doc_id or 0, i)
                    if key not in groups:
                        groups[key], winners[key] = [], (order, text)
                        size += 3 * len(content)
                    elif order < winners[key][0]:
                        winners[key] = (order, text)
                    groups[key].append(i)
                    i += 1
                if size >= LOCAL_BYTES:
                    yield from flush()
                    first, i, size = first + i, 0, 0
                    held.clear(), groups.clear(), winners.clear()
        yield from flush()
    return run


def _salts(docs: DataFrame) -> int:
    """Shares of one digest's local winners: about ``PER_SALT`` tasks in each."""
    return max(SALTS, -(-docs.rdd.getNumPartitions() // PER_SALT))


def _stages(docs: DataFrame, id_col: str, text_col: str, carry: bool, digest) -> tuple[DataFrame, DataFrame]:
    """The marked rows, and for each local winner whose content other tasks
    have too: ``local, keep, keep_id, group_size``."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"),
                       (F.struct(*rest) if carry and rest else F.struct(F.lit(0).alias("none"))).alias("rest"))
    out = StructType([*rows.schema.fields, *StructType.fromDDL(MARKS).fields])
    marked = written(rows.mapInArrow(_local(to_arrow_schema(out), digest), out), "marked")
    winners = marked.where("mine = local")
    repeated = winners.groupBy("digest").agg(F.count("*").alias("c")).where("c > 1")
    n = F.lit(_salts(docs))
    salt = F.pmod(F.xxhash64("mine"), n).alias("salt")
    repeated = repeated.select("digest", F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)).alias("salt"))
    content = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    shared = winners.select("digest", salt, "text", "mine", "local_n", "id").join(repeated, ["digest", "salt"]).select(
        "digest", "salt", content.alias("content"), "mine", "local_n",
        F.struct(F.col("id").isNull().alias("null"), "id", "mine").alias("first"))
    # The way back needs no content: a salted group knows its local winners, about PER_SALT of them.
    salted, path = written_at(shared.groupBy("digest", "salt", "content").agg(
        F.min("first").alias("first"), F.sum("local_n").alias("n"), F.collect_list("mine").alias("locals")), "salted")
    groups = (salted.groupBy("digest", "content")
              .agg(F.min("first").alias("first"), F.sum("n").alias("group_size")))
    decided = (salted.select("digest", "content", "locals").join(groups, ["digest", "content"])
               .select(F.explode("locals").alias("local"), F.col("first.mine").alias("keep"),
                       F.col("first.id").alias("keep_id"), "group_size"))
    decided = written(decided, "decided")
    discard(docs.sparkSession, path)
    return marked, decided


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every input row.

    Texts are equal when ``normalised`` makes them identical; of equal texts
    the row with the smallest id stays (a null id sorts last; of rows that
    repeat that id exactly one is kept).  Null and empty texts are equal to
    each other.  Texts of any length are compared whole; an empty table gives
    no rows; other columns are ignored.  ``digest`` maps a content to text:
    different contents that share a digest stay apart.
    """
    marked, decided = _stages(docs, id_col, text_col, False, digest)
    own = marked.select("id", "mine", "local", "local_id", "local_n", "digest")
    met = F.col("keep").isNotNull()
    return (own.join(decided, "local", "left")
            .select(F.col("id").alias("doc_id"), F.when(met, F.col("keep_id")).otherwise(F.col("local_id")).alias("keep_id"),
                    F.coalesce("group_size", "local_n").alias("group_size"),
                    (F.col("mine") == F.coalesce("keep", "local")).alias("kept"), F.col("digest").alias("text_sha256")))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns."""
    marked, decided = _stages(docs, id_col, text_col, True, sha256)
    lost = decided.where("local <> keep").select(F.col("local").alias("mine"))
    kept = marked.where("mine = local").join(lost, "mine", "left_anti")
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c)
                         for c in docs.columns])
