"""Filter interaction audit by Lehmer-rank difference arrays (operator 13).

Every document is reduced to the mask of the filters that it fails, and the
table to the number of documents per (part, mask).  Which filter removes a
mask, under an order of the filters, depends only on the order's letters up to
that filter; orders that begin alike are neighbours in lexicographic order, so
each removal step of a mask covers whole intervals of permutation ranks.  The
mask's counts are added at the first rank of each interval and taken off behind
its last; running sums over the ranks then give the removals of every order and
step at once, without going through orders times documents.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written_at

LETTERS = "ABCDE"
#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\v\f\r"


def lehmer_rank(prefix: str, letters: str = LETTERS) -> int:
    """Rank, among all orders of ``letters``, of the first one that begins
    with ``prefix``: the Lehmer code read in the factorial number system."""
    left, rank = list(letters), 0
    for k, letter in enumerate(prefix):
        at = left.index(letter)
        rank += at * factorial(len(letters) - 1 - k)
        del left[at]
    return rank


def removal_intervals(letters: str = LETTERS) -> list[tuple[int, int, str, int, int]]:
    """``(mask, step, letter, first, behind)``: under the orders of ranks
    ``first`` to ``behind - 1``, ``letter`` removes documents of ``mask`` at
    ``step``: the letters before it are outside the mask, and it is inside."""
    out = []
    for mask in range(1, 1 << len(letters)):
        inside = [c for k, c in enumerate(letters) if mask >> k & 1]
        outside = [c for k, c in enumerate(letters) if not mask >> k & 1]
        for before in range(len(outside) + 1):
            for passed in permutations(outside, before):
                for letter in inside:
                    first = lehmer_rank("".join(passed) + letter, letters)
                    out.append((mask, before + 1, letter, first, first + factorial(len(letters) - before - 1)))
    return out


def text_failures(text: Column) -> list[Column]:
    """Filters A to D of a text that is not null: under 50 words; less than
    65 % distinct words; over 5 % capitals ``A-Z``; any of ``#$%&*|``."""
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    return [F.size(words) < 50, 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
            100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text), text.rlike(r"[#$%&*|]")]


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """``part, mask, n, good, toxic``: documents per failure mask (bit k: the
    k-th letter), with those labelled quality 1 and toxic 1.

    Texts are read once; only ids and digests are shuffled.  The smallest id
    per text is a combining aggregate, and rows find it by (digest, id), so
    that copies which make up a third of the table meet nowhere.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    bits = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(text_failures(F.col("text")))), F.lit(0))
    facts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"),
                        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part")).select(
        "id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), bits.cast("int").alias("bits"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"))
    facts, path = written_at(facts, "facts")
    first = (facts.where("id is not null").groupBy("digest").agg(F.min("id").alias("id"))
             .withColumn("first", F.lit(True)))
    known = facts.join(first, ["digest", "id"], "left").join(marks, "id", "left")
    again = F.col("id").isNotNull() & F.col("first").isNull()
    counts = (known.select("part", F.col("bits").bitwiseOR(F.when(again, 16).otherwise(0)).alias("mask"),
                           F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
              .groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"),
                                           F.sum("toxic").alias("toxic")))
    counts, _ = written_at(counts, "masks")
    discard(docs.sparkSession, path)
    return counts


def audit(counts: DataFrame) -> DataFrame:
    """The report per (part, order, step) from the documents per mask (at most
    32 rows a part)."""
    spark = counts.sparkSession
    orders = ["".join(p) for p in permutations(LETTERS)]
    cells = F.broadcast(spark.createDataFrame(
        [(rank, order, step + 1, letter) for rank, order in enumerate(orders) for step, letter in enumerate(order)],
        "rank int, filter_order string, step int, letter string"))
    spans = F.broadcast(spark.createDataFrame(removal_intervals(), "mask int, step int, letter string, first int, behind int"))
    ends = counts.join(spans, "mask").select(
        "part", "step", F.explode(F.array(
            F.struct(F.col("first").alias("rank"), *[F.col(c) for c in ("n", "good", "toxic")]),
            F.struct(F.col("behind").alias("rank"), *[(-F.col(c)).alias(c) for c in ("n", "good", "toxic")]))).alias("end"))
    jumps = ends.groupBy("part", "step", F.col("end.rank").alias("rank")).agg(
        *[F.sum(f"end.{c}").alias(c) for c in ("n", "good", "toxic")])
    letter_bit = F.element_at(F.create_map(*[F.lit(x) for k, c in enumerate(LETTERS) for x in (c, 1 << k)]), F.col("letter"))
    letters = F.broadcast(spark.createDataFrame([(c,) for c in LETTERS], "letter string").withColumn("bit", letter_bit))
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"))
    by_letter = counts.crossJoin(letters).groupBy("part", "letter").agg(  # five letters per row
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n")).otherwise(0)).alias("unique_fails"))
    along = Window.partitionBy("part", "step").orderBy("rank")
    sums = [F.sum(F.coalesce(F.col(c), F.lit(0))).over(along).alias(out)
            for c, out in (("n", "removed"), ("good", "good_lost"), ("toxic", "toxic_lost"))]
    grid = parts.crossJoin(cells).join(jumps, ["part", "step", "rank"], "left").select(
        "part", "total", "filter_order", "step", "letter", *sums)
    done = Window.partitionBy("part", "filter_order").orderBy("step")
    every = Window.partitionBy("part", "letter")
    return (grid.join(by_letter, ["part", "letter"]).select(
        "part", "filter_order", "step", (F.col("total") - F.sum("removed").over(done)).alias("kept"), "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost",
        F.sum("removed").over(every).alias("shapley")))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step: ``part,
    filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley`` (long counts of documents within the part).

    Filters A to D are those of ``text_failures``; E fails a document whose
    text a row with a smaller id has, anywhere in the table, removed or not.
    Null texts are empty; a null part is the empty string; a null id is
    smaller and larger than none, so it neither fails E nor makes others fail;
    rows that repeat the smallest id of a text all pass E; repeated label rows
    count once (1 if any is 1); documents without a label are neither good nor
    toxic; texts of any length are read whole; an empty table gives no rows;
    other columns are ignored.
    """
    return audit(masks(docs, labels, id_col, text_col, part_col))
