"""Near duplicates by b-bit MinHash (operator 12).

1. Each text becomes its set of word shingles (64-bit hashes); equal sets are
   one class, so copies cost nothing further.  A class has ``HASHES`` minima:
   bands of ``BAND_ROWS`` whole minima make candidates, and the low ``BITS``
   bits of all minima, packed into 64-bit words, make its signature.
2. Classes that share a band meet in its bucket.  Each is compared with the
   first class that it meets: equal minima are counted by bits, corrected for
   the 1 in 2**BITS that agree by chance, and candidates whose estimate is
   within reach of the threshold are confirmed on their full sets.  Confirmed
   links give first components.  Then each class is compared with the likeliest
   class of another component in its buckets, and confirmed likewise.  So a
   large group of near copies becomes one component after a number of
   comparisons in proportion to its size.
3. Within buckets, only classes of different components are still open.  Their
   signatures are compared in chunks of bounded size; components that may link
   are gathered into blocks, and units of a block are confirmed on full sets,
   but for pairs of units that one component fills.

Full sets are made only for classes with a candidate; texts of all others are
read once.  At similarity ``s`` a pair shares no band with probability
``(1 - s**5)**32`` (3e-6 at 0.8), and its estimate falls short of the reach with
probability 2e-8 (5.5 standard deviations).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_of, discard, texts_of, written, written_at
from .graph import components
from .membership import IdFilter, id_filter
from .ngram_join import WordHashes, set_key, shingle_set

BANDS, BAND_ROWS, BITS = 32, 5, 4
HASHES = BANDS * BAND_ROWS
PER_WORD = 64 // BITS
WORDS = HASHES // PER_WORD
#: Standard deviations that an estimate may fall below the threshold.
REACH = 5.5
#: Signatures of a chunk and full sets of a unit that meet in one task.
CHUNK, UNIT = 4096, 512
#: Shares into which the rows of one set are dealt when results come back.
SALTS = 8
SUMMARY = pa.schema([("id", pa.int64()), ("n", pa.int32()), ("key", pa.binary()), ("bands", pa.list_(pa.int64())),
                     ("signature", pa.list_(pa.int64()))])
FULL = pa.schema([("key", pa.binary()), ("set", pa.binary())])
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
BEST = pa.schema([("cid", pa.int64()), ("leader", pa.int64()), ("agree", pa.int64())])
#: Open pairs by component: an edge between two (of no class), or one's open class (no other component).
OPEN = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("cid", pa.int64())])

_draw = np.random.default_rng(12)
_LOW, _HIGH = (_draw.integers(0, 2**32, size=HASHES, dtype=np.uint32) | np.uint32(1) for _ in range(2))
_BAND = _draw.integers(0, 2**63, size=BANDS, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FIRST_BITS = 0x1111111111111111


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set that is not empty."""
    low, high = shingles.astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 2**32 - 1, dtype=np.uint32)
    for k in range(0, len(shingles), 1024):
        values = np.multiply.outer(_LOW, low[k:k + 1024])
        values += np.multiply.outer(_HIGH, high[k:k + 1024])
        np.minimum(out, values.min(axis=1), out=out)
    return out


def band_hashes(m: np.ndarray) -> np.ndarray:
    """One 64-bit hash per row of ``m`` and band, the band's place included."""
    parts = m.reshape(len(m), BANDS, BAND_ROWS).astype(np.uint64)
    h = np.broadcast_to(_BAND, (len(m), BANDS)).copy()
    for k in range(BAND_ROWS):
        h = (h ^ parts[:, :, k]) * _MIX
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def signatures(m: np.ndarray) -> np.ndarray:
    """The low bits of the minima (mixed, so that they depend on the whole
    minimum), ``PER_WORD`` to a word."""
    mixed = (m ^ (m >> np.uint32(16))) * np.uint32(0x45D9F3B)
    low = ((mixed ^ (mixed >> np.uint32(16))) & np.uint32((1 << BITS) - 1)).astype(np.uint64)
    shifts = np.arange(PER_WORD, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low.reshape(len(m), WORDS, PER_WORD) << shifts, axis=2).view(np.int64)


def agreeing(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """How many of the minima of ``one`` agree in their low bits with each of ``many``."""
    x = (many ^ one).view(np.uint64)
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    return HASHES - np.bitwise_count(x & np.uint64(_FIRST_BITS)).sum(axis=1, dtype=np.int64)


def agreeing_columns(a: str, b: str) -> Column:
    """``agreeing`` of two columns of signatures."""
    differ = F.lit(0)
    for k in range(WORDS):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(_FIRST_BITS)))
    return F.lit(HASHES) - differ


def estimate(agree):
    """Similarity from agreeing minima, corrected for those that agree by chance."""
    chance = 1 / (1 << BITS)
    return (agree / HASHES - chance) / (1 - chance)


def least_agreeing(percent: int) -> int:
    """Agreeing minima of a pair within reach of the threshold."""
    chance = 1 / (1 << BITS)
    share = percent / 100 * (1 - chance) + chance
    return int(HASHES * share - REACH * (HASHES * share * (1 - share)) ** 0.5)


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets of distinct hashes reach the threshold."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _summaries(words: int):
    def run(batches):
        hashes = WordHashes()
        for b in batches:
            for k in range(0, b.num_rows, 256):
                sets = [shingle_set(t, hashes, words) for t in texts_of(b.column(1).slice(k, 256))]
                m = np.stack([minima(s) if len(s) else np.zeros(HASHES, np.uint32) for s in sets])
                yield batch_of(SUMMARY, [b.column(0).slice(k, 256), [len(s) for s in sets], [set_key(s) for s in sets],
                                         list(band_hashes(m)), list(signatures(m))])
    return run


def _full_sets(words: int, wanted: IdFilter):
    """Key and set of the rows whose id may be wanted; others end here."""
    def run(batches):
        hashes = WordHashes()
        for b in batches:
            b = b.filter(pa.array(wanted.passes(b.column(0).to_numpy())))
            for k in range(0, b.num_rows, 200):
                sets = [shingle_set(t, hashes, words) for t in texts_of(b.column(1).slice(k, 200))]
                yield batch_of(FULL, [[set_key(s) for s in sets], [s.tobytes() for s in sets]])
    return run


class Roots(dict):
    """Union by smallest root."""

    def find(self, x: int) -> int:
        while (up := self.get(x, x)) != x:
            self[x] = x = self.get(up, up)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)
        return a != b


def groups_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows that agree in their first ``keys`` (long) columns."""
    held, last = [], None
    for b in batches:
        if not b.num_rows:
            continue
        columns = [b.column(k).to_numpy() for k in range(keys)]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        cuts = [0, *change.tolist(), b.num_rows]
        for a, z in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(a, z - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def dealt(rows: DataFrame, keys: list[str], columns: list[str], run, schema: str) -> DataFrame:
    """``run`` over the rows with equal ``keys`` side by side in one task."""
    return (rows.select(*[F.col(k).cast("long").alias(k) for k in keys], *columns).repartition(*keys)
            .sortWithinPartitions(*keys).mapInArrow(run, schema))


def _confirm_stars(percent: int):
    """Links of classes with the first class of a bucket: ``leader, chunk,
    cid, set``, the leader itself among them."""
    def run(batches):
        for t in groups_of(batches, 2):
            leader = t.column("leader")[0].as_py()
            cids = t.column("cid").to_pylist()
            sets = [np.frombuffer(s, np.uint64) for s in t.column("set").to_pylist()]
            if leader not in cids:
                raise ValueError("the set of a class is missing")
            own = sets[cids.index(leader)]
            found = [c for c, s in zip(cids, sets) if c != leader and links(own, s, percent)]
            yield batch_of(EDGES, [found, [leader] * len(found)])
    return run


def _rows(column) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), WORDS)


def _open_in(t: pa.Table, least: int):
    """Of classes that meet in a chunk, side 0 with side 1: each class of side 0
    with the classes of other components within reach and how many minima agree."""
    side, cids, labels = (t.column(c).to_numpy() for c in ("side", "cid", "label"))
    marks = _rows(t.column("signature"))
    right = np.flatnonzero(side == 1)
    many, many_labels = marks[right], labels[right]
    for x in np.flatnonzero(side == 0).tolist():
        agree = agreeing(marks[x], many)
        near = np.flatnonzero((agree >= least) & (many_labels != labels[x]))
        if len(near):
            yield int(cids[x]), int(labels[x]), cids[right[near]], many_labels[near], agree[near]


def _likeliest(least: int):
    """Each open class with the likeliest class of another component."""
    def run(batches):
        for t in groups_of(batches, 3):
            out = [(x, int(y[at]), int(agree[at])) for x, _, y, _, agree in _open_in(t, least) for at in [agree.argmax()]]
            yield batch_of(BEST, list(zip(*out)) or [[]] * 3)
    return run


def _open_pairs(least: int):
    """Edges that connect the components that may link, and their open classes."""
    def run(batches):
        for t in groups_of(batches, 3):
            roots, out, seen = Roots(), [], set()
            for x, own, y, theirs, _ in _open_in(t, least):
                for label in np.unique(theirs).tolist():
                    if roots.join(own, label):
                        out.append((own, label, None))
                for cid, label in ((x, own), *zip(y.tolist(), theirs.tolist())):
                    if cid not in seen:
                        seen.add(cid)
                        out.append((label, None, cid))
            yield batch_of(OPEN, list(zip(*out)) or [[]] * 3)
    return run


def _confirm_units(percent: int, least: int):
    """Links between classes of different components of two units of a block."""
    def run(batches):
        for t in groups_of(batches, 5):
            side, cids, labels = (t.column(c).to_numpy() for c in ("side", "cid", "label"))
            marks = _rows(t.column("signature"))
            sets = [np.frombuffer(s, np.uint64) for s in t.column("set").to_pylist()]
            left = np.flatnonzero(side == 0)
            right = np.flatnonzero(side == 1) if (side == 1).any() else left
            roots, out = Roots(), []
            for x in left.tolist():
                for y in right[np.flatnonzero((agreeing(marks[x], marks[right]) >= least) & (labels[right] != labels[x]))].tolist():
                    a, b = int(labels[x]), int(labels[y])
                    if roots.find(a) != roots.find(b) and links(sets[x], sets[y], percent):
                        roots.join(a, b)
                        out.append((int(cids[x]), int(cids[y])))
            yield batch_of(EDGES, list(zip(*out)) or [[], []])
    return run


def _sets_of(rows: DataFrame, classes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``cid, set`` of the classes in ``wanted`` (``cid``): the texts of one
    row each, found by a bounded filter of ids, become sets again."""
    chosen = written(classes.join(wanted, "cid", "left_semi").select("cid", "key", "id"), "wanted")
    maybe = id_filter(chosen.select("id").distinct())
    full = rows.select(F.xxhash64("id"), "text").mapInArrow(_full_sets(words, maybe), "key binary, set binary")
    return written(full.join(chosen.select("cid", "key"), "key").dropDuplicates(["cid"]).select("cid", "set"), "full-sets")


def _chunked(rows: DataFrame, own: str, number: str, other: str) -> DataFrame:
    """Each row in its own chunk of ``number``, once for each of ``other``."""
    chunk = F.pmod(F.xxhash64("cid", F.lit(own)), F.col(number))
    return rows.withColumn(own, chunk).withColumn("i" if own == "j" else "j", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))


def _open_chunks(met: DataFrame, marks: DataFrame, joined: DataFrame) -> DataFrame:
    """``h, i, j, side, cid, label, signature``: the classes of buckets that
    hold several components, dealt so that any two of different components
    meet in a chunk."""
    open_ = met.join(joined, "cid", "left").select("h", "cid", F.coalesce("component", "cid").alias("label"))
    held = (open_.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("all"))
            .where("lo <> hi"))
    rows = open_.join(held.select("h", "hi"), "h")
    # Of any two components one is not the bucket's last: those meet all.
    few = rows.where("label <> hi").groupBy("h").agg(F.count("*").alias("few"))
    parts = held.join(few, "h").select("h", F.ceil(F.col("few") / CHUNK).alias("n_i"), F.ceil(F.col("all") / CHUNK).alias("n_j"))
    rows = written(rows.join(parts, "h").join(marks, "cid"), "open")
    left = _chunked(rows.where("label <> hi"), "i", "n_i", "n_j").withColumn("side", F.lit(0))
    right = _chunked(rows, "j", "n_j", "n_i").withColumn("side", F.lit(1))
    columns = ["h", "i", "j", "side", "cid", "label", "signature"]
    return left.select(*columns).union(right.select(*columns))


CHUNK_KEYS, CHUNK_COLUMNS = ["h", "i", "j"], ["side", "cid", "label", "signature"]


def _confirmed_pairs(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The links among ``cid, leader``, confirmed on full sets: the classes of
    one leader are dealt into units, each with the leader's set."""
    parts = pairs.groupBy("leader").agg(F.ceil(F.count("*") / UNIT).alias("parts"))
    chunk = F.pmod(F.xxhash64("cid"), F.col("parts"))
    spokes = pairs.join(parts, "leader").select("leader", chunk.alias("chunk"), "cid")
    hubs = spokes.select("leader", "chunk").distinct().withColumn("cid", F.col("leader"))
    return dealt(spokes.union(hubs).join(full, "cid"), ["leader", "chunk"], ["cid", "set"], _confirm_stars(percent),
                 "a long, b long")


def _block_links(members: DataFrame, sets: DataFrame, percent: int, least: int) -> DataFrame:
    """Confirmed links within blocks; ``members``: ``block, cid, label, signature``.

    A component that is large in its block fills units of its own; smaller
    ones share units.  Units meet in pairs, but for two of one component."""
    labels = members.groupBy("block", "label").agg(F.count("*").alias("n"))
    shared = labels.where(F.col("n") <= UNIT // 2).groupBy("block").agg(F.ceil(F.sum("n") / UNIT).alias("n_shared"))
    placed = members.join(labels, ["block", "label"]).join(shared, "block", "left")
    large = F.col("n") > UNIT // 2
    filled = written(placed.join(sets, "cid").select(
        "block", "cid", "label", "signature", "set", F.when(large, F.col("label")).otherwise(-1).alias("of"),
        F.when(large, F.pmod(F.xxhash64("cid"), F.ceil(F.col("n") / UNIT)))
        .otherwise(F.pmod(F.xxhash64("label"), F.col("n_shared"))).alias("part")), "block-units")
    units = filled.select("block", "of", "part").distinct()
    other = units.select("block", F.col("of").alias("of2"), F.col("part").alias("part2"))
    pairs = written(units.join(other, "block").where("(of < of2 or (of = of2 and of = -1 and part <= part2))"), "unit-pairs")
    keys, columns = ["block", "of", "part", "of2", "part2"], ["side", "cid", "label", "signature", "set"]
    left = filled.join(pairs, ["block", "of", "part"]).withColumn("side", F.lit(0))
    right = (filled.withColumnsRenamed({"of": "of2", "part": "part2"})
             .join(pairs.where("of <> of2 or part <> part2"), ["block", "of2", "part2"]).withColumn("side", F.lit(1)))
    both = left.select(*keys, *columns).union(right.select(*keys, *columns))
    return dealt(both, keys, columns, _confirm_units(percent, least), "a long, b long")


def _joined(found: DataFrame) -> DataFrame:
    return components(found).select(F.col("node").alias("cid"), "component")


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per document.

    Documents link when ``100 * intersection >= percent * union`` of their
    sets of ``words``-word shingles; ``component_id`` is the smallest id
    reachable by links, the own one included, and ``kept`` marks its document.

    Texts that are null, empty or without words have the empty set, link with
    nothing and are kept.  A null id is a component's id only where all its
    ids are null (then all are kept); rows that repeat a component's id are
    all kept; repeated rows are copies; texts of any length are read whole; an
    empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    least = least_agreeing(percent)
    summaries, path = written_at(rows.mapInArrow(
        _summaries(words), "id long, n int, key binary, bands array<long>, signature array<long>"), "summaries")
    classes = (summaries.where("n > 0").groupBy("key")
               .agg(F.first("bands").alias("bands"), F.first("signature").alias("signature"),
                    F.count("*").alias("copies"), F.min("id").alias("id"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = written(classes, "classes")
    sets = written(summaries.select("id", "n", "key"), "sets")
    discard(spark, path)

    marks = classes.select("cid", "signature")
    banded = classes.select(F.explode("bands").alias("h"), "cid")
    buckets = banded.groupBy("h").agg(F.min("cid").alias("leader"), F.count("*").alias("c")).where("c > 1")
    met, met_path = written_at(banded.join(buckets, "h"), "buckets")
    # Each class with the first one that it meets anywhere.
    first = met.where("cid <> leader").groupBy("cid").agg(F.min("leader").alias("leader"))
    pairs = first.join(marks, "cid").join(marks.select(F.col("cid").alias("leader"), F.col("signature").alias("first")), "leader")
    stars = written(pairs.where(agreeing_columns("signature", "first") >= least).select("cid", "leader"), "stars")
    full = _sets_of(rows, classes, stars.select("cid").union(stars.select("leader")).distinct(), words)
    found = written(_confirmed_pairs(stars, full, percent), "links")

    def more(wanted: DataFrame) -> DataFrame:
        missing = wanted.join(full, "cid", "left_anti").select("cid").distinct()
        return full.unionByName(_sets_of(rows, classes, missing, words))

    # Each open class with the likeliest one of another component.
    joined = _joined(found)
    best = dealt(_open_chunks(met, marks, joined), CHUNK_KEYS, CHUNK_COLUMNS, _likeliest(least), "cid long, leader long, agree long")
    likely = written(best.groupBy("cid").agg(F.max_by("leader", F.struct("agree", "leader")).alias("leader")), "likeliest")
    full = more(likely.select("cid").union(likely.select("leader")))
    found = written(found.union(_confirmed_pairs(likely, full, percent)), "links")

    # All that is open then.
    joined = _joined(found)
    open_ = written(dealt(_open_chunks(met, marks, joined), CHUNK_KEYS, CHUNK_COLUMNS, _open_pairs(least),
                          "a long, b long, cid long").distinct(), "open-pairs")
    discard(spark, met_path)
    blocks = components(open_.where("b IS NOT NULL").select("a", "b")).select(F.col("node").alias("label"), F.col("component").alias("block"))
    members = (open_.where("b IS NULL").select("cid", F.col("a").alias("label")).join(blocks, "label").join(marks, "cid")
               .select("block", "cid", "label", "signature"))
    members = written(members, "block-members")
    full = more(members.select("cid"))
    found = written(found.union(_block_links(members, full, percent, least)), "links")
    joined = _joined(found)

    smallest = classes.join(joined, "cid").groupBy("component").agg(F.min("id").alias("component_id"))
    known = (classes.select("cid", "key", "copies", "id").join(joined, "cid", "left").join(smallest, "component", "left")
             .where("copies > 1 or component is not null")
             .select("key", F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("least"),
                     F.lit(True).alias("met"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")))
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS).cast("long"))
    return (sets.withColumn("salt", salt).join(known, ["key", "salt"], "left")
            .select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("met") & (F.col("n") > 0), F.col("least")).otherwise(F.col("id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
