"""Jaccard join of n-gram sets with a prefix tree (operator 9).

1. Each text becomes the set of its distinct word shingles (64-bit hashes).
   Equal sets are one class, so copies cost nothing further.
2. The shingles of a class are dealt by hash into more parts than sets that link
   can have shingles apart, so that these agree in a whole part.  A class none of
   whose parts is equal to another's can link with nothing and ends here; the
   others form groups.  Single shingles that many documents share by chance, the
   more the larger the table, do not keep a class.
3. A global order of shingles puts a share of them (by hash) first, rarest
   first, exact document frequencies counted over all classes, and the others
   after.  Two sets that reach the threshold share a shingle in their prefixes
   in any one order; with the rare ones first, passages that many documents
   share lie beyond almost every prefix.
4. Classes of a group that a shared prefix shingle connects, directly or not,
   form a block; others can link with nothing.  Small blocks are joined whole,
   several in a task.  A large one is cut by length (only neighbouring length
   bands can link) and into units of bounded size by the rarest prefix shingle,
   and the pairs of units that share a prefix shingle meet in a task each.
5. There the sets of one unit are stored, most frequent shingle first, as a
   prefix tree: sets share the paths they have in common.  Each set of the other
   unit walks the tree once, reusing the overlap counted on a shared path, and
   leaves a subtree when the shingles left on either side cannot reach the
   threshold any more.
6. A task gives back spanning links and numbers of links, never all pairs.
"""

from __future__ import annotations

import math
import uuid
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_of, discard, only_for, texts_of, written, written_at
from .graph import components
from .membership import IdFilter, id_filter, rows_without

#: Odd multiplier of the shingle hash.
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Sets of a unit: a task holds two units.
UNIT = 512
#: Shares into which the rows of one large component are dealt when its id is looked up.
SALTS = 8
#: Marks of parts have 48 bits: the low ones say in which of the buckets equal marks meet.
BUCKETS, MARK_BYTES, REST_BYTES = 1 << 10, 6, 5
SETS = pa.schema([("id", pa.int64()), ("n", pa.int32()), ("key", pa.binary()), ("marks", pa.binary())])
LISTED = pa.schema([("cid", pa.int64()), ("n", pa.int32()), ("region", pa.int32()), ("listed", pa.list_(pa.int64()))])
DEALT = pa.schema([("bucket", pa.int32()), ("base", pa.int64()), ("marks", pa.binary()), ("owners", pa.binary())])
FULL = pa.schema([("key", pa.binary()), ("set", pa.binary())])
#: Classes whose listed shingles are tested at once.
TESTED = 1_000


class WordHashes(dict):
    """64-bit hash of each word, within a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str, hashes: WordHashes, n: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles: A-Z lower-cased, words
    apart by space, tab, line feed, vertical tab, form feed and carriage
    return; fewer than ``n`` words are one shingle, none is the empty set."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b"\0".join(words), seed=len(words))], dtype=np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    count = len(w) - n + 1
    h = np.zeros(count, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = (h ^ (h >> np.uint64(31))) * MIX + w[k:k + count]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return np.unique(h ^ (h >> np.uint64(29)))


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def least_overlap(n, percent: int):
    """Shingles that a set of ``n`` shares with any set that it links with."""
    return -(-percent * n // 100)


def region_limit(percent: int) -> int:
    """Shingles whose low 16 bits are below this stand first in the global
    order.  It takes in 5/3 of the share of a set that a prefix needs (one
    sixth of all shingles at 90 %, one third at 80 %): the rarest of them fill
    the prefix, and common passages stay out of it."""
    return min(0x10000, 0x10000 * (100 - percent) // 60 + 1)


@cache
def size_bands(percent: int) -> list[int]:
    """Smallest sizes of the length bands: a set links within its band and the two beside it only."""
    edges = [1]
    while edges[-1] < 1 << 31:
        edges.append(edges[-1] * 100 // percent + 1)
    return edges


@cache
def parts_of(band: int, percent: int) -> tuple[int, int]:
    """Parts for links whose smaller set is of this band, and how many of them
    agree beyond one in any such link; no parts if different sets cannot link."""
    edges = size_bands(percent)
    least, most = edges[band], edges[band + 1] - 1
    apart = (most + most * 100 // percent) * (100 - percent) // (100 + percent)
    spare = 0
    while apart and spare < apart:
        blank = (apart + 1 + spare) * math.exp(-least / (apart + 1 + spare))  # parts of a set without a shingle
        if spare >= math.ceil(blank + 4 * math.sqrt(blank)):
            break
        spare += 1
    return (apart + 1 + spare if apart else 0), spare


def part_marks(s: np.ndarray, percent: int) -> np.ndarray:
    """Marks of the parts of a set, as the smaller and as the larger one of a
    link.  Two different sets that link have a mark in common: their shingles
    apart leave ``spare + 1`` parts equal.  Parts without shingles have marks
    only in a set with more than ``spare`` of them; if one of two sets has no
    more, an equal part with shingles is left."""
    found = [np.zeros(0, dtype=np.uint64)]
    if percent >= 100:  # different sets never link
        return found[0]
    own = int(np.searchsorted(size_bands(percent), len(s), side="right")) - 1
    for band in (own, own - 1):
        parts, spare = parts_of(band, percent) if band >= 0 else (0, 0)
        if not parts:
            continue
        at = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # ascending, as the set is
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        sums = np.add.reduceat(s, starts)
        if parts - len(starts) > spare:
            blank = np.setdiff1d(np.arange(parts, dtype=np.uint64), at[starts])
            sums = np.concatenate((sums, blank))
        h = (sums ^ np.uint64(band)) * MIX
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        found.append((h ^ (h >> np.uint64(32))) & np.uint64(0xFFFFFFFFFFFF))
    return np.concatenate(found)


def packed(values: np.ndarray, size: int) -> bytes:
    """The low ``size`` bytes of each."""
    return np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def unpacked(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), dtype=np.uint8)
    out[:, :size] = np.frombuffer(data, dtype=np.uint8).reshape(-1, size)
    return out.view("<u8").ravel()


def _summaries(percent: int, n: int):
    work = uuid.uuid4().hex

    def run(batches):
        only_for(work)
        hashes = WordHashes()
        for b in batches:
            rows = []
            for text in texts_of(b.column(1)):
                s = shingle_set(text, hashes, n)
                rows.append((len(s), set_key(s), packed(part_marks(s, percent), MARK_BYTES) if len(s) else b""))
            yield batch_of(SETS, [b.column(0), *(list(zip(*rows)) or [[]] * 3)])
    return run


def _dealt(batches):
    """The marks of the classes (``cid, marks``) by bucket: a mark's other bits
    and, for its owner, the low 16 bits of the class beside their common base."""
    for b in batches:
        held = b.column(1).to_pylist()
        marks = unpacked(b"".join(held), MARK_BYTES)
        owner = np.repeat(b.column(0).to_numpy(), [len(x) // MARK_BYTES for x in held])
        base, bucket = owner >> 16, (marks % np.uint64(BUCKETS)).astype(np.int64)
        order = np.lexsort((bucket, base))
        base, bucket, rest, low = base[order], bucket[order], (marks // np.uint64(BUCKETS))[order], (owner[order] & 0xFFFF).astype("<u2")
        starts = np.flatnonzero(np.append(True, (base[1:] != base[:-1]) | (bucket[1:] != bucket[:-1]))) if len(base) else []
        rows = [(int(bucket[x]), int(base[x]), packed(rest[x:y], REST_BYTES), low[x:y].tobytes())
                for x, y in zip(starts, [*starts[1:], len(base)])]
        yield batch_of(DEALT, list(zip(*rows)) or [[]] * 4)


def _meet(group: pd.DataFrame) -> pd.DataFrame:
    """Classes of a bucket that have a mark in common, each with the least of them."""
    rest = np.concatenate([unpacked(x, REST_BYTES) for x in group["marks"]])
    owner = np.concatenate([(int(base) << 16) + np.frombuffer(x, dtype="<u2").astype(np.int64)
                            for base, x in zip(group["base"], group["owners"])])
    order = np.lexsort((owner, rest))
    rest, owner = rest[order], owner[order]
    first = np.append(True, rest[1:] != rest[:-1])
    least = owner[np.flatnonzero(first)[np.cumsum(first) - 1]]
    return pd.DataFrame({"a": owner, "b": least})[owner != least].drop_duplicates()


def _listed(percent: int):
    """Of each set the shingles that its prefix can have."""
    limit = region_limit(percent)

    def run(batches):
        for b in batches:
            rows = []
            for value in b.column(1):
                s = np.frombuffer(value.as_py(), dtype=np.uint64)
                first = (s & np.uint64(0xFFFF)) < limit
                prefix = len(s) - least_overlap(len(s), percent) + 1
                listed = s[first]
                region = len(listed)
                if region < prefix:
                    listed = np.concatenate((listed, s[~first][:prefix - region]))
                rows.append((len(s), region, listed.view(np.int64)))
            yield batch_of(LISTED, [b.column(0), *(list(zip(*rows)) or [[]] * 3)])
    return run


def _full_sets(n: int, wanted: IdFilter):
    """Key and set of the rows whose id may be wanted; others end here."""
    def run(batches):
        only_for(wanted.path)
        hashes = WordHashes()
        for b in batches:
            b = b.filter(pa.array(wanted.passes(b.column(0).to_numpy())))
            for k in range(0, b.num_rows, 200):
                sets = [shingle_set(t, hashes, n) for t in texts_of(b.column(1).slice(k, 200))]
                yield batch_of(FULL, [[set_key(s) for s in sets], [s.tobytes() for s in sets]])
    return run


class Tree:
    """Sets as paths of a prefix tree, in depth-first order: path ``j`` leaves
    path ``parent[j]`` at ``depth[j]`` and adds ``tokens[start[j]:end[j]]``."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        self.order = sorted(range(len(sets)), key=lambda k: sets[k].tolist())
        paths = [sets[k] for k in self.order]
        m = len(paths)
        self.sizes = sizes[self.order]
        self.parent, self.depth, self.skip = [0] * m, [0] * m, [m] * m
        added, stack = [], []
        for j, p in enumerate(paths):
            d = 0
            if j:
                q = paths[j - 1]
                k = min(len(p), len(q))
                differ = np.flatnonzero(p[:k] != q[:k])
                d = int(differ[0]) if len(differ) else k
            while stack and self.depth[stack[-1]] >= d and stack[-1] != 0:
                self.skip[stack.pop()] = j
            if j:
                self.parent[j] = stack[-1] if stack else 0
            if d == 0 and j:
                self.parent[j] = -1
                while stack:
                    self.skip[stack.pop()] = j
            self.depth[j] = d
            stack.append(j)
            added.append(p[d:])
        lengths = np.array([len(x) for x in added], dtype=np.int64)
        self.end = np.cumsum(lengths)
        self.start = self.end - lengths
        self.tokens = np.concatenate(added) if m else np.zeros(0, dtype=np.int64)
        # Of each subtree: the smallest set and the most shingles below the branch.
        self.least, self.rest = self.sizes.copy(), np.array([len(p) for p in paths], dtype=np.int64)
        for j in range(m - 1, 0, -1):
            p = self.parent[j]
            if p >= 0:
                self.least[p] = min(self.least[p], self.least[j])
                self.rest[p] = max(self.rest[p], self.rest[j])
        self.rest -= np.array(self.depth, dtype=np.int64)
        self.first = np.array([x[0] if len(x) else -1 for x in added], dtype=np.int64)
        self.lists = [x.tolist() for x in (self.start, self.end, self.least, self.sizes)]

    def search(self, ranks: np.ndarray, size: int, mark: np.ndarray, percent: int):
        """Positions of the sets whose Jaccard similarity reaches the threshold."""
        mark[ranks] = 1
        counted = np.concatenate(([0], np.cumsum(mark[self.tokens], dtype=np.int64))).tolist()
        mark[ranks] = 0
        ahead = len(ranks) - np.searchsorted(ranks, self.first)
        reach = np.where(self.first < 0, 0, np.minimum(ahead, self.rest)).tolist()
        start, end, least, sizes = self.lists
        base, found = [0] * len(sizes), []
        j, m, total = 0, len(sizes), 100 + percent
        while j < m:
            p = self.parent[j] if j else -1
            shared = 0 if p < 0 else base[p] + counted[start[p] + self.depth[j] - self.depth[p]] - counted[start[p]]
            if total * (shared + reach[j]) < percent * (size + least[j]):
                j = self.skip[j]
                continue
            base[j] = shared
            overlap = shared + counted[end[j]] - counted[start[j]]
            if total * overlap >= percent * (size + sizes[j]):
                found.append(j)
            j += 1
        return found


LINKS = "a long, b long, links long"


def _join_units(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        edges = [x for _, part in group.groupby("part") for x in joined(part)]
        return pd.DataFrame(edges, columns=["a", "b", "links"]).astype("int64")

    def joined(group: pd.DataFrame) -> list[tuple[int, int, int]]:
        ids, copies, sides = (group[c].to_numpy(np.int64) for c in ("cid", "copies", "side"))
        sets = [np.frombuffer(s, dtype=np.uint64) for s in group["set"]]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        tokens, local = np.unique(np.concatenate(sets), return_inverse=True)
        often = np.bincount(local, minlength=len(tokens))
        rank = np.full(len(tokens), -1, dtype=np.int64)
        common = np.flatnonzero(often > 1)  # a shingle of one set overlaps with nothing here
        rank[common[np.argsort(-often[common], kind="stable")]] = np.arange(len(common))
        cuts = np.split(rank[local], np.cumsum(sizes)[:-1])
        paths = [np.sort(c[c >= 0]) for c in cuts]
        self_join = (sides == 0).all()
        stored = np.flatnonzero(sides == (0 if self_join else 1))
        tree = Tree([paths[k] for k in stored], sizes[stored])
        place = stored[tree.order] if len(stored) else stored
        mark = np.zeros(len(common) + 1, dtype=np.int8)
        root, links, edges = list(range(len(ids))), np.zeros(len(ids), dtype=np.int64), []

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for x in np.flatnonzero(sides == 0).tolist():
            for j in tree.search(paths[x], int(sizes[x]), mark, percent):
                y = int(place[j])
                if y == x:
                    continue
                links[x] += copies[y]
                if not self_join:
                    links[y] += copies[x]
                a, b = find(x), find(y)
                if a != b:
                    root[a] = b
                    edges.append((int(ids[x]), int(ids[y]), 0))
        return edges + [(int(ids[k]), int(ids[k]), int(links[k])) for k in np.flatnonzero(links)]

    return run


def _perhaps_shared(shared: IdFilter):
    """Classes with those of their listed shingles that others may have too."""
    def run(batches):
        only_for(shared.path)
        for b in batches:
            for k in range(0, b.num_rows, TESTED):
                some = b.slice(k, TESTED)
                listed = some.column(3)
                tokens = listed.flatten().to_numpy()
                owner = np.repeat(np.arange(len(listed)), listed.value_lengths().to_numpy())
                passes = shared.passes(tokens)
                ends = np.cumsum(np.bincount(owner[passes], minlength=len(listed)))
                kept = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(tokens[passes]))
                yield pa.RecordBatch.from_arrays([*some.columns[:3], kept], names=["cid", "n", "region", "listed"])
    return run


def _prefixes(classes: DataFrame, percent: int) -> tuple[DataFrame, str]:
    """``cid, tok``: the shingles of each class's prefix that others have too,
    as a written table, and where it is.

    Most listed shingles are of one class alone.  They are only counted: a
    filter of the shared ones stops nearly all of them where they are read, and
    the join on the counts, which is exact, the rest."""
    spark = classes.sparkSession
    listed = classes.select(F.explode("listed").alias("tok"))
    shared, path = written_at(listed.groupBy("tok").agg(F.count("*").alias("df")).where("df > 1"), "shared")
    known = id_filter(shared.select("tok"), hashed=True)
    first = F.col("tok").bitwiseAND(0xFFFF) < region_limit(percent)
    rows = (classes.select("cid", "n", "region", "listed")
            .mapInArrow(_perhaps_shared(known), "cid long, n int, region int, listed array<long>")
            .select("cid", "n", "region", F.explode("listed").alias("tok"))
            .join(shared, "tok").withColumn("first", first))
    mine = Window.partitionBy("cid")
    rank = F.row_number().over(mine.orderBy(F.desc("first"), "df", "tok"))
    prefix = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    alone = F.col("region") - F.count_if("first").over(mine)
    ranked = rows.select("cid", "tok", "first", rank.alias("rank"), alone.alias("alone"), prefix.alias("prefix"))
    prefixes = written_at(ranked.where(~F.col("first") | (F.col("alone") + F.col("rank") <= F.col("prefix")))
                          .select("cid", "tok"), "prefixes")
    for done in (path, known.path):
        discard(spark, done)
    return prefixes


def similarity_join(docs: DataFrame, percent: int = 90, words: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` per document.

    Two documents link when ``100 * intersection >= percent * union`` of their
    shingle sets; ``component_id`` is the smallest id reachable by links, the
    own one included; ``n_links`` counts the documents linked directly.

    Texts that are null, empty or without words have the empty set and link
    with nothing.  Null ids are never a component's id unless all its ids are
    null; repeated rows link as copies do; texts of any length are read whole;
    an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    summaries, path = written_at(rows.mapInArrow(_summaries(percent, words), "id long, n int, key binary, marks binary"), "summaries")
    classes = (summaries.where("n > 0").groupBy("key")
               .agg(F.first("n").alias("n"), F.first("marks").alias("marks"), F.count("*").alias("copies"), F.min("id").alias("id"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes, marked = written_at(classes, "classes")
    sets = written(summaries.select("id", "n", "key"), "sets")
    discard(rows.sparkSession, path)
    # Equal marks meet by bucket; the least class of a mark connects its classes.
    alike = (classes.select("cid", "marks").mapInArrow(_dealt, "bucket int, base long, marks binary, owners binary")
             .groupBy("bucket").applyInPandas(_meet, "a long, b long"))
    groups = components(alike)
    classes = written(classes.drop("marks"), "class-ids")
    discard(rows.sparkSession, marked)
    near = written(groups.select(F.col("node").alias("cid"), F.col("component").alias("group")).join(classes, "cid"), "near")
    wanted = id_filter(near.select("id").distinct())
    full = rows.select(F.xxhash64("id"), "text").mapInArrow(_full_sets(words, wanted), "key binary, set binary")
    filled, filled_path = written_at(near.select("cid", "key").join(full, "key").dropDuplicates(["key"]).select("cid", "set"), "filled")
    listed, listed_path = written_at(filled.mapInArrow(_listed(percent), "cid long, n int, region int, listed array<long>"), "listed")
    prefixes, prefix_path = _prefixes(listed, percent)
    shared, shared_path = written_at(prefixes.join(near.select("cid", "group"), "cid"), "shared-prefixes")
    for done in (listed_path, prefix_path):
        discard(rows.sparkSession, done)
    # A star per prefix shingle that classes of a group share connects these.
    stars = shared.groupBy("group", "tok").agg(F.min("cid").alias("b"), F.count("*").alias("c")).where("c > 1")
    blocks = components(shared.join(stars, ["group", "tok"]).select(F.col("cid").alias("a"), "b"))
    blocks = blocks.select(F.col("node").alias("cid"), F.col("component").alias("block"))
    held = blocks.groupBy("block").agg(F.count("*").alias("held"))
    band = F.floor(F.log(F.col("n")) / -math.log(percent / 100 - 0.01)).cast("int")
    members = blocks.join(held, "block").join(near.select("cid", "n", "copies"), "cid").withColumn("band", band)
    members = written(members, "members")
    links = _linked(filled, members, shared.select("cid", "tok"), percent)
    for done in (filled_path, shared_path):
        discard(rows.sparkSession, done)
    joined = components(links.where("a <> b").select("a", "b")).select(F.col("node").alias("cid"), "component")
    reached = classes.select("cid", "id").join(joined, "cid")
    least = reached.groupBy("component").agg(F.min("id").alias("component_id"))
    counted = links.where("a = b").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    # All members of a component look its id up: the rows of one are dealt into shares.
    shares = least.select("component", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("share"))
    share = F.pmod(F.xxhash64("cid"), F.lit(SALTS)).cast("int")
    joined = joined.withColumn("share", share).join(shares, ["component", "share"]).select("cid", "component_id")
    known = (classes.select("cid", "key", "copies", "id").join(joined, "cid", "left")
             .join(counted, "cid", "left")
             .select("key", F.coalesce("component_id", "id").alias("component_id"),
                     (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    return (sets.select("id", "n", "key").join(known, "key", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))


def _linked(filled: DataFrame, members: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Spanning links (``a <> b``) and numbers of links (``a = b``) of classes."""
    key = ["block", "band", "step", "unit", "unit2"]
    columns = [*key, "cid", "copies", "part", "side"]
    # Small blocks are parts of a task of about UNIT sets.
    small = members.where(F.col("held") <= UNIT)
    tasks = max(1, -(-small.count() // UNIT))
    whole = (small.withColumn("part", F.col("block")).withColumn("block", F.pmod(F.xxhash64("block"), F.lit(tasks)).cast("long"))
             .withColumns({"band": F.lit(-1), "step": F.lit(0), "unit": F.lit(0), "unit2": F.lit(0), "side": F.lit(0)}).select(*columns))
    large = members.where(F.col("held") > UNIT)
    # Classes of one unit have the same rarest prefix shingle as far as it goes,
    # so that a unit shares shingles with few other units.
    own = prefixes.join(large.select("cid", "block", "band"), "cid")
    shared = own.groupBy("block", "tok").agg(F.count("*").alias("c")).where("c > 1")
    common = written(own.join(shared, ["block", "tok"]), "common")
    homes = common.groupBy("cid").agg(F.min(F.struct("c", "tok")).alias("home"))
    held = large.groupBy("block", "band").agg(F.ceil(F.count("*") / UNIT).cast("int").alias("parts"))
    crowd = F.ceil(F.col("home.c") / UNIT)
    unit = F.pmod(F.xxhash64("home.tok", F.pmod(F.xxhash64("cid"), crowd)), F.col("parts")).cast("int")
    placed = written(large.select("cid", "block", "band", "copies").join(held, ["block", "band"])
                     .join(homes, "cid").withColumn("unit", unit).drop("parts", "home"), "placed")
    # Two units meet if a class of one shares a prefix shingle with a class of the other.
    units = common.join(placed.select("cid", "unit"), "cid").groupBy("tok", "block", "band", "unit").agg(F.count("*").alias("n"))
    pairs = written(_unit_pairs(written(units, "shingle-units"), placed), "unit-pairs")
    placed = placed.withColumn("part", F.col("block"))
    left = placed.join(pairs, ["block", "band", "unit"]).withColumn("side", F.lit(0)).select(*columns)
    right = (placed.select("block", F.col("band").alias("band2"), F.col("unit").alias("unit2"), "cid", "copies", "part")
             .join(pairs.where("step = 1 or unit <> unit2"), ["block", "band2", "unit2"])
             .withColumn("side", F.lit(1)).select(*columns))
    # The sets join the short rows that say where they are needed, once.
    needed = written(whole.unionByName(left).unionByName(right), "tasks")
    return written(needed.join(filled, "cid").groupBy(*key).applyInPandas(_join_units(percent), LINKS), "links")


def _unit_pairs(units: DataFrame, placed: DataFrame) -> DataFrame:
    """``block, band, step, band2, unit, unit2`` of the units that meet.  A
    length band of one unit (all but large ones) needs no look at shingles:
    only pairs within large bands are told by them, in the order of units, so
    that a shingle of many units is a few rows per unit pair at most once."""
    bands = placed.groupBy("block", "band").agg((F.max("unit") + 1).alias("n_units"), F.count("*").alias("size"))
    next_ = bands.select("block", F.col("band").alias("band2"), F.col("n_units").alias("n_units2"))
    single = bands.where("n_units = 1")
    within = single.where("size > 1").select("block", "band", F.lit(0).alias("step"), F.col("band").alias("band2"),
                                             F.lit(0).alias("unit"), F.lit(0).alias("unit2"))
    across = (single.withColumn("band2", F.col("band") + 1).join(next_.where("n_units2 = 1"), ["block", "band2"])
              .select("block", "band", F.lit(1).alias("step"), "band2", F.lit(0).alias("unit"), F.lit(0).alias("unit2")))
    # The rest: units that share a shingle.
    large = bands.where("n_units > 1").select("block", F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)).alias("band")).distinct()
    some = units.join(large, ["block", "band"], "left_semi").select("tok", "block", "band", "unit")
    other = some.select("tok", "block", F.col("band").alias("band2"), F.col("unit").alias("unit2"))
    told = (some.join(other, ["tok", "block"]).where("band2 = band + 1 or (band2 = band and unit <= unit2)")
            .select("block", "band", (F.col("band2") - F.col("band")).alias("step"), "band2", "unit", "unit2").distinct())
    told = told.join(single.select("block", "band", F.lit(True).alias("one")), ["block", "band"], "left").join(
        single.select("block", F.col("band").alias("band2"), F.lit(True).alias("one2")), ["block", "band2"], "left")
    told = told.where("not (coalesce(one, false) and coalesce(one2, false))")
    columns = ["block", "band", "step", "band2", "unit", "unit2"]
    return within.union(across).union(told.select(*columns))


def one_per_group(docs: DataFrame, percent: int = 90, words: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without all but one of each component: the one
    with the smallest id stays (null last; of repeated ids one row)."""
    found = written(similarity_join(docs, percent, words, id_col, text_col), "found")
    if found.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1").isEmpty():
        lost = found.where("doc_id <> component_id").select("doc_id")
        return rows_without(docs, id_col, lost)
    # Ids that are null or repeat do not name a row: number the rows and decide by number.
    rows = written(docs.select(F.monotonically_increasing_id().alias("uid"), F.struct("*").alias("row")), "rows")
    flat = rows.select("uid", F.col(f"row.`{text_col}`").alias("text"))
    found = similarity_join(flat, percent, words, "uid", "text").select(F.col("doc_id").alias("uid"), "component_id")
    order = rows.select("uid", F.struct(F.col(f"row.`{id_col}`").isNull().alias("null"),
                                        F.col(f"row.`{id_col}`").alias("id"), "uid").alias("order"))
    found = written(found.join(order, "uid"), "found")
    stays = found.groupBy("component_id").agg(F.min("order").alias("stays"))
    lost = found.join(stays, "component_id").where("uid <> stays.uid").select("uid")
    return rows_without(rows, "uid", lost).select("row.*")
