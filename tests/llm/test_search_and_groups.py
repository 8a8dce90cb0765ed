"""Top-k search, sharding, duplicates and similarity joins against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import same_result
from llm_data import SF_SMALL, docs, empty, rows  # noqa: F401

from riskloom.llm import exact_dedup, membership, ngram_join, sharding, topk
from riskloom.llm.common import loaded_once, only_for, written_at
from riskloom.llm.graph import components
from riskloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_duckdb(spark, duck_small, name):
    same_result(QUERIES[name](spark, SF_SMALL), duck_small, ORACLES[name])


def brute_top_k(rows, k):
    whole = [(i, [int(np.floor(np.float64(256) * np.float64(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in whole:
        if q % 5:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return Counter(out)


@pytest.mark.parametrize("scales", [(1.0,), (0.01, 1.0, 30.0), (0.0,)])
def test_top_k(spark, scales):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6) * scales[i % len(scales)]]) for i in range(180)]
    rows += [(i + 500, rows[i][1]) for i in range(40)]  # ties
    rows += [(900, None), (905, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (910, [float("nan")] * 6), (915, [float("inf")] * 6),
             (920, []), (925, []), (930, [1.0, 2.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<double>, id string, norm double")
    got = topk.top_k(df, df.where("vec_id % 5 = 0"), k=4, block_rows=37, block_queries=11).collect()
    assert Counter(tuple(r) for r in got) == brute_top_k(rows, 4)


def test_pruning_rules_out_most_of_the_given_table(spark):
    """With the thresholds of the given vectors, whose lengths are nearly
    equal, coordinates leave less than half of the rows, and every result."""
    got = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = np.floor(256 * np.array([r.embedding for r in got], dtype=np.float64))
    block, shares = topk.Block(np.arange(len(rows)), rows), []
    for q in range(0, len(rows), 10):
        scores = block.rows @ rows[q]
        least = np.sort(scores[block.ids != q])[-5]
        kept = block.candidates(rows[q], least)
        assert set(np.flatnonzero(scores >= least)) <= set(kept.tolist())
        shares.append(len(kept) / len(rows))
    assert np.mean(shares) < 0.3


def test_top_k_of_an_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert topk.top_k(none, none).count() == 0


def test_top_k_large_products(spark):
    df = spark.createDataFrame([(0, [1e6, 1e6]), (5, [2e6, 3e6]), (10, [1e30, 1.0])], "vec_id long, embedding array<double>")
    two = df.where("vec_id < 10")
    assert [r.score for r in topk.top_k(two, two).collect()] == [256 * 256 * 5 * 10**12] * 2
    wide = spark.createDataFrame([(0, [1e21, 0.0]), (5, [1 / 256, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(wide, wide).collect()
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(df, df).collect()


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 10863919174838991] + [random.Random(k).getrandbits(64) - 2**63 for k in range(200)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 16, 100):
        got = df.select("k", *sharding.jump_hash(df.k, n)).collect()
        assert [tuple(r) for r in got] == [(k, jump(k % 2**64, n), jump(k % 2**64, n + 1)) for k in keys]


def test_shards(docs, rows, empty):
    got = sharding.shard_documents(docs).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 16)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert len({(r.doc_id, r.shard) for r in got}) == len({r.doc_id for r in got})
    assert sharding.shard_documents(empty).count() == 0


def brute_dedup(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = Counter()
    for content, ids in groups.items():
        ids.sort(key=lambda x: (x is None, x or 0))
        for n, i in enumerate(ids):
            out[(i, ids[0], len(ids), n == 0, hashlib.sha256(content.encode()).hexdigest())] += 1
    return out


def many_copies(rows):
    return rows + [(10_000 + k, ["same  text", "same\ttext", "same text "][k % 3]) for k in range(400)]


@pytest.mark.parametrize("local_bytes", [1 << 26, 50])
def test_exact_dedup(spark, rows, local_bytes, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LOCAL_BYTES", local_bytes)
    data = many_copies(rows)
    df = spark.createDataFrame([(*r, 1, "d") for r in data], "doc_id long, text string, mine long, digest string").repartition(9)
    got = Counter(tuple(r) for r in exact_dedup.exact_dedup(df).collect())
    assert got == brute_dedup(data)
    kept = exact_dedup.without_copies(df)
    assert kept.columns == df.columns
    firsts = Counter(k[0] for k, n in brute_dedup(data).items() for _ in range(n) if k[3])
    assert Counter(r.doc_id for r in kept.collect()) == firsts


def test_copies_without_end_are_not_held(monkeypatch):
    """Rows of one text leave as soon as their bytes reach the bound."""
    import pyarrow as pa
    monkeypatch.setattr(exact_dedup, "LOCAL_BYTES", 1 << 20)
    monkeypatch.setattr(exact_dedup, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": staticmethod(lambda: 0)})())}))
    rest = pa.struct([("none", pa.int32())])
    out = pa.schema([("id", pa.int64()), ("text", pa.string()), ("rest", rest), ("mine", pa.int64()), ("local", pa.int64()),
                     ("local_id", pa.int64()), ("local_n", pa.int64()), ("digest", pa.string())])
    taken = 0

    def batches():
        nonlocal taken
        for k in range(200):
            taken += 1
            yield pa.RecordBatch.from_arrays([pa.array(range(k * 500, k * 500 + 500)), pa.array(["copy " * 200] * 500),
                                              pa.array([{"none": 0}] * 500, rest)], names=["id", "text", "rest"])

    rows = exact_dedup._local(out, exact_dedup.sha256)(batches())
    next(rows)
    assert taken < 12
    n = 500 + sum(b.num_rows for b in rows)
    assert n == 200 * 500 and taken == 200


def test_exact_dedup_of_an_empty_table(empty):
    assert exact_dedup.exact_dedup(empty).count() == 0
    kept = exact_dedup.without_copies(empty)
    assert kept.count() == 0 and kept.columns == empty.columns


def test_more_salts_than_the_least(spark, rows, monkeypatch):
    monkeypatch.setattr(exact_dedup, "PER_SALT", 1)
    monkeypatch.setattr(exact_dedup, "SALTS", 2)
    data = many_copies(rows)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(9)
    assert Counter(tuple(r) for r in exact_dedup.exact_dedup(df).collect()) == brute_dedup(data)


def test_contents_that_share_a_digest_stay_apart(spark, rows):
    data = many_copies(rows)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(9)
    got = exact_dedup.exact_dedup(df, digest=lambda content: str(len(content) % 3)).collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter({k[:4]: 0 for k in brute_dedup(data)}) + Counter(
        k[:4] for k, n in brute_dedup(data).items() for _ in range(n))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.component for r in got} == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies():
    rng, rows = random.Random(4), []
    for size in (4, 20, 70, 300):
        base = [f"w{rng.randint(0, 400)}" for _ in range(size)]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randint(0, max(1, size // 40))):
                words[rng.randrange(size)] = f"X{rng.randint(0, 3)}"
            rows.append((len(rows), " ".join(words)))
    shared = " ".join(f"licence{k}" for k in range(60))  # a passage that many documents share
    rows += [(1000 + k, shared + " " + " ".join(f"own{k}x{j}" for j in range(30))) for k in range(40)]
    rows += [(2000, None), (2001, ""), (2002, "A b"), (2003, "a\nB"), (2004, " \t"), (2005, "a b c"), (2006, "A  b c"),
             (None, "a b c"), (None, "lonely words without any id"), (2005, "a b c"), (2005, "other text of that id")]
    return rows


def brute_join(rows, percent, n):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(set(zip(*(w[k:] for k in range(n)))) if len(w) >= n else {tuple(w)} if w else set())
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            if sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return Counter((rows[a][0], len(sets[a]), least.get(find(a)), links[a]) for a in range(len(rows)))


@pytest.mark.parametrize("percent, words, unit", [(90, 3, 512), (80, 5, 7)])
def test_similarity_join(spark, percent, words, unit, monkeypatch):
    monkeypatch.setattr(ngram_join, "UNIT", unit)
    rows = near_copies()
    df = spark.createDataFrame([(*r, 1, b"k", 2) for r in rows], "doc_id long, text string, cid long, `key` binary, n int")
    got = ngram_join.similarity_join(df.repartition(5), percent, words)
    assert Counter(tuple(r) for r in got.collect()) == brute_join(rows, percent, words)


@pytest.mark.parametrize("percent", [90, 80, 55])
def test_sets_that_link_have_a_mark_in_common(percent):
    rng = np.random.default_rng(percent)
    linked = 0
    for size in [*range(1, 40), *rng.integers(40, 900, size=400).tolist()]:
        s = np.unique(rng.integers(0, 1 << 64, size=size, dtype=np.uint64))
        fewer, more = size * (100 - percent) // 100, size * (100 - percent) // percent
        for lost, new in ((fewer, 0), (0, more), (fewer // 2, more // 2), (1, 1)):
            t = np.unique(np.concatenate((rng.permutation(s)[lost:], rng.integers(0, 1 << 64, size=new, dtype=np.uint64))))
            k = len(np.intersect1d(s, t))
            if len(t) and k < len(s) + len(t) - k and 100 * k >= percent * (len(s) + len(t) - k):
                linked += 1
                assert len(np.intersect1d(ngram_join.part_marks(s, percent), ngram_join.part_marks(t, percent)))
    assert linked > 1000


def test_shingles_shared_by_chance_move_no_sets(spark, monkeypatch):
    rows, moved = {}, []
    rng = random.Random(9)
    for k in range(300):
        rows[k] = rng.choices("abcdefghijkl", k=150)
    for k in range(0, 300, 30):
        rows[300 + k] = [*rows[k][:-1], "z"]
    rows = [(k, " ".join(words)) for k, words in rows.items()]

    def kept(df, label):
        out = written_at(df, label)
        moved.extend([out[0].count()] if label == "filled" else [])
        return out

    monkeypatch.setattr(ngram_join, "written_at", kept)
    got = ngram_join.similarity_join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == brute_join(rows, 90, 3)
    assert moved == [20]  # sets of the near copies alone


def test_one_per_group(spark, empty):
    rows = near_copies()
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, uid long")
    kept = ngram_join.one_per_group(df)
    assert kept.columns == df.columns
    # One row per component; rows without shingles are groups of their own.
    parts, alone = set(), 0
    for (i, n, c, _), times in brute_join(rows, 90, 3).items():
        if n and c is not None:
            parts.add(c)
        else:
            alone += times
    ids = [r.doc_id for r in kept.collect()]
    # id 2005 names two components: its own text and the copies of "a b c".
    assert len(ids) == len(parts) + alone + 1
    plain = [r for r in {i: (i, t) for i, t in rows}.values() if r[0] is not None]  # ids that name rows
    some = ngram_join.one_per_group(spark.createDataFrame([(*r, 5) for r in plain], "doc_id long, text string, lost long"))
    assert some.columns == ["doc_id", "text", "lost"]
    assert {r.doc_id for r in some.collect()} == {k[2] for k in brute_join(plain, 90, 3)}
    assert ngram_join.similarity_join(empty).count() == 0
    assert ngram_join.one_per_group(empty).count() == 0


@pytest.mark.parametrize("tested, most", [(1000, 1 << 29), (7, 1 << 29), (7, 1 << 6)])
def test_shingles_of_one_class_stop_where_they_are_read(spark, tested, most, monkeypatch):
    monkeypatch.setattr(ngram_join, "TESTED", tested)
    monkeypatch.setattr(membership, "MOST_BITS", most)  # a full filter stops nothing, the join the rest
    rng = random.Random(2)
    common = [rng.getrandbits(63) - (1 << 62) for _ in range(30)]
    data, limit = [], ngram_join.region_limit(80)
    for cid in range(60):
        listed = sorted({rng.getrandbits(63) - (1 << 62) for _ in range(50)} | set(rng.sample(common, cid % 4)))
        data.append((cid, len(listed) * 3, sum(t & 0xFFFF < limit for t in listed), listed))
    data.append((60, 1, 0, []))
    classes = spark.createDataFrame(data, "cid long, n int, region int, listed array<long>").repartition(4)
    df = Counter(t for *_, listed in data for t in listed)
    shared = spark.createDataFrame([(t,) for t in df if df[t] > 1], "tok long")
    known = membership.id_filter(shared, hashed=True)
    some = {r.cid: (r.n, r.region, r.listed) for r in classes.mapInArrow(
        ngram_join._perhaps_shared(known), classes.schema).collect()}
    assert {cid: r[:2] for cid, r in some.items()} == {cid: (n, region) for cid, n, region, _ in data}
    assert all({t for t in listed if df[t] > 1} <= set(some[cid][2]) <= set(listed) for cid, _, _, listed in data)
    if most > 1 << 20:
        assert sum(df[t] == 1 for *_, listed in some.values() for t in listed) < 60
    want = set()
    for cid, n, region, listed in data:
        first = sorted((df[t], t) for t in listed if t & 0xFFFF < limit and df[t] > 1)
        alone = region - len(first)
        want |= {(cid, t) for k, (_, t) in enumerate(first, 1) if alone + k <= n - -(-n * 80 // 100) + 1}
        want |= {(cid, t) for t in listed if t & 0xFFFF >= limit and df[t] > 1}
    assert Counter(map(tuple, ngram_join._prefixes(classes, 80)[0].collect())) == Counter(want)


def test_earlier_work_leaves_a_worker():
    only_for("first")
    kept = loaded_once(Counter)
    only_for("first")
    assert loaded_once(Counter) is kept
    only_for("second")
    assert loaded_once(Counter) is not kept


def test_tree_finds_what_it_stores():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, size=rng.integers(1, 50))) for _ in range(80)]
    sizes = np.array([len(s) for s in sets])
    tree = ngram_join.Tree(sets, sizes)
    mark = np.zeros(61, dtype=np.int8)
    for x in sets:
        found = {tree.order[j] for j in tree.search(x, len(x), mark, 70)}
        want = {k for k, y in enumerate(sets) if 100 * len(np.intersect1d(x, y)) >= 70 * len(np.union1d(x, y))}
        assert found == want
