"""b-bit MinHash near-duplicate removal against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from llm_data import SF_CHECK, docs, empty, rows  # noqa: F401
from test_search_and_groups import brute_join, near_copies

from riskloom.llm import membership, minhash_dedup as mh
from riskloom.llm.queries import QUERIES


def brute(rows, percent=80, n=4):
    return Counter({(i, size, least, i == least): c for (i, size, least, _), c in _folded(brute_join(rows, percent, n)).items()})


def _folded(counter):
    out = Counter()
    for (i, size, least, _), c in counter.items():
        out[(i, size, i if size == 0 else least, 0)] += c
    return out


def test_estimates_are_corrected():
    rng = np.random.default_rng(1)
    errors = []
    for s in (0.2, 0.5, 0.8, 0.95):
        for _ in range(40):
            shared = rng.integers(0, 2**64, size=int(600 * s), dtype=np.uint64)
            rest = rng.integers(0, 2**64, size=600 - len(shared), dtype=np.uint64)
            half = len(rest) // 2
            m = np.stack([mh.minima(np.concatenate((shared, x))) for x in (rest[:half], rest[half:])])
            a, b = mh.signatures(m)
            errors.append(mh.estimate(mh.agreeing(a, b[None])[0]) - len(shared) / 600)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_bits_are_counted_alike(spark):
    rng = np.random.default_rng(2)
    a, b = (mh.signatures(rng.integers(0, 2**32, size=(50, mh.HASHES), dtype=np.uint32)) for _ in range(2))
    b[:, :5] = a[:, :5]
    df = spark.createDataFrame([(x.tolist(), y.tolist()) for x, y in zip(a, b)], "x array<long>, y array<long>")
    got = [r[0] for r in df.select(mh.agreeing_columns("x", "y")).collect()]
    assert got == [int(mh.agreeing(x, y[None])[0]) for x, y in zip(a, b)]


def chains_and_passages():
    """Chains of near copies, a passage that most documents share, and groups whose first class links with few."""
    rng, out = random.Random(8), near_copies()
    words = [f"t{rng.randint(0, 5000)}" for _ in range(200)]
    for k in range(60):
        words[rng.randrange(200)] = f"new{k}"
        words[rng.randrange(200)] = f"newer{k}"
        out.append((5000 + k, " ".join(words)))
    passage = " ".join(f"terms{k}" for k in range(150))
    for k in range(80):  # 0.75 to 0.85 alike
        out.append((7000 + k, passage + " " + " ".join(f"z{k}x{j}" for j in range(rng.randint(10, 24)))))
    return out


@pytest.mark.parametrize("chunk, unit", [(4096, 512), (7, 5)])
def test_near_duplicates(spark, monkeypatch, chunk, unit):
    monkeypatch.setattr(mh, "CHUNK", chunk)
    monkeypatch.setattr(mh, "UNIT", unit)
    data = chains_and_passages()
    df = spark.createDataFrame([(*r, 1, b"k", 2, 3) for r in data],
                               "doc_id long, text string, cid long, `key` binary, h int, label long").repartition(5)
    got = Counter(tuple(r) for r in mh.near_duplicates(df).collect())
    assert got == brute(data)


def test_strange_rows(spark, docs, rows):
    assert Counter(tuple(r) for r in mh.near_duplicates(docs).collect()) == brute(rows)


def test_empty(spark, empty):
    assert mh.near_duplicates(empty).count() == 0


def test_query_on_the_given_table(spark):
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in QUERIES["op12_minhash"](spark, SF_CHECK).collect())
    assert got == brute(data)


@pytest.mark.parametrize("most", [1 << 29, 1 << 6])
def test_id_filter(spark, monkeypatch, most):
    """Beyond its bound the filter lets more through, and results stay right."""
    monkeypatch.setattr(membership, "MOST_BITS", most)
    df = spark.createDataFrame([(k, f"t{k}") for k in range(3000)] + [(None, "n")], "doc_id long, text string")
    lost = df.where("doc_id % 3 = 0").select("doc_id")
    kept = membership.rows_without(df, "doc_id", lost)
    assert sorted(r.text for r in kept.collect()) == sorted(["n"] + [f"t{k}" for k in range(3000) if k % 3])
    maybe = membership.id_filter(lost).maybe
    assert df.where("doc_id % 3 = 0").where(maybe(df.doc_id)).count() == 1000
    if most > 1 << 20:
        assert df.where("doc_id % 3 > 0").where(maybe(df.doc_id)).count() < 60
