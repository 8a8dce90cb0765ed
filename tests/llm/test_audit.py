"""The filter audit against a document-by-document simulation of all orders."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from llm_data import empty, rows  # noqa: F401

from riskloom.llm import filter_audit as fa


def test_ranks_are_lexicographic():
    assert [fa.lehmer_rank("".join(p)) for p in permutations("ABCDE")] == list(range(120))


def test_intervals_cover_each_order_once():
    for mask in range(1, 32):
        rows = [r for r in fa.removal_intervals() if r[0] == mask]
        ranks = [k for *_, first, behind in rows for k in range(first, behind)]
        assert sorted(ranks) == list(range(120))
        for _, step, letter, first, behind in rows:
            for k in range(first, behind):
                order = "".join(list(permutations("ABCDE"))[k])
                assert order[step - 1] == letter


def brute(rows, labels):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = defaultdict(list)
    for i, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = ""
        f += "A" * (len(w) < 50) + "B" * (100 * len(set(w)) < 65 * len(w))
        f += "C" * (100 * len(re.findall("[A-Z]", t)) > 5 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        f += "E" * (i is not None and i > least[t])
        parts[s or ""].append((f, i in good, i in toxic))
    out = []
    for part, docs in parts.items():
        shapley = Counter()
        steps = []
        for order in permutations("ABCDE"):
            alive = docs
            for k, c in enumerate(order):
                gone = [d for d in alive if c in d[0]]
                alive = [d for d in alive if c not in d[0]]
                shapley[c] += len(gone)
                steps.append((part, "".join(order), k + 1, len(alive), len(gone),
                              sum(c in d[0] for d in docs) - len(gone), sum(d[0] == c for d in docs),
                              sum(d[1] for d in gone), sum(d[2] for d in gone), c))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return Counter(out)


def test_audit(spark, rows):
    long = " ".join(f"word{k}" for k in range(60))
    data = [(i, t, ["s1", "s2", None, ""][k % 4]) for k, (i, t) in enumerate(rows)]
    data += [(900_000 + k, text, "s3") for k, text in enumerate(
        [long, long, long + " #", long.upper(), long + " word1" * 80, "A  b", "a b", " \v\f ", "é É"])]
    data += [(5, long, "s1"), (None, long, "s1"), (None, None, "s4"), (900_000, long, "s4")]
    labels = [(k, k % 2, k % 3) for k in range(0, 500, 2)] + [(900_001, 1, 1), (900_001, 0, 0), (900_003, None, 1), (None, 1, 1)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in data],
                               "doc_id long, text string, source string, mask int, digest string, n int").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = fa.filter_audit(df, marks)
    got, want = Counter(tuple(r) for r in got.collect()), brute(data, labels)
    assert got == want, (sorted((got - want).items())[:2], sorted((want - got).items())[:2])


def test_all_copies(spark):
    data = [(k, "same text", "s") for k in range(50)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Counter(tuple(r) for r in fa.filter_audit(df, labels).collect()) == brute(data, [])


@pytest.mark.parametrize("n", [0])
def test_empty(spark, empty, n):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.filter_audit(empty, labels).count() == n
