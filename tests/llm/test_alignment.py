"""Cross-tokenizer alignment against the two libraries, text by text."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from llm_data import docs, empty, real_texts, rows, strange_texts  # noqa: F401
from tokenizers import Tokenizer

from riskloom.llm import alignment as al
from riskloom.llm.queries import QUERIES
from riskloom.llm.segments import byte_alphabet

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def test_galloping_finds_what_lists_share():
    rng = random.Random(5)
    for _ in range(400):
        a, b = (sorted(rng.sample(range(60), rng.randint(0, 40))) for _ in range(2))
        assert al.common_ends(a, b) == [(a.index(x), b.index(x)) for x in sorted(set(a) & set(b))]


def test_galloping_through_many_lists_at_once():
    rng = random.Random(6)
    lists = [(sorted(rng.sample(range(90), rng.randint(0, 30))), sorted(rng.sample(range(90), rng.randint(0, 60))))
             for _ in range(200)]
    a = np.array([k * 100 + x for k, (p, _) in enumerate(lists) for x in p], dtype=np.int64)
    b = np.array([k * 100 + x for k, (_, q) in enumerate(lists) for x in q], dtype=np.int64)
    sizes = np.array([len(q) for _, q in lists])
    behind = np.cumsum(sizes)
    per = np.repeat(np.arange(200), [len(p) for p, _ in lists])
    got = al.galloping_many(a, b, (behind - sizes)[per], behind[per])
    where = {x: k for k, x in enumerate(b.tolist())}
    assert got.tolist() == [where.get(x, -1) for x in a.tolist()]


def test_overlap_ranges():
    assert al.overlap_ranges([2, 5, 6, 9], [1, 6, 9]) == [(0, 0), (0, 2), (3, 3)]


class Brute:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        self.back = {chr(c): x for x, c in byte_alphabet().items()}

    def b_bytes(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return None
        a = self.a.encode(" " + text, add_special_tokens=False)
        b = self.b.encode(text)
        spelled = [bytes(self.back[c] for c in t) for t in a.tokens], [self.b_bytes(i) for i in b]
        if any(b"".join(s) != (" " + text).encode() for s in spelled):
            return None
        ends = [[sum(map(len, s[:k + 1])) for k in range(len(s))] if len(s) < 400 else None for s in spelled]
        for k, s in enumerate(spelled):
            if ends[k] is None:
                total, ends[k] = 0, []
                for x in s:
                    total += len(x)
                    ends[k].append(total)
        return a.ids, b, *ends


def brute_report(rows):
    brute, counts, kept = Brute(), Counter(), []
    for i, text in rows:
        t = brute.tokens(text)
        if t is None:
            kept.append((i, 0, 0, [], []))
            continue
        a, b, ea, eb = t
        common = sorted(set(ea) & set(eb))
        at_a, at_b = {e: k for k, e in enumerate(ea)}, {e: k for k, e in enumerate(eb)}
        links = [(a[at_a[e]], b[at_b[e]]) for e in common]
        counts.update(links)
        groups, i0, j0 = [], 0, 0
        for e in common:
            groups.append(",".join(map(str, a[i0:at_a[e] + 1])) + "|" + ",".join(map(str, b[j0:at_b[e] + 1])))
            i0, j0 = at_a[e] + 1, at_b[e] + 1
        kept.append((i, len(a), len(b), groups, links))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return Counter((i, na, nb, len(g), len(k), sum(counts[x] == best[x[1]] for x in k), sum(counts[x] for x in k),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, na, nb, g, k in kept)


def test_report_equals_the_libraries(docs, rows):
    got = al.alignment_report(docs, A, B).collect()
    want = brute_report(rows)
    assert Counter(tuple(r)[:8] for r in got) == want
    assert sum(n for k, n in want.items() if k[1] == 0) >= 3
    assert all(r.n_overlaps == r.n_a + r.n_b - r.n_groups for r in got)


def test_strange_texts_in_one_process():
    texts = strange_texts(3, 2500) + ["a\tb\t c", "x\r\ny", "tab\t", "\ta", "a\n\tb", "<unk><0x0A>", "a▁b", "\n", "\r", " \n a"]
    aligner = al.Aligner(A, B)
    aligner.segments.limit = 60
    brute = Brute()
    for text, (groups, links, n_a, n_b) in zip(texts, aligner.texts(iter(texts))):
        t = brute.tokens(text)
        assert (n_a, n_b) == ((0, 0) if t is None else (len(t[0]), len(t[1]))), repr(text)
        assert len(links) // 4 == (groups.count(";") + 1 if groups else 0) == (0 if t is None else len(set(t[2]) & set(t[3])))


def test_pairs_have_a_bound():
    v = al.Vocabularies(A, B)
    assert len(v.pairs) <= sum(map(len, v.a)) + 2 * sum(map(len, v.b))
    assert all(v.a[i].endswith(v.b[j]) or v.b[j].endswith(v.a[i]) for i, j in list(zip(v.pairs.a, v.pairs.b))[::101])


def test_empty(spark, empty):
    assert al.alignment_report(empty, A, B).count() == 0


def test_query_on_the_given_table(spark):
    from llm_data import SF_SMALL
    got = QUERIES["op11_alignment"](spark, SF_SMALL).collect()
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert Counter(tuple(r)[:8] for r in got) == brute_report(data)


@pytest.mark.parametrize("texts", [["", None]])
def test_only_empty_texts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {tuple(r) for r in al.alignment_report(df, A, B).collect()} == {(k, 0, 0, 0, 0, 0, 0, "", 0) for k in range(2)}
