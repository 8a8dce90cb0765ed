"""Token operators against their libraries: counts, files, packing, codec."""

import json
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from llm_data import SF_SMALL as SF
from llm_data import crc, docs, empty, real_texts, rows, strange_texts, u32  # noqa: F401
from tokenizers import Tokenizer

from riskloom.llm import packing, sentencepiece_codec, token_counts, token_files
from riskloom.llm.segments import ByteLevel, NotSegmentable, WordLevel, prove_whole_pieces
from riskloom.session import scratch_path

PIECES = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.mark.parametrize("kind, name", [(ByteLevel, "byte_bpe_50k.json"), (WordLevel, "word_bpe_49k.json")])
def test_segmented_ids_equal_the_librarys(kind, name):
    lib, mine = Tokenizer.from_file(P.path(name)), kind(P.path(name))
    mine.words.limit = 50  # the cache turns over again and again
    texts = strange_texts(1, 1500) + real_texts()
    for text, ids in zip(texts, mine.encode(iter(texts))):
        assert ids == u32(lib.encode(text, add_special_tokens=False).ids), text[:80]
    assert len(mine.words.young) <= 50 + 64_000  # one batch of words beyond the limit at most


@pytest.mark.parametrize("kind, name", [(ByteLevel, "byte_bpe_50k.json"), (WordLevel, "word_bpe_49k.json")])
@pytest.mark.parametrize("change", ["dropout", "ignore_merges", "unk", "added", "normalizer", "prefix", "suffix", "pattern"])
def test_other_files_go_through_the_library_whole(tmp_path, kind, name, change):
    file = json.loads(Path(P.path(name)).read_text())
    steps = file["pre_tokenizer"].get("pretokenizers", [file["pre_tokenizer"]])
    if change == "dropout":
        file["model"]["dropout"] = 1e-9
    elif change == "ignore_merges":
        file["model"]["ignore_merges"] = True
    elif change == "unk":
        file["model"]["unk_token"] = "a"
    elif change == "added":
        file["added_tokens"].append(file["added_tokens"][0] | {"id": max(file["model"]["vocab"].values()) + 5, "content": "the cat"})
    elif change == "normalizer":
        file["normalizer"] = {"type": "NFKC"}
    elif change == "prefix":
        steps[-1]["add_prefix_space"] = True
    elif change == "suffix":
        file["model"]["end_of_word_suffix"] = None if kind is WordLevel else "</w>"
    elif kind is WordLevel:
        steps[0]["pattern"] = {"Regex": r"\p{L}+|[^\s\p{L}]+"}
    else:
        steps[-1]["use_regex"] = False
    (tmp_path / "t.json").write_text(json.dumps(file))
    mine = kind(str(tmp_path / "t.json"))
    assert not mine.cuts
    texts = real_texts()[:20] + strange_texts(4, 50)
    lib = Tokenizer.from_file(str(tmp_path / "t.json"))
    assert [*mine.encode(iter(texts))] == [u32(lib.encode(t, add_special_tokens=False).ids) for t in texts]


def test_one_repeated_row_spreads_over_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FRAMES_PER_FILE", 2000)
    df = spark.createDataFrame([(7, "the same text again and again " * 3)] * 600, "doc_id long, text string").repartition(6)
    folder = scratch_path(spark, "test-tokens-hot")
    files = token_files.write_token_files(df, P.path("byte_bpe_50k.json"), folder)
    sizes = [r.docs for r in files.collect()]
    assert sum(sizes) == 600 and max(sizes) < 200
    got = token_files.read_token_files(files).collect()
    assert len(got) == 600 and len({r.start for r in got}) == 600 and len({r.ids_crc32 for r in got}) == 1


def test_whole_pieces_are_proven(sp):
    proven = prove_whole_pieces(sp)
    assert proven[" the"] == 1 and len(proven) > 10_000
    assert all(len(sp.encode(s[1:])) == 1 for s in list(proven)[::97] if s != " ")


def test_a_model_that_cannot_be_cut_is_refused(monkeypatch):
    class Other:
        def __init__(self, model_file):
            pass

        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "a▁b"

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Other)
    from riskloom.llm.segments import piece_processor
    with pytest.raises(NotSegmentable):
        piece_processor("x")


def test_counts(docs, rows, sp):
    got = Counter(tuple(r) for r in token_counts.token_counts(docs, PIECES, limit=100).collect())
    want = Counter()
    for i, t in rows:
        n = len(sp.encode(t or ""))
        want[(i, len((t or "").encode()), n, n > 100)] += 1
    assert got == want


def test_token_files_round_trip(spark, docs, rows):
    path = P.path("byte_bpe_50k.json")
    folder = scratch_path(spark, "test-token-files")
    files = token_files.write_token_files(docs, path, folder)
    got = token_files.read_token_files(files).collect()
    lib = Tokenizer.from_file(path)
    want = Counter((i, crc(lib.encode(t or "", add_special_tokens=False).ids + [0])) for i, t in rows)
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == want
    got.sort(key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    first = token_files.TokenFile(files.orderBy("file").first().path)
    k = len(first.index) - 1
    assert list(first.ids(k)) == list(list(first.documents(block=64))[k][1])


def test_dictionary_must_match(spark, tmp_path):
    assert token_files.train_dictionary([]) == b""
    assert token_files.train_dictionary([b"ab"]) == b"ab"


def test_best_fit():
    bins = packing.best_fit([5, 4, 3, 3, 2, 2, 1], 10)
    assert sorted(i for b in bins for i in b) == list(range(7)) and len(bins) == 2


def test_packing(docs, rows, monkeypatch):
    capacity = 64
    got = [tuple(r) for r in packing.pack(docs, P.path("word_bpe_49k.json"), capacity=capacity).collect()]
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want, total = Counter(), 0
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        total += len(ids)
        for k, a in enumerate(range(0, len(ids), capacity)):
            want[(i, k, a, len(ids[a:a + capacity]), crc(ids[a:a + capacity]))] += 1
    assert Counter(r[:5] for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r[5]].append((r[6], r[3]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= -(-total // capacity) * 1.02 + 1


def test_packing_of_items_that_never_pair(spark, monkeypatch):
    # Every document needs more than half a sequence: no round can save a bin.
    docs = spark.createDataFrame([(k, "a " * 40) for k in range(300)], "doc_id long, text string").repartition(20)
    got = packing.pack(docs, P.path("word_bpe_49k.json"), capacity=64).collect()
    assert len(got) == 300 and len({r.sequence_id for r in got}) == 300


def test_codec(docs, rows, sp):
    got = Counter(tuple(r) for r in sentencepiece_codec.encode_and_decode(docs, PIECES).collect())
    want = Counter()
    for i, t in rows:
        ids = sp.encode(t or "")
        back = sp.decode(ids)
        want[(i, len(ids), crc(ids), zlib.crc32(back.encode()), back == (t or ""))] += 1
    assert got == want


@pytest.mark.parametrize("kind, name", [(ByteLevel, "byte_bpe_50k.json"), (WordLevel, "word_bpe_49k.json")])
def test_a_word_is_looked_up_once_a_batch(monkeypatch, kind, name):
    lib, mine, asked = Tokenizer.from_file(P.path(name)), kind(P.path(name)), []
    real = mine.words.values
    monkeypatch.setattr(mine.words, "values", lambda lists: asked.extend(k for keys in lists for k in keys) or real(lists))
    texts = ["some words of some words", "words", "", "of  two words ", "x\ny words", "some\x85words", "some"] * 40
    assert [*mine.encode(iter(texts))] == [u32(lib.encode(t, add_special_tokens=False).ids) for t in texts]
    assert asked.count("some") == 1


def test_suffix_array_finds_every_occurrence():
    c = sentencepiece_codec.codec(PIECES)
    text = "▁the▁then\0▁▁▁other\0"
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    found = {(int(s), c.names[p]) for s, _, p in zip(*c.edges(c.dense[points]))}
    own = {c.names[i] for i in c.piece}
    assert found == {(a, text[a:b]) for a in range(len(text)) for b in range(a + 1, len(text) + 1) if text[a:b] in own}


@pytest.mark.parametrize("together", [0, 3, 512])
def test_words_are_relaxed_together_as_alone(monkeypatch, sp, together):
    """Equal paths whatever words are relaxed over arrays, unknown characters and long words included."""
    monkeypatch.setattr(sentencepiece_codec, "TOGETHER", together)
    c = sentencepiece_codec.codec(PIECES)
    words = sorted({w for t in real_texts()[:60] + strange_texts() for w in t.split() if "▁" not in w and "\0" not in w})
    words += ["the" * 300 + "#汉é", "\n" * 600, "a\nb"]
    assert c.encode_words([" " + w for w in words]) == [u32(sp.encode(w)) for w in words]


def test_empty_tables(spark, empty):
    assert token_counts.token_counts(empty, PIECES).count() == 0
    assert token_files.write_and_read(empty, P.path("byte_bpe_50k.json")).count() == 0
    assert packing.pack(empty, P.path("word_bpe_49k.json")).count() == 0
    assert sentencepiece_codec.encode_and_decode(empty, PIECES).count() == 0


def test_registered_queries_on_the_whole_table(spark, sp):
    from riskloom.llm.queries import QUERIES
    texts = real_texts()
    counts = {r.doc_id: r.n_tokens for r in QUERIES["op2_token_counts"](spark, SF).collect()}
    codes = {r.doc_id: (r.n_tokens, r.round_trip) for r in QUERIES["op10_sentencepiece"](spark, SF).collect()}
    assert len(counts) == len(codes) == len(texts)
    assert sorted(counts.values()) == sorted(len(sp.encode(t)) for t in texts)
    assert codes == {i: (n, True) for i, n in counts.items()}
