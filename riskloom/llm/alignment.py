"""Cross-tokenizer alignment by galloping intersection (operator 11).

A text's tokens under two vocabularies, A (byte-level BPE) and B (BPE pieces
with byte fallback), cover the same bytes.  The byte offsets where tokens end
are two ascending lists; the shorter one drives an exponential and then binary
search into the longer.  The common offsets cut both token lists into groups;
between two of them, differences of ranks say which tokens overlap.

Two tokens that end together cover bytes of one text, so the bytes of one are
a suffix of the other's.  All pairs that can ever link are therefore known from
the vocabularies alone (``PairIndex``; no more than the bytes of both
vocabularies together), and corpus-wide counts are an array of that bounded
size: summed per task, added up by pair, and given back to every task.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, batch_of, chunks, loaded_once, texts_of, u32, written
from .segments import MARK, NO_SPACE, ODD, ByteLevel, NotSegmentable, byte_alphabet, piece_processor

#: Both vocabularies can be cut before a space or line feed that follows something else.
CUT = re.compile(r"(?<=[^ \t\n\r])(?=[ \n])")
UNUSUAL = re.compile(r"[ \n][ \n]|[\t\r]")
ALIGNED = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("groups", pa.string()),
                     ("links", pa.binary())])
COUNTS = pa.schema([("pair", pa.int64()), ("n", pa.int64())])
OUT = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                 ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
                 ("groups_sha256", pa.string()), ("n_overlaps", pa.int64())])


def galloping(shorter: list[int], longer: list[int]) -> list[tuple[int, int]]:
    """Index pairs of the values that two ascending lists share."""
    found, at, n = [], 0, len(longer)
    for i, x in enumerate(shorter):
        step = 1
        while at + step < n and longer[at + step] < x:
            step *= 2
        at = bisect_left(longer, x, at + step // 2 if step > 1 else at, min(n, at + step + 1))
        if at == n:
            break
        if longer[at] == x:
            found.append((i, at))
            at += 1
    return found


def common_ends(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """(index in ``a``, index in ``b``) of each offset where both end."""
    return galloping(a, b) if len(a) <= len(b) else [(i, j) for j, i in galloping(b, a)]


def galloping_many(shorter: np.ndarray, longer: np.ndarray, first: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """``galloping`` for many pairs of lists laid end to end: for each value
    of ``shorter`` its index in ``longer``, or -1, where its partner list is
    ``longer[first:behind]`` (bounds per value).  All values take their steps
    together: the stride from the list's begin doubles until it reaches the
    value, and halves again within the last stride."""
    stride = np.ones(len(shorter), dtype=np.int64)
    last = len(longer) - 1
    open_ = np.flatnonzero(first < behind)
    while len(open_):
        at = first[open_] + stride[open_]
        short = (at < behind[open_]) & (longer[np.minimum(at, last)] < shorter[open_])
        open_ = open_[short]
        stride[open_] *= 2
    low = first + np.where(stride > 1, stride // 2, 0)
    high = np.minimum(first + stride + 1, behind)
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) >> 1
        less = longer[mid] < shorter[open_]
        low[open_] = np.where(less, mid + 1, low[open_])
        high[open_] = np.where(less, high[open_], mid)
    found = (low < behind) & (longer[np.minimum(low, max(last, 0))] == shorter) if len(longer) else low < 0
    return np.where(found, low, -1)


def overlap_ranges(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """For each token of B the first and last token of A whose bytes it
    shares, from the ranks of its bounds among A's ends."""
    starts = [0, *b[:-1]]
    return [(bisect_left(a, s + 1), bisect_left(a, e)) for s, e in zip(starts, b)]


class PairIndex:
    """All (A id, B id) that can end together, numbered; ``b`` has each
    pair's B id."""

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]):
        a_ids, b_ids = ({}, {})
        for table, tokens in ((a_ids, a_bytes), (b_ids, b_bytes)):
            for i, token in enumerate(tokens):
                if token:
                    table.setdefault(token, []).append(i)
        pairs = {(i, j) for token, own in b_ids.items() for k in range(len(token))
                 for i in a_ids.get(token[k:], ()) for j in own}
        pairs |= {(i, j) for token, own in a_ids.items() for k in range(1, len(token))
                  for j in b_ids.get(token[k:], ()) for i in own}
        ordered = sorted(pairs)
        self.a = np.array([i for i, _ in ordered], dtype=np.int64)
        self.b = np.array([j for _, j in ordered], dtype=np.int64)
        self.codes = self.a << 32 | self.b

    def __len__(self) -> int:
        return len(self.codes)

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        wanted = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = np.searchsorted(self.codes, wanted)
        if len(wanted) and (at.max() >= len(self) or (self.codes[at] != wanted).any()):
            raise ValueError("two tokens end together and neither ends in the other")
        return at


class Vocabularies:
    """Bytes of every id of both files."""

    def __init__(self, a_path: str, b_path: str):
        with open(a_path, encoding="utf-8") as f:
            file = json.load(f)
        if file["normalizer"] or (file["pre_tokenizer"] or {}).get("type") != "ByteLevel" or file["pre_tokenizer"]["add_prefix_space"]:
            raise NotSegmentable("the file is not plain byte-level BPE")
        back = {chr(c): b for b, c in byte_alphabet().items()}
        special = {t["id"] for t in file["added_tokens"]}
        names = file["model"]["vocab"]
        self.a = [b""] * (max([*names.values(), *special]) + 1)
        for name, i in names.items():
            self.a[i] = b"" if i in special else bytes(map(back.__getitem__, name))
        sp = self.sp = piece_processor(b_path)
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        if any("\n" in p for p in pieces):
            raise NotSegmentable("a piece holds a line feed")
        self.b = [b"" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
                  else bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode()
                  for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([*map(len, x)], dtype=np.int64) for x in (self.a, self.b))
        self.pairs = PairIndex(self.a, self.b)


class Aligner:
    """Alignments of whole texts, one cached segment at a time."""

    def __init__(self, a_path: str, b_path: str):
        self.known = Vocabularies(a_path, b_path)
        self.sp, self.byte_level = self.known.sp, ByteLevel(a_path)
        if not self.byte_level.cuts:
            raise NotSegmentable("the byte-level file cannot be cut at spaces")
        self.byte_level.lib.encode_special_tokens = True  # their strings in a text are plain text
        self.space = self.sp.piece_to_id(MARK)
        self.segments = Memo(self.align_segments, limit=180_000)

    def b_ids(self, segments: list[str]) -> list[list[int]]:
        """Ids of strings that begin with a space (the one that the library
        puts before a text) or a line feed (which joins with nothing)."""
        out = self.sp.encode([s[1:] if s[0] == " " else s for s in segments], num_threads=1)
        return [ids if s[0] == " " else ids[1:] for s, ids in zip(segments, out)]

    def align(self, raw: bytes, a: list[int], b: list[int]):
        """``(groups, links, n_a, n_b)`` of one string, or False if its tokens
        do not spell it."""
        a_bytes, b_bytes = [self.known.a[i] for i in a], [self.known.b[i] for i in b]
        if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            return False
        common = common_ends([*accumulate(map(len, a_bytes))], [*accumulate(map(len, b_bytes))])
        groups, i0, j0 = [], 0, 0
        for i, j in common:
            groups.append(",".join(map(str, a[i0:i + 1])) + "|" + ",".join(map(str, b[j0:j + 1])))
            i0, j0 = i + 1, j + 1
        links = self.known.pairs.numbers(np.array([a[i] for i, _ in common]), np.array([b[j] for _, j in common]))
        return ";".join(groups), u32(links), len(a), len(b)

    def align_segments(self, keys: list[str]) -> list:
        """``align`` of many strings at once, laid end to end."""
        segments = [k[1:] if k[0] == NO_SPACE else k if k[0] == "\n" else " " + k for k in keys]
        raw = [s.encode() for s in segments]
        a_all = [np.frombuffer(a, "<u4") for a in self.byte_level.encode_strings(segments)]
        b_all = self.b_ids(segments)
        spelled = [b"".join(map(self.known.a.__getitem__, a.tolist())) == r == b"".join(map(self.known.b.__getitem__, b))
                   for r, a, b in zip(raw, a_all, b_all)]
        out: list = [False] * len(keys)
        good = [k for k, ok in enumerate(spelled) if ok]
        if not good:
            return out
        a, b = np.concatenate([a_all[k] for k in good]).astype(np.int64), np.array([i for k in good for i in b_all[k]])
        n_a, n_b = (np.array([len(x[k]) for k in good], dtype=np.int64) for x in (a_all, b_all))
        a_ends, b_ends = np.cumsum(self.known.a_size[a]), np.cumsum(self.known.b_size[b])
        a_behind, b_behind = np.cumsum(n_a), np.cumsum(n_b)
        if len(a) <= len(b):
            at = galloping_many(a_ends, b_ends, np.repeat(b_behind - n_b, n_a), np.repeat(b_behind, n_a))
            i = np.flatnonzero(at >= 0)
            j = at[i]
        else:
            at = galloping_many(b_ends, a_ends, np.repeat(a_behind - n_a, n_b), np.repeat(a_behind, n_b))
            j = np.flatnonzero(at >= 0)
            i = at[j]
        links = u32(self.known.pairs.numbers(a[i], b[j]))
        a_text, b_text = [*map(str, a.tolist())], [*map(str, b.tolist())]
        groups, i0, j0 = [], 0, 0
        for i1, j1 in zip((i + 1).tolist(), (j + 1).tolist()):
            groups.append((a_text[i0] if i1 - i0 == 1 else ",".join(a_text[i0:i1])) + "|"
                          + (b_text[j0] if j1 - j0 == 1 else ",".join(b_text[j0:j1])))
            i0, j0 = i1, j1
        g0 = 0
        for k, g1, x, y in zip(good, np.searchsorted(i, a_behind).tolist(), n_a.tolist(), n_b.tolist()):
            out[k] = (";".join(groups[g0:g1]), links[4 * g0:4 * g1], x, y)
            g0 = g1
        return out

    def cut(self, text: str) -> list[str] | None:
        """The segments of space+text (keys of the cache), or None if it must
        be seen whole."""
        if ODD.search(text) or MARK in text:
            return None
        if text[0] in " \n" or text[-1] == " " or UNUSUAL.search(text):
            return [NO_SPACE + s for s in CUT.split(" " + text)]
        return text.replace("\n", " \n").split(" ")

    def whole(self, text: str):
        a = self.byte_level.lib.encode(" " + text, add_special_tokens=False).ids
        return self.align((" " + text).encode(), a, self.sp.encode(text))

    def texts(self, texts: Iterator[str]) -> Iterator[tuple[str, bytes, int, int]]:
        """``(groups, links, n_a, n_b)`` per text; all zero without tokens."""
        for some in chunks(texts):
            cuts = [self.cut(t) if t else None for t in some]
            for text, cut, parts in zip(some, cuts, self.segments.values([c or [] for c in cuts])):
                if cut is None or False in parts:
                    yield (self.whole(text) if text else False) or ("", b"", 0, 0)
                else:
                    groups, links, n_a, n_b = zip(*parts)
                    yield ";".join(groups), b"".join(links), sum(n_a), sum(n_b)


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
            hashed: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, groups, links`` per document: the groups as text
    (``a1,a2|b1;a3|b2,b3``; with ``hashed`` its SHA-256, '' without tokens) and
    the number in ``PairIndex`` of each link as little-endian uint32.

    A encodes space+text, B the text (its library adds the space), both without
    special tokens.  Null and empty texts, and texts that either vocabulary
    does not spell byte by byte, have no tokens.  Null and repeated ids give a
    row each; texts of any length are encoded whole; an empty table gives no
    rows; other columns are ignored.
    """
    def run(batches):
        aligner = loaded_once(Aligner, a_path, b_path)
        for b in batches:
            rows = []
            for groups, links, n_a, n_b in aligner.texts(texts_of(b.column(1))):
                text = hashlib.sha256(groups.encode()).hexdigest() if hashed and groups else groups
                rows.append((n_a, n_b, text, links))
            yield batch_of(ALIGNED, [b.column(0), *(list(zip(*rows)) or [[]] * 4)])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, groups string, links binary")


def link_counts(aligned_docs: DataFrame, size: int) -> DataFrame:
    """``pair, n``: links of each pair over all documents; a task adds its
    own up in an array of ``size`` before anything is shuffled."""
    def run(batches):
        counts = np.zeros(size, dtype=np.int64)
        for b in batches:
            counts += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), "<u4"), minlength=size)
        held = np.flatnonzero(counts)
        yield batch_of(COUNTS, [pa.array(held), pa.array(counts[held])])

    sums = aligned_docs.select("links").mapInArrow(run, "pair long, n long")
    return sums.groupBy("pair").agg(F.sum("n").alias("n"))


def alignment_report(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, n_overlaps`` per document.

    ``count_sum`` adds up, over the document's links, how many links of the
    whole corpus join the same two ids; ``n_best`` counts the links whose pair
    is the most frequent of its B id (ties included); ``n_overlaps`` counts
    the pairs of tokens that share bytes.  Edge cases as in ``aligned``.
    """
    spark = docs.sparkSession
    pairs = loaded_once(Vocabularies, a_path, b_path).pairs
    rows = written(aligned(docs, a_path, b_path, id_col, text_col, hashed=True), "aligned")
    table = link_counts(rows, len(pairs)).toArrow()  # at most len(pairs) rows, whatever the corpus
    counts = np.zeros(len(pairs), dtype=np.int64)
    counts[table.column("pair").to_numpy()] = table.column("n").to_numpy()
    highest = np.zeros(int(pairs.b.max(initial=0)) + 1, dtype=np.int64)
    np.maximum.at(highest, pairs.b, counts)
    shared = spark.sparkContext.broadcast((counts, counts == highest[pairs.b]))

    def run(batches):
        counts, best = shared.value
        for b in batches:
            links = b.column("links").to_pylist()
            flat = np.frombuffer(b"".join(links), "<u4")
            n = np.array([len(x) // 4 for x in links], dtype=np.int64)
            ends = np.cumsum(n)
            summed = [np.concatenate(([0], np.cumsum(v[flat], dtype=np.int64))) for v in (counts, best)]
            count_sum, n_best = (s[ends] - s[ends - n] for s in summed)
            n_a, n_b = (b.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
            yield batch_of(OUT, [b.column("doc_id"), b.column("n_a"), b.column("n_b"), pa.array(n), pa.array(n),
                                 pa.array(n_best), pa.array(count_sum), b.column("groups"), pa.array(n_a + n_b - n)])

    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                "count_sum long, groups_sha256 string, n_overlaps long")
