"""SentencePiece encoding and decoding by suffix-array matching (operator 10).

The distinct new words of a batch are concatenated and indexed by a suffix
array; every vocabulary piece is found by binary search, which gives all its
occurrences as one range; the occurrences are edges of a lattice, sorted by
place in the word and relaxed from left to right, all words together.

The model is a BPE model, whose encoding is the one path in which no two
neighbours would have merged otherwise: an edge relaxes its end if its start is
reached and the pair (token there, this piece) encodes as just these two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, batch_of, chunks, texts_of, u32
from .segments import MARK, piece_processor, pieces_of

#: Characters per sort key, 16 bits each; 0 separates words, UNKNOWN is in no piece.
PER_KEY, UNKNOWN = 4, 65_535
#: Words of more characters are relaxed one by one, so that a batch takes at most so many rounds.
TOGETHER = 512
#: A place that no path reaches yet; the start of a word; a character of no piece.
OPEN, START, BYTES = -3, -1, -2
OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                 ("decoded_crc32", pa.int64()), ("round_trip", pa.bool_())])


class Pairs(dict):
    """Whether two neighbours encode, together, as just these two; the latest
    answers are also in arrays, a slot for each hash."""

    BITS = 20

    def __init__(self, codec):
        super().__init__()
        self.codec = codec
        self.keys = np.full(1 << self.BITS, -1, dtype=np.int64)
        self.found = np.zeros(1 << self.BITS, dtype=bool)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def many(self, keys: np.ndarray) -> np.ndarray:
        slot = self.slots(keys)
        out = self.found[slot]
        gaps = np.flatnonzero(self.keys[slot] != keys)
        if len(gaps):
            new, which = np.unique(keys[gaps], return_inverse=True)
            found = np.fromiter(map(self.__getitem__, new.tolist()), dtype=bool, count=len(new))
            out[gaps] = found[which]
            slot, first = np.unique(self.slots(new), return_index=True)
            self.keys[slot], self.found[slot] = new[first], found[first]
        return out

    def __missing__(self, key: int) -> bool:
        left, right = key >> 20, key & 0xFFFFF
        c = self.codec
        found = c.merged(c.names[left] + c.names[right]) == [left, right]
        if len(self) >= 1_000_000:
            self.clear()
        self[key] = found
        return found


class Codec:
    def __init__(self, path: str):
        sp = piece_processor(path)
        size = sp.get_piece_size()
        self.names = [sp.id_to_piece(i) for i in range(size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(size)]
        byte = [sp.is_byte(i) for i in range(size)]
        self.score = {self.names[i]: sp.get_score(i) for i in range(size) if not special[i] and not byte[i]}
        self.ids = {name: i for i, name in enumerate(self.names) if name in self.score}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = [b"" if special[i] else bytes([int(self.names[i][3:5], 16)]) if byte[i]
                      else self.names[i].replace(MARK, " ").encode() for i in range(size)]
        alphabet = sorted({ch for name in self.ids for ch in name})
        self.code = {ord(ch): k + 1 for k, ch in enumerate(alphabet)}
        self.dense = np.full(0x110000, UNKNOWN, dtype=np.uint16)
        self.dense[np.array([*self.code])] = np.array([*self.code.values()])
        self.dense[0] = 0  # the separator; a zero in a text is replaced before
        self.pairs = Pairs(self)
        # Pieces that encode alone as themselves are the only ones on a path.
        own = [(name, i) for name, i in self.ids.items() if self.merged(name) == [i]]
        self.length = np.array([len(name) for name, _ in own], dtype=np.int64)
        self.piece = np.array([i for _, i in own], dtype=np.int64)
        self.keys = -(-int(self.length.max()) // PER_KEY)
        codes = np.zeros((len(own), self.keys * PER_KEY), dtype=np.uint16)
        for k, (name, _) in enumerate(own):
            codes[k, :len(name)] = [self.code[ord(ch)] for ch in name]
        top = codes.copy()
        top[np.arange(codes.shape[1]) >= self.length[:, None]] = 65_535
        self.low, self.high = self.packed(codes), self.packed(top)
        self.words = Memo(self.encode_words, limit=400_000)
        self.batch_chars = 2_000_000  # one search of all pieces serves so many characters

    def merged(self, text: str) -> list[int]:
        """BPE by definition: merge the neighbours whose joined piece has the
        highest score, leftmost first.  For vocabulary strings and pairs."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [i for p in parts for i in ([self.ids[p]] if p in self.ids else [self.byte_ids[b] for b in p.encode()])]

    @staticmethod
    def packed(codes: np.ndarray) -> np.ndarray:
        """Rows of 16-bit codes as big-endian 64-bit keys, four codes each."""
        c = codes.reshape(len(codes), -1, PER_KEY).astype(np.uint64)
        return (c[:, :, 0] << np.uint64(48)) | (c[:, :, 1] << np.uint64(32)) | (c[:, :, 2] << np.uint64(16)) | c[:, :, 3]

    def suffix_array(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of their first characters, as many as the
        longest piece has; and their keys in that order."""
        n = len(codes)
        padded = np.concatenate((codes, np.zeros(self.keys * PER_KEY + PER_KEY, dtype=np.uint16))).astype(np.uint64)
        four = ((padded[:-3] << np.uint64(48)) | (padded[1:-2] << np.uint64(32)) | (padded[2:-1] << np.uint64(16))
                | padded[3:])
        columns = [four[k * PER_KEY:k * PER_KEY + n] for k in range(self.keys)]
        order = np.lexsort(columns[::-1])
        return order, np.stack([c[order] for c in columns], axis=1)

    @staticmethod
    def bound(keys: np.ndarray, wanted: np.ndarray, upper: bool) -> np.ndarray:
        """For each wanted key row, the first suffix not below it (``upper``:
        above it): one binary search for all pieces together."""
        lo, hi = np.zeros(len(wanted), dtype=np.int64), np.full(len(wanted), len(keys), dtype=np.int64)
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            at = keys[np.minimum(mid, len(keys) - 1)]
            differ = at != wanted
            first = differ.argmax(axis=1)
            rows = np.arange(len(wanted))
            less = at[rows, first] < wanted[rows, first]
            if upper:
                less |= ~differ.any(axis=1)
            lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        return lo

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of every occurrence, piece by piece."""
        order, keys = self.suffix_array(codes)
        first, last = self.bound(keys, self.low, False), self.bound(keys, self.high, True)
        n = np.maximum(0, last - first)
        which = np.repeat(np.arange(len(n)), n)
        within = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        start = order[first[which] + within]
        return start, start + self.length[which], self.piece[which]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word (its spaces first) as little-endian uint32 bytes."""
        marked = [w.replace(" ", MARK).replace("\0", "￿") for w in words]
        joined = "\0".join(marked) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        codes = self.dense[points]
        starts, ends, tokens = self.edges(codes)
        sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
        firsts = np.cumsum(sizes + 1) - sizes - 1
        unknown = np.flatnonzero(codes == UNKNOWN)
        alone = np.setdiff1d(unknown, starts[ends == starts + 1], assume_unique=True)
        starts, ends = np.concatenate((starts, alone)), np.concatenate((ends, alone + 1))
        tokens = np.concatenate((tokens, np.full(len(alone), BYTES)))
        last, back = self.relaxed(starts, ends, tokens, firsts, sizes)
        if (last[firsts + sizes] == OPEN).any():
            raise ValueError("the lattice has no path: the pieces do not cover a word")
        on_path = np.zeros(len(points) + 1, dtype=bool)
        at, first = (firsts + sizes)[sizes > 0], firsts[sizes > 0]
        while len(at):
            on_path[at] = True
            at = back[at]
            at, first = at[at > first], first[at > first]
        at = np.flatnonzero(on_path)
        path = last[at]
        a, b = np.searchsorted(at, firsts, "right"), np.searchsorted(at, firsts + sizes, "right")
        lacking = np.concatenate(([0], np.cumsum(path == BYTES)))
        plain, flat = lacking[a] == lacking[b], u32(np.maximum(path, 0))
        out = [flat[x:y] for x, y in zip((4 * a).tolist(), (4 * b).tolist())]
        for k in np.flatnonzero(~plain).tolist():
            w, ids = words[k], []
            for e, t in zip((at[a[k]:b[k]] - firsts[k]).tolist(), path[a[k]:b[k]].tolist()):
                ids += [t] if t >= 0 else [self.byte_ids[x] for x in w[e - 1].encode()]
            out[k] = u32(ids)
        return out

    def relaxed(self, starts: np.ndarray, ends: np.ndarray, tokens: np.ndarray, firsts: np.ndarray,
                sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per place, the token that the one path to it ends with, and that
        token's start.  One path alone leads to each end, so an end that is
        reached stays."""
        n = int(firsts[-1] + sizes[-1]) + 2
        last, back = np.full(n, OPEN, dtype=np.int64), np.zeros(n, dtype=np.int64)
        last[firsts] = START
        place = starts - np.repeat(firsts, sizes + 1)[starts]
        long = np.repeat(sizes > TOGETHER, sizes + 1)[starts]
        short = np.flatnonzero(~long)
        by = short[np.argsort(place[short].astype(np.uint16), kind="stable")]
        s_of, e_of, t_of = starts[by], ends[by], tokens[by]
        cuts = np.concatenate(([0], np.cumsum(np.bincount(place[by]))))
        for k in range(len(cuts) - 1):
            part = slice(cuts[k], cuts[k + 1])
            s, e, t = s_of[part], e_of[part], t_of[part]
            p = last[s]
            fresh = np.flatnonzero((p != OPEN) & (last[e] == OPEN))
            s, e, t, p = s[fresh], e[fresh], t[fresh], p[fresh]
            fits = (p < 0) | (t < 0)
            asked = np.flatnonzero(~fits)
            fits[asked] = self.pairs.many(p[asked] << 20 | t[asked])
            last[e[fits]], back[e[fits]] = t[fits], s[fits]
        rest = np.flatnonzero(long)
        rest = rest[np.argsort(starts[rest], kind="stable")]
        reached, ok = dict.fromkeys(firsts[sizes > TOGETHER].tolist(), START), self.pairs
        for s, e, t in zip(starts[rest].tolist(), ends[rest].tolist(), tokens[rest].tolist()):
            if e not in reached:
                p = reached.get(s)
                if p is not None and (p < 0 or t < 0 or ok[p << 20 | t]):
                    reached[e] = last[e] = t
                    back[e] = s
        return last, back

    def encode(self, texts: Iterator[str]) -> Iterator[bytes]:
        for some in chunks(texts, self.batch_chars, 2048):
            for ids in self.words.values([pieces_of(t.replace(MARK, " ")) for t in some]):
                yield b"".join(ids)

    def decode(self, ids: np.ndarray) -> str:
        """Pieces joined, the mark as space, byte pieces as bytes (invalid ones
        as the replacement character), without the space put before a text."""
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace").removeprefix(" ")


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode_and_decode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, decoded_crc32, round_trip`` per document:
    the ids' checksum as little-endian uint32, the checksum of the text
    decoded from them (UTF-8), and whether that is the text itself.

    One map, no shuffle.  Null texts are empty (no ids); the space mark in a
    text decodes to a space, as in the library; null and repeated ids give a
    row each; texts of any length are encoded whole; an empty table gives no
    rows; other columns are ignored.
    """
    def run(batches):
        c = codec(model)
        for b in batches:
            rows = []
            for text, raw in zip(texts_of(b.column(1)), c.encode(texts_of(b.column(1)))):
                back = c.decode(np.frombuffer(raw, "<u4"))
                rows.append((len(raw) // 4, zlib.crc32(raw), zlib.crc32(back.encode()), back == text))
            yield batch_of(OUT, [b.column(0), *(list(zip(*rows)) or [[]] * 4)])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, decoded_crc32 long, round_trip boolean")
