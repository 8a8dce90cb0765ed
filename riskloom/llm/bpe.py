"""Byte-pair merges of many words at once, over arrays.

``Merger`` reads the vocabulary and merge list of a tokenizers file and merges
a batch of byte strings together: in each round every word that still has a
mergeable pair merges its pair of lowest rank (the leftmost of equal ones),
which is the order the library follows.  Words leave the arrays when nothing
merges any more, so a round costs what is still open.
"""

from __future__ import annotations

import json

import numpy as np

NEVER = np.int32(2**31 - 1)


class PairTable:
    """(left id, right id) -> rank and merged id: a hash table in arrays, looked
    up for many pairs at once.  Nearly all slots hold one pair at most; the
    others continue in further layers."""

    BITS = 18

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        key = self.key(left, right)
        slot = self.slots(key)
        order = np.argsort(slot, kind="stable")
        slot = slot[order]
        layer = np.arange(len(slot)) - np.searchsorted(slot, slot)
        self.held = np.bincount(slot, minlength=1 << self.BITS).astype(np.int8)
        layers = int(layer.max(initial=0)) + 1
        self.keys = np.full((layers, 1 << self.BITS), np.uint64(2**64 - 1))
        self.ranks = np.full((layers, 1 << self.BITS), NEVER)
        self.keys[layer, slot] = key[order]
        self.ranks[layer, slot] = order
        self.merged = merged.astype(np.int32)

    @staticmethod
    def key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def slots(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = self.key(left, right)
        slot = self.slots(key)
        out = np.where(self.keys[0][slot] == key, self.ranks[0][slot], NEVER)
        more = np.flatnonzero(self.held[slot] > 1)
        for layer in range(1, len(self.keys)):
            if not len(more):
                break
            at = slot[more]
            hit = self.keys[layer][at] == key[more]
            out[more[hit]] = self.ranks[layer][at[hit]]
            more = more[self.held[at] > layer + 1]
        return out


class Merger:
    def __init__(self, path: str, alphabet: dict[int, int]):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        prefix = len(model.get("continuing_subword_prefix") or "")
        self.pairs = PairTable(np.array([vocab[a] for a, _ in pairs]), np.array([vocab[b] for _, b in pairs]),
                               np.array([vocab[a + b[prefix:]] for a, b in pairs]))
        self.inner = np.array([vocab.get(chr(alphabet[b]), -1) for b in range(256)], dtype=np.int32)
        self.final = np.array([vocab.get(chr(alphabet[b]) + suffix, -1) for b in range(256)], dtype=np.int32)

    def merge(self, data: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``data``: bytes of all words; ``last``: true at the last byte of
        each.  Returns the ids in order and, for each, the byte it starts at."""
        n = len(data)
        ids = np.where(last, self.final[data], self.inner[data])
        if n == 0:
            return ids, np.zeros(0, dtype=np.int64)
        done_at, done_id = [], []
        sym, at = ids, np.arange(n, dtype=np.int32)
        word = np.concatenate(([0], np.cumsum(last[:-1]))).astype(np.int32)
        rank = np.full(n, NEVER)
        inside = np.flatnonzero(~last)
        rank[inside] = self.pairs.rank(sym[inside], sym[inside + 1])
        while len(sym):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lengths = np.diff(np.append(starts, len(sym)))
            best = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            closed = best == NEVER
            done = np.flatnonzero(closed)
            if len(done):
                done_at.append(at[done])
                done_id.append(sym[done])
                if len(done) == len(sym):
                    break
                open_ = np.flatnonzero(~closed)
                sym, at, word, rank, best = sym[open_], at[open_], word[open_], rank[open_], best[open_]
            hit = np.flatnonzero(rank == best)
            hit = hit[np.concatenate(([True], word[hit[1:]] != word[hit[:-1]]))]
            sym[hit] = self.pairs.merged[rank[hit]]
            keep = np.ones(len(sym), dtype=bool)
            keep[hit + 1] = False
            keep = np.flatnonzero(keep)
            now = hit - np.arange(len(hit))
            sym, at, word, rank = sym[keep], at[keep], word[keep], rank[keep]
            follows = np.append(word[1:] == word[:-1], False)
            for p in (now, now[now > 0] - 1):
                joined = p[follows[p]]
                rank[p] = NEVER
                rank[joined] = self.pairs.rank(sym[joined], sym[joined + 1])
        at, sym = np.concatenate(done_at), np.concatenate(done_id)
        order = np.argsort(at, kind="stable")
        return sym[order], at[order]
