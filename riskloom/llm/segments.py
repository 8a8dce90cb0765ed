"""Exact token ids of whole texts, one cached segment at a time.

The three vocabularies never let a token cross certain boundaries, so a text
may be cut there, every segment encoded alone by the library, and the ids
joined.  Texts repeat most segments, so nearly all come from a bounded cache
(``Memo``).

* ``byte_bpe_50k.json`` (byte-level): the split pattern lets a white space
  character only *start* a pre-token or continue a run of white space, so
  "non-space, then space" is always a boundary, and its look-ahead never sees
  beyond the run.  Texts holding white space other than ``[ \t\n\r]`` go
  through the library whole.
* ``word_bpe_49k.json`` drops white space, and its normaliser (NFC, white
  space, lower case by character) never joins characters across it.

  The library needs 10 to 25 microseconds a word here, ten times the time
  that the work allows, so words of ASCII and Latin-1 letters (``REGULAR``)
  are cut by character class and merged together over arrays from the
  library's own file (``bpe.Merger``); all others go through the library.
  The tests compare both with the library on whole tables.
* ``piece_bpe_32k.model``: no piece holds the space mark after another
  character (checked when loading), so "non-space, then space" is a boundary.
  Texts holding the mark itself go through the library whole.

Special strings inside a text (``<|endoftext|>``) hold no white space and do
not begin with a letter, so they lie within one segment, where the library
treats them as its default does.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .bpe import Merger
from .common import Memo, chunks, loaded_once, u32

#: Characters whose class the byte tables below know: ASCII but the apostrophe
#: (contractions) and white space; Latin-1 letters, which are precomposed.
KNOWN = "!-&(-~À-ÖØ-öø-ÿ"
#: A word that the tables can cut: known characters, single line feeds between.
REGULAR = re.compile(rf" ?[{KNOWN}]+(?:\n[{KNOWN}]+)*")
#: A word with the white space before it.
RUNS = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
#: White space and separators beyond space, tab, line feed and carriage return.
ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
BEYOND_LATIN_1 = re.compile("[^\x00-\xff]")
LETTER, DIGIT, OTHER, FEED = 0, 1, 2, 3
#: Marks a word that no single space precedes; one of ODD, so in no text that is cut.
NO_SPACE = "\x1f"
MARK = "▁"
PIECES = re.compile(r" *[^ ]+| +")


def byte_alphabet() -> dict[int, int]:
    """The printable character that byte-level BPE writes for each byte:
    itself for printable Latin-1, else the next free code from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: b for b in own} | {b: 256 + k for k, b in enumerate(rest)}


def byte_classes() -> np.ndarray:
    """Class of each byte of a regular word; every byte of a Latin-1 letter
    beyond ASCII is a letter's."""
    kind = np.full(256, OTHER, dtype=np.int8)
    for first, last in ("AZ", "az"):
        kind[ord(first):ord(last) + 1] = LETTER
    kind[ord("0"):ord("9") + 1] = DIGIT
    kind[128:] = LETTER
    kind[ord("\n")] = FEED
    return kind


def plain_bpe(file: dict) -> bool:
    """Whether merging by rank alone gives the model's ids, and nothing but
    special strings ``<|...`` and the words themselves decides where to cut."""
    model = file["model"]
    return (model.get("type") == "BPE" and not model.get("dropout") and model.get("unk_token") is None
            and not model.get("byte_fallback") and not model.get("ignore_merges")
            and not model.get("continuing_subword_prefix") and not file.get("truncation") and not file.get("padding")
            and all(t["content"].startswith("<|") and not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized"))
                    for t in file["added_tokens"]))


def kinds(part: dict | None, name: str) -> list:
    """The steps of a normaliser or pre-tokenizer."""
    return [] if not part else part[name] if part["type"] == "Sequence" else [part]


#: Encoded both ways when a file is loaded: classes, case, contractions, white space, special strings.
PROBES = ("Don't stop, it's 1234 O'Neill's café!! A_b-c", "aBc  DEF\nghi\tj k\r\n l", "x<|endoftext|>y <|z|> <|endoftext|>",
          "(a)[b]{c}#1 $2.50 100% a@b.co #$%&*|", "Ünïcode ÀÉ ß 12a34 ½", " lead trail ", "I'M we'LL they'Ve 'd")


class ByteLevel:
    """Ids of a byte-level BPE file as little-endian uint32 bytes per text.

    Words are cut and merged here only if the file is of the kind that this
    was proven for (``fits``) and encodes the probes alike; all texts of any
    other file go through the library whole."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.cuts = plain_bpe(file) and self.fits(file)
        if self.cuts:
            self.merger = Merger(path, byte_alphabet())
        self.kind = byte_classes()
        self.words = Memo(self.encode_words, limit=200_000)
        if self.cuts:
            self.cuts = [*self.encode(iter(PROBES))] == [self.whole(t) for t in PROBES]

    @staticmethod
    def fits(file: dict) -> bool:
        steps = kinds(file["pre_tokenizer"], "pretokenizers")
        return (not file["normalizer"] and not file["model"].get("end_of_word_suffix") and len(steps) == 1
                and steps[0]["type"] == "ByteLevel" and not steps[0]["add_prefix_space"] and steps[0]["use_regex"])

    def whole(self, text: str) -> bytes:
        return u32(self.lib.encode(text, add_special_tokens=False).ids)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Regular words are cut by their bytes' classes and merged together;
        the library encodes the others one by one."""
        words = [w[1:] if w[0] == NO_SPACE else " " + w for w in words]
        return self.encode_strings(words)

    def encode_strings(self, words: list[str]) -> list[bytes]:
        regular = [w if "<|" not in w and REGULAR.fullmatch(w) else "" for w in words]
        raw = [w.encode() for w in regular]
        sizes = np.array([len(r) for r in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        ids, at = self.merger.merge(data, self.pretoken_ends(data, np.cumsum(sizes)))
        cut = np.searchsorted(at, np.concatenate(([0], np.cumsum(sizes)))) * 4
        flat = u32(ids)
        return [flat[a:b] if r else self.whole(w) if w else b""
                for w, r, a, b in zip(words, raw, cut[:-1].tolist(), cut[1:].tolist())]

    def pretoken_ends(self, data: np.ndarray, word_ends: np.ndarray) -> np.ndarray:
        """True at the last byte of each pre-token: where the class changes
        (a word's leading space belongs to what follows) or a word ends."""
        kind = self.kind[data]
        space = np.flatnonzero(data == 32)
        kind[space] = kind[space + 1]
        ends = np.append(kind[1:] != kind[:-1], True)[:len(data)]
        ends[word_ends[word_ends > 0] - 1] = True
        return ends

    def cut(self, text: str) -> str | list[str] | None:
        """The text's words without the space before each, as they stand
        between spaces or listed; what has none or more white space before it
        is marked.  None if the library must see the text whole."""
        if not self.cuts or ODD.search(text):
            return None
        if not text or "  " in text or "\n " in text or "\t " in text or "\r " in text or text[0] == " " or text[-1] == " ":
            return [NO_SPACE + w for w in RUNS.findall(text)]
        return NO_SPACE + text

    def encode(self, texts: Iterator[str]) -> Iterator[bytes]:
        for some in chunks(texts, 2_000_000, 2_048):
            cuts = [self.cut(t) for t in some]
            spaced = self.encode_spaced([c for c in cuts if isinstance(c, str)])
            for text, cut in zip(some, cuts):
                if isinstance(cut, str):
                    yield next(spaced)
                else:
                    yield self.whole(text) if cut is None else b"".join(self.words.values([cut])[0])

    def encode_spaced(self, texts: list[str]) -> Iterator[bytes]:
        """Arrow cuts the texts at spaces and numbers their distinct words;
        each distinct word is looked up once, and its ids go to its places."""
        words = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        numbered = words.flatten().dictionary_encode()
        ids = self.words.values([numbered.dictionary.to_numpy(zero_copy_only=False).tolist()])[0]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        which = numbered.indices.to_numpy()
        many, first = sizes[which], (np.cumsum(sizes) - sizes)[which]
        upto = np.concatenate(([0], np.cumsum(many)))
        flat = np.frombuffer(b"".join(ids), "<u4")[np.arange(upto[-1]) + np.repeat(first - upto[:-1], many)]
        cuts = upto[words.offsets.to_numpy() - words.offsets[0].as_py()].tolist()
        for a, b in zip(cuts, cuts[1:]):
            yield flat[a:b].tobytes()


class WordLevel(ByteLevel):
    """Ids of a BPE with word ends that drops white space and case."""

    @staticmethod
    def fits(file: dict) -> bool:
        norm, steps = kinds(file["normalizer"], "normalizers"), kinds(file["pre_tokenizer"], "pretokenizers")
        return ([n["type"] for n in norm] == ["NFC", "Replace", "Lowercase"] and norm[1]["content"] == " "
                and norm[1]["pattern"] == {"Regex": r"\s+"} and [s["type"] for s in steps] == ["Split", "ByteLevel"]
                and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and not steps[1]["use_regex"]
                and not steps[1]["add_prefix_space"] and bool(file["model"].get("end_of_word_suffix")))

    def encode_words(self, words: list[str]) -> list[bytes]:
        return self.encode_strings([w.lower() if "<|" not in w and REGULAR.fullmatch(w) else w for w in words])

    def pretoken_ends(self, data: np.ndarray, word_ends: np.ndarray) -> np.ndarray:
        return super().pretoken_ends(data, word_ends) | (self.kind[data] == DIGIT)

    def cut(self, text: str) -> str | None:
        if not self.cuts:
            return None
        if "<|" not in text and not BEYOND_LATIN_1.search(text):
            text = text.lower()
        return text.replace("\n", " ")


class NotSegmentable(ValueError):
    """The model's normaliser or pieces do not allow cutting at spaces."""


def piece_processor(path: str):
    """A sentencepiece model, refused unless cutting at spaces is exact."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any(MARK in n.lstrip(MARK) for n in names):
        raise NotSegmentable("a piece holds the space mark after another character")
    probe = "a  ﬁ　½ "
    if "".join(sp.encode(probe, out_type=str)) != MARK + probe.replace(" ", MARK):
        raise NotSegmentable("the normaliser changes texts")
    return sp


def pieces_of(text: str) -> list[str]:
    """The segments of a text: each begins with its spaces, the first one with
    the space that the library puts before a text."""
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return PIECES.findall(" " + text)
    return [" " + w for w in text.split(" ")]


def prove_whole_pieces(sp) -> dict[str, int]:
    """The segments " w" whose vocabulary string encodes, alone, as that one
    token, and the lone space (the mark itself): encoded once with the library, offline, piece by piece."""
    names = {sp.id_to_piece(i): i for i in range(sp.get_piece_size())
             if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
    leading = [n for n in names if n.startswith(MARK)]
    texts = [n[1:].replace(MARK, " ") for n in leading]
    return {" " + t: 1 for n, t, ids in zip(leading, texts, sp.encode(texts, num_threads=1)) if ids == [names[n]]} | {" ": 1}


class PieceCounts:
    """Number of tokens per text: segments that are proven whole tokens count
    one each; only the others are merged (by the library, then cached)."""

    def __init__(self, path: str):
        self.sp = piece_processor(path)
        self.words = Memo(self.merge, pinned=prove_whole_pieces(self.sp))

    def merge(self, segments: list[str]) -> list[int]:
        return [len(ids) for ids in self.sp.encode([s[1:] for s in segments], num_threads=1)]

    def count(self, texts: Iterator[str]) -> Iterator[int]:
        for some in chunks(texts):
            cuts = [None if MARK in t else pieces_of(t) for t in some]
            values = self.words.values([c or [] for c in cuts])
            for text, cut, counts in zip(some, cuts, values):
                yield len(self.sp.encode(text)) if cut is None else sum(counts)


def loaded(kind: type, path: str):
    """One encoder per worker process and file."""
    return loaded_once(kind, path)
