"""Token-id files with a shared zstandard dictionary (operator 3).

A dictionary is trained once on the serialized ids of a bounded sample of
short documents.  Every document is one zstandard frame of its own, so a short
document can be read alone.  A folder holds ``dictionary-<hash>.zdict`` and
``part-NNNNNN.tok`` files, whose names follow ascending document id:

    magic | u32 header size | header (JSON: id width, dictionary hash, end id)
    | frames | index (zstandard: per document i64 id, u8 id present,
    u64 offset, u32 frame bytes, u64 tokens) | u64 index offset
    | u32 index bytes | u32 documents | magic
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SharedFile, batch_of, new_folder, open_shared, read_exactly, texts_of, written
from .segments import ByteLevel, loaded

MAGIC = b"TOKZSTD1"
TRAILER = "<QII8s"
#: The dictionary's sample: so many documents at most, of so many bytes at most.
SAMPLE_DOCS, SAMPLE_BYTES = 512, 16_384
DICTIONARY_BYTES = 65_536
FRAMES_PER_FILE = 64 << 20
LEVEL = 3

ENCODED = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("frame", pa.binary())])
WRITTEN = pa.schema([("file", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())])
READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


@cache
def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary of serialized id arrays; where there is too
    little to train on, the samples' own bytes (a raw-content dictionary)."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def dictionary_hash(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@cache
def _coders(data: bytes):
    if not data:
        return zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
    d = zstandard.ZstdCompressionDict(data)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d), zstandard.ZstdDecompressor(dict_data=d)


def sample_dictionary(docs: DataFrame, tokenizer: str, id_col: str, text_col: str) -> bytes:
    """Trains on at most ``SAMPLE_DOCS`` whole documents of at most
    ``SAMPLE_BYTES``, the first in hash order of their ids.  Only the size of
    the files depends on it."""
    short = docs.where(F.octet_length(text_col) <= SAMPLE_BYTES)
    chosen = [r[0] for r in short.select(id_col, F.xxhash64(id_col).alias("h")).orderBy("h").limit(SAMPLE_DOCS).collect()]
    some = short.where(F.col(id_col).isin(chosen)).select(text_col).limit(SAMPLE_DOCS).collect()
    encoder = loaded(ByteLevel, tokenizer)
    kind = id_type(encoder.lib.get_vocab_size())
    return train_dictionary([np.frombuffer(x, "<u4").astype(kind).tobytes()
                             for x in encoder.encode(r[0] for r in some)])


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Writes ``docs`` into ``folder`` in ascending id order; returns the
    files: ``file, path, docs, tokens``, and ``start``, the ids before each.

    Texts are encoded where they are read; only compressed frames are
    shuffled, by ranges of (id, frame hash, place), so even one row that a third
    of the table repeats spreads over files.  A file is written under a private name and
    moved into place, so tasks may run again.  Null texts are empty (the end
    id alone), null ids come first, repeated rows are written each, an empty
    table writes no file.
    """
    shared = sample_dictionary(docs, tokenizer, id_col, text_col)
    f = SharedFile(f"{folder}/dictionary-{dictionary_hash(shared)}.zdict")
    f.write(shared)
    f.close()

    def encode(batches):
        encoder = loaded(ByteLevel, tokenizer)
        kind = id_type(encoder.lib.get_vocab_size())
        pack = _coders(shared)[0].compress
        end = np.array([end_id], kind)
        for b in batches:
            tokens, frames = [], []
            for ids in encoder.encode(texts_of(b.column(1))):
                ids = np.append(np.frombuffer(ids, "<u4").astype(kind), end)
                tokens.append(len(ids))
                frames.append(pack(ids.tobytes()))
            yield batch_of(ENCODED, [b.column(0), tokens, frames])

    def write(batches):
        part = TaskContext.get().partitionId()
        out, index, docs_here, tokens = None, bytearray(), 0, 0
        for b in batches:
            for doc_id, n, frame in zip(*(b.column(k).to_pylist() for k in range(3))):
                if out is None:
                    out = SharedFile(f"{folder}/part-{part:06d}.tok")
                    head = json.dumps({"ids": id_type(loaded(ByteLevel, tokenizer).lib.get_vocab_size()),
                                       "dictionary": dictionary_hash(shared), "end_id": end_id}).encode()
                    out.write(MAGIC + struct.pack("<I", len(head)) + head)
                index += struct.pack(ENTRY, doc_id or 0, doc_id is not None, out.write(frame), len(frame), n)
                docs_here += 1
                tokens += n
        if out is not None:
            table = zstandard.compress(bytes(index))
            at = out.write(table)
            out.write(struct.pack(TRAILER, at, len(table), docs_here, MAGIC))
            out.close()
            yield batch_of(WRITTEN, [[part], [out.uri], [docs_here], [tokens]])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    frames = written(rows.mapInArrow(encode, "id long, n_tokens long, frame binary"), "frames")
    size = frames.agg(F.sum(F.octet_length("frame"))).first()[0] or 0
    files = max(1, -(-size // FRAMES_PER_FILE), min(frames.sparkSession.sparkContext.defaultParallelism, size >> 20))
    order = ["id", "h", "place"]  # the row's place last: equal rows of one id spread over files too
    ordered = (frames.withColumns({"h": F.xxhash64("frame"), "place": F.monotonically_increasing_id()})
               .repartitionByRange(int(files), *order).sortWithinPartitions(*order).select("id", "n_tokens", "frame"))
    made = written(ordered.mapInArrow(write, "file int, path string, docs long, tokens long"), "files")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return made.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


ENTRY = "<qBQIQ"
INDEX = np.dtype([("id", "<i8"), ("known", "u1"), ("offset", "<u8"), ("bytes", "<u4"), ("tokens", "<u8")])


class TokenFile:
    """Reads one file: ``index`` has a row per document, ``ids(k)`` one
    document's ids, touching only its own frame."""

    def __init__(self, path: str):
        self.handle = open_shared(path)
        self.handle.seek(self.handle.size() - struct.calcsize(TRAILER))
        at, size, docs, magic = struct.unpack(TRAILER, read_exactly(self.handle, struct.calcsize(TRAILER)))
        self.handle.seek(0)
        if magic != MAGIC or read_exactly(self.handle, len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is not a whole token file")
        self.head = json.loads(read_exactly(self.handle, struct.unpack("<I", read_exactly(self.handle, 4))[0]))
        self.handle.seek(at)
        table = zstandard.decompress(read_exactly(self.handle, size), max_output_size=docs * INDEX.itemsize or 1)
        self.index = np.frombuffer(table, INDEX, count=docs)
        with open_shared(f"{path.rsplit('/', 1)[0]}/dictionary-{self.head['dictionary']}.zdict") as f:
            shared = bytes(f.read())
        if dictionary_hash(shared) != self.head["dictionary"]:
            raise ValueError("the dictionary does not match its hash")
        self.unpack = _coders(shared)[1].decompress

    def ids(self, k: int) -> np.ndarray:
        row = self.index[k]
        self.handle.seek(int(row["offset"]))
        return self.decoded(read_exactly(self.handle, int(row["bytes"])), int(row["tokens"]))

    def decoded(self, frame: bytes, tokens: int) -> np.ndarray:
        kind = np.dtype(self.head["ids"])
        ids = np.frombuffer(self.unpack(frame, max_output_size=tokens * kind.itemsize or 1), kind)
        if len(ids) != tokens:
            raise ValueError("a frame holds another number of ids than its index says")
        return ids

    def documents(self, block: int = 4 << 20):
        """(index row, ids) of all documents in order, read in blocks."""
        k = 0
        while k < len(self.index):
            first = int(self.index[k]["offset"])
            upto = int(np.searchsorted(self.index["offset"], first + block, side="right"))
            upto = max(k + 1, upto - 1 if upto < len(self.index) else upto)
            last = self.index[upto - 1]
            self.handle.seek(first)
            data = read_exactly(self.handle, int(last["offset"]) + int(last["bytes"]) - first)
            for row in self.index[k:upto]:
                a = int(row["offset"]) - first
                yield row, self.decoded(data[a:a + int(row["bytes"])], int(row["tokens"]))
            k = upto


def read_token_files(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from the files:
    the ids before it, its ids with the end id, and their checksum as
    little-endian unsigned 32-bit integers.  One task per file at most."""
    def read(batches):
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = []
                for row, ids in TokenFile(path).documents():
                    rows.append((int(row["id"]) if row["known"] else None, start, len(ids),
                                 zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(rows) >= 10_000:
                        yield batch_of(READ, list(zip(*rows)))
                        rows = []
                if rows:
                    yield batch_of(READ, list(zip(*rows)))

    files = written(files.select("path", "start"), "manifest")
    n = max(1, files.count())
    return files.repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    folder = new_folder(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, tokenizer, folder, end_id))
