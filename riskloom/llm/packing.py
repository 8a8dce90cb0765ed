"""Best-fit packing by hierarchical residual packing (operator 4).

Texts are encoded where they are read; from then on a row is a piece (40
bytes).  Every task packs its pieces best-fit, longest first, and emits the
bins that are nearly full; underfull bins go on as items of the next round,
merged by a tree of fewer and fewer tasks, until one task has seen what is
left or a round no longer saves bins.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, texts_of, written
from .segments import WordLevel, loaded

#: A bin with at most so many free places is full.
SLACK = 8
#: Items that a task packs at once, and tasks that a round merges into one.
WINDOW, FAN_IN = 100_000, 8
#: A round that saves a smaller share of its underfull bins is the last one.
LEAST_GAIN = 0.005

PIECE = [("known", "<i2"), ("doc_id", "<i8"), ("piece", "<i4"), ("start", "<i8"), ("length", "<i4"), ("crc", "<u4")]
ITEM = pa.schema([("used", pa.int32()), ("members", pa.binary())])
BIN = pa.schema([("used", pa.int32()), ("members", pa.binary()), ("full", pa.bool_()), ("sequence_id", pa.int64())])
PLACED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PLACED_DDL = ("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each item, longest first, goes into the open bin
    that it leaves least room in.  Bit ``r`` of ``open_`` is set while a bin
    with ``r`` free places exists, so the best bin is one shift away."""
    by_room: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    open_ = 0
    for i in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        fits = open_ >> sizes[i]
        if fits:
            room = sizes[i] + (fits & -fits).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                open_ &= ~(1 << room)
        else:
            room, chosen = capacity, []
            bins.append(chosen)
        chosen.append(i)
        left = room - sizes[i]
        by_room[left].append(chosen)
        open_ |= 1 << left
    return bins


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """One item per piece: a document's ids with its end id, cut every
    ``capacity`` ids only if it has more."""
    def cut(batches):
        encoder = loaded(WordLevel, tokenizer)
        end, width = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for b in batches:
            used, members = [], []
            for doc_id, ids in zip(b.column(0).to_pylist(), encoder.encode(texts_of(b.column(1)))):
                ids += end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    used.append(len(part) // 4)
                    members.append(np.array([(doc_id is not None, doc_id or 0, k, at // 4, len(part) // 4,
                                              zlib.crc32(part))], dtype=PIECE).tobytes())
            yield batch_of(ITEM, [used, members])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "used int, members binary")


def _pack(capacity: int, turn: int, last: bool):
    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        held: list[tuple[int, bytes]] = []

        def emit(final: bool):
            nonlocal held, made
            held.sort(key=lambda x: (-x[0], x[1]))  # the same bins if the task runs again
            packed = best_fit([u for u, _ in held], capacity)
            out, rest = [], []
            for items in packed:
                used, members = sum(held[i][0] for i in items), b"".join(held[i][1] for i in items)
                full = last or capacity - used <= SLACK
                if full or final:
                    out.append((used, members, full, (turn << 58) + (task << 28) + made))
                    made += 1
                else:
                    rest.append((used, members))
            held = rest
            if out:
                yield batch_of(BIN, list(zip(*out)))

        grown = 0
        for b in batches:
            held += zip(b.column(0).to_pylist(), b.column(1).to_pylist())
            if len(held) >= WINDOW + grown:
                yield from emit(False)
                grown = len(held)
                if grown > WINDOW:  # underfull bins that nothing fills: on to the next round
                    yield from emit(True)
                    grown, held = 0, []
        if held:
            yield from emit(True)
    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece.

    Every document has at least its end id, so null and empty texts are
    pieces of length 1; null ids stay null; repeated rows are packed each;
    an empty table gives no rows; other columns are ignored.  Sequence ids are
    unique numbers without meaning; offsets are gapless from 0 in each.
    """
    items = written(pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    tasks, turn, done = max(1, items.rdd.getNumPartitions()), 0, []
    count = None
    while True:
        last = tasks == 1 and count is not None and count <= WINDOW
        bins = written(items.mapInArrow(_pack(capacity, turn, last),
                                        "used int, members binary, full boolean, sequence_id long"), "bins")
        left = bins.where("not full").count()
        stuck = count is not None and left > (1 - LEAST_GAIN) * count and tasks == 1
        if last or left == 0 or stuck:
            done.append(bins)
            break
        done.append(bins.where("full"))
        fewer = max(-(-tasks // FAN_IN), -(-left // WINDOW))
        if count is not None and fewer >= tasks and left > (1 - LEAST_GAIN) * count:
            done[-1] = bins  # as many tasks again and next to nothing saved
            break
        tasks, count, turn = fewer, left, turn + 1
        items = bins.where("not full").select("used", "members").repartition(tasks)
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every.select("members", "sequence_id").mapInArrow(_places, PLACED_DDL)


def _places(batches):
    for b in batches:
        for k in range(0, b.num_rows, 2000):
            some = b.slice(k, 2000)
            raw = some.column(0).to_pylist()
            rows = np.frombuffer(b"".join(raw), dtype=PIECE)
            each = np.array([len(r) for r in raw], dtype=np.int64) // rows.dtype.itemsize
            length = rows["length"].astype(np.int64)
            ends = np.cumsum(length)
            firsts = np.cumsum(each) - each
            base = np.repeat((ends - length)[firsts], each)
            yield batch_of(PLACED, [pa.array(rows["doc_id"], mask=rows["known"] == 0), rows["piece"], rows["start"], length,
                                    rows["crc"].astype(np.int64),
                                    np.repeat(some.column(1).to_numpy(zero_copy_only=False), each), ends - length - base])
