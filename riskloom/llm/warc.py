"""WARC archives with an external index merge (operator 5).

Every task writes the pages it holds as one archive (one gzip member per
record) in the order of its captures, by URL key and time, and gives a sorted
run of index entries.  The runs are cut by key ranges, and each range is merged
from its runs by a loser tree, which gives capture histories in global order.
The archives are then read back record by record through that index.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SharedFile, batch_of, new_folder, open_shared, read_exactly, written

#: Payloads under this many bytes are never revisits.
LEAST_REVISIT = 100
#: Index entries that one merge task holds.
MERGE_ROWS = 100_000
ROLL_BYTES = 256 << 20
LEVEL = 3

ENTRY = pa.schema([("url_key", pa.string()), ("ts", pa.int64()), ("record", pa.string()), ("path", pa.string()),
                   ("offset", pa.int64()), ("size", pa.int64()), ("run", pa.int64()), ("seq", pa.int64())])
ENTRY_DDL = "url_key string, ts long, record string, path string, offset long, size long, run long, seq long"
RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("ts", pa.int64()),
                    ("url_key", pa.string()), ("ordinal", pa.int64())])
#: What a record itself says.
PARSED = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "ts")
RECORD_DDL = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
              "url string, ts long, url_key string, ordinal long")


class LoserTree:
    """k-way merge of sorted iterators: an array holds the loser of each match,
    so the next winner costs one path to the root."""

    def __init__(self, runs: list):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(self.runs))
        self.heads = [next(r, None) for r in self.runs] or [None]
        self.losers = [0] * self.k
        self.losers[0] = self._play(1)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        winner, self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        return winner

    def __iter__(self):
        while True:
            winner = self.losers[0]
            if self.heads[winner] is None:
                return
            yield self.heads[winner]
            self.heads[winner] = next(self.runs[winner], None)
            node = (winner + self.k) // 2
            while node:
                if self._beats(self.losers[node], winner):
                    winner, self.losers[node] = self.losers[node], winner
                node //= 2
            self.losers[0] = winner


def url_key(url: Column) -> Column:
    """The host's labels from the right, then the rest: ``org,example)/path``;
    urls without a host as they are, null as the empty key."""
    u = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(u, r"^[a-z][a-z0-9+.\-]*://([^/:?#]+)", 1)
    rest = F.regexp_extract(u, r"^[a-z][a-z0-9+.\-]*://[^/?#]*(.*)$", 1)
    return F.when(host == "", u).otherwise(F.concat(F.concat_ws(",", F.reverse(F.split(host, r"\."))), F.lit(")"), rest))


def revisits(pages: DataFrame) -> DataFrame:
    """``id, digest, refers_to`` of the rows that revisit an equal payload
    stored under a smaller id.  Only ids, digests and sizes are shuffled; the
    smallest id per digest is a combining aggregate."""
    named = pages.select("id", "digest").where((F.col("bytes") >= LEAST_REVISIT) & F.col("id").isNotNull())
    first = named.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    return (named.join(first, "digest").where("id > refers_to").select("id", "digest", "refers_to").distinct())


#: Capture times that a record can state: the years 1 to 9999.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def _date(ts: int) -> str:
    return dt.datetime.fromtimestamp(ts, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def record_bytes(page_id, url, ts: int, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member of its own."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Date: {_date(ts)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(http) + len(body)}"]
    member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return member.compress(("\r\n".join(lines) + "\r\n\r\n").encode() + http + body + b"\r\n\r\n") + member.flush()


def parse_record(data: bytes) -> dict:
    """The headers and payload of one record; a response whose payload does
    not have the digest it names is an error."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != stated):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: (lambda v: int(v) if v else None)(fields.get(name, "<urn:page:>")[10:-1])
    url = fields.get("WARC-Target-URI")
    return {"page_id": number("WARC-Record-ID"), "payload_bytes": stated, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"), "payload": payload,
            "url": url and url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%"),
            "ts": int(dt.datetime.fromisoformat(fields["WARC-Date"]).timestamp())}


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", ts: Column | None = None) -> DataFrame:
    """Writes a record per row into archives in ``folder``; returns the sorted
    index runs.  ``ts``: capture time in seconds (default: 0).

    Of records with equal payloads of ``LEAST_REVISIT`` bytes or more, rows
    with the smallest id are responses, the others revisit it; rows with a
    null id and smaller payloads are always responses.  Ids are any 64-bit
    numbers.  A capture time outside the years 1 to 9999 fails the job with the
    row's id and time; a null one is 0.  Null payloads are
    empty, null urls have no target header, repeated rows are written each,
    an empty table writes no archive; other columns are ignored.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.coalesce((F.lit(0) if ts is None else ts).cast("long"), F.lit(0)).alias("ts"))
    stated = F.when(F.col("ts").between(FIRST_SECOND, LAST_SECOND), F.col("ts")).otherwise(F.raise_error(F.concat(
        F.lit("no record can state the capture time of page "), F.coalesce(F.col("id").cast("string"), F.lit("null")),
        F.lit(": "), F.col("ts").cast("string"))))
    rows = rows.withColumn("ts", stated)
    known = rows.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("bytes"))
    marked = known.join(revisits(known), ["id", "digest"], "left").select(
        url_key(F.col("url")).alias("url_key"), "ts", "id", "url", "payload", "digest",
        "refers_to")

    def write(batches):
        task, out, seq, part = TaskContext.get().partitionId(), None, 0, 0
        for b in batches:
            entries = []
            for key, at, page_id, url, body, digest, refers in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    out = SharedFile(f"{folder}/run-{task:06d}-{part:04d}.warc.gz")
                data = record_bytes(page_id, url, at, body, digest, refers)
                entries.append((key, at, "" if page_id is None else str(page_id), out.uri, out.write(data), len(data),
                                task, seq))
                seq += 1
                if out.size >= ROLL_BYTES:
                    out.close()
                    out, part = None, part + 1
            yield batch_of(ENTRY, list(zip(*entries)) or [[]] * 8)
        if out is not None:
            out.close()

    ordered = marked.sortWithinPartitions("url_key", "ts", "id")
    return written(ordered.mapInArrow(write, ENTRY_DDL), "runs")


def merge_index(runs: DataFrame) -> DataFrame:
    """All index entries in global order of (URL key, time, record): ``shard``
    ascends with the key, ``position`` within it, ``ordinal`` over all.  Ranges also split by time
    and place, so one URL with many captures spreads over shards."""
    n = runs.count()

    def merge(batches):
        held: dict[int, list] = {}
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                held.setdefault(row[6], []).append(row)
        shard, out = TaskContext.get().partitionId(), []
        by_key = [((r[0], r[1], r[2], r[3], r[4]), r) for r in ()]
        runs_ = [[((r[0], r[1], r[2], r[3], r[4]), r) for r in rows] for rows in held.values()] or [by_key]
        for k, (_, row) in enumerate(LoserTree(runs_)):
            out.append((*row, shard, k))
            if len(out) >= 10_000:
                yield batch_of(merged, list(zip(*out)))
                out = []
        if out:
            yield batch_of(merged, list(zip(*out)))

    merged = pa.schema([*ENTRY, ("shard", pa.int32()), ("position", pa.int64())])
    ranges = (runs.repartitionByRange(max(1, -(-n // MERGE_ROWS)), "url_key", "ts", "record", "path", "offset")
              .sortWithinPartitions("run", "url_key", "ts", "record", "path", "offset"))
    index = written(ranges.mapInArrow(merge, ENTRY_DDL + ", shard int, position long"), "cdx")
    # One row per shard of about MERGE_ROWS entries: its place in the whole.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = index.groupBy("shard").agg(F.count("*").alias("entries"))
    starts = shards.select("shard", F.coalesce(F.sum("entries").over(before), F.lit(0)).alias("start"))
    return index.join(starts, "shard").withColumn("ordinal", F.col("start") + F.col("position")).drop("start")


def read_archives(index: DataFrame) -> DataFrame:
    """Every record that the index names, read from its archive and checked,
    with its place in the global order (``url_key, ordinal``).  Entries
    are dealt by archive and stretch of it, and read in file order."""
    files = max(1, min(index.select("path").distinct().count() * 4, 4096))

    def read(batches):
        path = handle = None
        for b in batches:
            out = []
            for name, offset, size, *place in zip(*(c.to_pylist() for c in b.columns)):
                if name != path:
                    if handle is not None:
                        handle.close()
                    path, handle = name, open_shared(name)
                handle.seek(offset)
                r = parse_record(read_exactly(handle, size))
                out.append((*(r[c] for c in PARSED), *place))
            yield batch_of(RECORD, list(zip(*out)) or [[]] * len(RECORD))
        if handle is not None:
            handle.close()

    stretch = F.floor(F.col("offset") / (16 << 20))
    return (index.select("path", "offset", "size", "url_key", "ordinal").repartition(files, "path", stretch)
            .sortWithinPartitions("path", "offset").mapInArrow(read, RECORD_DDL))


def write_and_read(pages: DataFrame, ts: Column) -> DataFrame:
    folder = new_folder(pages.sparkSession, "warc")
    return read_archives(merge_index(write_archives(pages, folder, ts=ts)))
