"""WARC archives of pages, and their index by an external merge of sorted capture runs.

Archives are written with each payload once: later copies are revisit records. Reading an
archive gives a run of captures, sorted by URL key and time. The runs are dealt to ranges
of the key, and in each range a loser tree merges what it has of each run, so that the
whole is in the order of URL keys and times.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagquality.llm import files
from tagquality.llm.common import scratch, sized, written

#: Payloads of fewer bytes are always stored whole.
LEAST_BYTES = 0
#: Captures in a range that a task merges, about.
RANGE_ROWS = 50_000
CHUNK = 1 << 20

#: Fixed values of the format.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BREAK = "\r\n\r\n"

CAPTURE = (
    "url_key string, captured_at string, page_id long, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, archive string, offset long, length long"
)


def _base32(hex20: Column) -> Column:
    """Base32 of 20 bytes in hex: 5 hex digits make 4 characters."""
    def char(i: int) -> Column:
        bits = F.conv(F.substring(hex20, 5 * (i // 4) + 1, 5), 16, 10).cast("int")
        return F.substring(F.lit(BASE32), F.shiftright(bits, 15 - 5 * (i % 4)).bitwiseAND(31) + 1, F.lit(1))

    return F.concat(*map(char, range(32)))


def write_archives(pages: DataFrame, path: str) -> None:
    """A WARC file for each partition of `pages` (page_id, url, html), with a record for each row.

    Of records with equal payloads of at least LEAST_BYTES bytes the one with the smallest
    page_id is a response, and the others revisit it; rows that repeat that page_id are all
    responses. Rows without an id refer to the smallest id, if there is one. A null html is an
    empty payload; a null url has no URI line.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn("size", F.octet_length("payload"))
    same = rows.where(F.col("size") >= LEAST_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    same = written(same.where("n > 1").drop("n"), "copies")
    rows = rows.join(sized(same), "digest", "left")
    again = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    named = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    date = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1 << 31))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    uri = F.regexp_replace("url", r"[\x00-\x1f]", " ")
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), named("page_id")),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), _base32(F.col("digest"))),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), named("first"))),
        F.when(again, F.lit(f"WARC-Profile: {PROFILE}")),
        # An extension field: the bytes of the payload that the record does not repeat.
        F.when(again, F.concat(F.lit("X-Payload-Length: "), F.col("size"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.lit(len(HTTP)) + F.when(again, 0).otherwise(F.col("size"))),
    )
    record = F.concat(head, F.lit(BREAK), F.lit(HTTP), F.when(again, "").otherwise(F.col("payload")))
    files.write_flat(rows.select(record.alias("record")), "record", path, BREAK.encode())


def url_key(url: str | None) -> str:
    """The URL in the order of its host's parts, from the last: com,example)/path?query."""
    try:
        parts = urlsplit((url or "").strip())
        host = ",".join(reversed((parts.hostname or "").removeprefix("www.").split(".")))
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return url or ""
    query = f"?{parts.query}" if parts.query else ""
    return f"{host}{port}){(parts.path or '/').lower()}{query.lower()}"


def records(path: str) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, fields, block) of the records of an archive, read as a stream."""
    with files.opened(path) as file:
        held, offset = b"", 0

        def more(n: int) -> bytes:
            nonlocal held
            parts, have = [held], len(held)
            while have < n and (got := file.read(max(CHUNK, n - have))):
                parts.append(got)
                have += len(got)
            held = b"".join(parts)
            return held

        while more(1):
            while (end := held.find(b"\r\n\r\n")) < 0:
                if len(held) == len(more(len(held) + 1)):
                    raise ValueError(f"a record of {path} at {offset} has no end of its head")
            lines = held[:end].decode().split("\r\n")[1:]
            fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            size = int(fields["content-length"])
            length = end + 4 + size + 4
            if len(more(length)) < length:
                raise ValueError(f"a record of {path} at {offset} is cut off")
            yield offset, length, fields, held[end + 4 : end + 4 + size]
            held, offset = held[length:], offset + length


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def capture_key(row: dict) -> tuple:
    """The order of captures: URL key, time, page_id (null first), then place."""
    own = row["page_id"]
    return row["url_key"], row["captured_at"], own is not None, own or 0, row["archive"], row["offset"]


def _captures(path: str) -> list[dict]:
    found = []
    for offset, length, fields, block in records(path):
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        revisit = fields["warc-type"] == "revisit"
        payload = block.partition(b"\r\n\r\n")[2]
        if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"the payload of {fields['warc-record-id']} differs from its digest")
        found.append(
            {
                "url_key": url_key(fields.get("warc-target-uri")),
                "captured_at": fields["warc-date"],
                "page_id": _page(fields["warc-record-id"]),
                "payload_bytes": int(fields["x-payload-length"]) if revisit else len(payload),
                "payload_digest": digest,
                "record_type": fields["warc-type"],
                "refers_to": _page(fields.get("warc-refers-to")),
                "archive": path,
                "offset": offset,
                "length": length,
            }
        )
    return found


_ARROW = pa.schema(
    [
        ("url_key", pa.string()),
        ("captured_at", pa.string()),
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("archive", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == 1000:
            yield pa.RecordBatch.from_pylist(held, _ARROW)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, _ARROW)


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of the archives below `path`; those of an archive are a sorted run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("path").to_pylist():
                yield from _batches(iter(sorted(_captures(archive), key=capture_key)))

    return written(files.dealt(files.listed(spark, path).select("path")).mapInArrow(run, CAPTURE), "runs")


class LoserTree:
    """Merges k sorted runs: inner nodes hold the losers of their matches, the top the winner.

    A step replays the winner's path only, a comparison on each level.
    """

    def __init__(self, runs: list[Iterator[dict]], key) -> None:
        self.runs, self.key = runs, key
        self.heads: list[tuple | None] = []
        for k in range(len(runs)):
            self.heads.append(self._next(k))
        self.losers = [-1] * max(1, len(runs))
        for k in range(len(runs)):
            self._replay(k, first=True)

    def _next(self, k: int) -> tuple | None:
        row = next(self.runs[k], None)
        return None if row is None else (self.key(row), k, row)

    def _before(self, a: int, b: int) -> bool:
        """Whether run `a` comes before run `b`; a run that has ended comes last."""
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x[:2] < y[:2])

    def _replay(self, k: int, first: bool = False) -> None:
        node = (k + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0 and first:
                self.losers[node] = k  # waits for the winner of the other side
                return
            if other >= 0 and self._before(other, k):
                self.losers[node], k = k, other
            node //= 2
        self.losers[0] = k

    def __iter__(self) -> Iterator[dict]:
        while self.runs and (head := self.heads[self.losers[0]]) is not None:
            yield head[2]
            self.heads[head[1]] = self._next(head[1])
            self._replay(head[1])


def merged(runs: DataFrame) -> DataFrame:
    """The captures of all runs in one order, from partition to partition and within each.

    Ranges are of the whole order, so that a URL with many captures is spread over several;
    a task holds its range of the runs, about RANGE_ROWS captures.
    """
    order = ["url_key", "captured_at", "page_id", "archive", "offset"]
    ranges = max(1, -(-runs.count() // RANGE_ROWS))
    dealt = runs.repartitionByRange(ranges, *order).sortWithinPartitions("archive", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.RecordBatch]] = {}
        for batch in batches:
            archive = batch.column("archive").to_pylist()
            start = 0
            for k in range(1, len(archive) + 1):
                if k == len(archive) or archive[k] != archive[start]:
                    held.setdefault(archive[start], []).append(batch.slice(start, k - start))
                    start = k
        rows = lambda parts: (row for part in parts for k in range(0, part.num_rows, 64) for row in part.slice(k, 64).to_pylist())
        yield from _batches(iter(LoserTree([rows(parts) for parts in held.values()], capture_key)))

    return dealt.mapInArrow(run, CAPTURE)


def page_captures(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, captured_at, place).

    Writes `pages` to archives and returns what reading them back gives, in the order of
    URL keys and times; a row for each row of `pages`. See `write_archives` for nulls,
    equal payloads and repeated rows. Other columns are ignored.
    """
    path = scratch(pages.sparkSession, "archives")
    write_archives(pages, path)
    return merged(capture_runs(pages.sparkSession, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at", "offset", "length"
    )
