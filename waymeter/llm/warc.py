"""WARC archives of captures, and their capture histories by external merge of index runs.

Writing tasks put records into gzipped archives, one member per record. Reading an archive back gives its
index run, sorted by URL key and timestamp within the archive. The runs are cut at common key boundaries, and
the segments of one key range are merged by a tournament tree of losers: ranges in order and rows in order
within each give one global order, in which the captures of a URL lie together by time.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymeter.llm.shared import worker_folder, written

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
RANGE_ROWS = 200_000
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
ROLES = "page_id long, url string, html string, record_type string, refers_to long"
MANIFEST = "archive string, records long, bytes long"
CAPTURES = (
    "urlkey string, captured string, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, archive string, position long, length long"
)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query, in lower case; scheme, user, port, leading www and fragment
    are left out."""
    rest = re.sub("^[a-z][a-z0-9+.-]*://", "", (url or "").strip().lower()).partition("#")[0]
    host, tail = re.fullmatch("([^/?]*)(.*)", rest, re.DOTALL).groups()
    host = host.rpartition("@")[2].partition(":")[0].removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + tail


def capture_time(page_id: int | None) -> str:
    """The table holds no time: a page is taken to be captured as many seconds after EPOCH as its id says."""
    return (EPOCH + timedelta(seconds=(page_id or 0) % (1 << 32))).strftime("%Y-%m-%dT%H:%M:%SZ")


def roles(pages: DataFrame) -> DataFrame:
    """Each page with record_type and refers_to: of equal payloads of REVISIT_BYTES or more, the one with the
    largest page_id is the response. Partial maxima per payload; the join back is split by AQE where skewed. Smaller
    pages are dealt by their own keys, which no payload has."""
    digest, size = F.sha2(F.coalesce("html", F.lit("")), 256), F.octet_length(F.coalesce("html", F.lit("")))
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"),
    ).withColumn("long", size >= REVISIT_BYTES)
    own = F.concat(F.lit("page "), F.xxhash64("page_id", "url").cast("string"))
    rows = rows.withColumn("payload", F.when(F.col("long"), digest).otherwise(own))
    first = rows.where("long").groupBy("payload").agg(F.max("page_id").alias("response_id"))
    refers = F.when(F.col("response_id") > F.coalesce("page_id", F.lit(-(1 << 63))), F.col("response_id"))
    return rows.join(first, "payload", "left").select(
        "page_id", "url", "html",
        F.when(refers.isNull(), "response").otherwise("revisit").alias("record_type"),
        refers.alias("refers_to"),
    )


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, html: str | None, kind: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit holds the HTTP header of its payload and not the payload."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {capture_time(page_id)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub("[\r\n]+", " ", url))
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    else:
        block += payload
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Writes a record per row of ROLES and returns the manifest (archive, records, bytes).

    A task opens archives of about ARCHIVE_BYTES under names of its own, so an attempt that is lost or repeated
    leaves only a file that no manifest names. Other columns are not read; an empty table gives an empty one.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name, out, records, size = "", None, 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "records": pa.array([records], pa.int64()), "bytes": pa.array([size], pa.int64())})

        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, records, size = f"captures-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                gzip = zlib.compressobj(4, zlib.DEFLATED, 31)
                member = gzip.compress(record(*values)) + gzip.flush()
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return written(rows.select("page_id", "url", "html", "record_type", "refers_to").mapInArrow(write, MANIFEST), "warc-manifest")


def members(source) -> Iterator[tuple[int, int, bytes]]:
    """Offset, compressed length and content of every gzip member of an open file, one member in memory."""
    at, rest = 0, b""
    while True:
        gzip, parts, used = zlib.decompressobj(31), [], 0
        while not gzip.eof:
            rest = rest or source.read(1 << 20)
            if not rest:
                if used:
                    raise ValueError("the archive ends within a record")
                return
            parts.append(gzip.decompress(rest))
            used += len(rest) - len(gzip.unused_data)
            rest = gzip.unused_data
        yield at, used, b"".join(parts)
        at += used


def _page(text: str | None) -> int | None:
    found = re.fullmatch("<urn:x-page:(-?[0-9]+)>", text or "")
    return int(found[1]) if found else None


def capture(archive: str, position: int, length: int, content: bytes) -> tuple:
    """The index row of a record, from the record alone; a response's digest is checked against its payload."""
    head, _, block = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    url = fields.get("WARC-Target-URI")
    stamp = re.sub("[^0-9]", "", fields["WARC-Date"])
    return (
        url_key(url), stamp, _page(fields["WARC-Record-ID"]), url, fields["WARC-Type"], _page(fields.get("WARC-Refers-To")),
        size, digest, archive, position, length,
    )


def _order(row: tuple) -> tuple:
    """URL key, timestamp, then page and place, so that equal captures have one order too."""
    return row[0], row[1], row[2] is None, row[2] or 0, row[8], row[9]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


ARROW = pa.schema([
    (name, pa.string() if kind == "string" else pa.int64()) for name, kind in (f.split() for f in CAPTURES.split(", "))
])


def index_runs(manifest: DataFrame, folder: str) -> DataFrame:
    """Reads every archive of the manifest back; its captures come sorted by URL key and time: one run each.

    One task per archive: the manifest's rows are a few bytes, by which AQE would send them all to one task, so
    their number is given. A run holds index rows only, at most what one archive of bounded size has.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                with store.open_input_stream(f"{root}/{archive}", compression=None) as source:
                    run = sorted((capture(archive, *m) for m in members(source)), key=_order)
                for at in range(0, len(run), 10_000):
                    yield _batch(run[at:at + 10_000], ARROW)

    return manifest.select("archive").repartition(max(1, manifest.count())).mapInArrow(read, CAPTURES)


def merged(runs: list[list[tuple]]) -> Iterator[tuple]:
    """Merges sorted runs by a tree of losers: a node keeps the loser of its match and the winner moves up, so
    the next row costs one match per level."""
    k = len(runs)
    if k == 0:
        return
    places, keys = [0] * k, [_order(r[0]) for r in runs]
    done = (chr(0x10FFFF) + chr(0x10FFFF),)
    losers = [0] * k

    def build(node: int) -> int:
        if node >= k:
            return node - k
        a, b = build(2 * node), build(2 * node + 1)
        winner, losers[node] = (a, b) if (keys[a], a) <= (keys[b], b) else (b, a)
        return winner

    winner = build(1) if k > 1 else 0
    while keys[winner] is not done:
        yield runs[winner][places[winner]]
        places[winner] += 1
        at = places[winner]
        keys[winner] = _order(runs[winner][at]) if at < len(runs[winner]) else done
        node = (winner + k) // 2
        while node:
            rival = losers[node]
            if (keys[rival], rival) < (keys[winner], winner):
                losers[node], winner = winner, rival
            node //= 2


def histories(runs: DataFrame) -> DataFrame:
    """All captures in the order of URL key and timestamp, over the partitions and within each.

    Ranges are cut through hot URLs too (time and page belong to the key) and hold about RANGE_ROWS rows. A
    task takes its range's segments apart by run, each in the run's order, and merges them.
    """
    runs = written(runs, "warc-runs")
    ranges = max(1, -(-runs.count() // RANGE_ROWS))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                segments.setdefault(row[8], []).append(row)
        for segment in segments.values():
            segment.sort(key=_order)  # one pass over rows in order, unless a fetch brought blocks of a run out of turn
        out: list[tuple] = []
        for row in merged([segments[a] for a in sorted(segments)]):
            out.append(row)
            if len(out) == 10_000:
                yield _batch(out, ARROW)
                out = []
        if out:
            yield _batch(out, ARROW)

    keys = [F.col("urlkey"), F.col("captured"), F.col("page_id"), F.col("archive"), F.col("position")]
    return runs.repartitionByRange(ranges, *keys).mapInArrow(merge, CAPTURES)


def archived(pages: DataFrame) -> DataFrame:
    """Writes an archive record per page, reads the archives back and returns the ordered capture histories.

    Null html is an empty payload, a null url has the empty host's key, null page_ids have no id in the record
    and come back null. Rows that repeat a page_id stay: those with the largest id of a payload are responses,
    all of them. Other columns are not read; an empty table gives no rows.
    """
    folder = worker_folder(pages.sparkSession, "warc")
    return histories(index_runs(write_archives(roles(pages), folder), folder))
