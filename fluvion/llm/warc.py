"""Web archives with a two-level capture index.

Records go to one archive file a task (a gzip member each); equal payloads of at least a given size are stored once, as
the response of the capture with the largest page_id, the others being revisits. The captures, sorted by reversed-host
URL key, are cut into compressed blocks of lines; each index file ends with its own block directory, and the sparse top
level is one row for each index file. A look-up bisects the top level, then a file's directory, reads one block by its
byte range, and then the record by its range.

Cases: a null html is an empty payload; a null or unreadable URL has the empty key; rows may repeat: of equal payloads
one row alone is the response, the last by page_id, then URL; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import struct
import uuid
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, new_path, partitions, ship, worker_cache

BLOCK_LINES = 1000
STAMP = "2024-01-01T00:00:00Z"


def url_key(url: str | None) -> str:
    """Host reversed, a comma after each label, then ) and the path: sorts captures of a domain together."""
    try:
        u = urlsplit((url or "").strip())
        host = (u.hostname or "").lower().removeprefix("www.")
        port = f":{u.port}" if u.port and u.port not in (80, 443) else ""
    except ValueError:
        return ""
    if not host:
        return ""
    return ",".join(reversed(host.split("."))) + port + ")" + (u.path or "/").lower() + ("?" + u.query if u.query else "")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _files(path: str):
    """A file system and the path in it, for any scheme that pyarrow knows."""
    import pyarrow.fs as pf

    return pf.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pf.LocalFileSystem(), path)


def _record_id(page_id: int | None, row: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=((page_id or 0) % 2**64) << 64 | row % 2**64)}>"


def record(page: dict, kind: str) -> bytes:
    """One WARC 1.1 record as a gzip member."""
    payload = page["payload"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" if kind == "response" else b"HTTP/1.1 200 OK\r\n\r\n"
    block = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_record_id(page['page_id'], page['row'])}",
        f"WARC-Date: {STAMP}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page["url"] is not None:
        head.insert(3, "WARC-Target-URI: " + "".join(page["url"].splitlines()))
    if page["page_id"] is not None:
        head.append(f"X-Page-Id: {page['page_id']}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(page['first'], page['first_row'])}"]
        if page["first"] is not None:
            head.append(f"X-Refers-To-Page-Id: {page['first']}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> dict:
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    fields["payload"] = block.partition(b"\r\n\r\n")[2]
    return fields


def _write(folder: str):
    def run(batches):
        fs, base = _files(folder)
        fs.create_dir(base, recursive=True)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        for b in batches:
            rows = []
            for p in b.to_pylist():
                out = out or fs.open_output_stream(f"{base}/{name}", compression=None)
                p["payload"] = (p["html"] or "").encode("utf-8", "surrogatepass")
                kind = "response" if p["is_first"] else "revisit"
                member = record(p, kind)
                out.write(member)
                rows.append((url_key(p["url"]), p["row"], p["page_id"], name, at, len(member)))
                at += len(member)
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 6, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], ["key", "row", "page_id", "file", "at", "size"])
        if out:
            out.close()

    return run


def _index(folder: str):
    """Sorted captures to a file of compressed blocks; the file's directory and its length come last."""

    def run(batches):
        fs, base = _files(folder)
        fs.create_dir(base, recursive=True)
        name, at, out, directory, lines, first = f"{uuid.uuid4().hex}.cdx", 0, None, [], [], None

        def flush():
            nonlocal at, lines
            block = gzip.compress("\n".join(json.dumps(x) for x in lines).encode(), 6, mtime=0)
            out.write(block)
            directory.append((lines[0][0], lines[0][1], at, len(block)))
            at, lines = at + len(block), []

        for b in batches:
            for r in b.to_pylist():
                if out is None:
                    out, first = fs.open_output_stream(f"{base}/{name}", compression=None), (r["key"], r["row"])
                lines.append((r["key"], r["row"], r["page_id"], r["file"], r["at"], r["size"]))
                if len(lines) == BLOCK_LINES:
                    flush()
        if out:
            if lines:
                flush()
            tail = gzip.compress(json.dumps(directory).encode(), 6, mtime=0)
            out.write(tail + struct.pack("<Q", len(tail)))
            out.close()
            yield pa.record_batch([pa.array([first[0]]), pa.array([first[1]], pa.int64()), pa.array([name]), pa.array([at + len(tail) + 8], pa.int64())], ["key", "row", "index_file", "bytes"])

    return run


class Archive:
    """Folders of archives and index files, and the top level: (key, row, file, bytes) for each index file, sorted."""

    def __init__(self, folder: str, top: list[tuple[str, int, str, int]]):
        self.folder, self.top = folder, top


def write_archive(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> Archive:
    """Writes every row of pages and indexes the captures."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    rows = pages.select("page_id", "url", "html", F.monotonically_increasing_id().alias("_m"))
    # a row's own number: of its content, and then of its place among equal rows
    rows = rows.select("page_id", "url", "html", F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).alias("_d"), F.octet_length(F.coalesce("html", F.lit(""))).alias("_n"), "_m")
    held = keep(rows.select("page_id", "url", "html", "_d", "_n", F.col("_m").alias("row")), "warc_rows")
    best = held.where(F.col("_n") >= least_bytes).groupBy("_d").agg(F.max(F.struct("page_id", "url", "row")).alias("best"))
    best = best.select(F.col("_d").alias("_b"), F.col("best.page_id").alias("first"), F.col("best.row").alias("first_row"))
    chosen = held.join(best, F.col("_d") == F.col("_b"), "left").select("page_id", "url", "html", "row", "first", "first_row", F.coalesce(F.col("row") == F.col("first_row"), F.lit(True)).alias("is_first"))
    captures = keep(chosen.mapInArrow(_write(f"{folder}/archive"), "key string, row long, page_id long, file string, at long, size long"), "warc_captures")
    n = captures.count()
    parts = max(1, min(partitions(spark), -(-n // (4 * BLOCK_LINES))))
    top = captures.repartitionByRange(parts, "key", "row").sortWithinPartitions("key", "row").mapInArrow(_index(f"{folder}/index"), "key string, row long, index_file string, bytes long")
    # one row for each index file, no more than there are partitions
    return Archive(folder, sorted((r["key"], r["row"], r["index_file"], r["bytes"]) for r in top.collect()))


def find(archive: Archive, key: str, row: int | None = None) -> list[dict]:
    """The records of a key (and of one row number), by two bisections, a block read and a read for each record."""
    held = worker_cache("warc")
    if held.get("folder") != archive.folder:
        held.clear()
        held.update(folder=archive.folder, fs=_files(archive.folder), files={}, blocks={}, open={})
    fs, base = held["fs"]

    def at(name: str, start: int, size: int) -> bytes:
        if name not in held["open"]:
            if len(held["open"]) >= 64:
                held["open"].pop(next(iter(held["open"]))).close()
            held["open"][name] = fs.open_input_file(f"{base}/{name}")
        return held["open"][name].read_at(size, start)

    low = (key, row if row is not None else -1)
    out, i = [], max(0, bisect.bisect_right(archive.top, (*low, "\U0010ffff", 0)) - 1)
    while i < len(archive.top) and (archive.top[i][0], archive.top[i][1]) <= (key, row if row is not None else 2**63):
        name, size = archive.top[i][2], archive.top[i][3]
        if name not in held["files"]:
            (tail,) = struct.unpack("<Q", at(f"index/{name}", size - 8, 8))
            held["files"][name] = json.loads(gzip.decompress(at(f"index/{name}", size - 8 - tail, tail)))
        directory = held["files"][name]
        j = max(0, bisect.bisect_right(directory, [*low, 2**63, 0]) - 1)
        while j < len(directory) and tuple(directory[j][:2]) <= (key, row if row is not None else 2**63):
            if (name, j) not in held["blocks"]:
                if len(held["blocks"]) >= 32:
                    held["blocks"].pop(next(iter(held["blocks"])))
                held["blocks"][name, j] = [json.loads(x) for x in gzip.decompress(at(f"index/{name}", directory[j][2], directory[j][3])).decode().split("\n")]
            lines = held["blocks"][name, j]
            for x in lines[bisect.bisect_left(lines, [*low]) :]:
                if x[0] != key or (row is not None and x[1] != row):
                    break
                out.append(parse(at(f"archive/{x[3]}", x[4], x[5])))
            j += 1
        i += 1
    return out


def _read(archive: Archive):
    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                for f in find(archive, r["key"], r["row"]):
                    get = lambda k: int(f[k]) if k in f else None
                    kind = f["WARC-Type"]
                    if kind == "response" and (len(f["payload"]) != get("X-Payload-Length") or "sha1:" + digest(f["payload"]) != f["WARC-Payload-Digest"]):
                        raise ValueError("a payload read back differs from its digest")
                    out.append((get("X-Page-Id"), f.get("WARC-Target-URI"), get("X-Payload-Length"), f["WARC-Payload-Digest"].removeprefix("sha1:"), kind, get("X-Refers-To-Page-Id")))
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * 6, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()))], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return run


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every capture, looked up by its key: the keys of each index block in order, so blocks are read once."""

    def keys(batches):
        fs, base = _files(archive.folder)
        for b in batches:
            for name, size in zip(b["index_file"].to_pylist(), b["bytes"].to_pylist()):
                with fs.open_input_file(f"{base}/index/{name}") as f:
                    (tail,) = struct.unpack("<Q", f.read_at(8, size - 8))
                    for _, _, at, length in json.loads(gzip.decompress(f.read_at(tail, size - 8 - tail))):
                        lines = [json.loads(x) for x in gzip.decompress(f.read_at(length, at)).decode().split("\n")]
                        yield pa.record_batch([pa.array([x[0] for x in lines]), pa.array([x[1] for x in lines], pa.int64())], ["key", "row"])

    files = spark.createDataFrame([(t[2], t[3]) for t in archive.top], "index_file string, bytes long").repartition(max(1, len(archive.top)))
    return files.mapInArrow(keys, "key string, row long").mapInArrow(_read(archive), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def look_up(spark: SparkSession, archive: Archive, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The captures of each URL of a table."""

    def run(batches):
        for b in batches:
            k = [url_key(u) for u in b[url_col].to_pylist()]
            yield from _read_keys(archive, k)

    return urls.select(url_col).mapInArrow(run, "page_id long, url string, record_type string, payload binary")


def _read_keys(archive: Archive, keys: list[str]):
    rows = [(int(f["X-Page-Id"]) if "X-Page-Id" in f else None, f.get("WARC-Target-URI"), f["WARC-Type"], f["payload"]) for k in keys for f in find(archive, k)]
    yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.int64(), pa.string(), pa.string(), pa.binary()))], ["page_id", "url", "record_type", "payload"])


ship(__name__)
