"""Legacy archive converter: ARC archives (versions 1 and 2) are parsed by their version's
header lines and declared lengths; every record gets an equivalent WARC identifier,
timestamp, type and digest, equal payloads become revisits, and WARC archives are written
and read back.

An archive is one file and one row of the written table, of about ``ARCHIVE_BYTES`` before
compression, so a task holds one archive at a time."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm.common import sized, written
from zoneflow.session import shared_path

ARCHIVE_BYTES = 8 << 20
MIN_REVISIT_BYTES = 0
# Header fields by ARC version (fixed values of the format; archive-length is always last).
ARC_FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "result", "checksum", "location", "offset", "filename", "length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
END = b"\r\n\r\n"
RECORD = ("record_id string, kind string, uri string, ip string, date string, mime string, head binary, payload binary, "
          "digest string, payload_bytes long, page_id long, truncated boolean")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def _pack(records: Iterator[bytes], first, joint: bytes, limit: int) -> Iterator[bytes]:
    """Archives of at most ``limit`` bytes (or one longer record); ``first()`` opens each."""
    held, size = [], 0
    for r in records:
        if held and size + len(r) > limit:
            yield joint.join([first(), *held])
            held, size = [], 0
        held.append(r)
        size += len(r) + len(joint)
    if held:
        yield joint.join([first(), *held])


def _archives(df: DataFrame, run, joint: str, path: str) -> None:
    """One file a row; the text writer ends each with ``joint``, as both formats ask. The
    files are gzipped at the fastest level; the default one took most of the JVM's time."""
    out = df.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    out.write.option("maxRecordsPerFile", 1).option("lineSep", joint).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").mode("overwrite").text(path)


def write_arc(pages: DataFrame, path: str, limit: int = ARCHIVE_BYTES) -> None:
    """Stand-in input: ARC archives with one HTTP response a row of ``pages`` (``page_id, url,
    html``; null html is an empty body, white space in a URL is percent-encoded, a null URL is
    ``-``). Archives alternate between both versions."""
    def run(batches):
        state = {"version": 2}

        def first() -> bytes:
            state["version"] = 3 - state["version"]
            names = "URL IP-address Archive-date Content-type" + " Result-code Checksum Location Offset Filename" * (state["version"] == 2) + " Archive-length"
            body = f"{state['version']} 0 zoneflow\n{names}\n".encode()
            tail = " 200 - - 0 -" if state["version"] == 2 else ""
            return f"filedesc://zoneflow.arc 0.0.0.0 20240101000000 text/plain{tail} {len(body)}\n".encode() + body

        def records():
            for b in batches:
                for i, url, html in zip(*(b.column(c) for c in ("page_id", "url", "html"))):
                    html, i = (html.as_py() or "").encode("utf-8", "surrogatepass"), i.as_py()
                    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (f"X-Page-Id: {i}\r\n" if i is not None else "") + f"Content-Length: {len(html)}\r\n\r\n"
                    yield re.sub(r"\s", lambda m: "".join(f"%{x:02X}" for x in m[0].encode()), url.as_py() or "-"), head.encode() + html

        def lines():  # the header line depends on the archive that a record lands in
            held, size = [], 0
            for url, body in records():
                if held and size + len(body) > limit:
                    yield held
                    held, size = [], 0
                held.append((url, body))
                size += len(body) + len(url) + 64
            if held:
                yield held
        for held in lines():
            start = first()
            tail = " 200 - - 0 -" if state["version"] == 2 else ""
            data = b"\n".join([start, *(f"{u} 0.0.0.0 20240101000000 text/html{tail} {len(x)}\n".encode("utf-8", "surrogatepass") + x for u, x in held)])
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["archive"])
    _archives(pages.select("page_id", "url", "html"), run, "\n", path)


def parse_arc(data: bytes, name: str = "") -> Iterator[dict]:
    """Records of one ARC archive: the fields of the version's header line, ``offset_`` and
    ``content``; ``filedesc`` blocks set the version. A record whose declared length passes the
    end is ``truncated``; a header line that fits no version raises ValueError."""
    at, version = 0, 1
    while at < len(data):
        if data[at:at + 1] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else len(data)].decode("utf-8", "surrogateescape").rstrip("\r")
        if line.startswith("filedesc://"):
            length = int(line.rsplit(" ", 1)[1])
            body = data[end + 1:end + 1 + length]
            version = int(body.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"{name}: unknown ARC version {version} at byte {at}")
        else:
            fields = ARC_FIELDS[version]
            parts = line.rsplit(" ", len(fields) - 1)
            if end < 0 or len(parts) != len(fields) or not parts[-1].isdigit():
                raise ValueError(f"{name}: no header line of ARC version {version} at byte {at}")
            length = int(parts[-1])
            content = data[end + 1:end + 1 + length]
            yield dict(zip(fields, parts)) | {"offset_": at, "content": content, "truncated": len(content) < length}
        at = end + 1 + length


def warc_date(arc_date: str) -> str:
    """``YYYYMMDDhhmmss`` (shorter dates: the first of the period) as WARC timestamp."""
    d = (arc_date + "00000101000000"[len(arc_date):])[:14] if len(arc_date) < 14 else arc_date[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _gunzip(data: bytes) -> bytes:
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def convert(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Rows of RECORD, one for each record of the ARC archives under ``path`` (``payload``
    False leaves head and payload null). The identifier is derived from archive name and
    offset; the type is response for HTTP content, else resource."""
    def run(batches):
        for b in batches:
            for name, content in zip(b.column("path"), b.column("content")):
                name = name.as_py().rsplit("/", 1)[-1]
                out = []
                for r in parse_arc(_gunzip(content.as_py()), name):
                    http = r["content"].startswith(b"HTTP/")
                    head, mark, body = r["content"].partition(END) if http else (b"", b"", r["content"])
                    if http and not mark:
                        head, mark, body = r["content"], END, b""
                    key = re.search(rb"(?im)^X-Page-Id: *(-?\d+)\r?$", head)
                    out.append((f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{r['offset_']}')}", "response" if http else "resource", r["url"], r["ip"], warc_date(r["date"]), r["mime"],
                                head + mark if payload else None, body if payload else None, sha1_base32(body), len(body), int(key[1]) if key else None, r["truncated"]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _types())], names=_names()) if out else pa.RecordBatch.from_arrays([pa.array([], t) for t in _types()], names=_names())
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, RECORD)


def _names() -> list[str]:
    return [x.strip().split()[0] for x in RECORD.split(",")]


def _types() -> list[pa.DataType]:
    kinds = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_()}
    return [kinds[x.strip().split()[1]] for x in RECORD.split(",")]


def revisits(light: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``record_id, refers_to_id`` of the records that revisit another: of records with equal
    payload digest and length (of ``min_bytes`` or more) the one with the smallest page id
    (null ids last, then smallest record id) is referred to by all others."""
    keyed = light.where(F.col("payload_bytes") >= min_bytes).select("digest", "payload_bytes", F.struct(F.col("page_id").isNull(), "page_id", "record_id").alias("place"))
    first = keyed.groupBy("digest", "payload_bytes").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = keyed.join(first.drop("n"), ["digest", "payload_bytes"])
    return pairs.select(F.col("place.record_id").alias("record_id"), F.col("first.record_id").alias("refers_to_id")).where("record_id != refers_to_id")


def write_warc(records: DataFrame, path: str, limit: int = ARCHIVE_BYTES) -> None:
    """WARC 1.0 archives of RECORD rows with ``refers_to_id`` (null: a record of its own).
    Each opens with a warcinfo record; a revisit keeps the HTTP head and drops the payload."""
    def record(fields: list[tuple], block: bytes) -> bytes:
        lines = [f"{k}: {v}" for k, v in fields if v is not None]
        return ("WARC/1.0\r\n" + "\r\n".join(lines) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode("utf-8", "surrogateescape") + block

    def run(batches):
        def info() -> bytes:
            return record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, path)}>"), ("WARC-Date", "2024-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")], b"software: zoneflow\r\nformat: WARC File Format 1.0\r\n")

        def records():
            for b in batches:
                for row in range(b.num_rows):
                    r = {n: b.column(n)[row].as_py() for n in b.schema.names}
                    again = r["refers_to_id"]
                    block = r["head"] if again else r["head"] + r["payload"]
                    http = r["kind"] == "response"
                    yield record([("WARC-Type", "revisit" if again else r["kind"]), ("WARC-Record-ID", f"<{r['record_id']}>"), ("WARC-Date", r["date"]), ("WARC-Target-URI", r["uri"]), ("WARC-IP-Address", r["ip"]),
                                  ("WARC-Payload-Digest", f"sha1:{r['digest']}"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"), ("WARC-Truncated", "length" if r["truncated"] else None),
                                  ("WARC-Refers-To", f"<{again}>" if again else None), ("WARC-Profile", REVISIT_PROFILE if again else None), ("X-Payload-Length", r["payload_bytes"]),
                                  ("X-Page-Id", r["page_id"]), ("Content-Type", "application/http; msgtype=response" if http else r["mime"])], block)
        for data in _pack(records(), info, END, limit):
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["archive"])
    _archives(records, run, "\r\n\r\n", path)


def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(header, block) of each record, by declared lengths."""
    at = 0
    while at < len(data):
        end = data.find(END, at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(": ", 1) for x in data[at:end].decode("utf-8", "surrogateescape").split("\r\n")[1:])
        at = end + 4 + int(head["Content-Length"])
        yield head, data[end + 4:at]
        if data[at:at + 4] != END:
            raise ValueError(f"a WARC record does not end at byte {at}")
        at += 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, page_id, payload_bytes, payload_digest, record_type, refers_to_id`` of the
    response, resource and revisit records under ``path``. Block digests are checked, and the
    payload digests of records that hold their payload; a difference raises ValueError."""
    def run(batches):
        for b in batches:
            for content in b.column("content"):
                out = []
                for head, block in parse_warc(_gunzip(content.as_py())):
                    kind = head["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    payload = block.partition(END)[2] if kind == "response" else block
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Block-Digest"] != f"sha1:{sha1_base32(block)}" or kind != "revisit" and sha1_base32(payload) != digest:
                        raise ValueError(f"digest of {head['WARC-Record-ID']} differs")
                    refers = head.get("WARC-Refers-To")
                    out.append((head["WARC-Record-ID"].strip("<>"), int(head["X-Page-Id"]) if "X-Page-Id" in head else None, int(head["X-Payload-Length"]) if kind == "revisit" else len(payload), digest, kind, refers.strip("<>") if refers else None))
                cols = list(zip(*out)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()))],
                                                 names=["record_id", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to_id"])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, "record_id string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to_id string")


def convert_archives(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """ARC archives under ``arc_path`` to WARC archives under ``warc_path``. The first pass
    takes digests only. Payloads are not shuffled while the list of revisits is small enough
    to broadcast, and once, by record, beyond that."""
    light = written(convert(spark, arc_path, payload=False).select("record_id", "digest", "payload_bytes", "page_id"), "arc-digests")
    again = written(revisits(light, min_bytes), "arc-revisits")
    write_warc(convert(spark, arc_path).join(sized(again), "record_id", "left"), warc_path)


def archive_pages(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages through ARC and WARC archives and back: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``.

    Every row of ``pages`` is a record, repeated rows and null ids included (a null id comes
    back null and is never preferred as the response); null html is an empty payload, which
    takes part in revisits like any other; other columns are ignored; an empty table gives
    none.
    """
    spark = pages.sparkSession
    arc, warc = shared_path(spark, "llm", "arc"), shared_path(spark, "llm", "warc")
    write_arc(pages, arc)
    convert_archives(spark, arc, warc, min_bytes)
    rows = written(read_warc(spark, warc), "warc-rows")
    target = rows.where("record_type != 'revisit'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    return rows.join(target, "refers_to_id", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id")
