"""WARC archives that are read through their index.

Writing. Every task writes archives of its rows (gzip member per record,
rolled at ``ROLL_BYTES``) into the shared folder and returns an index row per
record: archive, offset, length, URL, digest. The index, a Parquet table, is
what makes an archive count: a task that runs again writes archives under new
names, and what a lost attempt left is never named by the index.

Equal payloads are kept once: the row with the largest id becomes a
``response`` record, the others ``revisit`` records that refer to it and hold
HTTP headers only. Which payloads repeat is settled on their hashes first and
kept as a table of only these; while Spark finds it small enough to broadcast,
no page is shuffled (beyond that, pages join it by hash, and AQE splits a hot
one).

Reading. The index rows of the wanted records are dealt in ranges of
(archive, offset) and sorted; neighbours less than ``GAP`` bytes apart become
one ranged read of at most ``READ_BYTES`` (or one record), and records are cut
from it. No archive is ever listed or read from end to end.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import small_batches, written
from cohortlens.session import checkpoint_dir

#: Size from which a task begins another archive.
ROLL_BYTES = 1 << 30
#: Bytes between two wanted records that are read rather than skipped, and
#: the most that one ranged read of several records takes.
GAP, READ_BYTES = 64 << 10, 8 << 20

INDEX = ("archive string, offset long, length long, record_type string, url string, payload_digest string, "
         "page_id long, refers_to long")
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(folder: str):
    """``(file system, path)`` of a folder that all machines share."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", folder))


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def base32_sha1(data: bytes) -> str:
    return _base32(hashlib.sha1(data).digest())


def record_id(page_id: int | None, name: str) -> str:
    """The page's id stands in it, so that a reference can be followed."""
    return f"<urn:page:{'' if page_id is None else page_id}:{name}>"


def _response_name(url: str | None, sha1: str) -> str:
    """Names a response that others refer to: no other record of its id
    has both this URL and this payload."""
    return hashlib.md5(f"{sha1}:{url!r}".encode("utf-8", "surrogatepass")).hexdigest()


def _page_of(urn: str | None) -> int | None:
    page = urn.split(":")[2] if urn else ""
    return int(page) if page else None


def _header_value(text: str) -> str:
    """A URL as a header can hold it: white space and controls escaped."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _record(kind: str, fields: dict[str, str | None], block: bytes, date: str) -> bytes:
    fields = {"WARC-Type": kind, "WARC-Date": date, **fields, "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
              "Content-Length": str(len(block))}
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def page_record(row: dict, date: str) -> bytes:
    """The record of a row of ``with_types``."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    name = _response_name(row["url"], row["sha1"]) if row["referred"] else uuid.uuid4().hex
    fields = {"WARC-Record-ID": record_id(row["page_id"], name),
              "WARC-Target-URI": None if row["url"] is None else _header_value(row["url"]),
              "WARC-Payload-Digest": "sha1:" + _base32(bytes.fromhex(row["sha1"])), "Content-Type": "application/http; msgtype=response"}
    if row["record_type"] == "revisit":
        fields |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": record_id(row["refers_to"], _response_name(row["refers_url"], row["sha1"])),
                   "WARC-Refers-To-Target-URI": None if row["refers_url"] is None else _header_value(row["refers_url"])}
    else:
        block += row["payload"]
    return _record(row["record_type"], fields, block, date)


def _parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    length = int(fields["Content-Length"])
    if version != "WARC/1.1" or len(rest) != length + 4:
        raise ValueError("not a whole WARC record")
    return fields, rest[:length]


def parse_page(record: bytes) -> dict:
    """A page's record as ``RECORD``'s columns. The digest and the size of
    a response are those of its payload as read, which must match its
    header; a revisit states the payload that it repeats."""
    fields, block = _parsed(record)
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return {"page_id": _page_of(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": _page_of(fields.get("WARC-Refers-To")),
            "payload": payload if response else None}


# ---------------------------------------------------------------- writing

def with_types(pages: DataFrame, at_least: int = 0) -> DataFrame:
    """Rows to write: ``page_id, url, record_type, payload_bytes, sha1,
    payload, referred, refers_to, refers_url``. Of rows with equal payloads of
    at least ``at_least`` bytes the one with the largest ``page_id`` (nulls
    least; then the largest URL) is the response. Rows that equal it in id
    and URL as well are counted; all but one revisit it."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "key": F.sha2("payload", 256), "sha1": F.sha1("payload")})
    large = F.col("payload_bytes") >= at_least
    repeated = written(
        rows.filter(large).groupBy("key", "page_id", "url").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("key").agg(F.sum("n").alias("rows"), F.max(F.struct("page_id", "url", "n")).alias("head"))
        .filter("rows > 1").select(F.col("key").alias("of"), "head"), "repeated-payloads")
    joined = rows.join(repeated, (F.col("key") == F.col("of")) & large, "left")
    is_head = F.col("page_id").eqNullSafe(F.col("head.page_id")) & F.col("url").eqNullSafe(F.col("head.url"))
    several = F.col("of").isNotNull() & is_head & (F.col("head.n") > 1)
    again = F.col("of").isNotNull() & ~is_head

    def typed(df, again):
        return df.select(
            "page_id", "url", F.when(again, "revisit").otherwise("response").alias("record_type"), "payload_bytes",
            "sha1", F.when(~again, F.col("payload")).alias("payload"), (~again & F.col("head").isNotNull()).alias("referred"),
            F.when(again, F.col("head.page_id")).alias("refers_to"),
            F.when(again, F.col("head.url")).alias("refers_url"))

    out = typed(joined.filter(~several), again)
    if repeated.filter("head.n > 1").isEmpty():
        return out
    equal = joined.filter(several).groupBy("key", "page_id", "url").agg(
        F.first("payload_bytes").alias("payload_bytes"), F.first("sha1").alias("sha1"), F.first("payload").alias("payload"),
        F.first("head").alias("head"))
    equal = equal.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("head.n") - 1).cast("int"))))
    return out.unionByName(typed(equal, F.col("copy") > 0))


def write_archives(pages: DataFrame, folder: str, at_least: int = 0, level: int = 6, date: str | None = None) -> DataFrame:
    """Write a record for every row of ``page_id, url, html`` into archives
    in ``folder`` and return the index, itself kept as ``folder``/index.

    A null html is an empty payload, a null URL is left out of the header
    and null in the index, a null id stays null. Every row gets a record of
    its own, repeated rows as well; other columns are ignored. An empty
    table gives an empty index."""
    spark = pages.sparkSession
    small_batches(spark)
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    store, path = filesystem(folder)
    store.create_dir(path, recursive=True)

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = filesystem(folder)
        out, name, at = None, "", 0

        def put(record: bytes) -> tuple[int, int]:
            nonlocal at
            pack = zlib.compressobj(level, zlib.DEFLATED, 31)
            member = pack.compress(record) + pack.flush()
            out.write(member)
            at += len(member)
            return at - len(member), len(member)

        try:
            for batch in it:
                index = []
                for row in batch.to_pylist():
                    if out is None or at >= ROLL_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{path}/{name}", compression=None)
                        put(_record("warcinfo", {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Filename": name,
                                                 "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n", date))
                    offset, length = put(page_record(row, date))
                    index.append({"archive": name, "offset": offset, "length": length, "record_type": row["record_type"],
                                  "url": row["url"], "payload_digest": _base32(bytes.fromhex(row["sha1"])),
                                  "page_id": row["page_id"], "refers_to": row["refers_to"]})
                if index:
                    yield pa.RecordBatch.from_pylist(index, schema=_arrow(INDEX))
        finally:
            if out is not None:
                out.close()

    index = f"{folder.rstrip('/')}/index"
    with_types(pages, at_least).mapInArrow(write, INDEX).write.parquet(index)
    return spark.read.schema(INDEX).parquet(index)


def _arrow(columns: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))])


# ---------------------------------------------------------------- reading

def ranges(rows: list[dict], gap: int = GAP, most: int = READ_BYTES) -> Iterator[list[dict]]:
    """Runs of index rows, sorted by archive and offset, that one ranged
    read fetches."""
    run: list[dict] = []
    for row in rows:
        if run and (row["archive"] != run[0]["archive"] or row["offset"] - (run[-1]["offset"] + run[-1]["length"]) > gap
                    or row["offset"] + row["length"] - run[0]["offset"] > most):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def read_records(index: DataFrame, folder: str, payload: bool = True, per_task: int = 64 << 20) -> DataFrame:
    """The records that ``index`` (any rows of the index) names, each as
    often as it is named. The payload of a revisit is null (it stands with
    the response that ``refers_to`` names); ``payload=False`` checks
    payloads but returns none. An empty selection gives an empty result."""
    spark = index.sparkSession
    small_batches(spark)
    wanted = index.select("archive", "offset", "length", "url")
    total = wanted.agg(F.sum("length")).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-total // per_task))
    columns = RECORD if payload else RECORD.removesuffix(", payload binary")

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = filesystem(folder)
        file, name = None, None
        for batch in it:
            for run in ranges(batch.to_pylist()):
                if run[0]["archive"] != name:
                    name = run[0]["archive"]
                    file = store.open_input_file(f"{path}/{name}")
                start = run[0]["offset"]
                data = file.read_at(max(r["offset"] + r["length"] for r in run) - start, start)
                out = []
                for r in run:
                    member = data[r["offset"] - start:r["offset"] - start + r["length"]]
                    record = parse_page(zlib.decompress(member, 31)) | {"url": r["url"]}
                    if not payload:
                        del record["payload"]
                    out.append(record)
                yield pa.RecordBatch.from_pylist(out, schema=_arrow(columns))

    dealt = wanted.repartitionByRange(parts, "archive", "offset").sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(read, columns)


def round_trip(pages: DataFrame, at_least: int = 0) -> DataFrame:
    """Archive all pages in a folder of their own within the shared one, and
    read every record back."""
    folder = f"{checkpoint_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return read_records(write_archives(pages, folder, at_least), folder, payload=False)
