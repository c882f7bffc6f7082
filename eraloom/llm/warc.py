"""WARC writing and reading, and a globally ordered capture index.

``write_archives`` makes one WARC record per page. Of pages with equal payloads the
one with the largest page_id is a response, the others are revisits that refer to
it. Every record is a gzip member of its own, so that an archive can be read from any
record's offset. Spark's text writer makes the files in the shared folder: a member's
last byte is the high byte of its size, zero under 16 MiB (a longer record is followed
by an empty member), and serves as the line end. A file holds ``records_per_file``
records at most, and fewer where payloads are large, so that a reader holds little.

``read_archives`` parses archives member by member by their length fields, recomputes
each payload's SHA-1, and gives one capture per record with its file, offset and
length; ``fetch`` gets payloads back by those alone.

``merge_index`` is an external merge: captures are sorted where they lie (runs),
dealt by range of URL key and timestamp into ranges of about ``rows_per_range``
captures, and each range merges its pieces of the runs with a loser tree. Ranges
follow each other, so the whole is ordered. The range key ends in the page id, so a
host or URL with a third of all captures is spread over ranges.

Defined cases: a null html is an empty payload and a null url an empty one; line
ends inside a URL are percent-encoded; rows that repeat a page_id with the same
payload are all responses if that id is the largest, else all revisits; rows that
repeat a page_id with different payloads are each judged by their own; a null
page_id is written as "null", counts as 0 for its time and comes back null, and is a response only if no
other row with an id has its payload; an empty table gives an empty archive and no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eraloom.plans.scratch import materialize, scratch_path

CRLF = "\r\n"
END = CRLF + CRLF
CAPTURE = "page_id long, url string, captured_at string, record_type string, refers_to long, payload_bytes long, payload_digest string, filename string, offset long, length long"
FETCHED = "page_id long, payload binary"
#: Fixed value: the profile of a revisit record with an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A page is captured so many seconds after the epoch as this and its id modulo 2**31 say.
FIRST_SECOND = 1_704_067_200
#: Bytes of payloads that one archive holds at most.
ARCHIVE_BYTES = 1 << 28


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of a SHA-1: five hexadecimal digits make four characters."""
    hexed = F.sha1(data)
    digits = F.concat(*(F.lpad(F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)))
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: Column) -> Column:
    """Host labels reversed, then path and query: ``org,example)/a?b``."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#:]*)", 1)
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each record as a gzip member without its last byte, which is zero."""
    empty = gzip.compress(b"", mtime=0)
    for pdf in batches:
        out = []
        for record in pdf["record"]:
            data = record.encode("utf-8", "surrogatepass")
            member = gzip.compress(data, 6, mtime=0)
            out.append((member if len(data) < 1 << 24 else member + empty)[:-1])
        yield pd.DataFrame({"member": out})


def write_archives(pages: DataFrame, path: str, records_per_file: int = 2_000) -> None:
    """Write one WARC record per page under ``path``."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", F.coalesce(F.col("url"), F.lit("")).alias("url"), html.alias("html"), base32_sha1(html.cast("binary")).alias("digest"))
    largest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 1
    # Payloads are not grouped, only ids and digests; revisits are told by page, so that a
    # payload shared by very many pages makes no hot key for texts.
    digests = materialize(rows.select("page_id", "digest"), "page-digests")
    shared = digests.groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("copies")).where("copies > 1 and original is not null")
    refs = digests.join(shared, "digest").where(~F.col("page_id").eqNullSafe(F.col("original")))
    refs = refs.select(F.col("page_id").alias("page"), F.col("digest").alias("payload"), "original").distinct()
    rows = rows.join(refs, F.col("page_id").eqNullSafe(F.col("page")) & (F.col("digest") == F.col("payload")), "left")
    revisit = F.col("original").isNotNull()
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    date = F.date_format(F.timestamp_seconds(F.lit(FIRST_SECOND) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1 << 31))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    block = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length("html").cast("string"), F.lit(END), F.col("html"))
    block = F.when(revisit, F.lit("")).otherwise(block)
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    fields = {
        "WARC-Type": F.when(revisit, "revisit").otherwise("response"),
        "WARC-Record-ID": uri(F.col("page_id")),
        "WARC-Target-URI": url,
        "WARC-Date": date,
        "WARC-Payload-Digest": F.concat(F.lit("sha1:"), "digest"),
        "WARC-Refers-To": F.when(revisit, uri(F.col("original"))),
        "WARC-Profile": F.when(revisit, PROFILE),
        "Content-Type": F.lit("application/http; msgtype=response"),
        "Content-Length": F.octet_length(block).cast("string"),
    }
    head = F.concat_ws(CRLF, F.lit("WARC/1.1"), *(F.concat(F.lit(f"{k}: "), v) for k, v in fields.items()))
    members = rows.select(F.concat(head, F.lit(END), block, F.lit(END)).alias("record")).mapInPandas(_members, "member binary")
    per_file = max(1, min(records_per_file, ARCHIVE_BYTES // largest))
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").option("maxRecordsPerFile", per_file).text(path)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record of an archive."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:stop].decode("utf-8").split(CRLF)
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
        size = int(fields["content-length"])
        yield fields, data[stop + 4 : stop + 4 + size]
        at = stop + 4 + size + 4


def _page(uri: str | None) -> int | None:
    name = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name.lstrip("-").isdigit() else None


def members(content: bytes | memoryview, offset: int = 0) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and data of every gzip member from an offset on."""
    view = memoryview(content)
    while offset < len(content):
        reader, at, data = zlib.decompressobj(31), offset, []
        while not reader.eof:
            data.append(reader.decompress(view[at : at + 65_536]))
            at += 65_536
        end = min(at, len(content)) - len(reader.unused_data)
        yield offset, end - offset, b"".join(data)
        offset = end


def _payload(block: bytes) -> bytes:
    return block[block.index(b"\r\n\r\n") + 4 :] if block else b""


def _frame(rows: list, schema: str) -> pa.RecordBatch:
    """Rows as Arrow, where ids beside nulls stay whole numbers."""
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names, types = zip(*(x.split() for x in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], list(names))


def _files(batch: pa.RecordBatch, beside: str) -> Iterator[tuple[Any, memoryview]]:
    """Each archive with another column's value, one at a time and without a copy of its bytes."""
    for k in range(batch.num_rows):
        yield batch.column(beside)[k].as_py(), memoryview(batch.column("content")[k].as_buffer())


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in _files(batch, "path"):
            rows = []
            for offset, length, data in members(content):
                for fields, block in parse_records(data):
                    row = [_page(fields["warc-record-id"]), fields["warc-target-uri"], fields["warc-date"], fields["warc-type"], _page(fields.get("warc-refers-to"))]
                    if fields["warc-type"] == "revisit":
                        row += [None, fields["warc-payload-digest"].removeprefix("sha1:")]
                    else:
                        payload = _payload(block)
                        row += [len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()]
                    rows.append([*row, path.rsplit("/", 1)[-1], offset, length])
                if len(rows) >= 1_000:
                    yield _frame(rows, CAPTURE)
                    rows = []
            yield _frame(rows, CAPTURE)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One capture per record of the archives under ``path``; revisits get the
    size of the response they refer to."""
    found = materialize(_archives(spark, path).mapInArrow(_captures, CAPTURE), "captures")
    sizes = found.where("record_type = 'response' and page_id is not null").select(F.col("page_id").alias("original"), F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("size")).distinct()
    out = found.join(sizes, (found["refers_to"] == sizes["original"]) & (found["payload_digest"] == sizes["digest"]), "left")
    return out.select(*(F.coalesce("payload_bytes", "size").alias(c) if c == "payload_bytes" else c for c in found.columns))


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for wanted, content in _files(batch, "wanted"):
            rows = []
            for w in wanted:
                _, _, data = next(members(content[w["offset"] : w["offset"] + w["length"]]))
                ((_, block),) = parse_records(data)
                rows.append((w["page_id"], _payload(block)))
            yield _frame(rows, FETCHED)


def fetch(captures: DataFrame, path: str) -> DataFrame:
    """page_id and payload of captures, read by file, offset and length; a revisit's own record has none."""
    wanted = captures.groupBy("filename").agg(F.collect_list(F.struct("page_id", "offset", "length")).alias("wanted"))
    files = _archives(captures.sparkSession, path).withColumn("filename", F.substring_index("path", "/", -1))
    return files.join(wanted, "filename").select("content", "wanted").mapInArrow(_fetch, FETCHED)


def merge_runs(runs: list[list]) -> Iterator:
    """Merge sorted lists with a loser tree: each step replays one leaf-to-root path."""
    k = len(runs)
    if not k:
        return
    heads = [0] * k
    key = lambda r: (0, runs[r][heads[r]], r) if heads[r] < len(runs[r]) else (1, (), r)
    # Winners bottom up; every inner node keeps the loser of its match.
    winners, losers = [0] * k + list(range(k)), [0] * k
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if key(a) <= key(b) else (b, a)
    top = winners[1] if k > 1 else 0
    while heads[top] < len(runs[top]):
        yield runs[top][heads[top]]
        heads[top] += 1
        node = (top + k) // 2
        while node:
            if key(losers[node]) < key(top):
                losers[node], top = top, losers[node]
            node //= 2


def ordered_runs(keys: list) -> list[list]:
    """The sequence cut wherever a key is less than the one before."""
    cuts = [k for k in range(1, len(keys)) if keys[k] < keys[k - 1]]
    return [keys[a:b] for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True) if a < b]


def _merge(names: list[str]):
    """Merge the runs of one range. The pieces of a run arrive one after another, each in order; a piece that
    is out of order with the one before is a run of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)  # the index rows of one range
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        del parts
        ids = [-(2**63) if i is None else i for i in table["page_id"].to_pylist()]
        found: dict[int, list] = {}
        for at, (run_, *key) in enumerate(zip(*(table[c].to_pylist() for c in ("run", "url_key", "captured_at")), ids, strict=True)):
            found.setdefault(run_, []).append((*key, at))
        order = [x[3] for x in merge_runs([r for _, keys in sorted(found.items()) for r in ordered_runs(keys)])]
        yield from table.select(names).take(pa.array(order, pa.int64())).to_batches(max_chunksize=10_000)

    return run


def merge_index(captures: DataFrame, rows_per_range: int = 100_000) -> DataFrame:
    """Captures with their url_key, in the order of (url_key, captured_at, page_id)."""
    keyed = captures.withColumn("url_key", url_key(F.col("url")))
    keyed = materialize(keyed.withColumn("run", F.spark_partition_id()).sortWithinPartitions("url_key", "captured_at", "page_id"), "runs")
    ranges = max(int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-keyed.count() // rows_per_range))
    dealt = keyed.repartitionByRange(ranges, "url_key", "captured_at", "page_id")
    schema = keyed.drop("run").schema
    return dealt.mapInArrow(_merge(schema.names), schema)


def archive_and_index(pages: DataFrame, records_per_file: int = 2_000) -> DataFrame:
    """Write archives to the shared folder, read them back and merge their index."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, records_per_file)
    return merge_index(read_archives(spark, path))
