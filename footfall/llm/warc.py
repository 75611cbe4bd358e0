"""Web archives: records with revisits, and an index merged from sorted capture runs."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from datetime import datetime, timedelta
from itertools import islice
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm import files
from footfall.llm.common import bit_filter, passes, stage
from footfall.llm.loser_tree import merge
from footfall.staging import scratch_dir

ARCHIVE_BYTES = 128 << 20
OPEN_ARCHIVES = 16
RANGE_CAPTURES = 250_000
# The digits of base 32, and the profile of a revisit of the same payload.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = ("url_key STRING, captured STRING, page_id BIGINT, url STRING, digest STRING, "
           "record_type STRING, refers_to BIGINT, archive STRING, offset BIGINT, size BIGINT, "
           "run BIGINT")
_CAPTURE = pa.schema([(name, pa.string() if kind == "STRING" else pa.int64()) for name, kind in
                      (field.split() for field in CAPTURE.split(", "))])


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base-32 SHA-1: five hexadecimal digits are four of base 32."""
    hexadecimal = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexadecimal, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def url_key(url: str | None) -> str:
    """The host's parts from the last to the first, then path and query; fragments do not count."""
    parts = urlsplit((url or "").strip())
    host = ",".join(reversed((parts.hostname or "").split(".")))
    return f"{host}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".lower()


def safe_key(url: str | None) -> str:
    """``url_key``, or the text itself where it is no URL."""
    try:
        return url_key(url)
    except ValueError:
        return (url or "").lower()


def capture_time(page_id: int | None) -> str:
    """Where pages carry no time of capture, page n counts as taken n seconds after 1970.

    Up to page 253 402 300 799 the year has four digits; later ones have more and are ordered as text.
    """
    days, second = divmod(page_id or 0, 86_400)
    cycles, days = divmod(days, 146_097)  # 400 years are as many days
    moment = datetime(1970, 1, 1) + timedelta(days=days, seconds=second)
    return f"{moment.year + 400 * cycles:04d}{moment.strftime('-%m-%dT%H:%M:%SZ')}"


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, captured: str,
           refers_to: int | None, revisit: bool, size: int) -> bytes:
    """One record as a gzip member of its own. A revisit has the HTTP head but not the payload."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    block = head if revisit else head + payload
    target = "".join(c for c in url or "" if c not in "\r\n")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Date: {captured}", f"WARC-Target-URI: {target}",
             f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    if revisit:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}",
                  f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(data) + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Record headers, HTTP headers and payload of one gzip member."""
    data = zlib.decompress(member, 31)
    top, _, rest = data.partition(b"\r\n\r\n")

    def fields(block: bytes) -> dict[str, str]:
        pairs = (line.partition(": ") for line in block.decode().split("\r\n")[1:])
        return {name.lower(): value for name, _, value in pairs}

    headers = fields(top)
    block = rest[:int(headers["content-length"])]
    head, _, payload = block.partition(b"\r\n\r\n")
    return headers, fields(head), payload


def _key_in(keys: DataFrame, column: Column, of: Column) -> Column:
    """Whether a key of a row may be one of ``column`` in ``keys``: a filter of fixed size, never falsely no."""
    held = bit_filter(keys.select(F.xxhash64(column).alias("key")), "key")

    @F.pandas_udf("boolean")
    def may(hashes: pd.Series) -> pd.Series:
        return pd.Series(passes(held, hashes.to_numpy(np.int64)))

    return may(F.xxhash64(of))


def tell_revisits(pages: DataFrame, firsts: DataFrame) -> DataFrame:
    """Whether each page is a revisit, and of which page, by the first page of each repeated digest."""
    revisit = F.col("first").isNotNull() & (F.col("first.row") != F.col("row"))
    return pages.join(firsts, "digest", "left").withColumn("revisit", revisit).withColumn(
        "refers_to", F.when(revisit, F.col("first.page_id"))).drop("first")


def mark_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """Add digest and size of each payload, and for all but the first of equal ones what it revisits.

    The first has the smallest page id, null ids last. A revisit's own payload is dropped (null).

    Digests are counted before they are shuffled. Pages whose digest no other has are never shuffled, and of the
    others, revisits are told by a join of digests without payloads; payloads cross a shuffle only to keep the
    first of each repeated digest, by row, which no group can make hot. All filters before that only save work.
    The digests that occur twice are staged, so no aggregate stands between the join and its shuffle, and AQE
    can split a digest that many pages share.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    known = stage(pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload.alias("payload"), F.octet_length(payload).cast("bigint").alias("size"),
        base32_sha1(payload).alias("digest"), F.monotonically_increasing_id().alias("row")), "pages")
    order = F.struct(F.col("page_id").isNull().alias("late"), "page_id", "row")
    firsts = stage(
        known.filter(F.col("size") >= least).groupBy("digest")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select("digest", "first"), "firsts")

    repeated = known.withColumn(
        "repeated", (F.col("size") >= least) & _key_in(firsts, F.col("digest"), F.col("digest")))
    told = stage(tell_revisits(repeated.filter("repeated").drop("payload", "repeated"), firsts), "told")
    kept = told.filter(~F.col("revisit"))

    columns = ("page_id", "url", "payload", "digest", "revisit", "refers_to", "size")
    response = [F.lit(False).alias("revisit"), F.lit(None).cast("bigint").alias("refers_to")]
    single = repeated.filter(~F.col("repeated")).select("*", *response)
    first = repeated.filter("repeated").filter(_key_in(kept, F.col("row"), F.col("row"))).join(
        kept.select("row"), "row", "left_semi").select("*", *response)
    again = told.filter("revisit").withColumn("payload", F.lit(None).cast("binary"))
    return single.select(*columns).unionByName(first.select(*columns)).unionByName(again.select(*columns))


def write_archives(marked: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all records; return the captures as sorted runs, one per archive, staged.

    A task opens a new archive after ``archive_bytes``. Within a run, captures are in the order of
    URL key, time and page id, and their place in the run is their order in the table.
    """
    def run(batches: Iterator) -> Iterator:
        task, number = TaskContext.get().partitionId(), 0
        out, path, at, captures = None, "", 0, []

        def close() -> pa.RecordBatch:
            out.close()
            captures.sort(key=lambda c: (c[0], c[1], c[2] is None, c[2] or 0))
            return pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(zip(*captures), _CAPTURE)],
                schema=_CAPTURE)

        for batch in batches:
            for page_id, url, payload, digest, revisit, refers_to, size in zip(
                    *(batch.column(i).to_pylist() for i in range(7))):
                if out is None:
                    path, at, captures = files.own_name(folder, ".warc.gz"), 0, []
                    out = files.writer(path)
                captured = capture_time(page_id)
                member = record(page_id, url, payload, digest, captured, refers_to, revisit, size)
                out.write(member)
                captures.append((safe_key(url), captured, page_id, url, digest,
                                 "revisit" if revisit else "response", refers_to, path, at,
                                 len(member), (task << 20) + number))
                at += len(member)
                if at >= archive_bytes:
                    yield close()
                    out, number = None, number + 1
        if out is not None:
            yield close()

    return stage(marked.mapInArrow(run, CAPTURE), "captures")


def merge_index(captures: DataFrame, partitions: int | None = None) -> DataFrame:
    """All captures in the order of URL key, time and page id: the partitions follow one another.

    The runs are cut at the same keys, a range of keys goes to each task, and the task merges its
    parts of the runs with a loser tree. The range is over the whole order, so a URL with a third of
    all captures is spread too. Without ``partitions`` there are as many ranges as keep one to about
    ``RANGE_CAPTURES``; the order is the same for any number.
    """
    if partitions is None:
        setting = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partitions = max(setting, -(-captures.count() // RANGE_CAPTURES))

    def run(batches: Iterator) -> Iterator:
        parts: dict[int, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                page_id = row[2]
                parts.setdefault(row[-1], []).append(
                    ((row[0], row[1], page_id is None, page_id or 0), row[-1], row[-3], row))
        for part in parts.values():
            part.sort(key=lambda item: item[:3])  # blocks of one run can arrive out of order
        merged = (item[-1] for item in merge(parts.values()))
        while rows := list(islice(merged, 10_000)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(zip(*rows), _CAPTURE)],
                schema=_CAPTURE)

    ranged = captures.repartitionByRange(
        partitions, "url_key", "captured", F.col("page_id").asc_nulls_last(), "run", "offset")
    return ranged.mapInArrow(run, CAPTURE)


def read_captures(index: DataFrame) -> DataFrame:
    """Fetch every capture of the index from its archive and take stock of what is there."""
    fields = ("page_id BIGINT, payload_bytes BIGINT, payload_digest STRING, record_type STRING, "
              "refers_to BIGINT, url_key STRING, captured STRING")
    schema = pa.schema([(name, pa.string() if kind == "STRING" else pa.int64()) for name, kind in
                        (field.split() for field in fields.split(", "))])

    def number(urn: str | None) -> int | None:
        digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def run(batches: Iterator) -> Iterator:
        archives: OrderedDict = OrderedDict()
        for batch in batches:
            rows = []
            for path, at, size, key in zip(*(batch.column(n).to_pylist() for n in
                                             ("archive", "offset", "size", "url_key"))):
                if path not in archives:
                    archives[path] = files.reader(path)
                    if len(archives) > OPEN_ARCHIVES:
                        archives.popitem(last=False)[1].close()
                archives.move_to_end(path)
                archives[path].seek(at)
                headers, http, payload = parse(archives[path].read(size))
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                kind = headers["warc-type"]
                if kind == "response":
                    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if found != digest or len(payload) != int(http["content-length"]):
                        raise ValueError(f"{path}, offset {at}: the payload is not what was written")
                rows.append((number(headers["warc-record-id"]), int(http["content-length"]), digest,
                             kind, number(headers.get("warc-refers-to")), key, headers["warc-date"]))
            columns = list(zip(*rows)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema)

    return index.mapInArrow(run, fields)


def warc(pages: DataFrame, folder: str | None = None, least: int = 0,
         archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page, merge the index, and read everything back in its order.

    Null html is an empty payload; a null URL has an empty key; a page given twice is once the
    response and once its revisit; pages with a null id come after all others and are named by no
    number. An empty table writes nothing. Further columns are ignored.
    """
    folder = folder or scratch_dir(pages.sparkSession, "archives")
    captures = write_archives(mark_revisits(pages, least), folder, archive_bytes)
    return read_captures(merge_index(captures))
