"""WARC archives: writing captures, reading them back and assembling transactions (operator 2).

Writing. Every page becomes a request, a response or revisit, and a metadata record; request and metadata name the
response in ``WARC-Concurrent-To``. Spark's text writer puts the files into the shared folder, compressed and with a
bounded number of records each, so any store works. Payloads are deduplicated by digest before: only digests and ids are
grouped, and the page that stands for a payload comes back as a short list of revisits.

Reading. Files are read whole, cut by ``Content-Length`` and never searched for separators, so a payload may hold
anything. Transactions are joined by the concurrent-to identifiers, which are unique, so no key is hot.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.sources.tables import run_folder

#: Payloads of so many bytes at least are deduplicated.
LEAST_BYTES = 0
RECORDS_PER_FILE = 3000
#: Fixed values of the format.
END = "\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "record_type string, record_id string, concurrent_to string, target_uri string, refers_to long, page_id long, payload_bytes long, payload_digest string, block binary"


def bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_text(value: str | None) -> str:
    """A header value without line ends or other control characters, which are percent-encoded as UTF-8."""
    text = value or ""
    if text.isprintable():
        return text
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record(kind: str, record_id: str, fields: dict[str, str], block: str) -> str:
    """One record without the two line ends after it, which the writer adds."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {DATE}"]
    lines += [f"{k}: {v}" for k, v in fields.items()]
    lines.append(f"Content-Length: {len(block.encode())}")
    return "\r\n".join(lines) + END + block


def capture(page_id: int | None, url: str | None, html: str | None, refers_to: int | None, serial: str) -> Iterator[str]:
    """The three records of one page. The identifiers depend on the row's place as well, so repeated rows differ."""
    target, payload = _header_text(url), html or ""
    data = payload.encode()
    digest = bare_digest(data)
    ids = [f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{serial}/{part}').urn}>" for part in ("request", "response", "metadata")]
    request = f"GET {target or '/'} HTTP/1.1{END}"
    kind, block = ("response", f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8{END}{payload}")
    fields = {"WARC-Target-URI": target, "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http; msgtype=response"}
    if refers_to is not None:
        kind, block = "revisit", f"HTTP/1.1 200 OK{END}"
        fields |= {"WARC-Profile": PROFILE}
    about = f"page-id: {'' if page_id is None else page_id}\r\npayload-bytes: {len(data)}\r\nrefers-to-page: {'' if refers_to is None else refers_to}\r\n"
    linked = {"WARC-Target-URI": target, "WARC-Concurrent-To": ids[1]}
    yield record("request", ids[0], linked | {"Content-Type": "application/http; msgtype=request"}, request)
    yield record(kind, ids[1], fields, block)
    yield record("metadata", ids[2], linked | {"Content-Type": "application/warc-fields"}, about)


def revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``_page, _stands`` (the page that stands for each payload digest) for the pages whose payload another page, with a larger id, stands for."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.unhex(F.sha1(F.encode(html, "UTF-8"))).alias("digest"), F.octet_length(html).alias("size"))
    rows = stored(rows.filter(F.col("size") >= least_bytes).filter("page_id is not null"), "payloads")
    shared = rows.groupBy(F.col("digest").alias("of")).agg(F.max("page_id").alias("stands"), F.count("*").alias("n")).filter("n > 1")
    shared = stored(shared.select("of", "stands"), "shared-payloads")
    again = rows.join(shared, F.col("digest") == F.col("of")).filter("page_id < stands")
    entry = F.struct(F.hex("digest").alias("key"), F.col("stands").alias("value"))
    found = again.groupBy(F.col("page_id").alias("_page")).agg(F.map_from_entries(F.collect_set(entry)).alias("_stands"))
    return stored(found, "revisits")


def write_archive(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write all pages to ``folder``; needs ``page_id``, ``url`` and ``html``.

    Null html is an empty payload, a null URL an empty target. Of rows with equal payloads the largest ``page_id`` is
    the response; rows that repeat that id are responses too. Rows with a null id are always responses.
    """
    html = F.coalesce("html", F.lit(""))
    digest = F.hex(F.unhex(F.sha1(F.encode(html, "UTF-8"))))
    rows = pages.select(F.col("page_id").cast("long"), "url", "html").join(revisits(pages, least_bytes), F.col("page_id") == F.col("_page"), "left")
    rows = rows.select("page_id", "url", "html", F.element_at("_stands", digest).cast("long").alias("refers_to"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, row = TaskContext.get(), 0
        place = f"{folder}/{context.stageId()}/{context.partitionId()}"
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                records = []
                for page in batch.slice(first, 256).to_pylist():
                    records += capture(**page, serial=f"{place}/{row}")
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.string())], names=["value"])

    out = rows.mapInArrow(build, "value string")
    out.write.option("compression", "gzip").option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and block of each record of one file."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        end = head + 4 + int(fields["content-length"])
        yield fields, data[head + 4 : end]
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"a record does not end at byte {end}")
        at = end + 4


def _row(fields: dict[str, str], block: bytes, blocks: bool) -> tuple:
    kind, page, refers, size, digest = fields["warc-type"], None, None, None, None
    if kind == "metadata":
        about = dict(line.partition(": ")[::2] for line in block.decode().split("\r\n") if line)
        page, size, refers = (int(about[k]) if about.get(k) else None for k in ("page-id", "payload-bytes", "refers-to-page"))
    elif kind == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        size, digest = len(payload), bare_digest(payload)
        if fields["warc-payload-digest"] != f"sha1:{digest}":
            raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    elif kind == "revisit":
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
    return (
        kind, fields["warc-record-id"], fields.get("warc-concurrent-to"), fields.get("warc-target-uri"), refers, page, size, digest,
        block if blocks else None,
    )


def read_records(spark: SparkSession, folder: str, blocks: bool = True) -> DataFrame:
    """One row per record of the archives in ``folder``; without ``blocks`` the contents stay behind."""
    names = [f.split()[0] for f in RECORD.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for fields, block in parse(gzip.decompress(content)):
                    rows.append(_row(fields, block, blocks))
                    if len(rows) == 512:
                        yield _frame(rows, names)
                        rows = []
                yield _frame(rows, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInPandas(read, RECORD)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({n: "Int64" for n in ("refers_to", "page_id", "payload_bytes")})


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: the structs ``request``, ``response`` and ``metadata``.

    The response or revisit leads; a record without ``concurrent_to`` partner in the archives leaves its struct null.
    Several request or metadata records of one response give several rows.
    """
    whole = F.struct(*records.columns)
    leads = records.filter("record_type in ('response', 'revisit')").select(F.col("record_id").alias("_id"), whole.alias("response"))
    for kind in ("request", "metadata"):
        partner = records.filter(F.col("record_type") == kind).select(F.col("concurrent_to").alias(f"_{kind}"), whole.alias(kind))
        leads = leads.join(partner, F.col("_id") == F.col(f"_{kind}"), "left")
    return leads.select("request", "response", "metadata")


def archived_pages(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write the pages as archives, read them back and assemble: one row per page with what the archives say.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri``. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    folder = run_folder(spark, "warc")
    write_archive(pages, folder, least_bytes)
    records = stored(read_records(spark, folder, blocks=False), "records")
    return transactions(records).select(
        "metadata.page_id",
        F.coalesce("response.payload_bytes", "metadata.payload_bytes").alias("payload_bytes"),
        "response.payload_digest",
        "response.record_type",
        "metadata.refers_to",
        "response.target_uri",
    )
