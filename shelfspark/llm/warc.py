"""WARC derivatives: metadata and plain-text conversion records from response records.

A derivative refers to the response it was made of (WARC-Refers-To), repeats its target, date and payload digest, and
has a digest of its own block. Identifiers follow from what a record is about, so a task that runs again, or a later
run, gives the same records.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm.markup import facts, plain_text
from shelfspark.llm.storage import text_batches

BREAK = "\r\n"


@dataclass(frozen=True)
class Settings:
    version: str = "WARC/1.1"
    date: str = "2024-01-01T00:00:00Z"
    status: str = "HTTP/1.1 200 OK"
    content_type: str = "text/html; charset=utf-8"


def digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def identifier(*parts: str | None) -> str:
    """A record id that follows from its parts; null and empty differ."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps(parts))}>"


RECORD = pa.schema(
    [
        ("page_id", pa.int64()), ("warc_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
        ("target_uri", pa.string()), ("date", pa.string()), ("content_type", pa.string()), ("payload_digest", pa.string()),
        ("block_digest", pa.string()), ("content_length", pa.int64()), ("headers", pa.string()), ("block", pa.string()),
    ]
)
RECORD_SQL = (
    "page_id long, warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "payload_digest string, block_digest string, content_length long, headers string, block string"
)


def _record(how: Settings, page_id, kind: str, record_id: str, refers_to, uri, date, content_type: str, payload: str, block: str) -> tuple:
    data = block.encode()
    block_digest = digest(data)
    # A line break in a value would end the header; RFC 2616 folds it to a space.
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Refers-To", refers_to),
        ("WARC-Target-URI", None if uri is None else re.sub(r"[\r\n]+", " ", uri)), ("WARC-Date", date), ("Content-Type", content_type),
        ("WARC-Payload-Digest", payload), ("WARC-Block-Digest", block_digest), ("Content-Length", str(len(data))),
    ]
    headers = BREAK.join([how.version, *(f"{k}: {v}" for k, v in fields if v is not None)])
    return page_id, kind, record_id, refers_to, uri, date, content_type, payload, block_digest, len(data), headers, block


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(RECORD)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RECORD)], schema=RECORD)


def _responses(how: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page_id, uri, page in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                page = page or ""
                payload = digest(page.encode())
                http = BREAK.join([how.status, f"Content-Type: {how.content_type}", f"Content-Length: {len(page.encode())}"])
                record_id = identifier("response", None if page_id is None else str(page_id), uri, payload)
                block = http + BREAK * 2 + page
                rows.append(_record(how, page_id, "response", record_id, None, uri, how.date, "application/http; msgtype=response", payload, block))
            yield _batch(rows)

    return run


def responses(pages: DataFrame, how: Settings = Settings()) -> DataFrame:
    """A response record for every row of ``pages`` (page_id, url, html; other columns are not read).

    Null html is an empty page; a null url leaves the target out; repeated rows give equal records.
    """
    rows = text_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_responses(how), RECORD_SQL)


def _derived(how: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("page_id", "record_id", "target_uri", "date", "content_type", "payload_digest", "block_digest", "block")
        for batch in batches:
            rows = []
            for page_id, source, uri, date, kind, payload, block_digest, block in zip(*(batch.column(c).to_pylist() for c in names)):
                http, _, page = (block or "").partition(BREAK * 2)
                status, *lines = http.split(BREAK)
                fields = [[k.strip(), v.strip()] for k, _, v in (x.partition(":") for x in lines)]  # repeated names stay
                envelope = {
                    "warc": {"record_id": source, "content_type": kind, "date": date, "target_uri": uri, "payload_digest": payload, "block_digest": block_digest},
                    "http": {"status": status, "headers": fields},
                    "html": facts(page),
                }
                meta = json.dumps(envelope, ensure_ascii=False, sort_keys=True)
                for kind_, content_type, text in (("metadata", "application/json", meta), ("conversion", "text/plain; charset=utf-8", plain_text(page))):
                    rows.append(_record(how, page_id, kind_, identifier(kind_, source), source, uri, date, content_type, payload, text))
            yield _batch(rows)

    return run


def derivatives(records: DataFrame, how: Settings = Settings()) -> DataFrame:
    """A metadata and a conversion record for every response among ``records`` (the columns of ``responses``)."""
    return records.where("warc_type = 'response'").mapInArrow(_derived(how), RECORD_SQL)


def write_warc(records: DataFrame, path: str) -> None:
    """Records as gzipped WARC files, one a partition, by Spark's own writer."""
    whole = F.concat("headers", F.lit(BREAK * 2), "block")
    records.select(whole.alias("value")).write.option("lineSep", BREAK * 2).option("compression", "gzip").text(path)


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derivatives of all pages; blocks as digests."""
    made = derivatives(responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return made.drop("block", "headers")
