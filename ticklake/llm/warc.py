"""WARC archives with payload deduplication: revisit records resolved by payload digest.

Writing: the payloads' digests (SHA-1, base32) are headers of a few bytes; they alone are grouped.  In
each group of equal digest and length the record with the smallest id is a response, the others become
revisit records that name it.  The groups of more than one record are a table of their own; the pages are
joined with it, so that payloads are shuffled only if that table is too large to broadcast.  Archives are
written by Spark's text writer, whose line separator is the blank line between two WARC records.

Reading: Spark's text reader splits an archive at the beginnings of records, in any number of tasks.
Content-Length decides whether a split was right; an archive in which a payload holds what looks like a
record's beginning is read again record by record (:func:`_read_exact`).

:func:`resolve` joins revisit records to responses by digest, :func:`rededuplicate` turns the records of
any archives into deduplicated ones with fresh headers.

Defined cases: a null payload is an empty one; a null url becomes ``urn:id:<id>``; line breaks and control
characters in a url become ``%20``; rows that repeat the smallest id of a group are all responses; null ids
come last in a group (if all ids are null, all are responses); an empty table gives archives without
records; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ticklake.llm.common import ship, written

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
BLANK = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: The field that carries a record's id in its source table.
ID_FIELD = "X-Source-Id"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 5 hex digits are 4 base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), BASE32_HEX, BASE32)


def record_urn(id_col: Column, url: Column) -> Column:
    """A record id that is the same whenever the same record is written again."""
    h = F.md5(F.concat_ws("|", F.coalesce(id_col.cast("string"), F.lit("null")), url))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-"), part(13, 4), F.lit("-"), part(17, 4),
                    F.lit("-"), part(21, 12), F.lit(">"))


def with_record_types(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add record_type, refers_to and refers_to_url to rows with id, url, payload (binary).

    Adds payload_bytes and payload_digest.  Payloads below ``min_bytes`` are always responses.
    """
    rows = records.withColumn("payload_bytes", F.length("payload").cast("bigint")).withColumn("payload_digest", base32_sha1(F.col("payload")))
    groups = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes") \
        .agg(F.count(F.lit(1)).alias("_n"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "url"))).alias("_first")) \
        .where((F.col("_n") > 1) & F.col("_first").isNotNull()) \
        .select(F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes"), F.col("_first.id").alias("_id"),
                F.col("_first.url").alias("_url"))
    repeated = written(groups, "warc-groups")
    joined = rows.join(repeated, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") == F.col("_bytes")), "left")
    later = F.col("_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("_id"))
    return joined.withColumn("record_type", F.when(later, "revisit").otherwise("response")) \
        .withColumn("refers_to", F.when(later, F.col("_id"))).withColumn("refers_to_url", F.when(later, F.col("_url"))) \
        .drop("_digest", "_bytes", "_id", "_url")


def _record(date: str) -> Column:
    """A whole record without the two line breaks after it."""
    def field(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    revisit = F.col("record_type") == "revisit"
    payload = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=UTF-8" + CRLF),
                    field("Content-Length", F.col("payload_bytes").cast("string")), F.lit(CRLF))
    size = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    none = F.lit("")
    head = F.concat(
        F.lit(VERSION + CRLF), field("WARC-Type", F.col("record_type")), field("WARC-Record-ID", record_urn(F.col("id"), F.col("url"))),
        field("WARC-Date", F.lit(date)), field("WARC-Target-URI", F.col("url")),
        F.when(F.col("id").isNotNull(), field(ID_FIELD, F.col("id").cast("string"))).otherwise(none),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(field("WARC-Profile", F.lit(REVISIT_PROFILE)),
                                 field("WARC-Refers-To", record_urn(F.col("refers_to"), F.col("refers_to_url"))),
                                 field("WARC-Refers-To-Target-URI", F.col("refers_to_url")))).otherwise(none),
        field("Content-Type", F.lit("application/http; msgtype=response")), field("Content-Length", size.cast("string")), F.lit(CRLF))
    return F.concat(head, http, payload)


def prepared(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(id, url, payload) of a table of pages; text payloads are their UTF-8 bytes."""
    key = F.col(id_col).cast("bigint")
    url = F.coalesce(F.regexp_replace(F.col(url_col), r"[\x00-\x20\x7f]", "%20"),
                     F.concat(F.lit("urn:id:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return pages.select(key.alias("id"), url.alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))


def write_warc(records: DataFrame, path: str, min_bytes: int = 0, date: str | None = None) -> None:
    """Write (id, url, payload) as deduplicated archives, one record per row."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    with_record_types(records, min_bytes).select(_record(date).alias("value")).write.option("lineSep", BLANK).text(path)


def _fields(head: Column, block: Column, extra: list[Column] | None = None) -> list[Column]:
    """The columns of a record, from its header lines (a string) and its block (binary)."""
    def field(name):
        got = F.regexp_extract(head, r"(?im)^" + name + r":[ \t]*(.*?)[ \t]*\r?$", 1)
        return F.when(got != "", got)

    http = F.substring_index(block.cast("string"), BLANK, 1)
    inner = F.regexp_extract(http, r"(?im)^Content-Length:[ \t]*([0-9]+)", 1)
    is_http = field("Content-Type").startswith("application/http")
    payload = F.when(is_http, F.substring(block, F.octet_length(http) + F.lit(5), F.lit(2**31 - 1))).otherwise(block)
    kind = field("WARC-Type")
    return [kind.alias("record_type"), field("WARC-Record-ID").alias("record_id"), field("WARC-Date").alias("date"),
            field("WARC-Target-URI").alias("url"), field(ID_FIELD).cast("bigint").alias("id"),
            F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
            field("WARC-Refers-To").alias("refers_to_record"),
            F.when(kind == "revisit", F.when(inner != "", inner.cast("bigint"))).otherwise(F.octet_length(payload).cast("bigint")).alias("payload_bytes"),
            F.when(kind != "revisit", payload).alias("payload"), *(extra or [])]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives in a folder, one row each (record_type, record_id, ..., payload)."""
    raw = spark.read.option("lineSep", BLANK + VERSION + CRLF).text(path).where(F.octet_length("value") > 0) \
        .select(F.regexp_replace(F.substring_index("value", BLANK, 1), "^" + VERSION + CRLF, "").alias("head"),
                F.octet_length(F.substring_index("value", BLANK, 1)).alias("head_bytes"), F.col("value").cast("binary").alias("raw"),
                F.col("_metadata.file_path").alias("file"))
    size = F.regexp_extract("head", r"(?im)^Content-Length:[ \t]*([0-9]+)", 1)
    raw = raw.withColumn("size", F.when(size != "", size.cast("bigint"))) \
        .withColumn("rest", F.octet_length("raw") - F.col("head_bytes") - 4 - F.col("size"))
    # after the block comes nothing, or (at the end of an archive) the two line breaks
    fits = F.coalesce(F.col("rest").isin(0, 4) & F.col("head").contains("WARC-Type:"), F.lit(False))
    bad = [r.file for r in raw.where(~fits).select("file").distinct().collect()]  # as a rule none; at most the archives' names
    block = F.substring("raw", F.col("head_bytes") + 5, F.col("size").cast("int"))
    good = raw.where(~F.col("file").isin(bad)) if bad else raw
    records = good.select(*_fields(F.col("head"), block))
    return records.unionByName(_read_exact(spark, bad)) if bad else records


def _read_exact(spark: SparkSession, files: list[str]) -> DataFrame:
    """The records of archives whose payloads look like records: by Content-Length, each archive in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column(0):
                data, at, heads, blocks = cell.as_py(), 0, [], []
                while (at := data.find(b"WARC/", at)) >= 0:
                    end = data.index(b"\r\n\r\n", at)
                    lines = data[at:end].split(b"\r\n")[1:]
                    size = next(int(x.split(b":", 1)[1]) for x in lines if x.lower().startswith(b"content-length:"))
                    heads.append(b"\r\n".join(lines).decode("utf-8", "replace"))
                    blocks.append(data[end + 4:end + 4 + size])
                    at = end + 4 + size
                for i in range(0, len(heads), 500):
                    yield pa.RecordBatch.from_arrays([pa.array(heads[i:i + 500]), pa.array(blocks[i:i + 500], type=pa.binary())], ["head", "block"])

    ship(spark)
    found = spark.read.format("binaryFile").load(files).select("content").mapInArrow(run, "head string, block binary")
    return found.select(*_fields(F.col("head"), F.col("block")))


def resolve(records: DataFrame) -> DataFrame:
    """Add ``refers_to`` (id of the response a revisit repeats; null for others) to read records.

    Revisit headers are joined with response headers by digest; the record named in WARC-Refers-To wins
    over another response of the same digest.  Only headers of revisits and their responses are shuffled.
    """
    heads = records.select("record_type", "record_id", "id", "payload_digest", "refers_to_record")
    revisits = heads.where("record_type = 'revisit'").select("payload_digest", F.col("refers_to_record").alias("_ref")).distinct()
    answers = heads.where("record_type = 'response'").select(F.col("payload_digest").alias("_digest"), "record_id", F.col("id").alias("_id"))
    named = F.when(F.col("record_id").eqNullSafe(F.col("_ref")), 0).otherwise(1)
    best = revisits.join(answers, F.col("payload_digest") == F.col("_digest")).groupBy("payload_digest", "_ref") \
        .agg(F.min(F.struct(named, F.col("_id").isNull(), "_id")).getField("_id").alias("refers_to")) \
        .select(F.col("payload_digest").alias("_digest"), F.col("_ref").alias("_named"), "refers_to")
    found = written(best, "warc-revisits")
    return records.join(found, (F.col("record_type") == "revisit") & (F.col("payload_digest") == F.col("_digest"))
                        & F.col("refers_to_record").eqNullSafe(F.col("_named")), "left").drop("_digest", "_named")


def rededuplicate(records: DataFrame, path: str, min_bytes: int = 0, date: str | None = None) -> None:
    """Write read records as new archives: revisits get their response's payload back, then all are
    deduplicated again with fresh headers.  A revisit without its response is left out, as its payload is unknown."""
    answers = records.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("_digest")).agg(F.min("payload").alias("_payload"))
    whole = records.where("record_type in ('response', 'revisit')").join(answers, F.col("payload_digest") == F.col("_digest"), "left")
    write_warc(whole.select("id", "url", F.coalesce("payload", "_payload").alias("payload")).where("payload is not null"), path, min_bytes, date)
