"""A content-addressed WARC archive.

Each distinct payload is stored once under its SHA-256 digest, checked when it is read.
Record headers are kept exactly, byte for byte, in a table of their own, and an original
record is its header block joined with its payload. ``export_files`` writes the records as
``.warc`` files and ``import_files`` reads such files by their Content-Length.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from glyphline.llm.common import query, same, table, whole, written
from glyphline.session import scratch_path

MIN_REVISIT_BYTES = 100
CRLF = "\r\n"
END = CRLF + CRLF
GZIP = b"\x1f\x8b"
RECORDS_PER_FILE = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _id_text(page: str | Column) -> Column:
    return F.coalesce((F.col(page) if isinstance(page, str) else page).cast("string"), F.lit("none"))


def records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_revisit: int = MIN_REVISIT_BYTES, date: str = "2020-01-01T00:00:00Z",
) -> DataFrame:
    """One record per page: page_id, digest, bytes, header block, payload.

    Of the pages with one payload of ``min_revisit`` bytes or more the smallest page_id is
    the response and the others revisit it; the smallest id per digest is an aggregate with
    map-side combine, and the join back moves ids and digests, not payloads. A null payload is empty; a
    null url is left out of the header; null page ids come after all others (and are
    responses when no page of the payload has an id); rows that repeat the smallest id are
    responses too.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), whole(payload_col).cast("binary").alias("payload")
    ).select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("bigint").alias("bytes"))
    firsts = (
        rows.filter(F.col("bytes") >= min_revisit)
        .groupBy(F.col("digest").alias("of"))
        .agg(F.min("page_id").alias("first"))
        .filter("first IS NOT NULL")
    )
    headed = rows.select("page_id", "url", "digest", "bytes").join(firsts, F.col("digest") == F.col("of"), "left")
    first = F.col("first")
    revisit = first.isNotNull() & ~same(F.col("page_id"), first)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    # a header is one line, so line breaks inside an address are percent-encoded
    uri = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), _id_text("page_id"), F.lit(">"))),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", uri)).otherwise(F.lit("")),
        line("WARC-Date", F.lit(date)),
        F.when(
            revisit,
            F.concat(
                line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), _id_text("first"), F.lit(">"))),
                line("WARC-Profile", F.lit(PROFILE)),
            ),
        ).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("WARC-Payload-Length", F.col("bytes").cast("string")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit(CRLF),
    )
    return headed.select("page_id", "digest", "bytes", header.alias("header"), (~revisit).alias("is_response"))


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_revisit: int = MIN_REVISIT_BYTES,
) -> None:
    """Write ``headers`` (page_id, digest, header) and ``payloads`` (digest, bytes, payload) below ``path``.

    A payload is stored once: of the pages that share it, the row that is met first in the
    digest's group is written, whatever page it is from. The group is formed on map-side
    combined rows, so copies of one payload do not meet in one task in full. A null payload is stored as an empty
    one; a null or repeated page_id has its header like any other; an empty table makes an empty archive; other
    columns are not read.
    """
    heads = records(pages, id_col, url_col, payload_col, min_revisit)
    heads.select("page_id", "digest", "header").write.option("compression", "zstd").parquet(f"{path}/headers")
    payload = whole(payload_col).cast("binary")
    stored = pages.select(F.sha2(payload, 256).alias("digest"), payload.alias("payload"))
    stored.dropDuplicates(["digest"]).write.option("compression", "zstd").parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive: page_id, digest, header and the verified payload.

    Payloads are digested again when read; one that does not match its digest ends the job.
    """
    heads = spark.read.parquet(f"{path}/headers")
    found = F.sha2("payload", 256)
    stored = spark.read.parquet(f"{path}/payloads").select(
        F.col("digest").alias("address"),
        F.when(found == F.col("digest"), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "digest")).cast("binary"))
        .alias("payload"),
    )
    return heads.join(stored, F.col("digest") == F.col("address"), "left").drop("address")


def header_field(header: str | Column, name: str) -> Column:
    """A field of a header block, or null."""
    value = F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def described(records_read: DataFrame) -> DataFrame:
    """What the records say of themselves, with the payload's real length."""
    page = F.regexp_extract(header_field("header", "WARC-Refers-To"), "^<urn:page:(.*)>$", 1)
    return records_read.select(
        "page_id",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.regexp_replace(header_field("header", "WARC-Payload-Digest"), "^sha256:", "").alias("payload_digest"),
        header_field("header", "WARC-Type").alias("record_type"),
        page.cast("bigint").alias("refers_to"),
    )


def export_files(archive: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE, compression: str = "gzip") -> None:
    """Write records as WARC files, so many in a file at most: a response holds its payload, a revisit none."""
    is_response = header_field("header", "WARC-Type") == "response"
    body = F.when(is_response, F.col("payload").cast("string")).otherwise(F.lit(""))
    writer = archive.select(F.concat("header", body)).write.option("lineSep", END).option("compression", compression)
    writer.option("maxRecordsPerFile", records_per_file).text(path)


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content in batch["content"]:
            if content[:2] == GZIP:
                content = gzip.decompress(content)
            found, at = [], 0
            while at < len(content):
                if (end := content.find(END.encode(), at)) < 0:
                    raise ValueError("a WARC file ends inside a record")
                end += len(END)
                header = content[at:end].decode()
                length = next(
                    int(x.partition(":")[2]) for x in header.split(CRLF) if x.lower().startswith("content-length:")
                )
                if end + length + len(END) > len(content):
                    raise ValueError("a WARC file ends inside a record")
                found.append((header, content[end : end + length]))
                at = end + length + len(END)
            yield pd.DataFrame(found, columns=["header", "payload"])


def import_files(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files as header block and payload; a file is read by one task.

    An empty file has no records; a record without payload has an empty one; records that repeat each stay. A file
    whose last record is cut short, or has no Content-Length, is an error.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(_parse, "header string, payload binary")


def resolved(files_read: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of records read from files.

    A response's payload is digested again, and one that does not match its header ends the job; a revisit has the
    length of the response with its digest, by a join of ids and digests. An id that is no number is null.
    """
    page = lambda name: F.regexp_extract(header_field("header", name), "^<urn:page:(.*)>$", 1).try_cast("bigint")
    stated = F.regexp_replace(header_field("header", "WARC-Payload-Digest"), "^sha256:", "")
    rows = files_read.select(
        page("WARC-Record-ID").alias("page_id"), header_field("header", "WARC-Type").alias("record_type"), stated.alias("stated"),
        page("WARC-Refers-To").alias("refers_to"), F.sha2("payload", 256).alias("digest"),
        F.octet_length("payload").cast("bigint").alias("bytes"),
    )
    rows = written(rows, "records")
    damaged = F.raise_error(F.concat(F.lit("damaged payload "), "stated")).cast("string")
    responses = rows.filter("record_type = 'response'").select(
        "page_id", F.col("bytes").alias("payload_bytes"),
        F.when(F.col("stated") == F.col("digest"), F.col("digest")).otherwise(damaged).alias("payload_digest"),
        "record_type", "refers_to",
    )
    lengths = responses.groupBy(F.col("payload_digest").alias("of")).agg(F.first("payload_bytes").alias("payload_bytes"))
    revisits = rows.filter("record_type = 'revisit'").join(lengths, F.col("stated") == F.col("of"), "left")
    return responses.unionByName(
        revisits.select("page_id", "payload_bytes", F.col("stated").alias("payload_digest"), "record_type", "refers_to")
    )


@query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
    FROM f
    """
)
def op4_warc_archive(spark, sf):
    path = scratch_path(spark, "warc")
    write_archive(table(spark, sf, "pages"), path)
    export_files(read_archive(spark, path), f"{path}/files")
    return resolved(import_files(spark, f"{path}/files"))
