"""A content-addressed web archive.

Two tables: ``payloads`` holds each distinct payload once, by its SHA-256; ``headers`` holds
the exact header block of every record and the digest of its payload. Records are
reconstructed by a join on the digest, and a payload is only given out if its digest is what
it is stored under. ``export`` writes the records as WARC files, ``parse`` reads them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeledger.llm.store import join_small, new_folder, stored

#: Fixed values of the format.
VERSION = "WARC/1.1"
LINE = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this many bytes are stored with every record.
LEAST_REVISIT = 100
#: Date of records whose page has none.
DATE = "1970-01-01T00:00:00Z"


def _header(kind: Column, refers_to: Column) -> Column:
    """The exact header block, up to and with the empty line."""
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "")
    record = lambda page, url: F.concat(
        F.lit("<urn:sha256:"), F.sha2(F.concat_ws(" ", F.coalesce(page.cast("string"), F.lit("null")), url), 256), F.lit(">")
    )
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record(F.col("page_id"), F.coalesce("url", F.lit("")))),
        F.lit(f"WARC-Date: {DATE}"),
        F.when(uri != "", F.concat(F.lit("WARC-Target-URI: "), uri)),
        F.when(F.col("page_id").isNotNull(), F.concat(F.lit("X-Page-ID: "), F.col("page_id").cast("string"))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(kind == "revisit", F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(kind == "revisit", F.concat(F.lit("X-Refers-To-Page: "), refers_to.cast("string"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(kind == "revisit", F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
    ]
    return F.concat(F.concat_ws(LINE, *lines), F.lit(LINE + LINE)).cast("binary")


def write_archive(pages: DataFrame, folder: str) -> None:
    """Writes ``folder``/headers and ``folder``/payloads for pages (page_id, url, html).

    A null html is an empty payload. Of records with equal payloads of ``LEAST_REVISIT``
    bytes or more, that with the smallest page_id is the response and the others revisit it;
    null ids come last, and where all are null, all are responses, as are rows that repeat
    the smallest id. Each revisit keeps its own header. Further columns are ignored.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    rows = pages.withColumns({"digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    narrow = stored(rows.drop("payload"), "records")
    groups = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = stored(groups.where("n > 1"), "groups")
    spread = F.struct("page_id", "url")
    known = join_small(narrow, groups, ["digest"], spread=spread)
    one = F.col("first").isNull() | (F.col("payload_bytes") < LEAST_REVISIT) | F.col("page_id").eqNullSafe(F.col("first"))
    kind = F.when(one, "response").otherwise("revisit")
    headers = known.withColumn("kind", kind).select("digest", _header(F.col("kind"), F.col("first")).alias("header"))
    headers.write.parquet(f"{folder}/headers")
    # payloads that occur once don't move; of the others, only the first page's do
    kept = join_small(rows, groups, ["digest"], spread=spread)
    single = kept.where("n is null").select("digest", "payload")
    shared = kept.where("n > 1 and page_id <=> first").select("digest", "payload").dropDuplicates(["digest"])
    single.unionByName(shared).write.parquet(f"{folder}/payloads")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """(header, payload, digest): each record with its exact header and its full payload.

    A payload that doesn't have the digest it is stored under, or is missing, is an error.
    """
    headers = spark.read.parquet(f"{folder}/headers")
    payloads = spark.read.parquet(f"{folder}/payloads")
    found = headers.join(payloads, "digest", "left")
    wrong = F.raise_error(F.concat(F.lit("payload is missing or damaged: "), F.col("digest"))).cast("binary")
    sound = F.sha2("payload", 256).eqNullSafe(F.col("digest"))
    return found.select("digest", "header", F.when(sound, F.col("payload")).otherwise(wrong).alias("payload"))


def field(name: str, header: Column) -> Column:
    """A named field of a header block, or null."""
    found = F.regexp_extract(header.cast("string"), rf"(?:^|\r\n){name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def records(archive: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of read records."""
    return archive.select(
        field("X-Page-ID", F.col("header")).cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        field("WARC-Type", F.col("header")).alias("record_type"),
        field("X-Refers-To-Page", F.col("header")).cast("long").alias("refers_to"),
    )


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archives ``pages`` in a new folder of the shared ones, reads the archive back and gives
    ``records``. An empty table gives no rows."""
    folder = folder or new_folder(pages.sparkSession, "archive")
    write_archive(pages, folder)
    return records(read_archive(pages.sparkSession, folder))


def export(archive: DataFrame, folder: str) -> None:
    """Writes read records as WARC files: header, payload (none for revisits), two line ends."""
    body = F.when(field("WARC-Type", F.col("header")) == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat(F.col("header"), body).cast("string").alias("value")
    archive.select(record).write.option("lineSep", LINE + LINE).text(folder)


def parse(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(header block, body) of each record of one WARC file."""
    at, end = 0, (LINE + LINE).encode()
    while at < len(data):
        stop = data.index(end, at) + len(end)
        header = data[at:stop]
        length = next(int(x[15:]) for x in header.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        yield header, data[stop : stop + length]
        at = stop + length + len(end)
