"""WARC archives: write pages as records, read archives back by verifying the chain of record boundaries.

Archives are written by Spark's text writer with the record terminator as line separator, so files are plain WARC on any
store Spark writes to. Reading splits files anywhere: Spark's text reader cuts them at each occurrence of the version line,
wherever it stands. Each cut is a candidate; its header says where its successor must begin. Pointer jumping from the start
of each file keeps the candidates that the chain reaches, so a version line inside a payload is no record.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veloflow.llm.common import new_path, written

MAGIC = b"WARC/1.1\r\n"
END = "\r\n\r\n"
PAGE_URN = "urn:veloflow:page:"
#: Payloads below this length are stored again each time.
LEAST_REVISIT = 100
#: Digests that come more than once are broadcast up to this number (40 bytes each), joined otherwise.
FEW_DIGESTS = 50_000


def header(**fields: Column) -> Column:
    """Header lines; a null field is left out. Line breaks within a value would end it, so they are escaped."""
    lines = [F.concat(F.lit(f"{name.replace('_', '-')}: "), F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit("\r\n")) for name, value in fields.items()]
    return F.concat(*(F.coalesce(line, F.lit("")) for line in lines))


def records(pages: DataFrame) -> DataFrame:
    """One string per page: a whole record without its terminator.

    Of equal payloads of at least LEAST_REVISIT bytes the one with the smallest page_id is the response and the others are
    revisits of it, which carry the digest and the length but not the payload. Null html is an empty payload; a row that
    repeats the response's page_id is a response too.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.unhex(F.sha2(html.cast("binary"), 256)).alias("digest"), F.octet_length(html).cast("long").alias("size"))
    repeated = rows.filter(F.col("size") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND first IS NOT NULL").drop("n")
    repeated = written(repeated, "digests")
    few = repeated.count() <= FEW_DIGESTS
    joined = rows.join(F.broadcast(repeated) if few else repeated, "digest", "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    urn = lambda c: F.concat(F.lit(f"<{PAGE_URN}"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    digest = F.lower(F.hex("digest"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), header(Content_Type=F.lit("text/html; charset=utf-8"), Content_Length=F.col("size")), F.lit("\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    head = header(
        WARC_Type=F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        WARC_Record_ID=urn(F.col("page_id")),
        WARC_Date=F.lit("1970-01-01T00:00:00Z"),
        WARC_Target_URI=F.col("url"),
        WARC_Payload_Digest=F.concat(F.lit("sha256:"), digest),
        WARC_Refers_To=F.when(revisit, urn(F.col("first"))),
        WARC_Profile=F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        Content_Type=F.lit("application/http; msgtype=response"),
        Content_Length=F.octet_length(block),
    )
    return joined.select(F.concat(F.lit(MAGIC.decode()), head, F.lit("\r\n"), block).alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    """One archive for each task; an empty table gives archives without records."""
    records(pages).write.option("lineSep", END).text(path)


def _cuts(spark: SparkSession, path: str) -> DataFrame:
    """Pieces between version lines, in file order within each block of a file that a task reads."""
    text = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("piece"))


_FIELD = re.compile(rb"^([A-Za-z-]+):[ \t]*(.*?)[ \t]*$")


def parse(piece: bytes) -> tuple[dict[str, str], int, int] | None:
    """Header fields, where the block begins and its length; None where the piece does not begin with a record's header."""
    stop = piece.find(b"\r\n\r\n")
    if stop < 0:
        return None
    fields = {}
    for line in piece[:stop].split(b"\r\n"):
        if not (m := _FIELD.match(line)):
            return None
        fields[m[1].decode().lower()] = m[2].decode("utf-8", "replace")
    length = fields.get("content-length", "")
    return (fields, stop + 4, int(length)) if length.isdigit() and "warc-type" in fields else None


def content(fields: dict[str, str], block: bytes) -> tuple[int, str]:
    """Length and SHA-256 of the payload that a record's block has or, in a revisit, stands for."""
    stop = block.find(b"\r\n\r\n") + 4 if fields.get("content-type", "").startswith("application/http") else 0
    payload = block[stop:] if stop != 3 else block
    if fields["warc-type"] == "revisit":
        lengths = re.findall(rb"(?im)^content-length:\s*(\d+)", block[: max(stop, 0)])
        return int(lengths[0]) if lengths else len(payload), fields.get("warc-payload-digest", "").removeprefix("sha256:")
    return len(payload), hashlib.sha256(payload).hexdigest()


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(PAGE_URN)
    return int(number) if re.fullmatch(r"-?\d+", number) else None


_FOUND = "file string, block long, at long, length long, size long, whole boolean, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each piece: where it begins in its block of the file (``at``), its length, and, where a header begins it, the
    size of the record and what it holds if the piece holds all of it."""
    place: dict[tuple[str, int], int] = {}
    names = [f.split()[0] for f in _FOUND.split(", ")]
    for batch in batches:
        rows = []
        for file, block, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            at = place.get((file, block), 0)
            place[file, block] = at + len(piece) + len(MAGIC)
            row = [file, block, at, len(piece), None, False, None, None, None, None, None]
            if head := parse(piece):
                fields, start, length = head
                row[4] = len(MAGIC) + start + length + len(END)
                row[5] = row[4] == len(MAGIC) + len(piece)
                row[6:9] = _page(fields.get("warc-record-id")), fields["warc-type"], _page(fields.get("warc-refers-to"))
                if row[5]:
                    row[9:11] = content(fields, piece[start : start + length])
            rows.append(row)
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _placed(found: DataFrame) -> DataFrame:
    """Adds ``offset``, where the piece's version line begins in the file: blocks are added up in order."""
    blocks = found.groupBy(F.col("file").alias("f"), F.col("block").alias("b")).agg(F.sum(F.col("length") + len(MAGIC)).alias("n"))
    before = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("f", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return found.join(starts, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))).withColumn("offset", F.col("base") + F.col("at") - len(MAGIC)).drop("f", "b", "base")


def reached(candidates: DataFrame) -> DataFrame:
    """(file, offset) of the candidates that the chain from offset 0 of each file reaches, by pointer jumping.

    Every round doubles the step: what is reached jumps, and each pointer becomes the pointer of its target. The rounds
    grow with the logarithm of the records in a file. Each is written to the shared folder. Where the chain breaks (a cut
    archive), what lies behind is not reached.
    """
    jumps = candidates.filter("size IS NOT NULL").select("file", "offset", (F.col("offset") + F.col("size")).alias("next"))
    on = jumps.select("file", F.col("offset").alias("next"))
    jumps = written(jumps.join(on, ["file", "next"], "left_semi").select("file", "offset", "next"), "jumps")
    seen = written(candidates.filter("size IS NOT NULL AND offset = 0").select("file", "offset"), "reached")
    count = seen.count()
    while True:
        step = seen.join(jumps, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        seen = written(seen.unionAll(step).distinct(), "reached")
        now = seen.count()
        if now == count:
            return seen
        count = now
        then = jumps.select("file", F.col("offset").alias("next"), F.col("next").alias("after"))
        jumps = written(jumps.join(then, ["file", "next"]).select("file", "offset", F.col("after").alias("next")), "jumps")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record in the archives under ``path``.

    Records whose payload holds a version line are cut apart by the reader; they are put together from their pieces in a
    second read, which only takes place where there are any, and holds one record at a time.
    """
    found = written(_placed(_cuts(spark, path).mapInArrow(_candidates, _FOUND)).withColumn("file", F.xxhash64("file")), "candidates")
    records = written(found.join(reached(found), ["file", "offset"], "left_semi"), "records")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    parted = records.filter("NOT whole").select("file", "offset", "size")
    if parted.isEmpty():
        return records.select(columns)
    return records.filter("whole").select(columns).unionByName(_put_together(spark, path, parted).select(columns))


def _put_together(spark: SparkSession, path: str, parted: DataFrame) -> DataFrame:
    """Records from several pieces. A piece belongs to the last record that begins at or before it, if it reaches so far."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[tuple[str, int], int] = {}
        for batch in batches:
            at = []
            for file, block, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at.append(place.get((file, block), 0))
                place[file, block] = at[-1] + len(piece) + len(MAGIC)
            lengths = [len(p.as_py()) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64()), pa.array(lengths, pa.int64())], ["file", "block", "piece", "at", "length"])

    pieces = _placed(_cuts(spark, path).mapInArrow(measured, "file string, block long, piece binary, at long, length long")).withColumn("file", F.xxhash64("file"))
    pieces = pieces.join(parted.select("file").distinct(), "file", "left_semi").join(parted.withColumnRenamed("size", "reach"), ["file", "offset"], "left")
    last = Window.partitionBy("file").orderBy("offset")
    owned = pieces.withColumn("own", F.last(F.when(F.col("reach").isNotNull(), F.struct("offset", "reach")), True).over(last))
    owned = owned.filter("offset < own.offset + own.reach").select("file", F.col("own.offset").alias("record"), "offset", "piece")

    def whole(table: pa.Table) -> pa.Table:
        body = MAGIC.join(table.sort_by("offset").column("piece").to_pylist())
        fields, start, length = parse(body)
        size, digest = content(fields, body[start : start + length])
        return pa.table({
            "page_id": pa.array([_page(fields.get("warc-record-id"))], pa.int64()), "payload_bytes": pa.array([size], pa.int64()), "payload_digest": [digest],
            "record_type": [fields["warc-type"]], "refers_to": pa.array([_page(fields.get("warc-refers-to"))], pa.int64()),
        })

    return owned.groupBy("file", "record").applyInArrow(whole, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives into the shared folder and read them back; see ``records`` and ``read_archives``."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
