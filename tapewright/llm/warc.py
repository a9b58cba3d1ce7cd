"""WARC archives: one gzip stream per file to one member per record, with an index of offsets.

1. ``write_monolithic``: rows become WARC/1.1 records in files that are one gzip stream each, as many
   crawlers and tools leave them. Spark's text writer does it: a record is a line that ends with the
   two empty lines that close a record, so files come and go with Spark's commit. Of equal payloads
   of at least ``least_bytes`` that of the largest id is written in full (a response), the others as
   revisits that name it; one aggregate with a row per repeated payload, joined by its counted size,
   so that a payload which most pages share is no larger task than others.
2. ``normalise``: a task inflates a file once, from its first byte to its last, and deflates each
   record as a member of its own; headers are parsed, blocks are passed on in pieces, so that neither
   file nor record is ever held. Beside each archive it writes its index, a line per record (offset,
   length of the member, record id, type, block length). Files are written under a name of their own
   per attempt, and the returned table of index lines, committed by Spark, tells which are valid.
3. ``read_back``: index lines are dealt out in chunks of a file; a task seeks to each member, inflates
   it and reads headers, payload length and SHA-1 from what is there.

Tasks open archives by URI through Arrow's file systems (local and shared folders, HDFS, S3, GCS).

Defined results: a null payload is empty; a null or empty URL leaves the target header out; line ends
in URLs are percent-encoded. A row without an id never becomes the response of others that have one;
rows that share id and payload are all responses if the id is the largest. Input files may hold
several gzip members; a file that breaks off, or a record whose digest is not that of its payload, is
an error. Revisits give length and digest of the payload they refer to, as their headers tell. Empty
tables give empty results. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm.common import exact, materialize, ship
from tapewright.operators.joins import join_lookup
from tapewright.session import scratch_path

#: Records of an archive at most, and those that one task reads back at a time.
RECORDS_PER_FILE, CHUNK = 20_000, 1_000
#: Index lines that a task holds at a time.
LINES = 5_000
_PIECE = 1 << 18
# Parts of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTENT_TYPE = "application/http; msgtype=response"

INDEX = (
    "archive string, offset long, length long, record_id string, record_type string, block_bytes long"
)
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


# --- records -----------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``pages`` (page_id, url, body) with bytes, digest, record_type and refers_to."""
    sized = pages.withColumns(
        {"bytes": F.octet_length("body").cast("long"), "digest": F.sha1(F.col("body").cast("binary")),
         "print": F.xxhash64("body")}
    )
    keys = ["digest", "bytes", "print"]
    seen = sized.where(F.col("bytes") >= least_bytes).groupBy(*keys)
    repeated = seen.agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    out = join_lookup(sized, repeated, keys, how="left")
    again = F.coalesce(~F.col("kept").eqNullSafe(F.col("page_id")) & F.col("kept").isNotNull(), F.lit(False))
    return out.select(
        "page_id", "url", "body", "bytes", "digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("kept")).alias("refers_to"),
    )


def _record_id(page_id: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), digest, F.lit(">"))


def record_text(date: str) -> Column:
    """The record of a row of ``with_revisits``, without the empty lines at its end."""
    line = lambda name, value: F.concat(F.lit(f"\r\n{name}: "), value)
    revisit = F.col("record_type") == "revisit"
    target = F.nullif(F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(""))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"), line("Content-Length", F.col("bytes").cast("string")), F.lit(END)
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "body"))
    nothing = F.lit("")
    return F.concat(
        F.lit(VERSION), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        line("WARC-Date", F.lit(date)), F.coalesce(line("WARC-Target-URI", target), nothing),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("digest"))))).otherwise(nothing),
        line("Content-Type", F.lit(CONTENT_TYPE)), line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END), block,
    )


def write_monolithic(
    pages: DataFrame, path: str, least_bytes: int = 1_000, date: str = "1970-01-01T00:00:00Z",
    payload: str = "html", page_id: str = "page_id", url: str = "url",
) -> str:
    """Write the rows as WARC files that are one gzip stream each; returns ``path``."""
    own = exact(pages, page_id, url, payload).toDF("page_id", "url", "body")
    own = own.select(F.col("page_id").cast("long"), "url", F.coalesce("body", F.lit("")).alias("body"))
    records = with_revisits(own, least_bytes).select(record_text(date).alias("value"))
    writer = records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.text(path)
    return path


# --- streams -----------------------------------------------------------------------------------


def _open(uri: str):
    """The file system of a URI and the path in it."""
    from pyarrow import fs

    local = re.fullmatch(r"(?:file:)?(?://(?=/))?(/.*)", uri)
    return (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(uri)


class Inflated:
    """What a gzip stream holds, read forward once; several members are one after the other."""

    def __init__(self, stream):
        self.stream, self.buffer, self.at = stream, bytearray(), 0
        self.inflate, self.begun, self.left = zlib.decompressobj(31), False, b""

    def _more(self) -> bool:
        """Inflate another piece; false at the end of the file."""
        while True:
            raw = self.left or self.stream.read(_PIECE)
            self.left = b""
            if not raw:
                if self.begun and not self.inflate.eof:
                    raise ValueError("gzip: the stream breaks off")
                return False
            if self.inflate.eof:
                self.inflate, self.begun = zlib.decompressobj(31), False
            out = self.inflate.decompress(raw, _PIECE)
            self.begun = True
            self.left = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if out:
                del self.buffer[: self.at]
                self.at = 0
                self.buffer += out
                return True

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes | None:
        """All up to and with ``mark``; None at the end of the stream."""
        while (to := self.buffer.find(mark, self.at)) < 0:
            if len(self.buffer) - self.at > most:
                raise ValueError("WARC: header without end")
            if not self._more():
                if self.buffer[self.at :].strip():
                    raise ValueError("WARC: the last record breaks off")
                return None
        out = bytes(self.buffer[self.at : to + len(mark)])
        self.at = to + len(mark)
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes."""
        while n:
            if self.at == len(self.buffer) and not self._more():
                raise ValueError("WARC: the last record breaks off")
            out = bytes(self.buffer[self.at : self.at + n])
            self.at += len(out)
            n -= len(out)
            yield out


def header_fields(head: bytes) -> dict[str, str]:
    """Named fields of a record's or a message's head, names in lower case."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, mark, value in (x.partition(":") for x in lines) if mark}


def rewrite(source, sink) -> Iterator[tuple[int, int, str, str, int]]:
    """Each record of the stream ``source`` as a gzip member in ``sink``: its index line's fields."""
    stream, offset, mark = Inflated(source), 0, END.encode()
    while True:
        head = stream.until(mark)
        if head is None:
            return
        head = head.lstrip(b"\r\n")
        if not head.startswith(b"WARC/"):
            raise ValueError("WARC: no record where one should begin")
        fields = header_fields(head)
        size, member, length = int(fields["content-length"]), zlib.compressobj(6, zlib.DEFLATED, 31), 0
        length += sink.write(member.compress(head))
        for piece in stream.pieces(size):
            length += sink.write(member.compress(piece))
        if b"".join(stream.pieces(len(mark))) != mark:
            raise ValueError(f"WARC: record {fields.get('warc-record-id')} is longer than it says")
        length += sink.write(member.compress(mark) + member.flush())
        yield offset, length, fields.get("warc-record-id", ""), fields.get("warc-type", ""), size
        offset += length


# --- jobs --------------------------------------------------------------------------------------


def _index_batch(archive: str, lines: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    arrays = [pa.array(c, k) for c, k in zip(zip(*lines, strict=True), kinds, strict=True)]
    names = ["archive", "offset", "length", "record_id", "record_type", "block_bytes"]
    return pa.RecordBatch.from_arrays([pa.array([archive] * len(lines)), *arrays], names=names)


def normalise(spark: SparkSession, source: str, path: str) -> DataFrame:
    """The written index of all records of the gzip WARC files below ``source``.

    Archives and their indexes (``.idx``) go to ``path``; a task takes a file.
    """
    files = spark.read.format("binaryFile").load(source).select("path")  # contents are not read
    n = files.count()
    if not n:
        return spark.createDataFrame([], INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("path").to_pylist():
                system, place = _open(name)
                stem = re.sub(r"(\.txt|\.warc)?\.gz$", "", place.rsplit("/", 1)[-1])
                # An attempt's own name: one that dies, or runs twice, leaves no half file that counts.
                archive = f"{path}/{stem}-{uuid.uuid4().hex[:8]}.warc.gz"
                out, goal = _open(archive)
                out.create_dir(goal.rsplit("/", 1)[0], recursive=True)
                with (
                    system.open_input_stream(place, compression=None) as raw,
                    out.open_output_stream(goal, compression=None) as sink,
                    out.open_output_stream(goal + ".idx", compression=None) as side,
                ):
                    lines = rewrite(raw, sink)
                    while some := list(islice(lines, LINES)):
                        side.write("".join("\t".join(map(str, line)) + "\n" for line in some).encode())
                        yield _index_batch(archive, some)

    dealt = files.repartitionByRange(n, "path")
    return materialize(dealt.mapInArrow(run, INDEX), "warc-index")


def _read_record(raw, length: int) -> tuple:
    """RECORD's fields of the member that ``raw`` stands at."""
    stream = Inflated(_Window(raw, length))
    fields = header_fields(stream.until(END.encode()))
    size = int(fields["content-length"])
    http = stream.until(END.encode())
    sha, got = hashlib.sha1(), 0
    for piece in stream.pieces(size - len(http)):
        sha.update(piece)
        got += len(piece)
    _, page, digest = fields["warc-record-id"].strip("<>").rsplit(":", 2)
    kind, refers = fields["warc-type"], None
    told = int(header_fields(http)["content-length"])
    if kind == "revisit":
        refers = int(fields["warc-refers-to"].strip("<>").rsplit(":", 2)[1])
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
    elif sha.hexdigest() != digest or got != told:
        raise ValueError(f"WARC: record of page {page} does not hold what its head says")
    return None if page == "none" else int(page), fields.get("warc-target-uri"), told, digest, kind, refers


class _Window:
    """The next ``length`` bytes of an open file."""

    def __init__(self, raw, length: int):
        self.raw, self.left = raw, length

    def read(self, n: int) -> bytes:
        out = self.raw.read(min(n, self.left))
        self.left -= len(out)
        return out


def read_back(index: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of all indexed records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, raw = None, None
        for batch in batches:
            out = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                if archive != name:
                    if raw:
                        raw.close()
                    system, place = _open(archive)
                    name, raw = archive, system.open_input_file(place)
                raw.seek(offset)
                out.append(_read_record(raw, length))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        if raw:
            raw.close()

    # Chunks of a file: about CHUNK records by their share of the file.
    rows = index.select("archive", "offset", "length")
    mean = rows.groupBy("archive").agg(F.ceil(F.avg("length") * CHUNK).alias("span"))
    chunked = join_lookup(rows, mean, ["archive"]).withColumn("chunk", F.floor(F.col("offset") / F.col("span")))
    dealt = chunked.repartition("archive", "chunk").sortWithinPartitions("archive", "offset")
    return dealt.select("archive", "offset", "length").mapInArrow(run, RECORD)


def archived(pages: DataFrame, path: str | None = None, least_bytes: int = 1_000) -> DataFrame:
    """Write ``pages`` as monolithic archives, normalise them and read them back.

    Files go below ``path`` (monolithic/, members/), else below the shared folder.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_monolithic(pages, f"{path}/monolithic", least_bytes)
    return read_back(normalise(spark, f"{path}/monolithic", f"{path}/members"))


ship(__name__)
