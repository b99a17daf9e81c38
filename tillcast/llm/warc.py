"""WARC archives: writing, normalising monolithic gzip, and reading by offset.

A crawl's archives are often one gzip stream over the whole file, which can
only be read from the start. The normaliser inflates such a stream once, piece
by piece, writes every record as a gzip member of its own and, beside the
archive, an index with each member's offset and length. From then on any
record can be fetched alone, so reading is spread by ranges of records.

Archives are written by Spark's text writer: a record is a line, its line end
is the empty line that ends a WARC record, and gzip covers the whole file. The
normaliser's and reader's files go through ``pyarrow.fs``, so the shared folder
may be any file system it knows. A file is written under a name of its own
attempt and then moved into place, so a lost or repeated task leaves no half
archive.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import prepare, stored
from tillcast.session import checkpoint_dir, remember_written

END = b"\r\n\r\n"
LEAST_REVISIT = 1000
PIECE = 1 << 20
RANGE_BYTES = 4 << 20
LEVEL = 6
_DATE = "2020-01-01T00:00:00Z"


def plan_records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Each page's payload, its digest, and whether it is a response or a revisit.

    Only digests found twice or more are joined back, and only as (digest,
    length, largest id), so one payload that makes up a third of all pages
    costs a partial maximum; Spark splits its rows in the join.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    held = pages.select(
        "page_id",
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(F.encode(payload, "UTF-8")).alias("payload_digest"),
    )
    large = held.where(F.col("payload_bytes") >= least)
    copies = large.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    copies = copies.where(F.col("n") > 1).select(
        F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("b"), "first"
    )
    found = held.join(copies, (held["payload_digest"] == copies["d"]) & (held["payload_bytes"] == copies["b"]), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return found.select(
        *held.columns,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def _uri(page_id: str):
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.lit(">"))


def record_text(planned: DataFrame) -> DataFrame:
    """One WARC record a row as text, without its closing empty line.

    A revisit has no body; its payload's digest and length stand in headers.
    """
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(""))
    target = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]+", " ")
    refers = F.when(F.col("refers_to").isNotNull(), line("WARC-Refers-To", _uri("refers_to"))).otherwise(F.lit(""))
    return planned.select(
        F.concat(
            F.lit("WARC/1.1\r\n"),
            line("WARC-Type", F.col("record_type")),
            line("WARC-Record-ID", _uri("page_id")),
            line("WARC-Date", F.lit(_DATE)),
            line("WARC-Target-URI", target),
            refers,
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
            line("Content-Type", F.lit("text/html; charset=utf-8")),
            line("Content-Length", F.octet_length(body).cast("string")),
            F.lit("\r\n"),
            body,
        ).alias("value")
    )


def write_monolithic(records: DataFrame, folder: str) -> None:
    """Records as gzip archives, each one stream over the whole file."""
    records.write.option("lineSep", END.decode()).option("compression", "gzip").text(folder)


def _file_system(path: str):
    """``pyarrow`` file system and path of a Hadoop path or URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def inflate(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Inflate a gzip stream of one or more members, piece by piece."""
    engine = zlib.decompressobj(wbits=31)
    for piece in pieces:
        while piece:
            out = engine.decompress(piece, PIECE)
            if out:
                yield out
            piece = engine.unconsumed_tail
            if engine.eof:
                piece = engine.unused_data
                engine = zlib.decompressobj(wbits=31)
        tail = engine.flush() if engine.eof else b""
        if tail:
            yield tail


def parse_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Headers, whole record (without closing empty line) and body of each record."""
    held = bytearray()
    done = False

    def more() -> bool:
        nonlocal done
        piece = next(pieces, None)
        done = piece is None
        held.extend(piece or b"")
        return not done

    at = 0
    while True:
        head = held.find(END, at)
        while head < 0:
            seen = max(at, len(held) - len(END))
            if not more():
                if held[at:].strip():
                    raise ValueError("an archive ends inside a record's headers")
                return
            head = held.find(END, seen)
        headers = parse_headers(bytes(held[at:head]))
        start = head + len(END)
        end = start + int(headers["content-length"])
        while len(held) < end + len(END):
            if not more():
                raise ValueError("an archive ends inside a record")
        if held[end : end + len(END)] != END:
            raise ValueError("a record does not end where its length says")
        yield headers, bytes(held[at:end]), bytes(held[start:end])
        at = end + len(END)
        if at > PIECE:
            del held[:at]
            at = 0


def parse_headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("a record does not start with its version")
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}


def member(record: bytes, level: int = LEVEL) -> bytes:
    """One record as a gzip member without time stamp: equal records give equal bytes."""
    engine = zlib.compressobj(level, zlib.DEFLATED, 31)
    return engine.compress(record + END) + engine.flush()


INDEX_SCHEMA = "archive string, offset long, length long, record_id string, record_type string"


def normalise(spark: SparkSession, source: str, target: str, level: int = LEVEL) -> DataFrame:
    """Rewrite every archive under ``source`` into ``target``; returns the index.

    Each archive is one task's stream of pieces; memory holds one piece and
    one record. Beside ``x.warc.gz`` stands ``x.warc.gz.idx`` with one line
    ``offset length record_id record_type`` for each member.
    """
    prepare(spark)
    files = spark.read.format("binaryFile").load(source).select("path")

    def rewrite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out_fs, out = _file_system(target)
        for path in (p for frame in frames for p in frame["path"]):
            in_fs, name = _file_system(path)
            base = name.rsplit("/", 1)[-1].split(".", 1)[0]
            archive = f"{out}/{base}.warc.gz"
            attempt = f"{out}/_{base}.{uuid.uuid4().hex}"
            offset = records = 0
            with (
                in_fs.open_input_stream(name, compression=None) as stream,
                out_fs.open_output_stream(attempt, compression=None) as sink,
                out_fs.open_output_stream(attempt + ".idx", compression=None) as index,
            ):
                pieces = iter(lambda: stream.read(PIECE), b"")
                for headers, record, _ in parse_records(inflate(pieces)):
                    packed = member(record, level)
                    sink.write(packed)
                    index.write(f"{offset} {len(packed)} {headers['warc-record-id']} {headers['warc-type']}\n".encode())
                    offset += len(packed)
                    records += 1
            out_fs.move(attempt + ".idx", archive + ".idx")
            out_fs.move(attempt, archive)
            yield pd.DataFrame({"archive": [archive], "records": [records]})

    _file_system(target)[0].create_dir(_file_system(target)[1], recursive=True)
    tasks = files.repartition(max(1, files.count()), "path")
    stored(tasks.mapInPandas(rewrite, "archive string, records long"), "warc_normalised")
    return read_index(spark, target)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """``archive, offset, length, record_id, record_type`` of all sidecar files."""
    lines = spark.read.option("pathGlobFilter", "*.idx").text(folder).withColumn("file", F.input_file_name())
    part = F.split("value", " ", 4)
    return lines.select(
        F.regexp_replace(F.regexp_replace("file", r"\.idx$", ""), "%20", " ").alias("archive"),
        part[0].cast("long").alias("offset"),
        part[1].cast("long").alias("length"),
        part[2].alias("record_id"),
        part[3].alias("record_type"),
    )


RECORD_SCHEMA = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, body_ok boolean"
)


def _page(uri: str | None) -> int | None:
    number = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read_records(index: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fetch every indexed record alone and describe its payload.

    Records are dealt to tasks by archive and range of offsets. A response's
    length and digest are those of the body read; a revisit's come from its
    headers. ``body_ok`` says that body and headers agree.
    """
    dealt = index.select("archive", "offset", "length", F.floor(F.col("offset") / range_bytes).alias("range"))
    # By the bytes to fetch: the index itself is so small that AQE would make it one task.
    tasks = max(1, -(-(index.agg(F.sum("length")).first()[0] or 0) // range_bytes))
    dealt = dealt.repartition(int(tasks), "archive", "range").sortWithinPartitions("archive", "offset")

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, file = None, None
        for frame in frames:
            rows = []
            for archive, offset, length in zip(frame["archive"], frame["offset"], frame["length"]):
                if archive != opened:
                    system, name = _file_system(archive)
                    file, opened = system.open_input_file(name), archive
                file.seek(int(offset))
                raw = zlib.decompress(file.read(int(length)), wbits=31)
                headers, _, body = next(parse_records(iter([raw])))
                size, digest = int(headers["warc-payload-length"]), headers["warc-payload-digest"].removeprefix("sha1:")
                kind = headers["warc-type"]
                ok = True
                if kind == "response":
                    found = hashlib.sha1(body).hexdigest()
                    ok = (len(body), found) == (size, digest)
                    size, digest = len(body), found
                refers = _page(headers.get("warc-refers-to"))
                rows.append((_page(headers["warc-record-id"]), size, digest, kind, refers, ok))
            out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "body_ok"])
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    return dealt.mapInPandas(fetch, RECORD_SCHEMA)


def archive_round_trip(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Write every page as a WARC record, normalise the archives, read them back.

    ``pages`` has ``page_id, url, html``. Defined results: a null html has an
    empty payload; rows with equal payloads of at least ``least`` bytes are
    revisits of the one with the largest page id, and all rows that carry that
    id are responses; a null id is kept and refers to the largest other; an
    empty table gives no rows; a payload may hold anything, record ends included.
    """
    spark = pages.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/warc/{uuid.uuid4().hex}"
    remember_written(spark, folder)  # drop_materialized deletes it
    write_monolithic(record_text(plan_records(pages, least)), f"{folder}/monolithic")
    index = normalise(spark, f"{folder}/monolithic", f"{folder}/archives")
    records = read_records(index)
    wrong = F.raise_error(F.concat(F.lit("body and headers differ, page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))))
    digest = F.when(F.col("body_ok"), F.col("payload_digest")).otherwise(wrong.cast("string"))
    return records.withColumn("payload_digest", digest).drop("body_ok")
