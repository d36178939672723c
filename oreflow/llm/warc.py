"""WARC archives written and read as tables of chunks, so that no task holds a whole payload twice."""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from oreflow.llm.common import Workspace, salted_lookup

#: Payload bytes in one record; more go on in continuation records.
CHUNK_BYTES = 1 << 20
#: Payloads below this are stored again, however often they come.
REVISIT_BYTES = 100
#: An empty gzip member: it stands between the members of an archive and decompresses to nothing.
MARK = gzip.compress(b"", mtime=0).decode("latin-1")
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _head(fields: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), "", ""]
    return "\r\n".join(lines).encode("utf-8", "replace")


def _member(fields: list[tuple[str, object]], block: bytes) -> bytes:
    return gzip.compress(_head([*fields, ("Content-Length", len(block))]) + block + b"\r\n\r\n", 6, mtime=0)


def _uri(url: str | None) -> str:
    """A url as one header line; characters that would end the line are escaped."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")


def _records(chunk: int):
    """One gzip member for each record: a response in as many segments as it needs, or a revisit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = ("page_id", "url", "digest", "refers_to", "row")
            rows = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
            for (page, url, digest, refers, row), html in zip(rows, batch.column("html"), strict=True):
                size = html.as_buffer().size if html.is_valid else 0
                name = f"<urn:oreflow:{'null' if page is None else page}:{row}>"
                base = [
                    ("WARC-Record-ID", name),
                    ("WARC-Date", DATE),
                    ("WARC-Target-URI", _uri(url)),
                    ("WARC-Payload-Digest", f"sha256:{digest}"),
                    ("X-Page-ID", "" if page is None else page),
                    ("X-Payload-Length", size),
                ]
                out = []
                if refers is not None:
                    more = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:oreflow:{refers}>")]
                    out.append(_member([("WARC-Type", "revisit"), *base, *more], b""))
                else:
                    raw = memoryview(html.as_buffer()) if html.is_valid else memoryview(b"")
                    so_far = hashlib.sha256()
                    starts = range(0, max(size, 1), chunk)
                    for i, lo in enumerate(starts):
                        part = raw[lo : lo + chunk]
                        so_far.update(part)
                        kind = "continuation" if i else "response"
                        fields = [("WARC-Type", kind), *base]
                        if len(starts) > 1:
                            if i:
                                fields[1] = ("WARC-Record-ID", f"{name[:-1]}:{i + 1}>")
                                fields.append(("WARC-Segment-Origin-ID", name))
                            fields.append(("WARC-Segment-Number", i + 1))
                            # The digest of all bytes up to here, so that a reader can stop at the first bad segment.
                            fields.append(("X-Digest-So-Far", f"sha256:{so_far.hexdigest()}"))
                            if i == len(starts) - 1:
                                fields.append(("WARC-Segment-Total-Length", size))
                        out.append(_member(fields, part))
                        if len(starts) > 1:
                            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])
                            out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    return run


CHUNKS = (
    "record_id string, chunk int, chunks int, page_id long, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, digest string, payload binary"
)


def _parse(member: bytes, chunk: int) -> tuple:
    raw = zlib.decompress(member, 31)
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode("utf-8").split("\r\n")
    f = dict(line.split(": ", 1) for line in lines[1:])
    body = raw[end + 4 : end + 4 + int(f["Content-Length"])]
    if raw[end + 4 + len(body) :] != b"\r\n\r\n" or len(body) != int(f["Content-Length"]):
        raise ValueError(f"a record of {f['WARC-Record-ID']} is cut off")
    size, number = int(f["X-Payload-Length"]), int(f.get("WARC-Segment-Number", 1))
    kind = "response" if f["WARC-Type"] == "continuation" else f["WARC-Type"]
    chunks = 1 if kind == "revisit" or "WARC-Segment-Number" not in f else -(-size // chunk)
    refers = f["WARC-Refers-To"].rsplit(":", 1)[1][:-1] if kind == "revisit" else None
    return (
        f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"]),
        number,
        chunks,
        int(f["X-Page-ID"]) if f["X-Page-ID"] else None,
        kind,
        size,
        f["WARC-Payload-Digest"].removeprefix("sha256:"),
        int(refers) if refers else None,
        f["WARC-Payload-Digest"] if chunks > 1 or kind == "revisit" else "sha256:" + hashlib.sha256(body).hexdigest(),
        body,
    )


_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
_NAMES = [c.split()[0] for c in CHUNKS.split(", ")]


def _read(chunk: int, payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for member in batch.column("member"):
                if not member.as_buffer().size:
                    continue
                row = _parse(member.as_py(), chunk)
                # Whole records were digested here; only segments still need their bytes.
                rows.append(row if payload or row[2] > 1 else (*row[:-1], None))
                held += len(rows[-1][-1] or b"")
                if held > 16 << 20:
                    yield _table(rows)
                    rows, held = [], 0
            yield _table(rows)

    return run


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def _join_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of records whose chunks follow each other in order; keeps one hash state, no payload."""
    record, state, seen, last = None, None, 0, None
    columns = [c for c in _NAMES if c != "payload"]

    def closed() -> pa.RecordBatch:
        if seen != last["chunks"]:
            raise ValueError(f"record {record} has {seen} of {last['chunks']} segments")
        row = {**last, "digest": "sha256:" + state.hexdigest()}
        types = dict(zip(_NAMES, _TYPES, strict=True))
        return pa.RecordBatch.from_arrays([pa.array([row[c]], types[c]) for c in columns], names=columns)

    for batch in batches:
        plain = batch.select(columns).to_pylist()
        for row, payload in zip(plain, batch.column("payload"), strict=True):
            if row["record_id"] != record:
                if record is not None:
                    yield closed()
                record, state, seen = row["record_id"], hashlib.sha256(), 0
            state.update(memoryview(payload.as_buffer()))
            seen, last = seen + 1, row
    if record is not None:
        yield closed()


def write_archives(pages: DataFrame, path: str, work: Workspace, chunk: int = CHUNK_BYTES) -> None:
    """WARC 1.1 archives of ``pages`` (``page_id``, ``url``, ``html``) as gzip files in the folder ``path``.

    Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the smallest
    ``page_id`` is stored and the others refer to it (if that id repeats, so does the stored record;
    pages without id are stored always).  A payload above ``chunk`` bytes goes on in continuation
    records, each a gzip member of its own with the digest of all bytes so far; nothing longer is ever
    compressed at once.  Null html is an empty payload, null url an empty target.

    Files are written by Spark's text writer, each line being one member and the line end an empty
    one, so they can lie in any store that Spark knows, and ``zcat`` shows them as one archive.
    """
    raw = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    plain = pages.select("page_id", "url", "html", F.sha2(raw, 256).alias("digest"), F.octet_length(raw).alias("size"))
    # Only ids and digests are compared; page by page the outcome then meets the payload.  A digest that a
    # third of all pages share is divided over many tasks, and so are pages without id.
    large = work.keep(plain.where(F.col("size") >= REVISIT_BYTES).select("page_id", "digest"), "digests")
    each = F.count(F.lit(1)).alias("n")
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), each).where("n > 1")
    again = salted_lookup(large, work.keep(firsts, "firsts"), "digest").where("page_id <> refers_to")
    named = lambda page: F.when(page.isNotNull(), F.concat_ws(":", page, "digest"))
    again = again.groupBy(named(F.col("page_id")).alias("name")).agg(F.max("refers_to").alias("refers_to"), each)
    joined = salted_lookup(plain.withColumn("name", named(F.col("page_id"))), work.keep(again, "revisits"), "name", "left")
    rows = joined.select(
        "page_id", "url", F.col("html").cast("binary").alias("html"), "digest", "refers_to",
        F.monotonically_increasing_id().alias("row"),
    )
    members = rows.mapInArrow(_records(chunk), "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", MARK).option(
        "encoding", "ISO-8859-1"
    ).text(path)


def read_chunks(spark, path: str, chunk: int = CHUNK_BYTES, payload: bool = True) -> DataFrame:
    """The archives' records as rows of ``CHUNKS``: one for each record, or for each of its segments.

    Large files are split between tasks at the empty members.  With ``payload`` false only segments of
    larger records keep their bytes.
    """
    lines = spark.read.option("lineSep", MARK).option("encoding", "ISO-8859-1").text(path)
    return lines.select(F.col("value").cast("binary").alias("member")).mapInArrow(_read(chunk, payload), CHUNKS)


def read_records(spark, path: str, chunk: int = CHUNK_BYTES) -> DataFrame:
    """One row for each response and revisit, its payload digested and compared with the header's.

    Records of one segment are digested where they are read.  Segments of larger ones are sent to one
    task in order, which keeps a running digest and no payload.
    """
    chunks = read_chunks(spark, path, chunk, payload=False)
    names = [c for c in _NAMES if c != "payload"]
    whole = chunks.where("chunks = 1").select(*names)
    parts = chunks.where("chunks > 1").repartition("record_id").sortWithinPartitions("record_id", "chunk")
    schema = ", ".join(c for c in CHUNKS.split(", ") if not c.startswith("payload binary"))
    records = whole.unionByName(parts.mapInArrow(_join_digests, schema))
    bad = F.raise_error(F.concat(F.lit("payload digest differs in "), "record_id"))
    right = F.col("digest") == F.concat(F.lit("sha256:"), "payload_digest")
    return records.select(
        "page_id",
        "payload_bytes",
        F.when(right, F.col("payload_digest")).otherwise(bad.cast("string")).alias("payload_digest"),
        "record_type",
        "refers_to",
        "chunks",
        "record_id",
    )


def round_trip(pages: DataFrame, work: Workspace, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Writes ``pages`` to archives and gives back what is read from them."""
    path = work.path("warc")
    write_archives(pages, path, work, chunk)
    return read_records(work.spark, path, chunk)
