"""WARC archives as a chunked record table.

Payloads are cut into rows (record, chunk number, bytes), written record by
record as gzip members of WARC files, and read back the same way: a reader
holds one chunk at a time and carries the digest from chunk to chunk, so no
record is ever held whole.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import qualified, stage_table, with_row_key
from eventide.session import scratch_path

#: bytes of a chunk row
CHUNK_BYTES = 256 * 1024
#: an archive file is closed once it is larger
FILE_BYTES = 512 * 1024 * 1024
#: equal payloads of at least so many bytes are written once
REVISIT_BYTES = 100
#: bytes of chunks that a reader sends on at once
_SEND_BYTES = 4 * 1024 * 1024
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"  # a fixed date: equal input makes equal archives
_EPILOGUE = b"\r\n\r\n"

CHUNKS = ("record_id string, page_id long, url string, record_type string, refers_to long, declared_digest string, "
          "chunk_no long, chunk binary, bytes_so_far long, sha256_so_far string, is_last boolean")
_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
_CHUNK_SCHEMA = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in CHUNKS.split(","))])


def decided(keyed: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Rows (rid, page_id, url, payload_bytes, digest, refers_to): refers_to is null for what is a response."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = stage_table(keyed.select(
        "rid", F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"), F.length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("digest")), "payloads")
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "rid")
    first = stage_table(rows.filter(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("digest").agg(F.min(order).alias("f"))
                        .select("digest", F.col("f.page_id").alias("first_id"), F.col("f.rid").alias("first_rid")), "first")
    big = rows.filter(F.col("payload_bytes") >= REVISIT_BYTES).join(first, "digest")
    small = rows.filter(F.col("payload_bytes") < REVISIT_BYTES)
    again = F.col("rid") != F.col("first_rid")
    return big.select("rid", "page_id", "url", "payload_bytes", "digest", again.alias("again"),
                      F.when(again, F.col("first_id")).alias("refers_to"), F.when(again, F.col("first_rid")).alias("first_rid")
                      ).unionByName(small.select("rid", "page_id", "url", "payload_bytes", "digest", F.lit(False).alias("again"),
                                                 F.lit(None).cast("long").alias("refers_to"),
                                                 F.lit(None).cast("string").alias("first_rid")))


def chunk_rows(keyed: DataFrame, html_col: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(rid, chunk_no, n_chunks, chunk) of every payload; an empty payload is one empty chunk.

    A chunk is cut where its row is made: no row holds all chunks of a payload.
    """
    payload = keyed.select("rid", F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload")).withColumn(
        "n_chunks", F.greatest(F.ceil(F.length("payload") / F.lit(chunk_bytes)).cast("int"), F.lit(1)))
    numbered = payload.select("rid", "n_chunks", "payload", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("chunk_no"))
    return numbered.select("rid", "n_chunks", "chunk_no",
                           F.substring("payload", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("chunk"))


def _record_id(rid: str, page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{rid}')}>"


def _head(row: dict) -> bytes:
    """The header block of a record, ``Content-Length`` of the bytes that follow."""
    again = row["again"]
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if again else 'response'}",
             f"WARC-Record-ID: {_record_id(row['rid'], row['page_id'])}", f"WARC-Date: {_DATE}",
             f"WARC-Payload-Digest: sha256:{row['digest']}", "Content-Type: text/html; charset=utf-8"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + row["url"].replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if row["page_id"] is not None:
        lines.append(f"X-Page-ID: {row['page_id']}")
    if again:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(row['first_rid'], row['refers_to'])}"]
        if row["refers_to"] is not None:
            lines.append(f"X-Refers-To-Page: {row['refers_to']}")
    lines.append(f"Content-Length: {0 if again else row['payload_bytes']}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


class _Archives:
    """The archive files of one task: gzip members, one a record, fed chunk by chunk."""

    def __init__(self, folder: str, file_bytes: int):
        self.store, self.folder = fs.FileSystem.from_uri(folder)
        self.store.create_dir(self.folder, recursive=True)
        self.file_bytes, self.out, self.done = file_bytes, None, []

    def _open(self) -> None:
        self.name = f"{self.folder}/{uuid.uuid4().hex}.warc.gz"  # another name for each attempt of a task
        self.out, self.size, self.records = self.store.open_output_stream(self.name, compression=None), 0, 0

    def begin(self, head: bytes) -> None:
        if self.out is None:
            self._open()
        self.gz = zlib.compressobj(6, zlib.DEFLATED, 31)
        self.feed(head)

    def feed(self, data: bytes) -> None:
        self._put(self.gz.compress(data))

    def _put(self, packed: bytes) -> None:
        if packed:
            self.out.write(packed)
            self.size += len(packed)

    def end(self) -> None:
        self.feed(_EPILOGUE)
        self._put(self.gz.flush())
        self.records += 1
        if self.size >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.records, self.size))
            self.out = None


def _write(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Archives(folder, file_bytes)
        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk_no"] == 0:
                    files.begin(_head(row))
                if row["chunk"]:
                    files.feed(row["chunk"])
                if row["again"] or row["chunk_no"] == row["n_chunks"] - 1:
                    files.end()
        files.close()
        names, records, sizes = zip(*files.done) if files.done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
                                         names=["file", "records", "bytes"])
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   chunk_bytes: int = CHUNK_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` under ``folder`` (a URI); returns the manifest (file, records, bytes).

    Only files that the manifest names count: a task that is run again writes
    new files, and those of its lost attempt are in no manifest.  Of equal
    payloads of at least ``REVISIT_BYTES`` bytes the row of the smallest id (a
    null id last, then the first of repeated rows) is a response, the others
    revisit it without a payload.
    """
    keyed = with_row_key(pages.select(id_col, url_col, html_col), "rid")
    meta = decided(keyed, id_col, url_col, html_col)
    chunks = chunk_rows(keyed, html_col, chunk_bytes)
    told = chunks.join(meta, "rid").filter("not again or chunk_no = 0").withColumn(
        "chunk", F.when(F.col("again"), F.lit(b"")).otherwise(F.col("chunk")))
    # a record's chunks are in one task (one row made them, and the join keeps what one task sent together)
    told = told.sortWithinPartitions("rid", "chunk_no")
    return stage_table(told.mapInArrow(_write(folder, file_bytes), "file string, records long, bytes long"), "manifest")


class _Plain:
    """The unpacked bytes of a file of gzip members, read a bounded piece at a time."""

    def __init__(self, stream, piece: int):
        self.stream, self.piece = stream, piece
        self.inflate, self.raw, self.buffer = zlib.decompressobj(31), b"", b""

    def _more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.stream.read(self.piece)
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
                if not self.raw:
                    return False
            if not self.raw:
                raise ValueError("archive ends inside a record")
            out = self.inflate.decompress(self.raw, self.piece)
            self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if out:
                self.buffer += out
                return True

    def head(self) -> list[bytes] | None:
        """Lines of the next header block; None at the end of the file."""
        while (at := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.buffer:
                    raise ValueError("archive ends inside a header")
                return None
        lines, self.buffer = self.buffer[:at].split(b"\r\n"), self.buffer[at + 4:]
        return lines

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise ValueError("archive ends inside a payload")
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        return out


def _fields(lines: list[bytes]) -> dict[str, str]:
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    return {k.lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines[1:])}


def records(stream, chunk_bytes: int) -> Iterator[dict]:
    """Chunk rows of the records of one archive, in order."""
    plain = _Plain(stream, chunk_bytes)
    while (lines := plain.head()) is not None:
        f = _fields(lines)
        left, digest, seen, k = int(f["content-length"]), hashlib.sha256(), 0, 0
        num = lambda name: int(f[name]) if name in f else None
        url = f.get("warc-target-uri")
        base = {"record_id": f["warc-record-id"], "page_id": num("x-page-id"), "record_type": f["warc-type"],
                "url": None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
                "refers_to": num("x-refers-to-page"), "declared_digest": f["warc-payload-digest"].removeprefix("sha256:")}
        while True:
            chunk = plain.take(min(left, chunk_bytes))
            left -= len(chunk)
            seen += len(chunk)
            digest.update(chunk)
            yield base | {"chunk_no": k, "chunk": chunk, "bytes_so_far": seen, "sha256_so_far": digest.hexdigest(), "is_last": not left}
            k += 1
            if not left:
                break
        if plain.take(4) != _EPILOGUE:
            raise ValueError("payload and Content-Length disagree")


def _read(folder: str, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with store.open_input_stream(name, compression=None) as stream:
                    held, size = [], 0
                    for row in records(stream, chunk_bytes):
                        held.append(row)
                        size += len(row["chunk"]) + 500
                        if size >= _SEND_BYTES:
                            yield pa.RecordBatch.from_pylist(held, _CHUNK_SCHEMA)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, _CHUNK_SCHEMA)
    return run


def read_archives(manifest: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table of the archives a manifest names (schema ``CHUNKS``).

    Rows of a record carry the bytes and SHA-256 of its payload up to and with
    their chunk, so the row where ``is_last`` holds has the whole payload's.
    """
    files = manifest.count()
    spread = manifest.select("file").repartition(max(1, files))
    return spread.mapInArrow(_read(folder, chunk_bytes), CHUNKS)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               folder: str | None = None) -> DataFrame:
    """One row per row of ``pages``, from archives written and read back: page_id, payload_bytes,
    payload_digest, record_type, refers_to, verified.

    A revisit's size and digest are those read from the response it names;
    ``verified`` says that they are what the record's own header declares.  Null
    html is an empty payload; null urls and ids have no header line and come
    back null; repeated rows have a record each; no pages give no rows.
    """
    spark = pages.sparkSession
    folder = qualified(spark, folder or scratch_path(spark, "warc"))
    manifest = write_archives(pages, folder, id_col, url_col, html_col)
    read = stage_table(read_archives(manifest, folder).filter("is_last").select(
        "page_id", "record_type", "refers_to", "declared_digest", F.col("bytes_so_far").alias("n"), F.col("sha256_so_far").alias("d")), "read-back")
    own = read.filter("record_type = 'response'")
    again = read.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "declared_digest")
    named = own.filter(F.col("n") >= REVISIT_BYTES).select(F.col("d").alias("declared_digest"), "n", "d")
    both = own.unionByName(again.join(named, "declared_digest", "left"))
    return both.select("page_id", F.col("n").alias("payload_bytes"), F.col("d").alias("payload_digest"), "record_type",
                       "refers_to", F.coalesce(F.col("d") == F.col("declared_digest"), F.lit(False)).alias("verified"))
