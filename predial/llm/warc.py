"""Web archives with a two-level capture index.

Pages become WARC records, one gzip member each, in archives of bounded size: the page with
the smallest id of equal payloads is a response, the others are revisits that name it. The
index of the captures has two levels: its lines, sorted by reversed-host key and id, are
compressed in blocks, and a sparse directory holds the first key of each block. A lookup
binary-searches the directory for the block, reads the block's range, binary-searches its
lines, and reads the record's range of the archive.

The directory is small by construction: blocks hold so many lines that it has at most
`DIRECTORY_ROWS` entries, and one for each sorted part. Archives and index lie in the
shared folder; a file counts only if the tables of captures and of the directory name it,
so what a lost task has left behind is never read.

Defined results: null html is an empty payload; null urls have an empty key. Payloads are
equal when SHA-1, SHA-256 and length are. Rows that repeat the smallest id with the same
payload are all responses. A page without id that has the payload of a page with id is its
revisit. An empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from predial.llm.exact_dedup import per_salt, salt_of, winners_of
from predial.llm.support import keep
from predial.session import scratch_folder

ARCHIVE_BYTES = 64 << 20  # an archive is closed when it is larger
BLOCK_LINES = 3000  # of the index, at least
DIRECTORY_ROWS = 100_000
SORTED_LINES = 50_000  # of the index in one task, at least
READ_BYTES = 1 << 20  # read at once from an archive, at least
SPREAD = 8 << 20  # of an archive are read in one group

# Fixed values of the format.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELDS = "page_id long, url string, record_type string, payload_digest string, refers_to long"


# -- keys and records -------------------------------------------------------------


def surt(url: str | None) -> str:
    """The key of a URL: host labels from the last to the first, then path and query."""
    text = re.sub(r"[\x00-\x20]", lambda m: quote(m.group()), (url or "").strip())
    try:
        parts = urlsplit(text)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return text.lower()
    if not host:
        return text.lower()
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "")
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def capture_key(url: str | None, page_id: int | None) -> str:
    """Sorts by reversed host, then by id."""
    return surt(url) + "\t" + ("" if page_id is None else f"{page_id + 2**63:020d}")


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id, url, payload: bytes, refers_to, is_revisit: bool) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP header, not the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if is_revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%-._~' + chr(39))}")
        head.append(f"Page-Url: {base64.b64encode(url.encode()).decode()}")
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if is_revisit:
        head.append(f"WARC-Profile: {PROFILE}")
        head.append(f"WARC-Refers-To: {record_id(refers_to)}")
        if refers_to is not None:
            head.append(f"Refers-To-Page: {refers_to}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    text = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(text) + packer.flush()


def parse_record(member: bytes) -> dict:
    """What `make_record` was given, from its bytes; a revisit has no payload."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    is_revisit = fields["WARC-Type"] == "revisit"
    payload = None if is_revisit else block.partition(b"\r\n\r\n")[2]
    number = {k: int(fields[k]) if k in fields else None for k in ("Page-Id", "Refers-To-Page")}
    return {
        "page_id": number["Page-Id"],
        "url": base64.b64decode(fields["Page-Url"]).decode() if "Page-Url" in fields else None,
        "record_type": fields["WARC-Type"],
        "payload": payload,
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "refers_to": number["Refers-To-Page"],
    }


# -- files ------------------------------------------------------------------------

# Addresses that both Spark and the workers resolve, as the workers name them.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3a": "s3", "s3": "s3", "gs": "gs"}


def qualified(spark: SparkSession, root: str) -> str:
    """The full address of a folder as Spark understands it, in the workers' spelling.

    Records and index are written by the workers, tables by Spark: without a scheme one would
    take the default file system and the other the machine's own disk. An address that the
    workers can't resolve is refused.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    path = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
    scheme, _, rest = path.toString().partition(":")
    if scheme not in SCHEMES:
        raise ValueError(f"archives can't be written to {scheme}: addresses")
    return f"{SCHEMES[scheme]}:{rest}"


class RollingFile:
    """Appends pieces to files of bounded size with names of their own."""

    def __init__(self, root: str, suffix: str, limit: int = ARCHIVE_BYTES):
        self.files, self.folder = fs.FileSystem.from_uri(root)
        self.files.create_dir(self.folder, recursive=True)
        self.suffix, self.limit = suffix, limit
        self.name, self.out, self.size = "", None, 0

    def append(self, data: bytes) -> tuple[str, int]:
        """The file and the offset at which `data` now lies."""
        if self.out is None or self.size > self.limit:
            self.close()
            self.name = f"{uuid.uuid4().hex}{self.suffix}"
            self.out = self.files.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            self.size = 0
        self.out.write(data)
        self.size += len(data)
        return self.name, self.size - len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


class RangeReader:
    """Ranges of files; neighbouring ranges come from one read."""

    def __init__(self, root: str):
        self.files, self.folder = fs.FileSystem.from_uri(root)
        self.name, self.file, self.start, self.data = None, None, 0, b""

    def __call__(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            if self.file is not None:
                self.file.close()
            self.file = self.files.open_input_file(f"{self.folder}/{name}")
            self.name, self.start, self.data = name, 0, b""
        at = offset - self.start
        if at < 0 or at + length > len(self.data):
            self.file.seek(offset)
            self.data = self.file.read(max(length, READ_BYTES))
            self.start, at = offset, 0
        return self.data[at : at + length]


# -- writing ----------------------------------------------------------------------


@dataclass
class Archive:
    """Where an archive lies: records, index blocks, and the directory of the blocks."""

    root: str
    directory: DataFrame
    captures: int

    @property
    def records(self) -> str:
        return f"{self.root}/records"

    @property
    def index(self) -> str:
        return f"{self.root}/index"


def with_originals(df: DataFrame, page_id: str, url: str, html: str, at_least: int) -> DataFrame:
    """page_id, url, payload and refers_to, null for responses."""
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = df.select(
        F.col(page_id).cast("long").alias("doc_id"),
        F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumns({
        "digest": F.unhex(F.concat(F.sha1("payload"), F.sha2("payload", 256))),
        "salt": salt_of("doc_id"),
        "size": F.octet_length("payload"),
    })
    content = rows.filter(F.col("size") >= at_least).drop("payload", "url")
    winners = keep(winners_of(content, smallest=True, content=("size",)), "originals")
    first = per_salt(winners).select("digest", "salt", "size", "keep_id")
    original = F.when(~F.col("doc_id").eqNullSafe(F.col("keep_id")), F.col("keep_id"))
    return rows.join(first, ["digest", "salt", "size"], "left").select(
        F.col("doc_id").alias("page_id"), "url", "payload", original.alias("refers_to")
    )


def _write_records(pages: DataFrame, root: str) -> DataFrame:
    """Archives under `root`; one row per record: where it lies, and its index line."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = RollingFile(root, ".warc.gz")
        for batch in batches:
            lines = []
            for page in batch.to_pylist():
                refers_to = page["refers_to"]
                member = make_record(
                    page["page_id"], page["url"], page["payload"], refers_to, refers_to is not None
                )
                name, offset = out.append(member)
                lines.append((capture_key(page["url"], page["page_id"]), name, offset, len(member)))
            key, name, offset, length = zip(*lines) if lines else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.string()), pa.array(name, pa.string()),
                 pa.array(offset, pa.int64()), pa.array(length, pa.int64())],
                names=["key", "file", "offset", "length"],
            )
        out.close()

    return pages.mapInArrow(run, "key string, file string, offset long, length long")


def _write_index(captures: DataFrame, root: str, count: int) -> DataFrame:
    """Sorted lines in compressed blocks; the directory's rows."""
    block_lines = max(BLOCK_LINES, -(-count // DIRECTORY_ROWS))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = RollingFile(root, ".cdx.z")

        def block(lines: list[tuple]) -> tuple:
            text = "\n".join("\t".join(map(str, line)) for line in lines)
            data = zlib.compress(text.encode())
            return (lines[0][0], *out.append(data), len(data))

        waiting, rows = [], []
        for batch in batches:
            waiting += zip(*(batch[c].to_pylist() for c in ("key", "file", "offset", "length")))
            while len(waiting) >= block_lines:
                rows.append(block(waiting[:block_lines]))
                waiting = waiting[block_lines:]
        if waiting:
            rows.append(block(waiting))
        out.close()
        key, name, offset, length = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.string()), pa.array(name, pa.string()),
             pa.array(offset, pa.int64()), pa.array(length, pa.int64())],
            names=["key", "file", "offset", "length"],
        )

    # The id in the key splits also a host, or a url, that has a third of the captures.
    parts = max(1, -(-count // max(SORTED_LINES, 10 * block_lines)))
    dealt = captures.repartitionByRange(parts, "key") if parts > 1 else captures.coalesce(1)
    return dealt.sortWithinPartitions("key").mapInArrow(
        run, "key string, file string, offset long, length long"
    )


def write(
    df: DataFrame,
    root: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    at_least: int = 0,
) -> Archive:
    """Records and index of all rows, under a folder that all executors share.

    Payloads of fewer than `at_least` bytes are never revisits.
    """
    root = qualified(df.sparkSession, root or scratch_folder(df.sparkSession, "warc"))
    pages = with_originals(df, page_id, url, html, at_least)
    captures = keep(_write_records(pages, f"{root}/records"), "captures")
    count = captures.count()
    directory = keep(_write_index(captures, f"{root}/index", count), "directory")
    return Archive(root, directory, count)


# -- reading ----------------------------------------------------------------------


def lookup(archive: Archive, keys: DataFrame) -> DataFrame:
    """The index lines of `keys` (key, as of `capture_key`): key, file, offset, length.

    A prefix of a key without its id finds all captures of the url.
    """
    spark = keys.sparkSession
    directory = sorted(tuple(row) for row in archive.directory.collect())  # bounded
    shared = spark.sparkContext.broadcast(directory)
    firsts = spark.sparkContext.broadcast([row[0] for row in directory])
    index_root = archive.index

    def find_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = firsts.value
        for batch in batches:
            wanted, blocks = [], []
            for key in batch["key"].to_pylist():
                last = key if "\t" in key else key + "\t￿"
                low = max(0, bisect.bisect_left(first, key) - 1)
                for block in range(low, bisect.bisect_right(first, last)):
                    wanted.append(key)
                    blocks.append(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array(wanted, pa.string()), pa.array(blocks, pa.int64())], names=["key", "block"]
            )

    def search_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, present, lines, line_keys = RangeReader(index_root), None, [], []
        for batch in batches:
            found = []
            for key, block in zip(batch["key"].to_pylist(), batch["block"].to_pylist()):
                if block != present:
                    present, text = block, zlib.decompress(read(*shared.value[block][1:])).decode()
                    lines = [line.rsplit("\t", 3) for line in text.split("\n")]
                    line_keys = [line[0] for line in lines]
                last = key if "\t" in key else key + "\t￿"
                low, high = bisect.bisect_left(line_keys, key), bisect.bisect_right(line_keys, last)
                found += [(k, f, int(o), int(n)) for k, f, o, n in lines[low:high]]
            key, name, offset, length = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.string()), pa.array(name, pa.string()),
                 pa.array(offset, pa.int64()), pa.array(length, pa.int64())],
                names=["key", "file", "offset", "length"],
            )

    placed = keys.select("key").distinct().mapInArrow(find_blocks, "key string, block long")
    by_block = placed.repartition("block").sortWithinPartitions("block", "key")
    return by_block.mapInArrow(
        search_blocks, "key string, file string, offset long, length long"
    )


def read_records(archive: Archive, places: DataFrame) -> DataFrame:
    """The records at `places` (file, offset, length), read in the order they lie."""
    root = archive.records
    names = [f.split()[0] for f in FIELDS.split(", ")] + ["payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = RangeReader(root)
        for batch in batches:
            found = [
                parse_record(read(*place))
                for place in zip(*(batch[c].to_pylist() for c in ("file", "offset", "length")))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in found], kind) for n, kind in zip(names, kinds)],
                names=names,
            )

    stretch = F.floor(F.col("offset") / SPREAD)
    dealt = places.select("file", "offset", "length").repartition("file", stretch)
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(run, f"{FIELDS}, payload binary")


def read_pages(archive: Archive, keys: DataFrame) -> DataFrame:
    """Records of `keys` by way of the index; payloads must have the digest that is stated.

    page_id, url, record_type, payload_digest, refers_to, payload and payload_bytes, the
    last two null for revisits until `resolved`.
    """
    records = read_records(archive, lookup(archive, keys))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = batch["payload"].to_pylist()
            sizes = [None if p is None else len(p) for p in payloads]
            sums = [None if p is None else sha1_base32(p) for p in payloads]
            for stated, found in zip(batch["payload_digest"].to_pylist(), sums):
                if found not in (None, stated):
                    raise ValueError(f"payload digest {found}, the record states {stated}")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int64())],
                names=[*batch.schema.names, "payload_bytes"],
            )

    return records.mapInArrow(measure, f"{FIELDS}, payload binary, payload_bytes long")


def resolved(records: DataFrame) -> DataFrame:
    """`records` (stored) with each revisit's payload_bytes from the response it names.

    Responses are joined once for each salt that their revisits have, so the revisits of one
    response are spread over `SALTS` places.
    """
    response = F.col("record_type") == "response"
    named = F.when(response, F.col("page_id")).otherwise(F.col("refers_to"))
    bit = F.expr("shiftleft(1L, row_salt)")
    salted = records.withColumn("row_salt", salt_of("page_id"))
    originals = salted.groupBy(named.alias("original"), F.col("payload_digest").alias("digest")).agg(
        F.max(F.when(response, F.col("payload_bytes"))).alias("bytes"),
        F.bit_or(F.when(~response, bit)).alias("salts"),
    )
    same = (
        (F.col("refers_to") == F.col("original"))
        & (F.col("payload_digest") == F.col("digest"))
        & (F.col("row_salt") == F.col("salt"))
    )
    joined = salted.join(per_salt(originals), same, "left")
    size = F.coalesce("payload_bytes", "bytes")
    return joined.withColumn("payload_bytes", size).drop("original", "digest", "bytes", "salt", "row_salt")


def keys_of(df: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """The capture keys of pages."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = map(capture_key, batch["url"].to_pylist(), batch["page_id"].to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(keys), pa.string())], names=["key"])

    rows = df.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"))
    return rows.mapInArrow(run, "key string")
