"""Zstandard WARC archives: one frame per record, dictionary in the leading skippable frame."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.workspace import staged

# Fixed values of the formats: the skippable frame that carries a dictionary, the
# magic of a data frame, and an empty skippable frame. The last one is plain
# ASCII, so Spark's text writer can put it behind every record as its line end.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
EMPTY_SKIPPABLE = "P*M\x18\x00\x00\x00\x00"
WARC_DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Groups of equal payloads that are looked up by broadcast: the largest ones,
#: this many at any input size. All others have at most 1/HOT_GROUPS of the rows.
HOT_GROUPS = 1024
#: What a task gathers to train its dictionary, in records and bytes, and its size.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 64, 1 << 20, 1 << 14


def mark_revisits(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 1000
) -> DataFrame:
    """``page_id, url, html, digest, keeper``: what each record will be.

    Of the pages with equal payloads of at least ``least_bytes`` the one with
    the largest id is the ``keeper`` of all; others have themselves. Null html
    is an empty payload. Ids are compared with nulls lowest; repeated rows of
    the keeper's id all count as the keeper. Nothing is collected: groups are
    counted with map-side sums, the HOT_GROUPS largest are joined by broadcast
    and the rest by a shuffle in which the rows of hot groups are spread.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    groups = (
        rows.where(F.octet_length("html") >= least_bytes)
        .groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    groups = staged(groups, "payloads")
    hot = groups.orderBy(F.desc("n"), "digest").limit(HOT_GROUPS).select("digest", F.col("keeper").alias("hot"))
    rest = groups.join(F.broadcast(hot), "digest", "left_anti").select(F.col("digest").alias("_key"), F.col("keeper").alias("cold"))
    # a hot row's key is its own, so no task gets a hot group; short payloads look for nothing
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    rows = rows.join(F.broadcast(hot), "digest", "left")
    rows = rows.withColumn(
        "_key", F.when(F.col("hot").isNotNull() | (F.octet_length("html") < least_bytes), alone).otherwise(F.col("digest"))
    )
    return rows.join(rest, "_key", "left").select(
        "page_id", "url", "html", "digest", F.coalesce("hot", "cold", "page_id").alias("keeper")
    )


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, keeper: int | None) -> bytes:
    """One WARC record; a revisit has no payload but says how long it was."""
    same = page_id == keeper
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if same else 'revisit'}", f"WARC-Record-ID: {_uri(page_id)}", f"WARC-Date: {WARC_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not same:
        head += [f"WARC-Refers-To: {_uri(keeper)}", f"WARC-Profile: {REVISIT_PROFILE}"]
        payload = b""
    block = http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> bytes:
    """Trained on the first records of an archive; too few of them are used as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:] or b"WARC/1.1\r\n"


def write_archives(marked: DataFrame, path: str, level: int = 3) -> None:
    """Write the rows of :func:`mark_revisits` as archives below ``path``, one per partition.

    Each archive is a skippable frame with its dictionary, then a frame per
    record. Spark's own writer commits them to whatever file system ``path``
    names, so a lost executor costs its tasks only. Partitions should be small
    enough for one file to be read at once (adaptive execution keeps them at its
    advisory size). No rows leave no archives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def frames(records: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pack.compress(r) for r in records], pa.binary())], names=["frame"])

        waiting: list[bytes] = []
        held, pack = 0, None
        for batch in batches:
            ready = []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                page_id, url, html, digest, keeper = row
                one = record(page_id, url, html.encode(), digest, keeper)
                if pack is not None:
                    ready.append(one)
                    continue
                waiting.append(one)
                held += len(one)
                if len(waiting) >= SAMPLE_RECORDS or held >= SAMPLE_BYTES:
                    yield _open(waiting)
                    pack = _packer(waiting, level)
                    ready, waiting = waiting, []
            if ready:
                yield frames(ready)
        if waiting:
            yield _open(waiting)
            pack = _packer(waiting, level)
            yield frames(waiting)

    rows = marked.select("page_id", "url", "html", "digest", "keeper").mapInArrow(run, "frame binary")
    rows.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_SKIPPABLE).text(path)


def _open(samples: list[bytes]) -> pa.RecordBatch:
    words = _dictionary(samples)
    frame = DICTIONARY_MAGIC + len(words).to_bytes(4, "little") + words
    return pa.RecordBatch.from_arrays([pa.array([frame], pa.binary())], names=["frame"])


def _packer(samples: list[bytes], level: int) -> zstandard.ZstdCompressor:
    words = zstandard.ZstdCompressionDict(_dictionary(samples))
    return zstandard.ZstdCompressor(level=level, dict_data=words, write_checksum=True, write_content_size=True)


def _frame_end(data: memoryview, at: int) -> int:
    """Where the data frame at ``at`` ends, from its header and block headers."""
    flags = data[at + 4]
    single = flags >> 5 & 1
    size = (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6] + (not single)
    pos = at + 5 + size
    while True:
        head = int.from_bytes(data[pos : pos + 3], "little")
        pos += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if pos > len(data):
            raise ValueError("frame is cut off")
        if head & 1:
            return pos + 4 * (flags >> 2 & 1)


def records(content: bytes) -> Iterator[bytes]:
    """The records of one archive, a frame each."""
    if content[:4] != DICTIONARY_MAGIC:
        raise ValueError("archive does not begin with a dictionary frame")
    data = memoryview(content)
    at = 8 + int.from_bytes(data[4:8], "little")
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(data[8:at])))
    while at < len(data):
        magic = bytes(data[at : at + 4])
        if magic[1:] == DICTIONARY_MAGIC[1:] and 0x50 <= magic[0] <= 0x5F:
            at += 8 + int.from_bytes(data[at + 4 : at + 8], "little")
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"no frame at byte {at}")
        end = _frame_end(data, at)
        frame = data[at:end]
        told = zstandard.frame_content_size(frame)
        one = unpack.decompress(frame)
        if told != len(one):
            raise ValueError(f"frame at byte {at} tells {told} bytes and holds {len(one)}")
        yield one
        at = end


def parse(raw: bytes) -> dict:
    """Headers and payload of one record, after checking them against each other."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not mark or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC record header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"header line without a colon: {line[:80]}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"header {name} is missing")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"content length is {n}, record holds {len(rest) - 4}")
    http, mark, payload = rest[:n].partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("no HTTP header")
    told = re.search(rb"(?mi)^content-length:\s*(\d+)\s*$", http)
    if told is None:
        raise ValueError("HTTP header without a length")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response":
        if int(told[1]) != len(payload):
            raise ValueError(f"HTTP length is {int(told[1])}, payload holds {len(payload)}")
        if digest and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("payload does not have its digest")
    elif kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError("revisit with a payload or without a reference")
    return {
        "record_id": fields["warc-record-id"], "record_type": kind, "url": fields.get("warc-target-uri"),
        "payload_bytes": int(told[1]), "payload_digest": digest, "refers_to": fields.get("warc-refers-to"),
        "payload": None if kind == "revisit" else payload,
    }


READ_SCHEMA = (
    "record_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to string, payload binary"
)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of all archives below ``path``, checked as they are read.

    A record whose headers, lengths or digest do not agree ends the job with the
    reason. A revisit's ``payload`` is null, its length that of the full payload.
    A missing ``payload`` column is not built when ``with_payload`` is false.
    """
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    if not with_payload:
        names.remove("payload")
    schema = ", ".join(x for x in READ_SCHEMA.split(", ") if x.split()[0] in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names=names)

        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows, held = [], 0
                for raw in records(content):
                    rows.append(parse(raw))
                    held += len(raw)
                    if held >= 8 << 20 or len(rows) >= 4096:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(run, schema)


def page_number(uri: Column) -> Column:
    """The page id in a record's name; null for the page without one."""
    return F.regexp_extract(uri, r"<urn:page:(-?\d+)>", 1).try_cast("long")
