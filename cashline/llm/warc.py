"""Web archives with a Zstandard frame per record and the dictionary in a leading skippable frame.

A file is the skippable frame with the dictionary, then one frame per WARC record, so that a reader can
start at any record once it has the dictionary. Records of equal payloads of at least `LEAST_BYTES`
bytes are stored once: the one with the smallest page id is a `response`, all others are `revisit`
records that refer to it and hold no payload.

The dictionary is trained on about `SAMPLE_PAGES` pages, those with the smallest hashes of their id,
at most twice as many, of which the first `SAMPLE_CHARS` characters are looked at. Everything else
covers all rows. Copies are
found by the SHA-256 of the payload, counted before they are shuffled; a payload that a third of all
pages share is one row there, and its pages are joined as a skewed join. Each task writes files of
its own (see `files`), so a lost executor costs only its tasks.

The reader decodes frame by frame and checks the version line, the fields every record needs, the
length of the block against Content-Length, the record's end, the payload's length where HTTP names it,
and digests by SHA-1 or SHA-256; a record that fails raises `ArchiveError`. `broken_revisits` holds the
digests of revisits against those of their responses.

It also reads archives of others: versions 1.0 and 1.1, field names in any case and folded lines, all
record types, dictionaries that are compressed or missing, and skippable frames between records. Only
records named as above have a page id; all have `record_id`. The payload is what follows the HTTP head
of a response, revisit or request, else the whole block. Digests of other kinds are not verified.

Defined results: a null html is an empty payload, a null url an empty one; control characters in a url
are percent-encoded. A null page id stays null, and its page is a revisit only of a page that has an
id. Pages that repeat the smallest id of a payload are responses too. An empty table gives an
archive without files. Other columns are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashline.llm.common import settled
from cashline.llm.files import NewFile, contents, make, uri

LEAST_BYTES = 100
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 16_384, 65_536
FILE_BYTES = 32 << 20
LEVEL = 3

# Fixed values of the archive formats.
SKIPPABLE = 0x184D2A5D
FRAME = 0xFD2FB528
VERSION = "WARC/1.1"
VERSIONS = ("WARC/1.0", "WARC/1.1")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELDS = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
_FRAME = "<II"
_PAGE = "<urn:page:{}>"
_PAGE_ID = re.compile(r"<urn:page:(-?[0-9]+)>")


class ArchiveError(ValueError):
    """An archive or record that is not what the formats or its own fields say."""


def train(pages: DataFrame) -> bytes:
    """The dictionary for `pages` (page_id, html)."""
    # Hashes are spread evenly, so a share of their range holds that share of the pages.
    share = min(1.0, SAMPLE_PAGES / max(1, pages.count()))
    upto = min(2**63 - 1, round(2**64 * share) - 2**63)
    some = pages.filter((F.xxhash64("page_id") <= upto) & (F.length("html") > 0))
    chosen = some.select(F.substr("html", F.lit(1), F.lit(SAMPLE_CHARS)).alias("html")).limit(2 * SAMPLE_PAGES).collect()
    samples = [row["html"].encode() for row in chosen]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: they are the dictionary themselves
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One uncompressed record: header, block (an HTTP response, or its head for a revisit), end."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    address = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _PAGE.format("" if page_id is None else page_id),
        "WARC-Date": date,
        "WARC-Target-URI": address,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _PAGE.format(refers_to)}
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def decisions(pages: DataFrame) -> DataFrame:
    """`pages` (page_id, url, html) with digest and refers_to, the page that a copy refers to."""
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    hashed = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("digest"), F.length(payload).alias("n"))
    copies = hashed.filter(F.col("n") >= LEAST_BYTES).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("copies")
    )
    copies = settled(copies.filter("copies > 1").select("digest", "first"), "copies")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return hashed.join(copies, "digest", "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record for every row of `pages` (page_id a whole number, url, html) to a new folder."""
    folder = uri(folder)
    dictionary = train(pages)
    make(f"{folder}/files")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary)).compress
        out, n = None, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"name": [out.name], "n_records": [n], "n_bytes": [out.size]})

        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out and out.size >= FILE_BYTES:
                    yield closed()
                    out, n = None, 0
                if not out:
                    out = NewFile(f"{folder}/files", ".warc.zst")
                    out.write(struct.pack(_FRAME, SKIPPABLE, len(dictionary)) + dictionary)
                out.write(pack(record(page_id, url, (html or "").encode(), digest, refers_to, date)))
                n += 1
        if out:
            yield closed()

    rows = decisions(pages).mapInArrow(archive, "name string, n_records long, n_bytes long")
    rows.write.parquet(f"{folder}/manifest")


def _skippable(view: memoryview, at: int) -> tuple[int, int] | None:
    """Where the content of a skippable frame begins and ends, None if another frame is there."""
    if len(view) - at < 8:
        return None
    magic, size = struct.unpack_from(_FRAME, view, at)
    if magic & 0xFFFFFFF0 != SKIPPABLE & 0xFFFFFFF0:
        return None
    begin = at + struct.calcsize(_FRAME)
    if begin + size > len(view):
        raise ArchiveError(f"the skippable frame at byte {at} is cut short")
    return begin, begin + size


def frames(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one per frame; all frames but skippable ones are records."""
    view, at, dictionary = memoryview(data), 0, b""
    if len(view) < 8:
        raise ArchiveError("an archive begins with a frame")
    try:
        if struct.unpack_from("<I", view)[0] == SKIPPABLE and (place := _skippable(view, 0)):
            dictionary, at = bytes(view[slice(*place)]), place[1]
            if dictionary[:4] == struct.pack("<I", FRAME):
                dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
        reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        while at < len(view):
            if place := _skippable(view, at):
                at = place[1]
                continue
            frame, parts = reader.decompressobj(), []
            while not frame.eof:
                some = view[at : at + 65_536]
                if not some:
                    raise ArchiveError(f"the frame that ends at byte {at} is cut short")
                parts.append(frame.decompress(some))
                at += len(some) - len(frame.unused_data)
            yield b"".join(parts)
    except zstandard.ZstdError as error:
        raise ArchiveError(f"the frame at byte {at}: {error}") from error


def _page(name: str | None) -> int | None:
    found = _PAGE_ID.fullmatch(name or "")
    return int(found[1]) if found else None


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    """The version of a record and its fields by lower-case name."""
    try:
        version, *lines = re.sub(r"\r\n[ \t]+", " ", head.decode()).split("\r\n")
    except UnicodeDecodeError as error:
        raise ArchiveError(f"not a record: {head[:200]!r}") from error
    fields = dict(line.split(":", 1) if ":" in line else (line, None) for line in lines)
    if version not in VERSIONS or None in fields.values():
        raise ArchiveError(f"not a record: {head[:200]!r}")
    named = {name.strip().lower(): value.strip() for name, value in fields.items()}
    if any(name.lower() not in named for name in FIELDS) or not re.fullmatch("[0-9]+", named["content-length"]):
        raise ArchiveError(f"not a record: {head[:200]!r}")
    return version, named


def _digests(data: bytes, kind: str) -> tuple[str, ...] | None:
    """The digest of some kind as archives write it, None for kinds that are not verified."""
    if kind not in ("sha1", "sha256"):
        return None
    found = hashlib.new(kind, data)
    return found.hexdigest(), base64.b32encode(found.digest()).decode().rstrip("=").lower()


def _check_digest(record_id: str, declared: str | None, data: bytes) -> None:
    kind, _, value = (declared or "").partition(":")
    found = _digests(data, kind.strip().lower().replace("-", ""))
    if found and value.strip().rstrip("=").lower() not in found:
        raise ArchiveError(f"{record_id}: its bytes have another digest than {declared}")


def parse(data: bytes) -> dict:
    """A checked record: record_id, page_id, url, record_type, refers_to_id, refers_to, payload_bytes, payload_digest, payload.

    The digest is the SHA-256 of the payload; a revisit, which has none, gives the one it declares, by
    another kind with its kind in front, and the length that its HTTP head declares, if any.
    """
    head, gap, rest = data.partition(b"\r\n\r\n")
    _, fields = _fields(head)
    record_id, kind = fields["warc-record-id"], fields["warc-type"].lower()
    block, end = rest[:-4], rest[-4:]
    if not gap or end != b"\r\n\r\n" or len(block) != int(fields["content-length"]):
        raise ArchiveError(f"{record_id}: {len(block)} bytes for {fields['content-length']}")
    _check_digest(record_id, fields.get("warc-block-digest"), block)
    payload, size = block, None
    if kind in ("response", "revisit", "request") and block.startswith((b"HTTP/", b"GET ", b"POST ", b"HEAD ")):
        http, _, payload = block.partition(b"\r\n\r\n")
        length = re.search(rb"\r\ncontent-length:[ \t]*([0-9]+)[ \t]*(?:\r\n|$)", http, re.IGNORECASE)
        size = int(length[1]) if length else None
    declared, revisit = fields.get("warc-payload-digest"), kind == "revisit"
    if revisit:
        if declared is None:
            raise ArchiveError(f"{record_id}: a revisit names the digest of its payload")
        label, _, value = declared.partition(":")
        digest = value.strip().lower() if label.strip().lower() == "sha256" else declared
        if label.strip().lower() == "sha256" and not re.fullmatch("[0-9a-f]{64}|[a-z2-7]{52}=*", digest):
            raise ArchiveError(f"{record_id}: {declared} is no digest")
        if payload and fields.get("warc-profile", "").lower().endswith("identical-payload-digest"):
            raise ArchiveError(f"{record_id}: a revisit of an equal payload holds none")
    else:
        if size is not None and len(payload) != size and "warc-truncated" not in fields:
            raise ArchiveError(f"{record_id}: a payload of {len(payload)} bytes for {size}")
        _check_digest(record_id, declared, payload)
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    refers_to = fields.get("warc-refers-to") if revisit else None
    return {
        "record_id": record_id,
        "page_id": _page(record_id),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to_id": refers_to,
        "refers_to": _page(refers_to),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


def broken_revisits(records: DataFrame) -> DataFrame:
    """Revisits among the records of `read` that name a record which is not there or has another payload.

    Those that name none, or whose digest is not a hexadecimal SHA-256, are not judged. Records are joined
    by their ids, each once; only ids and digests are shuffled.
    """
    known = records.filter("record_type <> 'revisit'").groupBy(F.col("record_id").alias("refers_to_id"))
    known = known.agg(F.min("payload_digest").alias("least"), F.max("payload_digest").alias("most"))
    judged = records.filter("record_type = 'revisit' and refers_to_id is not null and payload_digest rlike '^[0-9a-f]{64}$'")
    judged = judged.select("record_id", "refers_to_id", "payload_digest").join(known, "refers_to_id", "left")
    agrees = (F.col("least") == F.col("payload_digest")) | (F.col("most") == F.col("payload_digest"))
    return judged.filter(~F.coalesce(agrees, F.lit(False))).select("record_id", "refers_to_id", "payload_digest")


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in `folder`, each checked."""
    folder = uri(folder)
    kinds = {
        "record_id": pa.string(),
        "page_id": pa.int64(),
        "url": pa.string(),
        "record_type": pa.string(),
        "refers_to_id": pa.string(),
        "refers_to": pa.int64(),
        "payload_bytes": pa.int64(),
        "payload_digest": pa.string(),
    } | ({"payload": pa.binary()} if payloads else {})

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for data in frames(content.as_buffer().to_pybytes()):
                    rows.append(parse(data))
                    if len(rows) == 1000:
                        yield _batch(rows, kinds)
                        rows = []
                if rows:
                    yield _batch(rows, kinds)

    schema = "record_id string, page_id long, url string, record_type string, refers_to_id string, refers_to long"
    schema += ", payload_bytes long, payload_digest string"
    found = contents(spark, folder, ".warc.zst").select("content")
    return found.mapInArrow(decode, schema + ", payload binary" * payloads)


def _batch(rows: list[dict], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in kinds.items()], list(kinds))
