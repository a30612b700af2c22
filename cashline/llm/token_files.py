"""Token ids of a table of documents as Huffman-coded files in ascending order of the document id.

`write` sorts the texts by id in ranges, encodes every text once, counts the ids of all documents and
codes them by the counts. A file holds the documents of one stretch of that order as segments of about
a million ids (see `huffman`). The folder has

    codebook        the ids that occur and the lengths of their codes
    files/*.ids     segments
    manifest/       Parquet: name, place in the order, documents, ids and bytes of each file

`read` decodes the files independently and adds up the ids before each.

What is sent to the driver is a count per distinct id, so at most the vocabulary. A file is the
work of one task, written as its own attempt (see `files`), so lost executors cost only that task.

Defined results: a null text is an empty document, which has the end id only. Rows that repeat an id
are documents of their own, in the order of a hash of their text. Null ids come first. A very long text is
encoded and coded whole, its segment is as much longer. An empty table gives no files and
no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cashline.llm.common import new_folder
from cashline.llm.files import NewFile, contents, make, manifest, uri
from cashline.llm.huffman import LIMIT, Codebook, pack_segment, read_segments
from cashline.llm.tokens import encoder, narrowest

_IDS = ["shard", "doc_id", "ids", "counts"]
_SCHEMA = "shard int, doc_id long, ids binary, counts binary"
SEGMENT_IDS = 1 << 20
FILE_BYTES = 32 << 20


def _encoded(docs: DataFrame, tokenizer: str, end_id: int, width: int) -> DataFrame:
    """shard, doc_id and ids of every document; shards ascend with doc_id, as do the rows of each.

    One more row of every task has no shard but `counts`: how often each id occurs in the task.
    """
    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias("check"))
    ordered = ordered.repartitionByRange("doc_id", "check").sortWithinPartitions("doc_id", "check")
    ordered = ordered.select(F.spark_partition_id().alias("shard"), F.col("doc_id").cast("long"), "text")
    end = end_id.to_bytes(width, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, width).encode
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = [own(text) + end for text in batch.column("text").to_pylist()]
            found = np.bincount(np.frombuffer(b"".join(ids), f"<u{width}"))
            if len(found) > len(total):
                found, total = total, found
            total[: len(found)] += found
            none = pa.nulls(len(ids), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("doc_id"), pa.array(ids, pa.binary()), none], _IDS
            )
        counts = pa.array([total.astype("<u8").tobytes()], pa.binary())
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, k) for k in (pa.int32(), pa.int64(), pa.binary())), counts], _IDS)

    return ordered.mapInArrow(encode, _SCHEMA)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for counts in batch.column("counts").to_pylist():
            total = np.frombuffer(counts, "<u8").astype(np.int64)
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["id", "n"])


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, limit: int = LIMIT) -> None:
    """Write the ids of `docs` (doc_id a whole number, text), each with `end_id` after it, to a new folder."""
    spark = docs.sparkSession
    folder = uri(folder)
    work = new_folder(spark, "ids")
    width = narrowest(tokenizer, end_id)
    _encoded(docs, tokenizer, end_id, width).write.options(
        **{"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
    ).parquet(work)
    ids = spark.read.schema(_SCHEMA).parquet(work)
    counts = ids.select("counts").filter("counts is not null").mapInArrow(_counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    book = Codebook.of_counts({r["id"]: r["n"] for r in counts.collect()}, limit)
    make(f"{folder}/files")
    system, path = pyarrow.fs.FileSystem.from_uri(folder)
    with system.open_output_stream(f"{path}/codebook", compression=None) as out:
        out.write(book.to_bytes())

    schema = "name string, shard int, stretch long, part int, n_docs long, n_ids long, n_bytes long"
    # A task may read stretches of several files: each stretch gets files of its own.
    chunks = ids.filter("shard is not null").select("shard", F.col("_metadata.file_block_start").alias("stretch"), "doc_id", "ids")
    rows = chunks.mapInArrow(lambda batches: _files(batches, book, f"{folder}/files", width), schema)
    rows.write.parquet(f"{folder}/manifest")


def _files(batches: Iterator[pa.RecordBatch], book: Codebook, folder: str, width: int) -> Iterator[pa.RecordBatch]:
    out = None

    def documents():
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "stretch", "doc_id")), batch.column("ids")):
                yield row[:2], row[2], np.frombuffer(row[3].as_buffer(), f"<u{width}")

    for stretch, docs in _segments(documents()):
        if out and (out.stretch != stretch or out.file.size >= FILE_BYTES):
            yield out.closed()
            out = _Out(folder, stretch, out.part + 1 if out.stretch == stretch else 0)
        out = out or _Out(folder, stretch, 0)
        sizes = np.array([len(ids) for _, ids in docs], np.int64)
        out.add(pack_segment(book, [d for d, _ in docs], sizes, np.concatenate([ids for _, ids in docs])), sizes)
    if out:
        yield out.closed()


def _segments(documents):
    """Documents in a row of one stretch, of about SEGMENT_IDS ids."""
    now, held, size = None, [], 0
    for stretch, doc_id, ids in documents:
        if held and (stretch != now or size >= SEGMENT_IDS):
            yield now, held
            held, size = [], 0
        now = stretch
        held.append((doc_id, ids))
        size += len(ids)
    if held:
        yield now, held


class _Out:
    def __init__(self, folder: str, stretch: tuple[int, int], part: int):
        self.file, self.stretch, self.part = NewFile(folder, ".ids"), stretch, part
        self.n_docs = self.n_ids = 0

    def add(self, segment: bytes, sizes: np.ndarray) -> None:
        self.file.write(segment)
        self.n_docs += len(sizes)
        self.n_ids += int(sizes.sum())

    def closed(self) -> pa.RecordBatch:
        self.file.close()
        values = (self.file.name, *self.stretch, self.part, self.n_docs, self.n_ids, self.file.size)
        names = "name shard stretch part n_docs n_ids n_bytes".split()
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)


def _starts(files: DataFrame) -> DataFrame:
    """name and the ids of all files before it: shards are summed first, then files within a shard."""
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # One row per range partition of the writing job, whose number the session sets.
    shards = shards.select("shard", F.coalesce(F.sum("n").over(upto(Window.orderBy("shard"))), F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum("n_ids").over(upto(Window.partitionBy("shard").orderBy("stretch", "part"))), F.lit(0))
    return files.withColumn("inside", inside).join(shards, "shard").select("name", (F.col("before") + F.col("inside")).alias("base"))


def read(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, ids (little-endian 32 bits) of every document."""
    folder = uri(folder)
    system, path = pyarrow.fs.FileSystem.from_uri(folder)
    with system.open_input_stream(f"{path}/codebook", compression=None) as source:
        book = Codebook.from_bytes(source.read())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
                start = 0
                for docs, sizes, found in read_segments(book, content.as_buffer().to_pybytes()):
                    raw, ends = found.astype("<u4").tobytes(), np.cumsum(sizes) * 4
                    parts = [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
                    columns = {
                        "name": pa.array([name] * len(docs)),
                        "doc_id": pa.array(docs, pa.int64()),
                        "inside": pa.array(start + np.cumsum(sizes) - sizes),
                        "n_tokens": pa.array(sizes),
                        "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                    }
                    if ids:
                        columns["ids"] = pa.array(parts, pa.binary())
                    yield pa.RecordBatch.from_pydict(columns)
                    start += int(sizes.sum())

    schema = "name string, doc_id long, inside long, n_tokens long, ids_crc32 long" + ", ids binary" * ids
    found = contents(spark, folder, ".ids").mapInArrow(decode, schema)
    placed = found.join(_starts(manifest(spark, folder)), "name")
    return placed.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), *found.columns[3:])
