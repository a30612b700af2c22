"""Stupid-backoff scores of documents under the n-gram counts of the whole corpus.

The score of a word is the relative frequency of the longest n-gram that ends with it and occurs at
least `least` times in the corpus, count of the n-gram over count of its context, times `ALPHA` for
every order that was left out; a single word counts against all words. A document's score is the sum
of the logarithms.

It is a join, done on packed rows. Documents are stored as blocks of about `BLOCK_WORDS` words. Every
block explodes into its distinct n-grams with their counts, dealt by hash into buckets: one row holds
the n-grams of one block in one bucket, as sorted hashes. The rows of a bucket are the partition of the
count table with its hashes; they are summed up there and each row gets the sums for its own n-grams.
These go back to their block, where each document's logarithms are added up. A frequent n-gram
is one entry per block, so no hash is hot; the number of buckets grows with the corpus, so that a bucket
stays at a few million entries, and only rows that hold something exist, at most one per entry.
Nothing but the number of words reaches the driver.

N-grams are told apart by 64-bit hashes of their words; two of n different ones share a hash with a
chance of about n^2 / 2^65.

Defined results: words are cut at white space, A-Z lower-cased. A null or blank text has no words, the
score 0 and no mean. N-grams do not reach over the ends of documents. Copies and repeated rows count as
often as they stand and each get a score. A document longer than a block is a block. An empty table
gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashline.llm.common import settled
from cashline.llm.shingles import chunks, mixed, word_hashes

ORDER, LEAST, ALPHA = 3, 2, 0.4
BLOCK_WORDS = 1 << 20
BUCKET_ENTRIES = 1 << 22
LEAST_BUCKETS = 512

_PLACES = np.random.default_rng(20070628).integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _packed(values: np.ndarray) -> bytes:
    """Numbers as planes of bytes, from the lowest to the highest that is needed, each a frame of its own.

    Planes of a sorted list's steps are noise but for the highest, which a frame with the others would not tell.
    """
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    needed = planes[: np.flatnonzero(planes.any(axis=1)).max(initial=0) + 1]
    frames = [zstandard.ZstdCompressor(level=1).compress(plane) for plane in needed]
    return struct.pack(f"<B{len(frames)}I", len(frames), *map(len, frames)) + b"".join(frames)


def _unpacked(data: bytes) -> np.ndarray:
    sizes = struct.unpack_from(f"<{data[0]}I", data, 1)
    at, planes = 1 + 4 * len(sizes), []
    for size in sizes:
        planes.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at : at + size]), np.uint8))
        at += size
    out = np.zeros((len(planes[0]), 8), np.uint8)
    out[:, : len(planes)] = np.stack(planes, axis=1)
    return out.view("<u8").ravel()


def _packed_counts(counts: np.ndarray) -> bytes:
    """Counts, most of which are 1: where they are more, and how much."""
    more = np.flatnonzero(counts > 1)
    steps = _packed(np.diff(more, prepend=0))
    return struct.pack("<2I", len(counts), len(steps)) + steps + _packed(counts[more])


def _unpacked_counts(data: bytes) -> np.ndarray:
    n, size = struct.unpack_from("<2I", data)
    counts = np.ones(n, np.uint64)
    counts[np.cumsum(_unpacked(data[8 : 8 + size])).astype(np.int64)] = _unpacked(data[8 + size :])
    return counts


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (block, documents, their numbers of words, distinct word hashes, places of the words in them)."""
    number = TaskContext.get().partitionId() << 32
    docs, sizes, hashes, held = [], [], [], 0

    def out() -> pa.RecordBatch:
        known, words = np.unique(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), return_inverse=True)
        steps = np.diff(known, prepend=np.uint64(0))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([docs], pa.list_(kind)),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.array([_packed(steps)], pa.binary()),
                pa.array([_packed(words)], pa.binary()),
            ],
            ["block", "docs", "sizes", "known", "words"],
        )

    for batch in batches:
        kind = batch.schema.field("doc_id").type
        ids = batch.column("doc_id").to_pylist()
        texts = [b"" if x is None else x for x in batch.column("text").cast(pa.binary()).to_pylist()]
        for a, b in chunks(texts):
            data = np.frombuffer(b"".join(b" " + t for t in texts[a:b]), np.uint8)
            starts, words = word_hashes(data)
            begins = np.cumsum([0, *(len(t) + 1 for t in texts[a:b])])
            docs += ids[a:b]
            sizes += np.diff(np.searchsorted(starts, begins)).tolist()
            hashes.append(words)
            held += len(words)
            if held >= BLOCK_WORDS:
                yield out()
                docs, sizes, hashes, held = [], [], [], 0
                number += 1
    if docs:
        yield out()


def _grams(known: bytes, words: bytes, sizes: list[int], order: int) -> list[np.ndarray]:
    """Per order the hash of the n-gram that ends with each word, 0 where the document begins too late."""
    own = np.cumsum(_unpacked(known), dtype=np.uint64)[_unpacked(words).astype(np.int64)]
    sizes = np.array(sizes, np.int64)
    place = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = [own]
    for n in range(2, order + 1):
        total = np.zeros(len(own), np.uint64)
        for k in range(n):
            total[n - 1 :] += own[n - 1 - k : len(own) - k] * _PLACES[k]
        total = mixed(total + _PLACES[n])
        total[place < n - 1] = 0
        out.append(total)
    return out


def _distinct(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate(grams)
    return np.unique(every[every != 0], return_counts=True)


def _spread(grams: list[np.ndarray], totals: np.ndarray) -> list[np.ndarray]:
    """The totals of the distinct n-grams, which come in the order of their hashes, at every place of `grams`; 0 where there is none.

    Sorting the places and numbering what is distinct takes a third of the time of looking up each hash.
    """
    every = np.concatenate(grams)
    order = np.argsort(every)
    every = every[order]
    numbers = np.cumsum(np.diff(every, prepend=np.uint64(0)) != 0)
    out = np.empty(len(every))
    out[order] = np.concatenate((np.zeros(1), totals))[numbers]
    return np.split(out, len(grams))


def count_tables(blocks: DataFrame, order: int, bits: int) -> DataFrame:
    """Per block and bucket the counts in the whole corpus of the block's n-grams, in the order of their hashes."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, sizes, known, words in zip(*(batch.column(c).to_pylist() for c in ("block", "sizes", "known", "words"))):
                hashes, counts = _distinct(_grams(known, words, sizes, order))
                bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
                firsts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
                # The first number of a row is a whole hash, the others are steps.
                spans = list(zip(firsts, [*firsts[1:], len(hashes)], strict=True))
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(bucket[firsts]),
                    "block": pa.array([block] * len(spans), pa.int64()),
                    "hashes": pa.array([_packed(np.diff(hashes[a:b], prepend=np.uint64(0))) for a, b in spans], pa.binary()),
                    "counts": pa.array([_packed_counts(counts[a:b]) for a, b in spans], pa.binary()),
                })

    def add_up(rows: pa.Table) -> pa.Table:
        hashes = [np.cumsum(_unpacked(x), dtype=np.uint64) for x in rows.column("hashes").to_pylist()]
        counts = np.concatenate([_unpacked_counts(x) for x in rows.column("counts").to_pylist()])
        _, entry = np.unique(np.concatenate(hashes), return_inverse=True)
        totals = np.bincount(entry, weights=counts).astype(np.uint64)[entry]
        own = np.split(totals, np.cumsum([len(h) for h in hashes])[:-1])
        return pa.table({
            "block": rows.column("block"),
            "bucket": rows.column("bucket"),
            "counts": pa.array([_packed_counts(x) for x in own], pa.binary()),
        })

    exploded = blocks.mapInArrow(explode, "bucket long, block long, hashes binary, counts binary")
    return exploded.groupBy("bucket").applyInArrow(add_up, "block long, bucket long, counts binary")


def _log_scores(counts: list[np.ndarray], place: np.ndarray, n_words: int, least: int, alpha: float) -> np.ndarray:
    """Per word the logarithm of its stupid-backoff score, from the counts of the n-grams that end with it."""
    out = np.log(counts[0] / n_words) if len(counts[0]) else np.zeros(0)
    for n in range(2, len(counts) + 1):
        context = np.concatenate(([1.0], counts[n - 2][:-1]))
        with np.errstate(divide="ignore", invalid="ignore"):
            own = np.log(counts[n - 1] / context)
        out = np.where(counts[n - 1] >= least, own, np.where(place >= n - 1, np.log(alpha) + out, out))
    return out


def score(docs: DataFrame, order: int = ORDER, least: int = LEAST, alpha: float = ALPHA) -> DataFrame:
    """doc_id, n_words, log_score and mean_log_score of every row of `docs` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"block long, docs array<{kind}>, sizes array<long>, known binary, words binary"
    blocks = settled(docs.select("doc_id", "text").mapInArrow(_blocks, schema), "blocks")
    n_words = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0
    bits = (max(LEAST_BUCKETS, n_words * order // BUCKET_ENTRIES) - 1).bit_length()
    counted = settled(count_tables(blocks, order, bits), "counts")

    def add_up(block: pa.Table, rows: pa.Table) -> pa.Table:
        [(docs, sizes, known, words)] = zip(*(block.column(c).to_pylist() for c in ("docs", "sizes", "known", "words")))
        grams = _grams(known, words, sizes, order)
        parts = rows.sort_by("bucket").column("counts").to_pylist()
        counts = _spread(grams, np.concatenate([*map(_unpacked_counts, parts), np.zeros(0)]))
        sizes = np.array(sizes, np.int64)
        ends = np.cumsum(sizes)
        place = np.arange(len(grams[0])) - np.repeat(ends - sizes, sizes)
        sums = np.concatenate((np.zeros(1), np.cumsum(_log_scores(counts, place, n_words, least, alpha))))
        logs = sums[ends] - sums[ends - sizes]
        return pa.table({"doc_id": pa.array(docs, block.schema.field("docs").type.value_type), "n_words": sizes, "log_score": logs})

    scored = blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(
        add_up, f"doc_id {kind}, n_words long, log_score double"
    )
    return scored.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
