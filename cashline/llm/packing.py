"""Best-fit packing of token pieces into sequences of one length by minimum bin slack.

Per bin, the longest piece length left is taken and a subset-sum table over the lengths that are still
available, kept as the bits of one integer, finds the combination that fills the rest best; that
combination is removed, as often as the pieces last. So the packing is worked out on the histogram of
lengths, which has `capacity` entries however many documents there are, and gives patterns: which
lengths a bin holds and how many bins are like it. There are at most about as many patterns as
lengths, as each one uses some length up (or all but less than a bin needs of it).

Pieces then find their bin by their number among the pieces of their length. Numbers are dealt in two
steps, within the part of the table a piece is in and over the parts, so a length that a third of all
pieces have is not sorted in one task.

A document longer than the capacity is cut into pieces of exactly the capacity, the first of which may
be shorter: that one is packed, the others are bins of their own.

Defined results: a null text is an empty one, whose only token is the end id. Ids that repeat are
documents of their own. Long texts just give more pieces. Equal documents are spread like any others.
An empty table gives no pieces. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cashline.llm.common import settled
from cashline.llm.tokens import encoder

CAPACITY = 1024


def fullest(counts: dict[int, int], capacity: int) -> list[int]:
    """The multiset of available lengths whose sum comes closest to the capacity without passing it.

    Bit s of `reached` says that some choice of the lengths seen so far sums up to s.
    """
    reached, steps = 1, []
    mask = (1 << (capacity + 1)) - 1
    for length in sorted(counts, reverse=True):
        left, size = min(counts[length], capacity // length), 1
        while left and not reached >> capacity:
            size = min(size, left)
            after = (reached | reached << (length * size)) & mask
            if after != reached:
                steps.append((length, size, reached))
                reached = after
            left -= size
            size *= 2
        if reached >> capacity:
            break
    total = reached.bit_length() - 1
    chosen = []
    for length, size, before in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * size
            total -= length * size
    return chosen


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(number of bins, lengths in each) that use up all pieces."""
    left = {length: n for length, n in counts.items() if n}
    out = []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        chosen = [longest, *fullest({k: n for k, n in rest.items() if n and k <= capacity - longest}, capacity - longest)]
        used = {length: chosen.count(length) for length in set(chosen)}
        times = min(left[length] // n for length, n in used.items())
        out.append((times, sorted(chosen, reverse=True)))
        for length, n in used.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return out


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of `docs` (doc_id, text): doc_id, piece, start, length, ids (little-endian 32 bits)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, pieces array<struct<piece:int,start:bigint,length:bigint,ids:binary>>"
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                ids = encode(text) + end
                n = len(ids) // 4
                cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                rows.append([
                    {"piece": k, "start": a, "length": b - a, "ids": ids[4 * a : 4 * b]}
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
                ])
            kinds = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kinds)], ["doc_id", "pieces"])

    return docs.select("doc_id", "text").mapInArrow(cut, schema).select("doc_id", F.inline("pieces"))


def _plan(found: list[tuple[int, list[int]]]) -> tuple[np.ndarray, ...]:
    """Per length and pattern, sorted by length: length, first number, first bin, pieces per bin, offset."""
    rows, used, first_bin = [], {}, 0
    for times, lengths in found:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            each = lengths.count(length)
            rows.append((length, used.get(length, 0), first_bin, each, offset))
            used[length] = used.get(length, 0) + each * times
            offset += each * length
        first_bin += times
    rows.sort()
    return tuple(np.array(column, np.int64) for column in zip(*rows, strict=True))


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`cut` (with a `length` from 1 to the capacity) with sequence_id and offset for every row.

    `cut` must give the same rows whenever it is read: pass a stored table.
    """
    # A part is a run of rows of a task; numbers within it and over all parts make a piece's number.
    numbered = settled(cut.withColumn("row", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("row", 14)
    parts = settled(numbered.groupBy(part.alias("part"), "length").agg(F.count("*").alias("n")), "parts")
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if not histogram:
        return cut.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    plan = _plan(patterns(histogram, capacity))

    before = F.coalesce(
        F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    bases = settled(parts.select("part", "length", before.alias("base")), "bases")
    own = F.row_number().over(Window.partitionBy("part", "length").orderBy("row")) - 1
    ranked = numbered.withColumn("part", part).withColumn("own", own).join(bases, ["part", "length"])
    ranked = ranked.select(*cut.columns, (F.col("base") + F.col("own")).alias("number"))
    schema = ranked.drop("number").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts, bins, each, offsets = plan
        # Length and number as one sortable key; numbers stay below 2^40 per length.
        keys = (lengths << 40) + firsts
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            at = np.searchsorted(keys, (length << 40) + number, side="right") - 1
            rank = number - firsts[at]
            columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "number"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(bins[at] + rank // each[at]), pa.array(offsets[at] + rank % each[at] * length)],
                [*(n for n in batch.schema.names if n != "number"), "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids of each sequence as one binary, from rows of `pack` that kept `ids`."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(parts, F.lit(b""), lambda ids, x: F.concat(ids, x["ids"]))
    return packed.groupBy("sequence_id").agg(whole.alias("ids"))


def with_crc(cut: DataFrame) -> DataFrame:
    """`cut` with the unsigned crc32 of the ids in place of the ids."""
    return cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
