"""Repeated byte strings of a corpus by suffix arrays per shard, and the texts without any of their copies.

A window, `length` bytes of one document, is repeated if the same bytes start anywhere else. All bytes
of repeated windows go, those of the first copy too.

Shards are dealt by content, so that equal windows meet. Every window has an anchor: its place with the
least hash of `ANCHOR` bytes. Windows in a row with one anchor make a piece, the bytes they cover; equal
windows have equal anchors, hence a piece goes where the hash of its anchor says. Anchors that occur
once in the corpus have no copy anywhere, and their pieces stay where they are. In a shard the distinct
pieces are sorted by one suffix array (Larsson-Sadakane refinement); a window whose common prefix with
a neighbour, by Kasai's rule, is as long as the window is repeated, as are those of a piece that came
more than once. So bytes decide, never a hash.

An anchor with more pieces than `MOST_PIECES` is dealt over several shards. Their arrays are merged:
every shard sends its distinct windows as 128-bit fingerprints, sorted, cut into as many ranges as there
are shards, and in each range the sorted runs are looked up in the merged one by binary search. Merging
by the order of the bytes instead would send `length` bytes for each byte of text.

Texts are written once, in compressed blocks, and read from there, as places in them must not change.
Within a block equal pieces of a shard are sent once, so a passage that stands everywhere is one piece
per block. What comes back are spans per block.

Defined results: a null text is empty. Texts shorter than a window lose nothing. Rows that repeat an
id, or a whole row, are documents each, so equal texts of a window or more lose all. The kept bytes need
not be whole characters, so they are binary. An empty table gives an empty one. Only the id and the
text are looked at; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashline.llm.common import settled
from cashline.llm.suffix_arrays import common_prefixes, suffix_array, words

LENGTH = 200
ANCHOR = 24
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 2 << 20
MOST_PIECES = 4096
CHUNK = 1 << 20

_BLOCKS = pa.schema([("block", pa.int64()), ("ends", pa.binary()), ("texts", pa.binary()), ("n_bytes", pa.int64())])
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]
_PIECES = "block long, shard long, part int, n_parts int, n_bytes long, texts binary, sizes binary, n_places binary, places binary, anchors binary"
_WHOLE = "block long, shard long, part int, range int, a binary, b binary, c binary"


# Blocks of texts.


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of some documents as one compressed row; a longer text is a block of its own."""
    number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
    pack = zstandard.ZstdCompressor(level=3).compress
    of_id = None

    def row() -> pa.RecordBatch:
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        columns = [pa.array([number]), pa.array([ends.tobytes()], pa.binary()), pa.array([pack(b"".join(texts))], pa.binary())]
        columns += [pa.array([size], pa.int64()), pa.array([ids], pa.list_(of_id))]
        return pa.RecordBatch.from_arrays(columns, schema=_BLOCKS.append(pa.field("ids", pa.list_(of_id))))

    for batch in batches:
        of_id = batch.column("doc_id").type
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            text = text or b""
            if ids and size + len(text) > BLOCK_BYTES:
                yield row()
                number, ids, texts, size = number + 1, [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if ids:
        yield row()


def _texts(row: dict) -> tuple[bytes, np.ndarray]:
    """The texts of a block, one after the other, and where each ends."""
    data = zstandard.ZstdDecompressor().decompress(row["texts"], max_output_size=row["n_bytes"]) if row["n_bytes"] else b""
    return data, np.frombuffer(row["ends"], np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, as one may be large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


# Anchors and pieces.


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes from every place that has so many."""
    eight, n = words(data), len(data) - size + 1
    mixed = np.zeros(n, np.uint64)
    for j in range(0, size, 8):
        part = eight[j : j + n] if j + 8 <= size else eight[j : j + n] << np.uint64(64 - 8 * (size - j))
        mixed = (mixed ^ (mixed >> np.uint64(29)) ^ part) * _MIX[j // 8 % 4]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX[1]
    return mixed ^ (mixed >> np.uint64(29))


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of `width` values from every place that has so many, by running minima of stretches."""
    n = len(values)
    whole = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    whole[:n] = values
    whole = whole.reshape(-1, width)
    upto = np.minimum.accumulate(whole, axis=1).ravel()
    since = np.minimum.accumulate(whole[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(since[: n - width + 1], upto[width - 1 : n])


def _room(ends: np.ndarray, low: int, n: int) -> np.ndarray:
    """For `n` places from `low`, the bytes up to the end of their text."""
    own = ends[np.searchsorted(ends, low, "right") : np.searchsorted(ends, low + n - 1, "right") + 1]
    return np.repeat(own, np.diff(np.minimum(own, low + n), prepend=low)) - np.arange(low, low + n)


def pieces(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per piece the hash of its anchor (not negative), its start, and its number of windows."""
    anchors, starts, sizes = [], [], []
    first_bit = np.uint64(24)
    for low in range(0, max(0, len(data) - length + 1), CHUNK):
        some = data[low : low + CHUNK + length - 1]
        hashes = _hashes(some, anchor)
        place = np.arange(len(hashes), dtype=np.uint64)
        least = _least_of(hashes >> first_bit << first_bit | place, length - anchor + 1)
        at = (least & ((np.uint64(1) << first_bit) - np.uint64(1))).astype(np.int64)
        own = np.where(_room(ends, low, len(at)) >= length, at, -1)
        # A window of another document than the one before has an anchor behind that one's.
        cut = np.flatnonzero(np.diff(own, prepend=-2))
        size = np.diff(cut, append=len(own))
        real = own[cut] >= 0
        anchors.append((hashes[own[cut[real]]] >> np.uint64(1)).astype(np.int64))
        starts.append(low + cut[real])
        sizes.append(size[real])
    if not anchors:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(anchors), np.concatenate(starts), np.concatenate(sizes)


def _anchors(length: int, anchor: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            data, ends = _texts(row)
            found, n = np.unique(pieces(np.frombuffer(data, np.uint8), ends, length, anchor)[0], return_counts=True)
            block = pa.array(np.full(len(found), row["block"]))
            yield pa.RecordBatch.from_arrays([block, pa.array(found), pa.array(n)], ["block", "anchor", "n"])

    return count


def _deal(length: int, anchor: int, n_shards: int):
    """Pieces with repeated anchors, those of one shard and block as one row, equal ones once."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for row in _rows(batches):
            data, ends = _texts(row)
            hashes, starts, sizes = pieces(np.frombuffer(data, np.uint8), ends, length, anchor)
            known, n_parts = np.array(row["anchors"], np.int64), np.array(row["parts"], np.int64)
            order = np.argsort(known)
            known, n_parts = known[order], n_parts[order]
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            found = known[at] == hashes
            n_parts, hashes, starts, sizes = n_parts[at[found]], hashes[found], starts[found], sizes[found]
            spread = (row["block"] * int(_MIX[0]) & (1 << 64) - 1) >> 33
            part = np.where(n_parts > 1, spread % n_parts, -1)
            shard = np.where(n_parts > 1, hashes, hashes % n_shards)
            order = np.lexsort((part, shard))
            cuts = np.flatnonzero((np.diff(shard[order], prepend=-1) != 0) | (np.diff(part[order], prepend=-2) != 0))
            for a, b in zip(cuts, [*cuts[1:], len(order)]):
                these, own, of = order[a:b], {}, {}
                for s, n, h in zip(starts[these].tolist(), sizes[these].tolist(), hashes[these].tolist()):
                    piece = data[s : s + n + length - 1]
                    own.setdefault(piece, []).append(s)
                    of[piece] = h
                texts = b"".join(own)
                one = these[0]
                columns = [[row["block"]], [int(shard[one])], [int(part[one])], [int(n_parts[one])], [len(texts)], [pack(texts)]]
                columns += [[np.array([*map(len, x)], np.int64).tobytes()] for x in (own, own.values())]
                columns += [[np.array([s for at in own.values() for s in at], np.int64).tobytes()]]
                columns += [[np.array([*of.values()], np.int64).tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _DEALT)], schema=_DEALT)

    return deal


_DEALT = pa.schema(
    [("block", pa.int64()), ("shard", pa.int64()), ("part", pa.int32()), ("n_parts", pa.int32())]
    + [("n_bytes", pa.int64()), ("texts", pa.binary())]
    + [(name, pa.binary()) for name in ("sizes", "n_places", "places", "anchors")]
)


# Shards.


class _Shard:
    """Distinct pieces, with the (block, place) of each time that one occurs."""

    def __init__(self, table: pa.Table):
        number: dict[bytes, int] = {}
        of, blocks, places, anchors = [], [], [], []
        for row in table.to_pylist():
            texts = zstandard.ZstdDecompressor().decompress(row["texts"], max_output_size=row["n_bytes"])
            sizes, n_places = (np.frombuffer(row[c], np.int64) for c in ("sizes", "n_places"))
            end = np.cumsum(sizes).tolist()
            known = len(number)
            own = np.array([number.setdefault(texts[a:b], len(number)) for a, b in zip([0, *end], end)], np.int64)
            # New pieces are numbered as they come, so theirs are the first of each number.
            fresh = np.unique(own[own >= known], return_index=True)[1]
            anchors.append(np.frombuffer(row["anchors"], np.int64)[own >= known][fresh])
            of.append(np.repeat(own, n_places))
            places.append(np.frombuffer(row["places"], np.int64))
            blocks.append(np.full(len(places[-1]), row["block"]))
        self.of, self.blocks, self.places = map(np.concatenate, (of, blocks, places))
        self.data = np.frombuffer(b"".join(number), np.uint8)
        self.sizes = np.array([*map(len, number)], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        anchors = np.concatenate(anchors)
        _, place, n = np.unique(anchors, return_inverse=True, return_counts=True)
        self.compared = n[place] > 1

    def repeated(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether each place starts a repeated window, and the first place of each distinct window.

        A piece that is the only one with its anchor shares no window with another piece: all its windows
        occur as often as it does. The others are sorted.
        """
        window = np.repeat(self.starts + self.sizes, self.sizes) - np.arange(len(self.data)) >= length
        sorted_bytes = np.repeat(self.compared, self.sizes)
        place = np.flatnonzero(sorted_bytes)
        data, sizes = self.data[place], self.sizes[self.compared]
        order = suffix_array(data, sizes)
        as_before = common_prefixes(data, sizes, order, length) >= length
        found = np.zeros(len(self.data), bool)
        found[place[order[as_before | np.append(as_before[1:], False)]]] = True
        distinct = np.concatenate((place[order[~as_before]], np.flatnonzero(~sorted_bytes)))
        twice = np.bincount(self.of, minlength=len(self.sizes)) > 1
        found |= np.repeat(twice, self.sizes)
        return found & window, distinct[window[distinct]]


def _runs(flags: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the places in a row that are flagged within one piece."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at
    new = np.flatnonzero((np.diff(at, prepend=-2) > 1) | (np.diff(piece[at], prepend=-1) != 0))
    return at[new], at[np.append(new[1:], len(at)) - 1]


def _spans(flags, sizes, of, blocks, places, length) -> Iterator[tuple[int, bytes]]:
    """Per block the spans (start, end) that the flagged windows of its pieces cover."""
    starts = np.cumsum(sizes) - sizes
    piece = np.repeat(np.arange(len(sizes)), sizes)
    first, last = _runs(flags, piece)
    if not len(first):
        return
    owner = piece[first]
    n_runs = np.bincount(owner, minlength=len(sizes))
    begin = np.cumsum(n_runs) - n_runs
    each = n_runs[of]
    occurrence = np.repeat(np.arange(len(of)), each)
    run = begin[of[occurrence]] + np.arange(len(occurrence)) - np.repeat(np.cumsum(each) - each, each)
    move = places[occurrence] - starts[of[occurrence]]
    spans = np.stack((first[run] + move, last[run] + move + length), 1)
    order = np.argsort(blocks[occurrence], kind="stable")
    own = blocks[occurrence][order]
    cuts = np.flatnonzero(np.diff(own, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(own)]):
        yield int(own[a]), spans[order[a:b]].astype(np.int64).tobytes()


def _window_prints(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Two 64-bit fingerprints of each window, the first as key."""
    eight = words(data)
    prints = np.zeros((len(at), 2), np.uint64)
    for k in range(2):
        mixed = np.full(len(at), _MIX[k + 2])
        for j in [*range(0, length - 7, 8), max(0, length - 8)]:
            part = eight[at + j]
            if length < 8:
                part = part << np.uint64(64 - 8 * length)
            mixed = (mixed ^ part) * _MIX[k]
            mixed ^= mixed >> np.uint64(31 - 2 * k)
        prints[:, k] = mixed * _MIX[k + 1]
    return prints


def _range_of(prints: np.ndarray, n_ranges: int) -> np.ndarray:
    return ((prints[:, 0] >> np.uint64(40)).astype(np.int64) * n_ranges) >> 24


def _resolve(length: int):
    """A shard's spans; of one of several also its windows for the others and what it needs afterwards."""

    def resolve(key: tuple, table: pa.Table) -> pa.Table:
        shard = _Shard(table)
        flags, distinct = shard.repeated(length)
        number, part = (k.as_py() for k in key)
        rows = []
        if part < 0:
            rows = [(block, None, None, None, spans, None, None) for block, spans in _spans(flags, shard.sizes, shard.of, shard.blocks, shard.places, length)]
        else:
            places = np.stack((shard.of, shard.blocks, shard.places), 1)
            rows.append((None, number, part, -1, np.packbits(flags).tobytes(), shard.sizes.tobytes(), places.tobytes()))
            prints = _window_prints(shard.data, distinct, length)
            order = np.argsort(prints[:, 0], kind="stable")
            prints, distinct = prints[order], distinct[order]
            n_ranges = table.column("n_parts")[0].as_py()
            bounds = np.searchsorted(_range_of(prints, n_ranges), np.arange(n_ranges + 1))
            rows += [
                (None, number, part, k, prints[a:b].tobytes(), distinct[a:b].astype(np.int64).tobytes(), None)
                for k, (a, b) in enumerate(zip(bounds, bounds[1:]))
                if b > a
            ]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        columns = zip(*rows) if rows else [[]] * len(kinds)
        names = ["block", "shard", "part", "range", "a", "b", "c"]
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return resolve


def _merge(key: tuple, runs: pa.Table) -> pa.Table:
    """Windows that stand in several sorted runs: their places per part."""
    rows = runs.to_pylist()
    prints = [np.frombuffer(r["a"], np.uint64).reshape(-1, 2) for r in rows]
    every = np.concatenate(prints)
    merged = np.sort(every[:, 0])
    upto = [np.searchsorted(merged, p[:, 0], "right") - np.searchsorted(merged, p[:, 0], "left") for p in prints]
    several = np.flatnonzero(np.concatenate(upto) > 1)
    # The second half of the fingerprint tells those apart that share the first by chance.
    some = every[several]
    order = np.lexsort((some[:, 1], some[:, 0]))
    equal = (some[order][1:] == some[order][:-1]).all(1)
    found = np.zeros(len(every), bool)
    found[several[order[1:][equal]]] = True
    found[several[order[:-1][equal]]] = True
    bounds = np.cumsum([0, *map(len, prints)])
    places = [np.frombuffer(r["b"], np.int64)[found[i:j]].tobytes() for r, i, j in zip(rows, bounds, bounds[1:])]
    number = pa.array([key[0].as_py()] * len(rows), pa.int64())
    return pa.table([number, pa.array([r["part"] for r in rows], pa.int32()), pa.array(places, pa.binary())], ["shard", "part", "a"])


def _finish(length: int):
    """The spans of a shard that is one of several, with the windows that others have too."""

    def finish(key: tuple, own: pa.Table, others: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        sizes = np.frombuffer(row["b"], np.int64)
        of, blocks, places = np.frombuffer(row["c"], np.int64).reshape(-1, 3).T
        flags = np.unpackbits(np.frombuffer(row["a"], np.uint8), count=int(sizes.sum())).astype(bool)
        for at in others.column("found").to_pylist():
            flags[np.frombuffer(at, np.int64)] = True
        # A window that is repeated elsewhere is so at all its places here, which are its only ones.
        rows = list(_spans(flags, sizes, of, blocks, places, length))
        return pa.table([pa.array([b for b, _ in rows], pa.int64()), pa.array([s for _, s in rows], pa.binary())], ["block", "a"])

    return finish


# Whole operator.


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without the bytes of the block's spans."""
    for batch in batches:
        of_id = batch.column("ids").type.value_type
        for row in _rows([batch]):
            data, ends = _texts(row)
            spans = np.frombuffer(b"".join(row["spans"] or []), np.int64).reshape(-1, 2)
            gone = np.zeros(len(data) + 1, np.int32)
            np.add.at(gone, spans[:, 0], 1)
            np.add.at(gone, spans[:, 1], -1)
            gone = np.cumsum(gone[:-1]) > 0
            whole = np.frombuffer(data, np.uint8)
            out, start = [], 0
            for doc_id, end in zip(row["ids"], ends.tolist()):
                own = gone[start:end]
                turns = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
                runs = [{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])]
                kept = data[start:end] if not runs else whole[start:end][~own].tobytes()
                out.append((doc_id, end - start, int(own.sum()), runs, kept))
                start = end
            for i in range(0, len(out), 1000):
                columns = zip(*out[i : i + 1000])
                kinds = [of_id, pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
                names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, most_pieces: int = MOST_PIECES, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed bytes from start to before end) and kept, of `docs` (doc_id, text)."""
    if not 1 <= anchor <= length:
        raise ValueError("an anchor lies within the length")
    of_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"block long, ends binary, texts binary, n_bytes long, ids array<{of_id}>"
    blocks = settled(docs.select("doc_id", "text").mapInArrow(_blocks, schema), "blocks", compression="none")
    texts = blocks.select("block", "ends", "texts", "n_bytes")
    counts = texts.mapInArrow(_anchors(length, anchor), "block long, anchor long, n long")
    counts = settled(counts, "anchors")
    total = counts.groupBy("anchor").agg(F.sum("n").alias("total")).filter("total > 1")
    parts = F.ceil(F.col("total") / most_pieces).cast("int").alias("parts")
    known = counts.select("block", "anchor", "n").join(total.select("anchor", parts), "anchor")
    known = known.groupBy("block").agg(
        F.collect_list("anchor").alias("anchors"), F.collect_list("parts").alias("parts"), F.sum("n").alias("n")
    )
    known = settled(known, "repeated-anchors")
    n_pieces = known.agg(F.sum("n")).first()[0] or 0
    n_shards = max(1, -(-n_pieces * 3 * length // 2 // shard_bytes))
    dealt = texts.join(known.drop("n").hint("merge"), "block").mapInArrow(_deal(length, anchor, n_shards), _PIECES)
    resolved = settled(dealt.groupBy("shard", "part").applyInArrow(_resolve(length), _WHOLE), "resolved")
    spans = resolved.filter("block is not null").select("block", "a")
    own = resolved.filter("range = -1").select("shard", "part", "a", "b", "c")
    if not own.isEmpty():
        merged = resolved.filter("range >= 0").groupBy("shard", "range").applyInArrow(_merge, "shard long, part int, a binary")
        others = settled(merged, "merged").toDF("of", "of_part", "found")
        late = own.groupBy("shard", "part").cogroup(others.groupBy("of", "of_part")).applyInArrow(_finish(length), "block long, a binary")
        spans = spans.union(late)
    of_block = settled(spans.groupBy("block").agg(F.collect_list("a").alias("spans")), "spans")
    joined = blocks.join(of_block.withColumnRenamed("block", "of").hint("merge"), F.col("block") == F.col("of"), "left").drop("of")
    runs = "array<struct<start: bigint, end: bigint>>"
    return joined.mapInArrow(_cut, f"doc_id {of_id}, n_bytes long, n_removed long, spans {runs}, kept binary")
