"""How filters on documents overlap: what each removes in every order, with copies found by radix tries.

Five filters are judged once per document, as bits of a mask: A, B, C and D from the text alone, E (a
copy of the text of a document with a smaller id) by tries. The audit of all orders of the filters
needs only the number of documents per part, mask and label, so no order is ever run.

Copies. Each map task inserts its texts, some tens of MB at a time, into a compressed trie whose
terminals hold the least id; what is beaten there is a copy, and of each text only the rows with the
least id go on, so a text that a third of all documents share is shuffled once per such trie. The texts
left are range-partitioned by a prefix, sorted by it, and each prefix gets a trie of its own, which ends
with it. Prefixes adapt: one under which more than `PART_BYTES` of longer texts lie grows to four times
its length, until what it holds is small or the texts end. Equal texts have equal prefixes. Prefixes
to grow are broadcast; there are at most `MOST_PREFIXES` of them, as the bytes allowed per prefix are
raised with the corpus beyond that.

Defined results: a null text is an empty one. A null id is no smaller id and no copy, and has no
labels. Rows that repeat an id count each; equal ones are no copies of each other. Of several labels of
an id, one that says so is enough. A null part is the empty string. An empty table has no parts.
Columns other than the id, the part and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashline.llm.common import settled

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
FOLLOWING = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point

HELD_BYTES, HELD_ROWS = 32 << 20, 100_000
PART_BYTES = 256 << 10
MOST_PREFIXES = 100_000
FIRST_PREFIX = 16


class _Node:
    __slots__ = ("edges", "least")

    def __init__(self):
        self.edges: dict[int, tuple[bytes, _Node]] = {}
        self.least = None


def _common(a: bytes, b: bytes, start: int) -> int:
    """How many bytes of `a` stand at `start` in `b`."""
    low, high = 0, min(len(a), len(b) - start)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[start + low : start + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class RadixTrie:
    """A compressed trie of whole texts; the node where a text ends holds the least key given with it."""

    def __init__(self):
        self.root = _Node()

    def insert(self, text: bytes, key) -> _Node:
        """The terminal of the text; None is no key."""
        node, at = self.root, 0
        while at < len(text):
            edge = node.edges.get(text[at])
            if edge is None:
                leaf = _Node()
                node.edges[text[at]] = (text[at:], leaf)
                node, at = leaf, len(text)
            elif text.startswith(edge[0], at):
                node, at = edge[1], at + len(edge[0])
            else:
                label, below = edge
                n = _common(label, text, at)
                middle = _Node()
                middle.edges[label[n]] = (label[n:], below)
                node.edges[label[0]] = (label[:n], middle)
                node, at = middle, at + n
        if key is not None and (node.least is None or key < node.least):
            node.least = key
        return node


def failures(text: bytes) -> int:
    """The bits of the filters A to D that a UTF-8 text fails."""
    words = text.split()
    n, n_points = len(words), len(text.translate(None, FOLLOWING))
    return (
        (n < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * n) << 1
        | (100 * (len(text) - len(text.translate(None, CAPITALS))) > MOST_CAPITALS * n_points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


class _Held:
    """Rows whose trie is not yet complete, equal ones counted."""

    def __init__(self):
        self.trie, self.rows, self.size = RadixTrie(), {}, 0

    def add(self, text: bytes, doc_id, part: str, mask: int, n: int = 1) -> None:
        key = self.trie.insert(text, doc_id), doc_id, part
        if key in self.rows:
            self.rows[key][1] += n
        else:
            self.rows[key] = [mask, n, text]
            self.size += len(text) + 64

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The rows with their flags; texts only of those that no other row here beats."""
        rows = [
            (doc_id, part, mask, n, copy, None if copy or doc_id is None else text)
            for (node, doc_id, part), (mask, n, text) in self.rows.items()
            for copy in [doc_id is not None and doc_id > node.least]
        ]
        for i in range(0, len(rows), 1000):
            columns = zip(*rows[i : i + 1000])
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _schema(of_id: pa.DataType) -> pa.Schema:
    names = ("doc_id", "part", "mask", "n", "copy", "text")
    return pa.schema(list(zip(names, (of_id, pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.binary()))))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        schema = _schema(batch.column("doc_id").type)
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for doc_id, part, text in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), texts):
            held = held or _Held()
            text = text or b""
            held.add(text, doc_id, part or "", failures(text))
            if held.size > HELD_BYTES or len(held.rows) > HELD_ROWS:
                yield from held.batches(schema)
                held = None
    if held:
        yield from held.batches(schema)


def _settle_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by prefix, one trie per prefix."""
    now, held = None, None
    for batch in batches:
        schema = _schema(batch.column("doc_id").type)
        columns = [batch.column(c).to_pylist() for c in ("prefix", "text", "doc_id", "part", "mask", "n")]
        for prefix, *row in zip(*columns):
            if prefix != now:
                if held:
                    yield from held.batches(schema)
                now, held = prefix, _Held()
            held.add(*row)
    if held:
        yield from held.batches(schema)


def _prefixed(rows: DataFrame, part_bytes: int) -> DataFrame:
    """`rows` with `prefix`, long enough that few bytes of different texts share it. `text` is binary."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    allowed = max(part_bytes, total // MOST_PREFIXES)
    size = FIRST_PREFIX
    rows = rows.withColumn("prefix", F.substring("text", 1, size))
    while True:
        longer = rows.filter(F.octet_length("text") > size).filter(F.octet_length("prefix") == size)
        heavy = longer.groupBy("prefix").agg(F.sum(F.octet_length("text")).alias("bytes"))
        heavy = settled(heavy.filter(F.col("bytes") > allowed).select("prefix", F.lit(True).alias("grows")), "prefixes")
        if heavy.isEmpty():
            return rows
        size *= 4
        grown = F.when(F.col("grows"), F.substring("text", 1, size)).otherwise(F.col("prefix"))
        rows = rows.join(F.broadcast(heavy), "prefix", "left").withColumn("prefix", grown).drop("grows")


def judged(docs: DataFrame, part: str = "lang", part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, part, mask (bits of the filters A to E that fail) and n, the number of such rows.

    `docs` has doc_id, text and the column `part`.
    """
    rows = docs.select("doc_id", F.col(part).alias("part"), "text")
    of_id = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {of_id}, part string, mask int, n long, copy boolean, text binary"
    measured = settled(rows.mapInArrow(_measure, schema), "measured", compression="zstd")
    left = _prefixed(measured.filter("text is not null"), part_bytes)
    dealt = left.repartitionByRange("prefix").sortWithinPartitions("prefix")
    found = dealt.select("doc_id", "part", "mask", "n", "text", "prefix").mapInArrow(_settle_copies, schema).drop("text")
    every = measured.filter("text is null").drop("text").union(found)
    return every.select("doc_id", "part", (F.col("mask") + F.when(F.col("copy"), 16).otherwise(0)).alias("mask"), "n")


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good, toxic, n: how many documents there are of each kind."""
    said = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    known = rows.join(said.withColumnRenamed("doc_id", "of"), F.col("doc_id") == F.col("of"), "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return known.groupBy("part", "mask", flag("good"), flag("toxic")).agg(F.sum("n").alias("n"))


def orders_audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """What each filter does at each step of every order, per part, from `mask_counts`."""
    orders = ["".join(p) for p in permutations(filters)]
    step = F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step")
    steps = counts.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders)))).select("*", step)

    def bit(letter: Column) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for i, f in enumerate(filters) for x in (f, 1 << i)]), letter)

    letter = F.substr("filter_order", F.col("step"), F.lit(1))
    earlier = F.slice(F.split("filter_order", ""), F.lit(1), F.col("step") - 1)
    before = F.aggregate(earlier, F.lit(0), lambda total, x: total + bit(x))
    steps = steps.withColumn("letter", letter).withColumn("own", bit(F.col("letter"))).withColumn("before", before)
    mask, n = F.col("mask"), F.col("n")
    fails = mask.bitwiseAND(F.col("own")) != 0
    gone = mask.bitwiseAND(F.col("before")) != 0
    here = fails & ~gone
    total = lambda when: F.sum(F.when(when, n).otherwise(0))
    summed = steps.groupBy("part", "filter_order", "step", "letter").agg(
        total(~fails & ~gone).alias("kept"),
        total(here).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(mask == F.col("own")).alias("unique_fails"),
        total(here & F.col("good")).alias("good_lost"),
        total(here & F.col("toxic")).alias("toxic_lost"),
    )
    shares = summed.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return summed.join(shares, ["part", "letter"]).drop("letter")
