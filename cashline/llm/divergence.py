"""How far the sources of a language differ in their words, by exact products of one-hot levels.

Every (language, source) group gives each term that the language keeps a price that depends only on
the group and on the term's count there, its level. So the sum over all terms of a function of two
groups' prices is a sum over pairs of levels, weighted by how many terms are at both. These joint
tables are products: with one indicator column per (group, level) and one row per term, the matrix
times its transpose holds the table of every two groups. Terms are dealt into blocks by hash; in each,
column blocks of at most `COLUMNS` indicators are multiplied as 32-bit floats, exact as no entry
exceeds the block's number of terms, and priced in whole numbers. Blocks add up in Spark.

Words are counted per group in the map tasks before anything is shuffled, in tables of bounded size,
so neither a source nor a word that is everywhere is a hot key. A block holds at most about
`CELLS` counts whatever the number of sources.

All arithmetic is exact: decimals where a billion times a count would not fit 64 bits.

Defined results: null text, language and source are empty strings. A group without terms has its pairs
and prices all kept terms of its language; a language without kept terms has pairs of value 0. Rows that
repeat an id are documents each. An empty table gives no rows. Columns other than text, language and
source are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cashline.llm.common import settled

LEAST_DOCS = 10
MOST_TERMS = 10
ONE = 1_000_000_000
TERMS, CELLS, COLUMNS = 1024, 1 << 20, 2048
HELD_TERMS = 400_000

# A-Z as a-z, every other ASCII byte that is no letter as a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if b < 0x61 or 0x7B <= b < 0x80 else b for b in range(256))
_COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each term, and documents with it, per (lang, source); one row without a term per group."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
            n, docs = held.setdefault((lang or "", source or ""), (Counter(), Counter()))
            terms = (text or b"").translate(_FOLD).split()
            n.update(terms)
            docs.update(set(terms))
        if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
            yield from _counted(held)
            held = {}
    yield from _counted(held)


def _counted(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in held.items():
        size = len(n) + 1
        columns = [
            pa.array([lang]).take(pa.array(np.zeros(size, np.int32))),
            pa.array([source]).take(pa.array(np.zeros(size, np.int32))),
            pa.array([*n, None], pa.binary()).cast(pa.string()),
            pa.array([*n.values(), 0], pa.int64()),
            pa.array([*map(docs.__getitem__, n), 0], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=_COUNTS)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs of `docs` (lang, source, text); a group's row without a term has a null."""
    counted = docs.select("lang", "source", "text").mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept)), exact; `kept` is above 0."""
    over = (n.cast("decimal(20,0)") + 2) * F.lit(ONE).cast("decimal(10,0)")
    return F.call_function("div", over, total.cast("decimal(20,0)") + 2 * kept) + 1


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) in whole numbers; both are at most 10^9 + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _prices(levels: np.ndarray, under: int) -> np.ndarray:
    return np.array([1 + ONE * (int(n) + 2) // under for n in levels], np.int64)


def joint_values(counts: np.ndarray, unders: list[int]) -> np.ndarray:
    """Per two columns of `counts` (terms x groups) the distances of their prices, summed over the terms.

    `unders` are the divisors of the groups' prices.
    """
    n_terms, n_groups = counts.shape
    firsts, prices, codes = [0], [], np.empty(counts.shape, np.int64)
    for g in range(n_groups):
        levels, at = np.unique(counts[:, g], return_inverse=True)
        codes[:, g] = firsts[-1] + at
        firsts.append(firsts[-1] + len(levels))
        prices.append(_prices(levels, unders[g]))
    values = np.zeros((n_groups, n_groups), np.int64)
    parts = _column_blocks(firsts)
    for i, (a, b) in enumerate(parts):
        left = _indicators(codes[:, a:b] - firsts[a], firsts[b] - firsts[a])
        p = np.concatenate(prices[a:b])[:, None]
        for c, d in parts[i:]:
            right = left if (c, d) == (a, b) else _indicators(codes[:, c:d] - firsts[c], firsts[d] - firsts[c])
            joint = (left.T @ right).astype(np.int64)
            q = np.concatenate(prices[c:d])[None, :]
            priced = joint * ((p - q) ** 2 // (p + q))
            rows = np.add.reduceat(priced, np.array(firsts[a:b]) - firsts[a], axis=0)
            values[a:b, c:d] = np.add.reduceat(rows, np.array(firsts[c:d]) - firsts[c], axis=1)
    return values


def _column_blocks(firsts: list[int]) -> list[tuple[int, int]]:
    """Ranges of groups with about COLUMNS levels together, at least one group each."""
    out, a = [], 0
    for b in range(1, len(firsts)):
        if b == len(firsts) - 1 or firsts[b + 1] - firsts[a] > COLUMNS:
            out.append((a, b))
            a = b
    return out


def _indicators(codes: np.ndarray, n_columns: int) -> np.ndarray:
    found = np.zeros((len(codes), n_columns), np.float32)
    found[np.arange(len(codes))[:, None], codes] = 1
    return found


def _block(key: tuple, cells: pa.Table, groups: pa.Table) -> pa.Table:
    """The part of all pairs' values that the terms of one block give."""
    groups = groups.sort_by("at")
    n_groups = groups.num_rows
    terms = cells.column("term").combine_chunks().dictionary_encode()
    counts = np.zeros((len(terms.dictionary), n_groups), np.int64)
    counts[terms.indices.to_numpy(), cells.column("place").to_numpy()] = cells.column("n").to_numpy()
    unders = [int(t) + 2 * int(k) for t, k in zip(groups.column("total").to_pylist(), groups.column("n_terms").to_pylist())]
    values = joint_values(counts, unders) if len(counts) else np.zeros((n_groups, n_groups), np.int64)
    a, b = np.triu_indices(n_groups, 1)
    lang = pa.array([key[0].as_py()]).take(pa.array(np.zeros(len(a), np.int32)))
    return pa.table([lang, pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(values[a, b])], ["lang", "a", "b", "value"])


class Audit:
    """The settled tables of one audit: `cells`, `groups`, and from them `pairs` and `terms`."""

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS):
        counts = settled(term_counts(docs), "term-counts")
        words = counts.filter("term is not null")
        of_term = words.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        kept = settled(of_term.filter(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
        self.cells = settled(words.drop("docs").join(kept, ["lang", "term"]), "cells")
        langs = kept.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("lang_n").alias("lang_total"))
        totals = self.cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        size = F.count("*").over(Window.partitionBy("lang"))
        groups = counts.filter("term is null").select("lang", "source", place.alias("place"), size.alias("n_groups"))
        groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        self.groups = settled(groups.na.fill(0), "groups")

    def pairs(self) -> DataFrame:
        """lang, source, item (another source of the language), value."""
        terms = F.greatest(F.lit(1), F.least(F.lit(TERMS), F.floor(F.lit(CELLS) / F.col("n_groups"))))
        n_blocks = F.greatest(F.lit(1), F.ceil(F.col("n_terms") / terms)).cast("int")
        groups = self.groups.withColumn("n_blocks", n_blocks)
        block = F.pmod(F.xxhash64("term"), F.col("n_blocks")).cast("int").alias("block")
        cells = self.cells.join(groups.select("lang", "source", "place", "n_blocks"), ["lang", "source"])
        cells = cells.select("lang", block, "term", "place", "n")
        every = groups.select("lang", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"), F.col("place").alias("at"), "total", "n_terms")
        every = every.withColumnRenamed("lang", "of")
        parts = cells.groupBy("lang", "block").cogroup(every.groupBy("of", "block")).applyInArrow(_block, "lang string, a int, b int, value long")
        values = settled(parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pairs")
        both = values.union(values.select("lang", "b", "a", "value"))
        own = self.groups.select("lang", F.col("place").alias("a"), "source")
        other = self.groups.select("lang", F.col("place").alias("b"), F.col("source").alias("item"))
        return both.join(own, ["lang", "a"]).join(other, ["lang", "b"]).select("lang", "source", "item", "value")

    def terms(self) -> DataFrame:
        """lang, source, item (a term dearer in the group than in the language), value."""
        cells = self.cells.join(self.groups, ["lang", "source"])
        priced = cells.select(
            "lang",
            "source",
            F.col("term").alias("item"),
            price(F.col("n"), F.col("total"), F.col("n_terms")).alias("p"),
            price(F.col("lang_n"), F.col("lang_total"), F.col("n_terms")).alias("q"),
        )
        return priced.filter("p > q").select("lang", "source", "item", distance(F.col("p"), F.col("q")).alias("value"))


def ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    """`rows` with part and rank, by falling value and rising item."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    found = rows.withColumn("rank", F.row_number().over(order))
    if most:
        found = found.filter(F.col("rank") <= most)
    return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, most_terms: int = MOST_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank of `docs` (lang, source, text)."""
    audit = Audit(docs, least_docs)
    return ranked(audit.pairs(), "pair").union(ranked(audit.terms(), "term", most_terms))
