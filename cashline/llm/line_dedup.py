"""Repeated line runs of a corpus by a suffix array over line ids, and the texts without later copies.

Every line becomes an id (the rank of its 128-bit fingerprint among lines that occur twice or more;
the others end a run). Prefix doubling sorts the suffixes of the id sequences: ranks by the first 2^k
lines give, joined with the ranks 2^k lines further on, the pairs whose order is the rank by 2^(k+1)
lines. Only suffixes whose rank some other one shares go on, so the tables shrink from round to round.

Suffixes with one rank at level k are an interval of the suffix array whose longest common prefix is
at least 2^k lines. Any run of n lines, 2^k <= n < 2^(k+1), is such an interval too, named by the two
ranks that cover it: that of its first and that of its last 2^k lines. For every place we take the
shortest run that starts there, and the shortest that ends there, with `least_words` words; the
intervals of these runs cover exactly the lines of all maximal repeated runs with so many words (a
line of such a run lies either in the shortest run from the maximal run's first line, or in the
shortest run that ends with that line). In each interval the first occurrence, by document and line,
stays and the lines of all others are deleted. A deleted line always has an equal line before it, so
of every line that occurs one copy is left.

Ranks are dealt by range-partitioned sorts of distinct pairs, whose row numbers grow with the
partition, so neither a task nor the driver sees all of them; a line that stands everywhere is one
pair. Each level is written out, as its numbers must not change when a task is run again.

Defined results: a null text has no lines and stays null. Lines are split by \\n; words by white space.
Blank lines have no words but are part of runs. Documents are taken in the order of their id, null
first, and of one id in the order of a hash of the text; rows equal in both are one document and get
the same result. A document of which every line goes has an empty text. An empty table gives an empty
one. Other columns are kept, but one named `deleted` is replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cashline.llm.common import let, settled, white_words

LEAST_WORDS = 50


def _numbered(df: DataFrame, order: list[str], name: str, number: str) -> DataFrame:
    """Numbers that grow with the order of the (distinct) rows, settled because they must not change."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return settled(ranged.withColumn(number, F.monotonically_increasing_id()), name)


def suffix_ranks(ids: DataFrame, longest: int | None = None) -> list[DataFrame]:
    """Ranks (doc, at, rank) per level k of the suffixes whose first 2^k lines occur elsewhere too.

    `ids` has doc, at (0, 1, ...) and rank, the rank of the line. Ranks grow with the order of the
    suffixes by their first 2^k lines. Levels go on until no two suffixes are equal, or, where only
    runs of up to `longest` lines matter, while 2^k is not above that.
    """
    levels = [ids.select("doc", "at", "rank")]
    step = 1
    while not levels[-1].isEmpty() and (longest is None or 2 * step <= longest):
        now, k = levels[-1], len(levels)
        later = now.select("doc", (F.col("at") - step).alias("at"), F.col("rank").alias("later"))
        pairs = settled(now.join(later, ["doc", "at"]), f"pairs-{k}")
        distinct = pairs.groupBy("rank", "later").agg(F.count("*").alias("n")).filter("n > 1").select("rank", "later")
        numbers = _numbered(distinct, ["rank", "later"], f"ranks-{k}", "next")
        found = pairs.join(numbers, ["rank", "later"]).select("doc", "at", F.col("next").alias("rank"))
        levels.append(settled(found, f"level-{k}"))
        step *= 2
    return levels


def _shortest_runs(lines: DataFrame, least_words: int) -> DataFrame:
    """Runs (doc, at, n) of the fewest lines with `least_words` words, from and up to every place.

    A document is taken apart where its places leave out a line.

    With words summed up to each line, the run from `at` ends with the first line that reaches the sum
    before `at` plus the least words. Sorted by sum, that line is found by one ordered pass per document.
    """
    part = F.col("at") - F.row_number().over(Window.partitionBy("doc").orderBy("at"))
    parts = lines.select("doc", part.alias("part"), "at", "words")
    of_doc = Window.partitionBy("doc", "part").orderBy("at")
    summed = parts.select("doc", "part", "at", "words", F.sum("words").over(of_doc).alias("upto"))
    total = F.max("upto").over(Window.partitionBy("doc", "part"))
    summed = summed.withColumn("total", total)
    before = F.col("upto") - F.col("words")
    # Forward: target sum, asked of the lines. Of lines with equal sums the first one reaches it.
    ends = summed.select("doc", "part", F.col("upto").alias("sum"), F.lit(0).alias("asks"), F.col("at").alias("place"))
    asks = summed.filter(before + least_words <= F.col("total")).select(
        "doc", "part", (before + least_words).alias("sum"), F.lit(1).alias("asks"), F.col("at").alias("place")
    )
    # Read from the greatest sum down, so the last line seen is the first that has at least the sum.
    down = Window.partitionBy("doc", "part").orderBy(F.desc("sum"), "asks", F.desc("place"))
    end = F.last(F.when(F.col("asks") == 0, F.col("place")), True).over(
        down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    forward = ends.union(asks).withColumn("end", end).filter("asks = 1")
    forward = forward.select("doc", F.col("place").alias("at"), (F.col("end") - F.col("place") + 1).alias("n"))
    # Backward: the last start whose sum before it leaves enough words up to the end of the line.
    starts = summed.select("doc", "part", before.alias("sum"), F.lit(0).alias("asks"), F.col("at").alias("place"))
    asks = summed.filter(F.col("upto") >= least_words).select(
        "doc", "part", (F.col("upto") - least_words).alias("sum"), F.lit(1).alias("asks"), F.col("at").alias("place")
    )
    up = Window.partitionBy("doc", "part").orderBy("sum", "asks", "place")
    start = F.last(F.when(F.col("asks") == 0, F.col("place")), True).over(
        up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    backward = starts.union(asks).withColumn("start", start).filter("asks = 1")
    backward = backward.select("doc", F.col("start").alias("at"), (F.col("place") - F.col("start") + 1).alias("n"))
    return forward.union(backward).distinct()


def repeated_lines(lines: DataFrame) -> DataFrame:
    """The lines that occur twice or more, once each: doc, at, words and rank, by the order of `print`."""
    repeated = lines.groupBy("print").agg(F.count("*").alias("n")).filter("n > 1").select("print")
    ids = _numbered(repeated, ["print"], "line-ids", "rank")
    return settled(lines.join(ids, "print").select("doc", "at", "words", "rank").distinct(), "level-0")


def later_copies(lines: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Runs (doc, at, n) that repeat an earlier run. `lines` has doc, at, print and words."""
    ids = repeated_lines(lines)
    runs = settled(_shortest_runs(ids, least_words), "runs")
    longest = runs.agg(F.max("n")).first()[0] or 0
    copies = []
    for k, level in enumerate(suffix_ranks(ids, longest)):
        size = 2**k
        own = runs.filter((F.col("n") >= size) & (F.col("n") < 2 * size))
        heads = own.join(level.withColumnRenamed("rank", "head"), ["doc", "at"])
        tails = level.select("doc", (F.col("at") + size).alias("end"), F.col("rank").alias("tail"))
        both = heads.withColumn("end", F.col("at") + F.col("n")).join(tails, ["doc", "end"])
        named = settled(both.select("doc", "at", "n", "head", "tail"), f"intervals-{k}")
        firsts = named.groupBy("n", "head", "tail").agg(
            F.min(F.struct("doc", "at")).alias("first"), F.count("*").alias("copies")
        )
        firsts = settled(firsts.filter("copies > 1"), f"firsts-{k}")
        later = named.join(firsts, ["n", "head", "tail"]).filter(F.struct("doc", "at") > F.col("first"))
        copies.append(later.select("doc", "at", "n"))
    return reduce(DataFrame.union, copies)


def _doc(text: str, key: str) -> Column:
    return F.struct(F.col(key).alias("id"), F.xxhash64(text).alias("text")).alias("doc")


def dedup_lines(docs: DataFrame, least_words: int = LEAST_WORDS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`docs` with the lines of later copies deleted from `text`, and `deleted`, their runs (at, n)."""
    line = F.col("line")
    lines = docs.select(_doc(text, key), F.posexplode(F.split(text, "\n", -1)).alias("at", "line")).select(
        "doc", "at", F.unhex(F.md5(line)).alias("print"), F.size(white_words(line)).cast("long").alias("words")
    )
    runs = later_copies(settled(lines, "lines"), least_words)
    before = Window.partitionBy("doc").orderBy("at", "n").rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.col("at") > F.max(F.col("at") + F.col("n")).over(before), F.lit(True))
    upto = Window.partitionBy("doc").orderBy("at", "n").rowsBetween(Window.unboundedPreceding, 0)
    merged = (
        runs.withColumn("apart", apart.cast("int"))
        .withColumn("block", F.sum("apart").over(upto))
        .groupBy("doc", "block")
        .agg(F.min("at").alias("at"), F.max(F.col("at") + F.col("n")).alias("end"))
    )
    gone = merged.groupBy("doc").agg(
        F.sort_array(F.collect_list(F.struct("at", (F.col("end") - F.col("at")).alias("n")))).alias("deleted")
    )
    gone = settled(gone, "deleted")
    # A name that no column of the caller's should have, as `doc` may be one.
    whole = docs.drop("deleted").withColumn("__line_dedup_doc", _doc(text, key))
    # By shuffle at any size: what is deleted grows with the corpus.
    joined = whole.join(gone.withColumnRenamed("doc", "__line_dedup_doc").hint("merge"), "__line_dedup_doc", "left")
    return joined.withColumn(text, F.when(F.col("deleted").isNull(), F.col(text)).otherwise(_without(F.col(text)))).select(
        *[c for c in docs.columns if c != "deleted"],
        F.coalesce("deleted", F.array().cast(gone.schema["deleted"].dataType)).alias("deleted"),
    )


def _without(text: Column) -> Column:
    """The lines of the text that lie between the runs of `deleted`."""
    deleted = F.col("deleted")
    end = lambda x: F.coalesce(x["at"] + x["n"], F.lit(0))

    def kept(lines: Column) -> Column:
        rest = F.struct(F.size(lines).alias("at"), F.lit(0).alias("n"))
        gaps = F.concat(deleted, F.array(rest))
        return F.array_join(
            F.flatten(
                let(gaps, lambda g: F.transform(g, lambda x, i: F.slice(lines, end(F.get(g, i - 1)) + 1, x["at"] - end(F.get(g, i - 1)))))
            ),
            "\n",
        )

    return let(F.split(text, "\n", -1), kept)
