"""Benchmark passages in documents, found by a prefix-filtered set join on word shingles.

An item's text is cut into windows of consecutive words; a document contains a window when the same
words stand in a row in it. As containment must be whole, the prefix of a window is one shingle: the
rarest by its count over all documents, so the join touches few places of few documents. A shared
shingle fixes where the window would have to stand (positional bound: not before the first word) and
end (length bound: not after the last); then the words of that place are compared.

The corpus is read once to count the benchmark's shingles and once to join; its texts are never
shuffled while the benchmark's windows fit a broadcast (`most_broadcast` windows, a window being a
few hundred bytes). A larger benchmark is joined by shuffling (document, place, shingle) and only
then fetching the words of the documents left. Both ways give the same rows.

Defined results: a null text has no words and nothing in it is hit. An item without words has no
window. A repeated item id counts once per document. An item with a null id hits like any other, in n_hit
and contaminated; n_items and items_sha256 are of ids that are not null, as in the SQL. Repeated documents are judged row by row as long
as their ids differ; rows of one id get the union of their hits. An empty benchmark hits nothing.
Other columns of either table are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cashline.llm.common import ascii_lower, join_by_id, settled, split_words

WINDOW = 10
SHINGLE = 3


def text_words(text: Column) -> Column:
    """Words of ASCII letters, digits and all other than ASCII characters, A-Z lower-cased."""
    return split_words(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The distinct windows of each item: its id and the words. A shorter item is one window."""
    words = items.select("item_id", text_words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (size - 1)))
    each = words.select("item_id", "words", F.explode(starts).alias("at"))
    return each.select("item_id", F.slice("words", F.col("at"), size).alias("window")).distinct()


def _shingles(words: Column, size: int) -> Column:
    """Hashes of the runs of `size` words, in order; none where there are fewer words."""

    def run(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(size)])

    last = F.size(words) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), run))


def _placed(docs: DataFrame, size: int) -> DataFrame:
    """Every shingle of `docs` (doc_id, words) with its place."""
    return docs.select("doc_id", "words", F.posexplode(_shingles(F.col("words"), size)).alias("at", "shingle"))


def _counts(docs: DataFrame, wanted: DataFrame, size: int, small: bool) -> DataFrame:
    """How often each of the `wanted` shingles stands in the documents."""
    placed = _placed(docs, size).select("shingle")
    if small:
        return placed.join(F.broadcast(wanted), "shingle").groupBy("shingle").agg(F.count("*").alias("n"))
    # Summed per task first: a frequent shingle is then one row of each task.
    return placed.groupBy("shingle").agg(F.count("*").alias("n")).join(wanted, "shingle")


def _rarest(found: DataFrame, docs: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """Each distinct window with its rarest shingle and the places where that stands in it."""
    distinct = found.groupBy("window").agg(F.collect_set("item_id").alias("items"))
    numbered = distinct.withColumn("size", F.least(F.lit(SHINGLE), F.size("window")))
    by_size = [
        numbered.filter(F.col("size") == n).select(
            "window", "items", "size", F.posexplode(_shingles(F.col("window"), n)).alias("offset", "shingle")
        )
        for n in sizes
    ]
    places = settled(_union(by_size), "window-shingles")
    counts = _union([
        _counts(docs, places.filter(F.col("size") == n).select("shingle").distinct(), n, small).withColumn("size", F.lit(n))
        for n in sizes
    ])
    # Windows with a shingle that no document has drop out here.
    known = places.join(counts, ["shingle", "size"], "left")
    of_window = Window.partitionBy("window")
    ranked = known.withColumn("missing", F.max(F.col("n").isNull()).over(of_window)).filter("not missing")
    first = Window.partitionBy("window").orderBy("n", "shingle", "offset")
    return ranked.withColumn("rank", F.row_number().over(first)).filter("rank = 1").select(
        "window", "items", "size", "offset", "shingle"
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def occurrences(docs: DataFrame, items: DataFrame, size: int = WINDOW, most_broadcast: int = 200_000) -> DataFrame:
    """Where windows of `items` (item_id, text) stand in `docs` (doc_id, text): doc_id, items, at, length."""
    spark = docs.sparkSession
    worded = docs.select("doc_id", text_words(F.col("text")).alias("words"))
    found = settled(windows(items, size), "windows")
    sizes = [r.size for r in found.select(F.least(F.lit(SHINGLE), F.size("window")).alias("size")).distinct().collect()]
    if not sizes:
        nothing = found.schema["item_id"].dataType.simpleString()
        kind = docs.schema["doc_id"].dataType.simpleString()
        return spark.createDataFrame([], f"doc_id {kind}, items array<{nothing}>, at int, length int")
    small = found.count() <= most_broadcast
    anchors = settled(_rarest(found, worded, sorted(sizes), small), "anchors")
    hits = []
    for n in sorted(sizes):
        own = anchors.filter(F.col("size") == n).drop("size")
        placed = _placed(worded, n)
        if small:
            joined = placed.join(F.broadcast(own), "shingle")
        else:
            places = placed.select("doc_id", "at", "shingle").join(own, "shingle")
            joined = join_by_id(places, worded, "inner")
        start = F.col("at") - F.col("offset")
        fits = (start >= 0) & (start + F.size("window") <= F.size("words"))
        same = F.when(fits, F.slice("words", start + 1, F.size("window")) == F.col("window"))
        hits.append(joined.filter(same).select("doc_id", "items", start.alias("at"), F.size("window").alias("length")))
    return _union(hits)


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document id: n_words, n_hit, n_items, items_sha256 and contaminated, over `docs` (doc_id, text)."""
    hits = settled(occurrences(docs, items, size), "occurrences")
    # Overlapping occurrences: a place counts where its first occurrence covers it.
    spans = hits.groupBy("doc_id", "at").agg(F.max("length").alias("length"))
    before = Window.partitionBy("doc_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("length")
    reached = F.greatest(F.col("at"), F.coalesce(F.max(end).over(before), F.lit(0)))
    hit = spans.select("doc_id", F.greatest(F.lit(0), end - reached).alias("new")).groupBy("doc_id").agg(
        F.sum("new").alias("n_hit")
    )
    ids = hits.select("doc_id", F.explode("items").alias("item_id")).groupBy("doc_id").agg(
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")
    )
    words = docs.select("doc_id", F.size(text_words(F.col("text"))).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    item_ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    # Hits of items without an id have no row in `ids`.
    found = join_by_id(hit, ids, "left")
    return join_by_id(words, found, "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(item_ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", item_ids), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
