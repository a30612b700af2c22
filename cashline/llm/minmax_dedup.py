"""Near duplicates by min-max hashing: each permutation gives a signature its least and its greatest value.

The least and the greatest shingle under one permutation are both uniform samples of a union of two
sets, and nearly independent, so `HASHES` hash evaluations per shingle give a signature of twice as
many values. `BANDS` bands of `ROWS` values propose candidates; a pair at a similarity of exactly 0.75
shares no band with a chance of (1 - 0.75^5)^40, about 2 in 100,000. Every proposed link is
confirmed on the full sets of 64-bit shingle hashes.

Equal sets are one class by a 128-bit hash of the set, of which only the member with the least id goes
on. In a bucket of a band, members are compared with one centre and not with each other. That suffices
where all members turn out connected. Buckets of three or more that hold several components make up
families (what such buckets chain together), and there the links that are still missing are found
exactly, without comparing all members of a family with each other:

1. A token is common if it is in a quarter of the family or more. All members are compared with the one
   that has the most common tokens, which joins what is near to the family's core.
2. Of the pairs of different components that are left, a linked one either shares a token that is not
   common within its prefixes (the first n - ceil(0.75 n) + 1 tokens, the rarest first), or shares
   only common ones, and then both have as many of these as must be shared. Both kinds are found by
   joins, on the token and on the size, and confirmed.

Texts are hashed once; the sets themselves are rebuilt only for documents with a candidate. Hot keys
(a third of all rows in one class, bucket or star) are summed before they are shuffled or joined as
skewed joins. All numbers come from fixed seeds, so a task that runs again gives the same rows.

Defined results: a null or blank text has the empty set, is linked with nothing and is kept. Rows that
repeat an id are linked, also where their texts differ; the least of these is then compared with others.
`kept` holds for each row whose id is the component's least. Ids are whole numbers. Rows without an id are
documents like others and are linked like them; their own id and that of a component without any id are
null, and of such a component one row is kept. An empty table gives an empty one. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cashline.llm.common import settled
from cashline.llm.components import components
from cashline.llm.shingles import mixed, shingle_hashes

HASHES, ROWS = 100, 5
BANDS = 2 * HASHES // ROWS
PERCENT = 75
COMMON_PART = 4

_random = np.random.default_rng(19970613)
_FACTORS = _random.integers(0, 2**31, (HASHES, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADDENDS = _random.integers(0, 2**32, (HASHES, 1), dtype=np.uint32)
_COLUMNS = _random.integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = _random.integers(0, 2**63, BANDS, dtype=np.uint64)
_AT_ONCE = 4096


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least and the greatest value under each permutation, 2 x HASHES 32-bit numbers."""
    points = (hashes >> np.uint64(32)).astype(np.uint32)
    least = greatest = None
    for at in range(0, len(points), _AT_ONCE):
        values = points[at : at + _AT_ONCE] * _FACTORS + _ADDENDS
        low, high = values.min(axis=1), values.max(axis=1)
        least = low if least is None else np.minimum(least, low)
        greatest = high if greatest is None else np.maximum(greatest, high)
    return np.concatenate((least, greatest))


def bands(signed: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, with the band's number mixed in."""
    # Least and greatest of one permutation go to different bands.
    return mixed((signed.reshape(BANDS, ROWS).astype(np.uint64) * _COLUMNS).sum(axis=1, dtype=np.uint64) ^ _SALTS)


def _texts(column: pa.Array) -> list[bytes]:
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, keys = [], [], []
        for hashes in shingle_hashes(_texts(batch.column("text"))):
            own = np.unique(hashes)
            sizes.append(len(own))
            halves = [mixed(own ^ np.uint64(salt)).sum(dtype=np.uint64) for salt in (0x51ED, 0xC0FFEE)]
            digests.append(np.array(halves, "<u8").tobytes() if len(own) else None)
            keys.append(bands(signature(own)).view(np.int64) if len(own) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "digest", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [np.unique(h).view(np.int64) for h in shingle_hashes(_texts(batch.column("text")))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(own, pa.list_(pa.int64()))], ["doc_id", "shingles"]
        )


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set and the keys of its bands, for `docs` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles bigint, digest binary, bands array<bigint>"
    return docs.select("doc_id", "text").mapInArrow(_sketch, schema)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id and its distinct shingle hashes, one row per id."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_sets, f"doc_id {kind}, shingles array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets share PERCENT of their union."""
    left, right = (sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"{x}_set")) for x in "ab")
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - F.col("shared")
    return both.withColumn("shared", shared).filter(100 * F.col("shared") >= PERCENT * union).select("a", "b")


def _components(placed: DataFrame, links: DataFrame) -> DataFrame:
    """`placed` with the component of each `rep` under `links`; a rep without links is its own."""
    node = settled(components(links), "components").select(F.col("node").alias("rep"), F.col("component").alias("least"))
    found = placed.join(node, "rep", "left")
    return found.withColumn("component", F.coalesce("least", "rep")).drop("least")


def _families(mixed: DataFrame) -> DataFrame:
    """rep, size, component and family of the members of mixed buckets: what buckets chain together."""
    docs = mixed.select("rep", "size", "component").distinct()
    node = settled(components(mixed.select(F.col("centre").alias("a"), F.col("rep").alias("b"))), "families")
    family = node.select(F.col("node").alias("rep"), F.col("component").alias("family"))
    docs = docs.join(family, "rep", "left").withColumn("family", F.coalesce("family", "rep"))
    return settled(docs, "family-members")


def _ranked_tokens(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Every token of the families with its count in the family and whether it is common there."""
    chosen = sets.select(F.col("doc_id").alias("rep"), "shingles").join(docs.select("rep", "family"), "rep")
    tokens = settled(chosen.select("rep", "family", F.explode("shingles").alias("token")), "tokens")
    counts = tokens.groupBy("family", "token").agg(F.count("*").alias("n"))
    sizes = docs.groupBy("family").agg(F.count("*").alias("members"))
    counts = settled(counts.filter("n > 1").join(sizes, "family"), "token-counts")
    common = COMMON_PART * F.col("n") >= F.col("members")
    ranked = tokens.join(counts, ["family", "token"], "left")
    return settled(
        ranked.select("rep", "family", "token", F.coalesce("n", F.lit(1)).alias("n"), F.coalesce(common, F.lit(False)).alias("common")),
        "ranked-tokens",
    )


def _overlap(size: Column, other: Column) -> Column:
    """The least intersection of sets of these sizes that are linked."""
    return F.ceil(PERCENT * (size + other) / (100 + PERCENT))


def _apart(docs: DataFrame, mark: str) -> DataFrame:
    return docs.select("family", *[F.col(c).alias(f"{mark}_{c}") for c in ("rep", "component", "size", "shared")])


def _fits(*more: Column) -> Column:
    size, other = F.col("x_size"), F.col("y_size")
    fits = (F.col("x_component") != F.col("y_component")) & (100 * F.least(size, other) >= PERCENT * F.greatest(size, other))
    for condition in more:
        fits &= condition
    return fits


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("x_rep", "y_rep").alias("a"), F.greatest("x_rep", "y_rep").alias("b"))


def _exact_pairs(docs: DataFrame, tokens: DataFrame) -> DataFrame:
    """All pairs of different components of a family that can be linked; `docs` has the common tokens' number.

    Tokens are ordered: those not common by their counts, then the common ones. Of a linked pair the
    first shared token is in both prefixes. If it is not common, the join on such tokens finds the pair.
    If it is, then all shared tokens are, and neither document has fewer common tokens than must be
    shared; such pairs are found by family and size.
    """
    place = F.row_number().over(Window.partitionBy("rep").orderBy("common", "n", "token"))
    prefix = F.col("size") - F.ceil(F.col("size") * PERCENT / 100) + 1
    first = tokens.withColumn("place", place).filter("not common and n > 1").join(docs.drop("family"), "rep")
    first = settled(first.filter(F.col("place") <= prefix), "prefixes")
    x, y = (_apart(first.withColumn("family", F.struct("family", "token")), mark) for mark in "xy")
    by_token = _pairs(x.join(y, "family").filter(_fits(F.col("x_rep") < F.col("y_rep"))))

    able = docs.filter(F.col("shared") >= F.ceil(F.col("size") * PERCENT / 100))
    able = settled(able, "able")
    sizes = able.select("family", F.col("size").alias("y_size")).distinct()
    x = _apart(able, "x")
    reach = x.join(sizes, "family").filter(
        (F.col("x_shared") >= _overlap(F.col("x_size"), F.col("y_size")))
        & (100 * F.least("x_size", "y_size") >= PERCENT * F.greatest("x_size", "y_size"))
    )
    y_fits = F.col("y_shared") >= _overlap(F.col("x_size"), F.col("y_size"))
    by_size = _pairs(reach.join(_apart(able, "y"), ["family", "y_size"]).filter(_fits(F.col("x_rep") < F.col("y_rep"), y_fits)))
    return settled(by_token.union(by_size).distinct(), "exact-pairs")


def _links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """All links (a, b) that components need between `members` (band, rep, size, centre)."""
    ids = members.select(F.col("rep").alias("doc_id")).distinct()
    wanted = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    # Rows of one id may differ in text: the least speaks for the id, whichever task sees it first.
    one = wanted.groupBy("doc_id").agg(F.min("text").alias("text"))
    sets = settled(shingle_sets(one), "sets")
    stars = members.filter("rep != centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    links = settled(confirmed(settled(stars, "stars"), sets), "confirmed")

    placed = settled(_components(members, links), "placed")
    ends = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    # In a bucket of two, the one pair has been looked at.
    open_bands = settled(ends.filter("low != high and n > 2").select("band"), "mixed-buckets")
    mixed = settled(placed.join(open_bands, "band"), "mixed-members")
    if mixed.isEmpty():
        return links

    family = _families(mixed)
    tokens = _ranked_tokens(family, sets)
    shared = tokens.groupBy("rep").agg(F.sum(F.col("common").cast("long")).alias("shared"))
    family = settled(family.join(shared, "rep"), "family-shared")
    best = family.groupBy("family").agg(F.min(F.struct(-F.col("shared"), F.col("rep"), F.col("component"))).alias("c"))
    best = settled(best.select("family", F.col("c.rep").alias("a"), F.col("c.component").alias("own")), "best")
    near = family.filter(F.col("shared") > 0).join(best, "family").filter("component != own")
    stars = settled(near.select("a", F.col("rep").alias("b")), "best-stars")
    links = links.union(settled(confirmed(stars, sets), "best-confirmed"))
    family = settled(_components(family.drop("component"), links), "family-components")
    return links.union(settled(confirmed(_exact_pairs(family, tokens), sets), "exact-confirmed"))


def with_numbers(docs: DataFrame, number: str) -> DataFrame:
    """`docs` with a column `number`: the id, or for rows without one a number of its own above all ids."""
    unnamed = docs.filter("doc_id is null")
    if unnamed.isEmpty():
        return docs.withColumn(number, F.col("doc_id"))
    top = F.lit((docs.agg(F.max("doc_id")).first()[0] or 0) + 1)
    numbered = settled(unnamed.withColumn(number, top + F.monotonically_increasing_id()), "unnamed")
    named = docs.filter("doc_id is not null")
    return named.withColumn(number, F.col("doc_id").cast("long")).union(numbered)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of `docs` (doc_id, text)."""
    numbered = with_numbers(docs.select("doc_id", "text"), "number")
    found = _near_duplicates(numbered.select(F.col("number").alias("doc_id"), "text"))
    top = docs.agg(F.max("doc_id")).first()[0]
    named = lambda c: F.when(F.col(c) <= F.lit(top), F.col(c)).alias(c)
    return found.select(named("doc_id"), "n_shingles", named("component_id"), "kept")


def _near_duplicates(docs: DataFrame) -> DataFrame:
    """The same where every row has an id."""
    sketched = settled(sketches(docs), "sketches")
    classes = sketched.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("n_shingles").alias("size")
    )
    classes = settled(classes, "classes")
    keyed = classes.select("rep", "size", F.explode("bands").alias("band"))
    buckets = keyed.groupBy("band").agg(F.min("rep").alias("centre"), F.count("*").alias("n"))
    buckets = settled(buckets.filter("n > 1").select("band", "centre"), "buckets")
    members = settled(keyed.join(buckets, "band"), "members")
    rep = classes.select("digest", "rep")
    if members.isEmpty():
        rep = rep.select("digest", F.col("rep").alias("component"))
    else:
        rep = _components(rep, _links(docs, members))
    of_class = settled(rep.select("digest", F.col("component").alias("component_id")), "class-components")
    return sketched.join(of_class, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        (F.coalesce("component_id", "doc_id") == F.col("doc_id")).alias("kept"),
    )
