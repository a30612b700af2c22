"""Secrets in texts, told apart by who owns them across the corpus.

Candidates are the matches of three base patterns and, beside them, long mixed tokens. All candidates
are hashed and counted by the distinct repositories and owners they occur in: one that many owners
hold is a copied example, one that a single owner holds in few places looks live. Base spans are
always reported; a long mixed token is added, as kind `owned`, only if it belongs to one owner.

Spans are code points, end exclusive, leftmost and without overlap per kind. Distinct holders are
counted in two steps, (value, owner, repository) first, so a value that stands in a third of all
documents is summed before it meets; its rows are joined back as a skewed join that Spark splits.
Only hashes of candidates leave the task that read a text.

Defined results: a null text is empty and has no spans. A null owner or repository is an owner or
repository of its own. Rows are judged one by one, so repeated ids and texts each give a row. An empty
table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashline.llm.common import let, settled

# The base patterns by kind in their order, the group that holds the secret, and the
# least length of that group. A run of 18 characters starts where a longer search for it would.
BASE = {
    "assign": (
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
# Long tokens of a kind that a key generator makes.
MIXED = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = [*BASE, "owned"]

# Owners from which on a candidate is a copied example.
SHARED_OWNERS = 3


def _matches(text: Column, pattern: str, group: int, least: int, kind: str) -> Column:
    """Array of (start, kind number, end, hash) of the matches whose group has the least length."""

    def located(pieces: Column, found: Column, values: Column) -> Column:
        # Text between matches and matches alternate, so their lengths add up to the places.
        starts = F.aggregate(
            F.transform(found, lambda m, i: F.struct(F.length(F.get(pieces, i)).alias("gap"), F.length(m).alias("own"))),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
            lambda s, x: F.struct(
                (s["at"] + x["gap"] + x["own"]).alias("at"),
                F.concat(s["starts"], F.array(s["at"] + x["gap"])).alias("starts"),
            ),
            lambda s: s["starts"],
        )
        spans = let(starts, lambda at: F.transform(found, lambda m, i: F.struct(
            F.get(at, i).alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            (F.get(at, i) + F.length(m)).alias("end"),
            F.md5(F.get(values, i)).alias("hash"),
            F.length(F.get(values, i)).alias("size"),
        )))
        return F.filter(spans, lambda x: x["size"] >= least)

    regex = F.lit(pattern)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    values = F.regexp_extract_all(text, regex, F.lit(group))
    all_of = let(F.split(text, pattern, -1), lambda p: let(found, lambda f: let(values, lambda v: located(p, f, v))))
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,hash:string,size:int>>")
    return F.when(F.rlike(text, regex), all_of).otherwise(nothing)


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents without the text but with `base` and `mixed`: arrays of (start, kind, end, hash, size)."""
    whole = F.coalesce(docs[text], F.lit(""))
    base = F.sort_array(F.concat(*[_matches(whole, *args, kind) for kind, args in BASE.items()]))
    # Mixed: a whole run of token characters with a digit and a letter in it.
    tokens = rf"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z]){MIXED}"
    mixed = _matches(whole, tokens, 0, 20, "owned")
    found = docs.withColumns({"base": base, "mixed": mixed}).drop(text)
    apart = lambda x: ~F.exists("base", lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"]))
    return found.withColumn("mixed", F.filter("mixed", apart))


def holders(found: DataFrame) -> DataFrame:
    """Per candidate hash: distinct owners and repositories. `found` has hash, owner, repository."""
    each = found.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = each.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash").agg(
        F.count("*").alias("n_owners"), F.sum("repositories").alias("n_repositories"), F.sum("n").alias("n_places")
    )


def _named(span: Column) -> Column:
    kind = F.get(F.array(*[F.lit(k) for k in KINDS]), span["kind"])
    return F.concat_ws(":", kind, span["start"].cast("string"), span["end"].cast("string"))


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: the base spans, all spans, and how many are live-looking or shared examples."""
    chosen = docs.select("doc_id", docs[owner].alias("owner"), docs[repository].alias("repository"), text)
    # The row number is stored with the spans, so it is the same whenever it is read.
    found = settled(candidates(chosen, text).withColumn("row", F.monotonically_increasing_id()), "candidates")
    spans = found.select("row", "owner", "repository", F.explode(F.concat("base", "mixed")).alias("span"))
    flat = spans.select("row", "owner", "repository", F.col("span.hash").alias("hash"), "span")
    counted = settled(holders(flat), "holders")
    known = flat.select("row", "hash", "span").join(counted, "hash")
    kept = known.filter((F.col("span.kind") < len(BASE)) | (F.col("n_owners") == 1))
    live = (F.col("n_owners") == 1) & (F.col("n_repositories") <= 2)
    of_row = kept.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("span.start", "span.kind", "span.end"))).alias("spans"),
        F.sum(live.cast("long")).alias("n_live"),
        F.sum((F.col("n_owners") >= SHARED_OWNERS).cast("long")).alias("n_shared"),
    )
    none = F.lit(0).cast("long")
    return found.join(of_row, "row", "left").select(
        "doc_id",
        "base",
        F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,end:int>>")).alias("spans"),
        F.coalesce("n_live", none).alias("n_live"),
        F.coalesce("n_shared", none).alias("n_shared"),
    )


def digest(scanned: DataFrame) -> DataFrame:
    """The counts, the hash of the base spans and the list of all spans per document of `scan`."""
    listed = lambda spans: F.concat_ws(",", F.transform(spans, _named))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(kind))).cast("long")
    return scanned.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        "n_live",
        "n_shared",
    )
