"""Quality rules as a bitmask ledger: every rule is evaluated once, policies are masks over the bits.

`ledger` stores, per document, the measurements and one bit for each rule it fails. A policy is a
versioned set of rules, so applying a new one, or asking what a policy would keep without one of its
rules, reads the ledger and never the texts again.

Defined results: a null or blank text has no words, so all measurements are 0 and `few_words` fails.
Documents with the same id or text are judged row by row. Very long texts cost n log n. All other
columns are left alone, and a column named like a measurement is kept, as the measurements live in the
struct `quality`; only a column of that name is replaced. An empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashline.llm.common import WHITE, let, settled, white_words

SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Rules in the order of their bits, which versions keep: append, never reorder.
RULES: dict[str, Callable[[Column], Column]] = {
    "few_words": lambda m: m["n_words"] < 10,
    "repeated_words": lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"],
    "symbols": lambda m: 100 * m["n_symbols"] > 10 * m["word_chars"],
    "duplicate_lines": lambda m: 100 * m["n_dup_lines"] > 50 * m["n_lines"],
    "shouting": lambda m: 100 * m["n_marks"] > 15 * m["word_chars"],
    "long_words": lambda m: m["word_chars"] > 40 * m["n_words"],
}


@dataclass(frozen=True)
class Policy:
    """A version and the rules it rejects documents for."""

    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(rule) for rule in self.rules)


BASE = Policy(1, ("few_words", "repeated_words"))
STANDARD = Policy(2, tuple(RULES))


def _repeat_words(words: Column) -> Column:
    """Words in five-word windows that occur twice or more in the text."""

    def windows(hashes: Column) -> Column:
        last = F.size(hashes) - WINDOW
        return F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])
        )

    def repeated(found: Column) -> Column:
        by_hash = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return let(by_hash, lambda s: F.sort_array(F.filter(F.transform(s, lambda x, i: _twin(s, x, i)), F.isnotnull)))

    def _twin(s: Column, x: Column, i: Column) -> Column:
        same = [F.coalesce(F.get(s, i + k)["h"] == x["h"], F.lit(False)) for k in (-1, 1)]
        return F.when(same[0] | same[1], x["at"])

    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.transform(starts, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - at, F.lit(WINDOW)))),
            F.lit(0),
            lambda total, more: total + more,
        )

    def counted(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) < F.size(found), let(repeated(found), covered)).otherwise(0)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) >= WINDOW, let(let(hashes, windows), counted)).otherwise(0)


def measurements(text: Column) -> Column:
    """All measurements of a text as one struct of longs."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.translate(line, WHITE, "")) > 0)

    def without(characters: str) -> Column:
        return F.length(text) - F.length(F.translate(text, characters, ""))

    def of(words: Column, lines: Column) -> Column:
        fields = {
            "n_words": F.size(words),
            "word_chars": F.length(F.translate(text, WHITE, "")),
            "n_symbols": without(SYMBOLS),
            "n_marks": without("!?"),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": _repeat_words(words),
        }
        return F.struct(*[value.cast("long").alias(name) for name, value in fields.items()])

    return let(white_words(text), lambda words: let(lines, lambda l: of(words, l)))


def _bits(measured: Column) -> Column:
    failed = [F.when(rule(measured), F.lit(1 << n)).otherwise(0) for n, rule in enumerate(RULES.values())]
    return reduce(lambda a, b: a.bitwiseOR(b), failed).cast("long")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with `quality`: the measurements, and `failed`, a bit for each rule of `RULES`."""
    measured = let(measurements(docs[text]), lambda m: F.struct(m.alias("measured"), _bits(m).alias("failed")))
    return docs.withColumn("quality", measured)


def stored(judged: DataFrame, key: str = "doc_id") -> DataFrame:
    """The ledger alone, written once and read from there: id, measurements and bits, without texts.

    Any policy is then a mask over the stored bits, and no text is looked at again.
    """
    return settled(judged.select(key, "quality"), "ledger")


def passes(policy: Policy, failed: Column) -> Column:
    return failed.bitwiseAND(F.lit(policy.mask)) == 0


def ablations(judged: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents failing it, failing only it, and kept without it.

    Documents are counted by bits first, at most two to the number of rules of them.
    """
    failed = judged["quality.failed"].bitwiseAND(F.lit(policy.mask))
    counts = judged.groupBy(failed.alias("failed")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << list(RULES).index(r)).cast("long").alias("bit")) for r in policy.rules]))
    each = counts.select("failed", "n", rules.alias("r")).select("failed", "n", "r.*")
    has = F.col("failed").bitwiseAND(F.col("bit")) != 0
    rest = F.col("failed").bitwiseAND(F.bitwise_not("bit")) == 0
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    return each.groupBy("rule").agg(
        total(has).alias("n_failed"), total(has & rest).alias("n_only"), total(rest).alias("n_kept_without")
    )
