"""The operators on texts against plain versions, over messy, repeated and empty tables."""

import sys
from collections import Counter
from pathlib import Path

import hashlib
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
from messy import DOCUMENTS, documents, prose, repeated  # noqa: E402

from cashline.llm import backoff_lm, components, decontamination, line_dedup, minmax_dedup, quality_rules, secret_scan  # noqa: E402

IN_ORDER = lambda r: (r[0] is not None, r[0])


@pytest.fixture(scope="module", params=["documents", "repeated", "empty"])
def rows(request):
    return {"documents": documents(), "repeated": repeated(), "empty": []}[request.param]


@pytest.fixture
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS)


def texts(*pairs):
    return [(k, t, *[None] * 9) for k, t in pairs]


# Quality rules


def test_measurements(docs, rows):
    found = quality_rules.ledger(docs)
    assert [f.name for f in found.schema][: len(docs.columns)] == docs.columns[:]
    got = Counter((r.doc_id, *r.quality.measured) for r in found.collect())
    assert got == Counter((r[0], *brute.measured(r[1])) for r in rows)


def test_ablations(spark):
    rows = documents()
    judged = quality_rules.ledger(spark.createDataFrame(rows, DOCUMENTS))
    failed = [r.quality.failed for r in judged.collect()]
    for policy in (quality_rules.BASE, quality_rules.STANDARD):
        names = list(quality_rules.RULES)
        for r in quality_rules.ablations(judged, policy).collect():
            bit = 1 << names.index(r.rule)
            rest = policy.mask & ~bit
            assert r.n_failed == sum(bool(f & bit) for f in failed)
            assert r.n_only == sum(bool(f & bit) and not f & rest for f in failed)
            assert r.n_kept_without == sum(not f & rest for f in failed)


def test_clean_prose_passes(spark):
    docs = spark.createDataFrame(texts((1, prose(3, 12)), (2, prose(4, 5000))), DOCUMENTS)
    assert docs.count() == quality_rules.ledger(docs).filter("quality.failed = 0").count()


# Line dedup


def test_line_dedup(docs, rows):
    by_id = dict(sorted({r[0]: r[1] for r in rows}.items(), key=IN_ORDER))
    expected = brute.deduplicated(by_id)
    found = line_dedup.dedup_lines(docs)
    assert found.columns == [c for c in docs.columns if c != "deleted"] + ["deleted"]
    assert Counter((r.doc_id, r.text) for r in found.collect()) == Counter((r[0], expected[r[0]]) for r in rows)


def test_runs_of_many_lines_blank_lines_and_overlaps(spark):
    run = "\n".join(f"l{i} a b c d" for i in range(40))
    cases = {
        1: run,
        2: "own\n" + run + "\nend",
        3: "\n".join(run.split("\n")[5:30]),
        4: "\n\n".join(run.split("\n")[:20]),
        5: "\n\n".join(run.split("\n")[:20]) + "\n\n\nx",
        6: "\n".join(["s " * 20] * 9),
        7: "\n".join(["s " * 20] * 4) + "\nother",
        8: "\n".join(["p " * 60, "q", "p " * 60]),
        9: "l1 a b c d\nl2 a b c d",
    }
    found = line_dedup.dedup_lines(spark.createDataFrame(texts(*cases.items()), DOCUMENTS)).collect()
    assert {r.doc_id: r.text for r in found} == brute.deduplicated(cases)


def test_suffix_ranks_are_the_order_of_suffixes(spark):
    lines = {1: [3, 1, 2, 1, 2, 3], 2: [1, 2, 1, 2], 3: [2, 1, 2, 3]}
    rows = [(d, i, x) for d, own in lines.items() for i, x in enumerate(own)]
    levels = line_dedup.suffix_ranks(spark.createDataFrame(rows, "doc long, at int, rank long"))
    for k, level in enumerate(levels):
        found = {(r.doc, r["at"]): r["rank"] for r in level.collect()}
        runs = {(d, i): lines[d][i : i + 2**k] for d, i, _ in rows if i + 2**k <= len(lines[d])}
        times = Counter(map(tuple, runs.values()))
        assert set(found) == {p for p, run in runs.items() if k == 0 or times[tuple(run)] > 1}
        for p in found:
            for q in found:
                assert (found[p] < found[q]) == (runs[p] < runs[q])


# Decontamination


@pytest.mark.parametrize("most", [200_000, 0])
def test_contamination(spark, rows, most, monkeypatch):
    items = [
        (1, prose(9, 60, 60)),
        (2, " ".join(prose(1, 150).split()[20:45])),
        (3, "One, TWO three!"),
        (33, "one"),
        (4, ""),
        (5, None),
        (6, "nowhere to be found at all in any of these texts here"),
        (7, "été  AKIA0"),
        (7, "AKIA0 api"),
    ]
    own = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, words string")
    docs = spark.createDataFrame(rows, DOCUMENTS)
    occurrences = decontamination.occurrences
    monkeypatch.setattr(decontamination, "occurrences", lambda d, i, n: occurrences(d, i, n, most))
    found = Counter(tuple(r) for r in decontamination.contamination(docs, own).collect())
    expected = Counter()
    for r in rows:
        n, hit, ids = brute.contamination(r[1], items)
        expected[(r[0], n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0)] += 1
    assert found == expected


def test_an_empty_benchmark_hits_nothing(spark):
    docs = spark.createDataFrame(documents(), DOCUMENTS)
    items = spark.createDataFrame([(1, None), (2, "...")], "item_id long, text string")
    found = decontamination.contamination(docs, items)
    assert found.count() == len(documents()) and not found.filter("contaminated or n_items > 0").count()


@pytest.mark.parametrize("most", [200_000, 0])
def test_items_without_an_id_hit(spark, most, monkeypatch):
    own, shared = (" ".join(f"{letter}{k}" for k in range(12)) for letter in "ab")
    rows = [(1, f"before {own} after"), (2, f"{shared}\n{own}"), (3, f"{shared} end"), (4, "nothing here"), (None, own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(None, own), (None, shared), (8, shared)], "item_id long, text string")
    occurrences = decontamination.occurrences
    monkeypatch.setattr(decontamination, "occurrences", lambda d, i, n: occurrences(d, i, n, most))
    found = {r.doc_id: r for r in decontamination.contamination(docs, items).collect()}
    assert {k: (r.n_hit, r.n_items, r.contaminated) for k, r in found.items()} == {
        1: (12, 0, True), 2: (24, 1, True), 3: (12, 1, True), 4: (0, 0, False), None: (12, 0, True)
    }
    assert found[1].items_sha256 == hashlib.sha256(b"").hexdigest() and found[2].items_sha256 == hashlib.sha256(b"8").hexdigest()


# Secrets


def test_secrets(docs, rows):
    found = secret_scan.digest(secret_scan.scan(docs)).collect()
    got = Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in found)
    expected = brute.secrets([(r[0], r[3], r[1]) for r in rows])
    assert got == Counter((r[0], *e) for r, e in zip(rows, expected))


def test_shared_examples_and_live_keys_are_told_apart(spark):
    example, live = "token=EXAMPLEEXAMPLE123", "key Zq81mfk3Lp0Tt5Vb9Xc2"
    many = [(k, f"see {example} here", "en", f"s{k}") for k in range(5)]
    one = [(9, f"my {live} and secret: own-own-own-own", "en", "s9")]
    kept = [(10, "key Aa11bb22Cc33dd44Ee55", "en", "s1"), (11, "key Aa11bb22Cc33dd44Ee55", "en", "s2")]
    docs = spark.createDataFrame(many + one + kept, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in secret_scan.digest(secret_scan.scan(docs)).collect()}
    assert [(found[k].n_shared, found[k].n_live) for k in (0, 9)] == [(1, 0), (0, 2)]
    assert found[9].spans == "owned:7:27,assign:32:55" and found[10].spans == found[11].spans == ""


def test_line_dedup_leaves_a_column_of_its_inner_name(spark):
    rows = [(1, prose(1, 150), "mine"), (2, prose(1, 150), "yours"), (3, None, None)]
    left = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, doc string"))
    assert sorted((r.doc_id, r.doc) for r in left.collect()) == [(1, "mine"), (2, "yours"), (3, None)]
    assert left.schema["doc"].dataType.simpleString() == "string"


# Near duplicates


def test_near_duplicates(docs, rows):
    found = minmax_dedup.near_duplicates(docs).collect()
    expected = brute.near_groups([(r[0], r[1]) for r in rows])
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter(
        (r[0], *e) for r, e in zip(rows, expected)
    )
    assert all(r.kept == (r.doc_id == r.component_id) for r in found if r.doc_id is not None or r.component_id is not None)


def test_rows_without_an_id_are_linked(spark):
    words = [f"w{n}" for n in range(100)]
    near = lambda n, base=words: " ".join([*base[:n], "new", *base[n + 1 :]])
    other = [f"v{n}" for n in range(100)]
    rows = [(None, near(10)), (None, near(50)), (7, near(90)), (9, "x y"), (None, "x  y")]
    rows += [(None, near(3, other)), (None, near(3, other)), (None, near(60, other)), (None, None), (None, "")]
    found = minmax_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.component_id) for r in found) == {(7, 7): 1, (None, 7): 2, (9, 9): 1, (None, 9): 1, (None, None): 5}
    assert [r.doc_id for r in found if r.kept and r.doc_id] in ([7, 9], [9, 7])
    assert not any(r.kept for r in found if r.doc_id is None and r.component_id)
    assert Counter(r.n_shingles for r in found if r.kept and r.doc_id is None) == {96: 1, 0: 2}


def test_families_with_many_near_misses(spark):
    import random

    r = random.Random(5)
    base = [f"w{i}" for i in range(150)]

    def variant(k):
        own = list(base)
        for _ in range(k):
            own[r.randrange(len(own))] = f"v{r.randrange(4000)}"
        return " ".join(own[r.choice([0, 0, 0, 5, 20]) :])

    other = [f"u{i}" for i in range(60)]
    rows = [(1000 + i, variant(r.choice([1, 2, 4, 5, 6, 8, 12]))) for i in range(150)]
    rows += [(5, " ".join(other)), (6, " ".join(other[:52])), (7, " ".join(other[8:])), (8, " ".join(base))]
    found = minmax_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in found.collect()}
    assert got == {k: e for (k, _), e in zip(rows, brute.near_groups(rows))}


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (205, 203), (203, 201), (205, 201)]
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    expected = {i: 0 for i in range(1, 31)} | {100 + i: 100 for i in range(1, 20)} | {205: 201, 203: 201}
    assert {r.node: r.component for r in found.collect()} == expected
    assert components.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


# Language model


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_scores(docs, rows, order, monkeypatch):
    monkeypatch.setattr(backoff_lm, "BLOCK_WORDS", 200)
    found = backoff_lm.score(docs, order).collect()
    expected = brute.backoff([r[1] for r in rows], order)
    key = lambda x: (x[0] is not None, x[0], x[2])
    got = sorted(((r.doc_id, r.n_words, r.log_score) for r in found), key=key)
    want = sorted(((r[0], len(brute.white_words(r[1])), e) for r, e in zip(rows, expected)), key=key)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-9, abs=1e-9)
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in found)


def test_scores_grow_with_what_the_corpus_holds(spark):
    rows = texts((1, "a b c d"), (2, "a b c d"), (3, "a b c d"), (4, "q r s t"))
    found = {r.doc_id: r.log_score for r in backoff_lm.score(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert found[1] == found[2] > found[4]


@pytest.mark.parametrize("values", [[], [0], [1, 1, 1], [1, 2**63, 1, 300], [7] * 5000])
def test_numbers_and_counts_are_unpacked_as_they_were(values):
    values = np.array(values, np.uint64)
    assert (backoff_lm._unpacked(backoff_lm._packed(values)) == values).all()
    counts = np.maximum(values, 1)
    found = backoff_lm._unpacked_counts(backoff_lm._packed_counts(counts))
    assert len(found) == len(counts) and (found == counts).all()


def test_totals_reach_every_place_of_their_gram_without_a_search(monkeypatch):
    grams = [np.array(g, np.uint64) for g in ([7, 2**64 - 1, 7, 5], [0, 9, 2**63, 9], [0, 0, 5, 0])]
    monkeypatch.setattr(np, "searchsorted", None)
    found = backoff_lm._spread(grams, np.array([50.0, 70.0, 90.0, 1.0, 2.0]))
    assert [g.tolist() for g in found] == [[70, 2, 70, 50], [0, 90, 1, 90], [0, 0, 50, 0]]
    assert [len(g) for g in backoff_lm._spread([np.zeros(0, np.uint64)] * 3, np.zeros(0))] == [0, 0, 0]
