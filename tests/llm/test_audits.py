"""Divergence of sources, repeated bytes and the audit of filters against plain versions."""

import hashlib
import random
import re
import sys
from collections import Counter, defaultdict
from itertools import permutations
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from messy import DOCUMENTS, documents, prose, repeated  # noqa: E402

from cashline.llm import byte_repeats, divergence, filter_audit  # noqa: E402
from cashline.llm.suffix_arrays import common_prefixes, suffix_array  # noqa: E402


def tables():
    return {"documents": documents(), "repeated": repeated(), "empty": []}


def varied():
    """Documents with few words, in languages and sources of which some are null."""
    r = random.Random(4)
    words = "a b c dd ee FF Gg über ñ x9y it's".split()
    texts = [" ".join(r.choices(words, range(1, 12), k=r.randrange(40))) for _ in range(150)]
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["s1", "s2", "s3", None])) for i, t in enumerate(texts)]
    rows += [(900, None, "fr", "s1"), (901, "lonely", "fr", None), (None, "a b c", None, "s9"), (5, "a a", "en", "s1")]
    return [(*row, len(row[1] or ""), 1, "d", 5, "w", 7, 3) for row in rows]


# Divergence.


def plain_divergence(rows, least):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for row in rows:
        text, lang, source = (x or "" for x in row[1:4])
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(fold))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]

        def priced(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        own = priced(counts[lang, source])
        whole = priced(sum((counts[g] for g in groups if g[0] == lang), Counter()))
        f = lambda p, q: (p - q) ** 2 // (p + q)
        pairs = []
        for other_lang, other in groups:
            if other_lang == lang and other != source:
                theirs = priced(counts[lang, other])
                pairs.append((other, sum(f(own[t], theirs[t]) for t in kept)))
        terms = [(t, f(own[t], whole[t])) for t in kept if counts[lang, source][t] and own[t] > whole[t]]
        for part, items in ("pair", pairs), ("term", terms):
            items = sorted(items, key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, *x, k) for k, x in enumerate(items, 1) if part == "pair" or k <= 10]
    return sorted(out)


@pytest.mark.parametrize("kind, least", [("varied", 10), ("documents", 2), ("repeated", 3), ("documents", 500), ("empty", 10)])
def test_divergence(spark, kind, least):
    rows = varied() if kind == "varied" else tables()[kind]
    found = divergence.divergence(spark.createDataFrame(rows, DOCUMENTS), least).collect()
    assert sorted(map(tuple, found)) == plain_divergence(rows, least)


def test_joint_values_are_exact_over_column_blocks(monkeypatch):
    monkeypatch.setattr(divergence, "COLUMNS", 9)
    r = np.random.default_rng(3)
    counts = r.poisson(r.exponential(3, (200, 1)), (200, 7)) ** 3
    counts[0, 0] = 10**12  # a billion times that needs more than 64 bits
    unders = [int(n) for n in counts.sum(0) + 400]
    found = divergence.joint_values(counts, unders)
    price = lambda g, t: 1 + 10**9 * (int(counts[t, g]) + 2) // unders[g]
    for a in range(7):
        for b in range(a + 1, 7):
            pairs = [(price(a, t), price(b, t)) for t in range(200)]
            assert found[a, b] == sum((p - q) ** 2 // (p + q) for p, q in pairs)


def test_prices_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**13, 10**13, 5)], "n long, total long, kept long")
    assert row.select(divergence.price(row.n, row.total, row.kept)).first()[0] == 1 + 10**9 * (10**13 + 2) // (10**13 + 10)


# Suffix arrays.


@pytest.mark.parametrize("seed", range(30))
def test_suffix_arrays_and_common_prefixes(seed):
    r = random.Random(seed)
    symbols = r.choice([b"a", b"ab", b"abc", bytes(range(256))])
    base = [bytes(r.choices(symbols, k=r.randrange(1, 200))) for _ in range(5)]
    strings = [r.choice(base)[r.randrange(30) :] + r.choice(base) for _ in range(30)] + [b"", b"a"]
    data, sizes = np.frombuffer(b"".join(strings), np.uint8), np.array([*map(len, strings)])
    starts = np.cumsum(sizes) - sizes
    suffixes = sorted((s[i:], k, i) for k, s in enumerate(strings) for i in range(len(s)))
    order = suffix_array(data, sizes)
    assert order.tolist() == [starts[k] + i for _, k, i in suffixes]

    def shared(a, b, most):
        return next((n for n, (x, y) in enumerate(zip(a, b)) if x != y or n == most), min(len(a), len(b), most))

    most = r.choice([3, 20, 1000])
    found = common_prefixes(data, sizes, order, most).tolist()
    assert found == [0] + [shared(a[0], b[0], most) for a, b in zip(suffixes, suffixes[1:])]


def test_a_suffix_array_of_more_positions_than_fit_beside_two_ranks():
    data = np.frombuffer(bytes(random.Random(1).choices(b"ab", k=(1 << 21) + 5)), np.uint8)
    order = suffix_array(data, np.array([len(data)]))
    raw = data.tobytes()
    assert np.array_equal(np.sort(order), np.arange(len(data)))
    assert all(raw[a : a + 200] <= raw[b : b + 200] for a, b in zip(order[:-1:997], order[1::997]))


# Repeated bytes.


def plain_repeats(texts, length):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        turns = np.flatnonzero(np.diff(gone, prepend=False))
        out.append((len(t), int(gone.sum()), list(zip(turns[::2].tolist(), turns[1::2].tolist())), bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])))
    return out


def check_repeats(spark, rows, **options):
    left = byte_repeats.remove_repeats(spark.createDataFrame(rows, DOCUMENTS), **options)
    found = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in left.collect()]
    want = [(r[0], *p) for r, p in zip(rows, plain_repeats([r[1] for r in rows], options.get("length", 200)))]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    return found


@pytest.mark.parametrize("kind", ["documents", "repeated", "empty"])
def test_repeats(spark, kind):
    found = check_repeats(spark, tables()[kind])
    assert kind == "empty" or any(n for _, _, n, _, _ in found)


@pytest.mark.parametrize("length, anchor", [(200, 24), (40, 7), (9, 9), (5, 1), (1, 1)])
def test_repeats_of_other_lengths(spark, length, anchor):
    rows = [r for r in documents() if len(r[1] or "") < 3000]
    check_repeats(spark, rows, length=length, anchor=anchor)


@pytest.mark.parametrize("most_pieces", [1, 3])
def test_shards_of_one_anchor_are_merged(spark, most_pieces, monkeypatch):
    """A passage in every document, between words of its own; every block holds some documents."""
    monkeypatch.setattr(byte_repeats, "BLOCK_BYTES", 2000)
    passage = prose(7, 60, 60)
    r = random.Random(2)
    rows = [(i, prose(r.randrange(12), 30) + " " + passage + " " + prose(r.randrange(9), 35)) for i in range(60)]
    rows = [(*row, "en", "s", 1, 1, "d", 5, "w", 7, 3) for row in rows]
    check_repeats(spark, spark.createDataFrame(rows, DOCUMENTS).repartition(5).collect(), length=60, anchor=12, most_pieces=most_pieces)


def test_windows_whose_first_fingerprint_is_shared(spark):
    import pyarrow as pa

    runs = [[(1, 1), (5, 8), (9, 9)], [(5, 7), (9, 9)], [(2, 2), (5, 8)]]
    rows = {
        "part": [0, 1, 2],
        "a": [np.array(r, np.uint64).tobytes() for r in runs],
        "b": [np.arange(len(r), dtype=np.int64).tobytes() for r in runs],
    }
    found = byte_repeats._merge((pa.scalar(4), pa.scalar(0)), pa.table(rows))
    assert [np.frombuffer(x, np.int64).tolist() for x in found.column("a").to_pylist()] == [[1, 2], [1], [1]]
    assert found.column("shard").to_pylist() == [4, 4, 4] and found.column("part").to_pylist() == [0, 1, 2]


def test_pieces_cover_every_window_once_also_over_chunks(monkeypatch):
    monkeypatch.setattr(byte_repeats, "CHUNK", 100)
    texts = [prose(3, 200).encode(), b"x" * 90, b"", b"abcabcabc" * 30]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([*map(len, texts)])
    _, starts, sizes = byte_repeats.pieces(data, ends, 50, 8)
    covered = [p for s, n in zip(starts, sizes) for p in range(s, s + n)]
    begins = ends - [*map(len, texts)]
    assert covered == [p for a, b in zip(begins, ends) for p in range(a, b - 49)]


# Filters.


def plain_masks(rows):
    texts = defaultdict(list)
    for row in rows:
        if row[0] is not None:
            texts[row[1] or ""].append(row[0])
    out = []
    for row in rows:
        text = row[1] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append(
            (len(words) < 100)
            | (100 * len(set(words)) < 80 * len(words)) << 1
            | (100 * len(re.findall("[A-Z]", text)) > 10 * len(text)) << 2
            | bool(re.search(r"[#$%&*|]", text)) << 3
            | (row[0] is not None and min(texts[text]) < row[0]) << 4
        )
    return out


def plain_audit(rows, labels):
    good = {k for k, q, _ in labels if k is not None and q == 1}
    toxic = {k for k, _, t in labels if k is not None and t == 1}
    masks, parts = plain_masks(rows), [r[2] or "" for r in rows]
    out, removed = [], Counter()
    for part in set(parts):
        own = [(m, r[0]) for m, r, p in zip(masks, rows, parts) if p == part]
        for order in permutations("ABCDE"):
            left, before = own, 0
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                here = [k for m, k in left if m & bit]
                redundant = sum(bool(m & bit and m & before) for m, _ in own)
                left = [(m, k) for m, k in left if not m & bit]
                before |= bit
                out.append([part, "".join(order), step, len(left), len(here), redundant, sum(m == bit for m, _ in own)])
                out[-1] += [sum(k in good for k in here), sum(k in toxic for k in here)]
                removed[part, letter] += len(here)
    return sorted((*x, removed[x[0], x[1][x[2] - 1]]) for x in out)


LABELS = [(1, 1, 0), (2, 0, 1), (4, 1, 1), (10, None, 1), (11, 1, None), (13, 1, 0), (13, 0, 1), (None, 1, 1), (17, 1, 0), (999, 1, 1)]


@pytest.mark.parametrize("kind", ["documents", "repeated", "empty", "varied"])
@pytest.mark.parametrize("part_bytes", [100, 1 << 20])
def test_filter_audit(spark, kind, part_bytes):
    rows = varied() if kind == "varied" else tables()[kind]
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    judged = filter_audit.judged(spark.createDataFrame(rows, DOCUMENTS), part_bytes=part_bytes)
    found = filter_audit.orders_audit(filter_audit.mask_counts(judged, labels))
    names = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    assert sorted(map(tuple, found.select(*names).collect())) == plain_audit(rows, LABELS)


def test_copies_over_many_tries(spark, monkeypatch):
    """Near copies that share long beginnings, exact ones in every task, tries that hold few texts."""
    monkeypatch.setattr(filter_audit, "HELD_ROWS", 7)
    a = prose(1, 300)
    texts = [a, a + " b", a[:-1], a[:900], a[:60], "", "short", a[:16], a[:17], a[:64] + "x"] * 12
    rows = [(i * 37 % 120, t, "en", "s", 1, 1, "d", 5, "w", 7, 3) for i, t in enumerate(texts)]
    judged = filter_audit.judged(spark.createDataFrame(rows, DOCUMENTS).repartition(6), part_bytes=500)
    found = Counter()
    for r in judged.collect():
        found[r.doc_id, r["mask"]] += r.n
    assert found == Counter(zip([r[0] for r in rows], plain_masks(rows)))


def test_radix_trie():
    trie, r = filter_audit.RadixTrie(), random.Random(5)
    texts = [bytes(r.choices(b"ab", k=r.randrange(9))) for _ in range(400)]
    nodes = [trie.insert(t, k) for t, k in zip(texts, r.sample(range(1000), 400))]
    assert len({id(n) for n in nodes}) == len(set(texts))
    assert trie.insert(b"abab", None) is trie.insert(b"abab", None)
    assert all(len({a, b}) == 1 or nodes[i] is not nodes[j] for i, a in enumerate(texts[:40]) for j, b in enumerate(texts[:40]))


def test_the_hash_of_what_is_kept(spark):
    rows = [(1, "é" * 150, *[None] * 9), (2, "x" + "é" * 120, *[None] * 9)]
    left = {r.doc_id: r for r in byte_repeats.remove_repeats(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert hashlib.sha256(left[2].kept).hexdigest() == hashlib.sha256(b"x").hexdigest()
