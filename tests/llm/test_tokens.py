"""Ids by words against the tokenizer, files against an exact round trip, packing against its rules."""

import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

from messy import DOCUMENTS, documents, repeated  # noqa: E402

from cashline.llm import huffman, packing, token_files  # noqa: E402
from cashline.llm.common import new_folder, settled  # noqa: E402
from cashline.llm.tokens import Encoder  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH)


def ids(text, end=None):
    found = TOKENIZER.encode(text or "", add_special_tokens=False).ids
    return np.array(found + ([] if end is None else [end]), "<u4")


def test_messy_texts_encode_as_the_tokenizer_does():
    assert ENCODER.by_words
    for _, text, *_ in documents():
        assert ENCODER.encode(text) == ids(text).tobytes()


@pytest.mark.parametrize("text", ["a\x00b", "\x00", "a \x00 b\nc", "tab\there", "nb\xa0sp \u3000 x", "soft\xadhyphen", "a\x85b", "\ufeffbom"])
def test_strange_characters_go_to_the_tokenizer(text):
    assert ENCODER.encode(text) == ids(text).tobytes()
    assert ENCODER.encode(text + " again") == ids(text + " again").tobytes()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB é'st 1,.\n\t\xa0!ß日"), max_size=30) | st.text(max_size=30))
def test_any_text_encodes_as_the_tokenizer_does(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ENCODER.encode(text) == ids(text).tobytes()


def test_a_full_word_table_changes_nothing(monkeypatch):
    monkeypatch.setattr("cashline.llm.tokens.MOST_WORDS", 5)
    encoder = Encoder(PATH)
    for _, text, *_ in documents()[:6] * 2:
        assert encoder.encode(text) == ids(text).tobytes()


def test_a_word_is_asked_for_once_whatever_marks_follow_it():
    encoder, asked = Encoder(PATH), Counter()
    tokenize = encoder.words.tokenize

    def counted(piece):
        asked[piece] += 1
        return tokenize(piece)

    encoder.words.tokenize = counted
    text = "so stone, stone. stone; stone' stone\nstone's é, é. é stra\u00dfe, stra\u00dfe. 'stone', don't, _stone_, x1, x1. 's. \u00aa, ''s"
    for _ in range(2):
        assert encoder.encode(text) == ids(text).tobytes()
    assert asked["\u0120stone"] == 1 and set(asked.values()) == {1}


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_other_tokenizers_get_the_text_whole(name):
    path = public_tokenizers.path(name)
    other = Tokenizer.from_file(path)
    for text in ("Hello there  world", "a b\nc", ""):
        assert Encoder(path).encode(text) == np.array(other.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def optimum(counts):
    import heapq

    heap = [(n, i, 0) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    total, at = 0, len(counts)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], at, 0))
        at += 1
    return total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5000), min_size=1, max_size=80))
def test_codes_are_prefix_free_and_optimal_where_the_limit_allows(counts):
    free = huffman.code_lengths(np.array(counts), 40 if len(counts) < 40 else 60)
    assert sum(2.0 ** -n for n in free.tolist()) <= 1
    if len(counts) > 1:
        assert int((free * np.array(counts)).sum()) == optimum(counts)
        limited = huffman.code_lengths(np.array(counts), 7)
        assert limited.max() <= 7 and sum(2.0 ** -n for n in limited.tolist()) <= 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 90_000).map(lambda x: x % 97 if x % 3 else x), max_size=2000), st.sampled_from([1, 7, 512]))
def test_blocks_round_trip(values, block):
    values = np.array(values, np.int64)
    book = huffman.Codebook.of_counts(Counter(values.tolist()))
    book = huffman.Codebook.from_bytes(book.to_bytes())
    checkpoints, bits = book.encode(values, block)
    assert len(checkpoints) == -(-len(values) // block)
    assert book.decode(len(values), checkpoints, bits, block).tolist() == values.tolist()
    for k, at in enumerate(checkpoints.tolist()):  # each block by itself
        own = values[k * block : (k + 1) * block]
        assert book.decode(len(own), np.array([at], np.uint64), bits, block).tolist() == own.tolist()


def test_a_cut_segment_is_refused():
    book = huffman.Codebook.of_counts({1: 3, 2: 1})
    data = huffman.pack_segment(book, [5, None], np.array([2, 2]), np.array([1, 2, 1, 1]))
    assert [(d, s.tolist(), i.tolist()) for d, s, i in huffman.read_segments(book, data)] == [([5, None], [2, 2], [1, 2, 1, 1])]
    for broken in (data[:-1], b"x" + data):
        with pytest.raises(ValueError):
            list(huffman.read_segments(book, broken))


def written(spark, rows, monkeypatch=None):
    docs = spark.createDataFrame(rows, DOCUMENTS)
    folder = new_folder(spark, "test-ids")
    token_files.write(docs, PATH, folder)
    return token_files.read(spark, folder).collect()


def test_token_files_round_trip(spark):
    rows = repeated()
    found = sorted(written(spark, rows), key=lambda r: r.start)
    at = 0
    for r in found:
        assert (r.start, r.ids_crc32, r.n_tokens) == (at, zlib.crc32(r.ids), len(r.ids) // 4)
        at += r.n_tokens
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k))
    assert Counter((r.doc_id, bytes(r.ids)) for r in found) == Counter((r[0], ids(r[1], 0).tobytes()) for r in rows)


def test_token_files_of_small_files_and_segments(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 100)
    monkeypatch.setattr(token_files, "FILE_BYTES", 500)
    found = sorted(written(spark, documents()), key=lambda r: r.start)
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
    assert {(r.doc_id, bytes(r.ids)) for r in found} == {(r[0], ids(r[1], 0).tobytes()) for r in documents()}


def test_token_files_of_an_empty_table(spark):
    assert written(spark, []) == []


def check_packing(rows, found, capacity):
    by, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    expected = defaultdict(list)
    for row in rows:
        expected[row[0]].append(ids(row[1], 2))
    for doc_id, texts in expected.items():
        pieces = Counter()
        for own in texts:
            first = (len(own) - 1) % capacity + 1
            cuts = [0, *range(first, len(own) + 1, capacity)]
            pieces.update((k, a, b - a, zlib.crc32(own[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
        assert Counter((r.piece, r.start, r.length, r.ids_crc32) for r in by[doc_id]) == pieces
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(by) == set(expected)
    return len(sequences)


def pack_rows(spark, rows, capacity):
    docs = spark.createDataFrame(rows, DOCUMENTS)
    return packing.pack(packing.with_crc(packing.pieces(docs, PATH, capacity=capacity)), capacity).collect()


@pytest.mark.parametrize("capacity", [1024, 16])
def test_packing_follows_its_rules(spark, capacity):
    rows = repeated()
    n = check_packing(rows, pack_rows(spark, rows, capacity), capacity)
    assert n <= 1.1 * -(-sum(len(ids(r[1], 2)) for r in rows) // capacity) + 1


def test_packing_of_an_empty_table(spark):
    assert pack_rows(spark, [], 64) == []


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame(documents(), DOCUMENTS)
    cut = settled(packing.pieces(docs, PATH, capacity=64), "test-pieces")
    packed = packing.pack(cut, 64)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids


def best_fill(lengths, capacity):
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= capacity}
    return max(sums)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=40), st.integers(40, 60))
def test_each_bin_is_filled_as_well_as_can_be(lengths, capacity):
    chosen = packing.fullest(Counter(lengths), capacity)
    assert sum(chosen) == best_fill(lengths, capacity) and not Counter(chosen) - Counter(lengths)
    found = packing.patterns(dict(Counter(lengths)), capacity)
    used = Counter()
    for times, each in found:
        assert sum(each) <= capacity
        used.update({n: k * times for n, k in Counter(each).items()})
    assert used == Counter(lengths)


def test_codes_the_decoder_cannot_read_are_refused():
    with pytest.raises(ValueError, match="up to 25 bits, not 28"):
        huffman.Codebook.of_counts({1: 5, 2: 3}, limit=28)
    counts = {n: 2 ** min(n, 40) for n in range(60)}
    book = huffman.Codebook.of_counts(counts, limit=25)
    ids = np.array(list(counts) * 3, np.uint32)
    checkpoints, bits = book.encode(ids)
    assert np.array_equal(book.decode(len(ids), checkpoints, bits), ids)
