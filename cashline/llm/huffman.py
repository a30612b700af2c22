"""Canonical Huffman codes of limited length for token ids, with independent blocks.

The code lengths are optimal under the limit (package-merge); codes of one length ascend with the id, so
the lengths alone define the code. A segment is a run of codes, most significant bit first, and a
checkpoint, the bit at which it starts, for every block of `BLOCK` ids: any block can be decoded
on its own, and a whole segment is decoded by stepping through all its blocks at once.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass
from functools import cached_property

import numpy as np

BLOCK = 256
LIMIT = 18
_HEAD = struct.Struct("<4sIQQQQ")
MAGIC = b"HSEG"

# 32 bits are read from the byte in which a code begins, of which up to 7 belong to the code before.
MOST_BITS = 25

# Of an entry of the decoding table, what holds the length of the code.
LENGTH_BITS = MOST_BITS.bit_length()
LENGTH_MASK = (1 << LENGTH_BITS) - 1


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """The length of each symbol's code, at most `limit`, that makes the coded text shortest."""
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need codes of more than {limit} bits")
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    packages, levels = weights[:0], []
    for _ in range(limit):
        merged = np.concatenate((weights, packages))
        by_weight = np.argsort(merged, kind="stable")
        levels.append(by_weight < n)
        merged = merged[by_weight]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, wanted = np.zeros(n, np.int64), 2 * n - 2
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:wanted].sum())
        lengths[order[:symbols]] += 1
        wanted = 2 * (wanted - symbols)
    return lengths


@dataclass(frozen=True)
class Codebook:
    """Symbols (ascending) and the lengths of their codes."""

    symbols: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of_counts(cls, counts: dict[int, int], limit: int = LIMIT) -> Codebook:
        if limit > MOST_BITS:
            raise ValueError(f"the decoder reads codes of up to {MOST_BITS} bits, not {limit}")
        symbols = np.array(sorted(counts), np.int64)
        return cls(symbols, code_lengths(np.array([counts[s] for s in symbols.tolist()], np.int64), limit))

    def to_bytes(self) -> bytes:
        return self.symbols.astype("<u4").tobytes() + self.lengths.astype("u1").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Codebook:
        n = len(data) // 5
        return cls(np.frombuffer(data, "<u4", n).astype(np.int64), np.frombuffer(data, "u1", n, 4 * n).astype(np.int64))

    @cached_property
    def _canonical(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the symbols by code, and the codes of the symbols."""
        order = np.lexsort((self.symbols, self.lengths))
        widest = int(self.lengths.max(initial=1))
        steps = np.left_shift(1, widest - self.lengths[order])
        codes = np.zeros(len(order), np.int64)
        codes[order] = (np.cumsum(steps) - steps) >> (widest - self.lengths[order])
        return order, codes

    @cached_property
    def _by_id(self) -> tuple[np.ndarray, np.ndarray]:
        size = int(self.symbols.max(initial=0)) + 1
        codes, lengths = np.zeros(size, np.uint64), np.zeros(size, np.uint8)
        # Codes begin at the highest bit.
        codes[self.symbols] = self._canonical[1].astype(np.uint64) << (64 - self.lengths).astype(np.uint64)
        lengths[self.symbols] = self.lengths
        return codes, lengths

    @cached_property
    def _table(self) -> tuple[np.ndarray, int]:
        """For every value of the next bits the symbol, and in the lowest bits the code's length: one place to look at."""
        widest = int(self.lengths.max(initial=1))
        order = self._canonical[0]
        times = np.left_shift(1, widest - self.lengths[order])
        table = np.ones(1 << widest, np.uint64 if self.symbols.max(initial=0) >> 32 - LENGTH_BITS else np.uint32)
        table[: int(times.sum())] = np.repeat(self.symbols[order] << LENGTH_BITS | self.lengths[order], times)
        return table, widest

    def encode(self, ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, bytes]:
        """Checkpoints and bits."""
        if not len(ids):
            return np.zeros(0, np.uint64), b""
        codes, lengths = self._by_id
        code, length = codes.take(ids), lengths.take(ids)
        ends = np.cumsum(length, dtype=np.int64)
        starts = ends - length
        word, place = starts >> 6, (starts & 63).astype(np.uint64)
        # Codes are shorter than a word, so a code starts in each word but perhaps the last one.
        firsts = np.concatenate(([0], np.flatnonzero(word[1:] != word[:-1]) + 1))
        words = np.zeros((int(ends[-1]) + 63 >> 6) + 1, np.uint64)
        words[: len(firsts)] = np.bitwise_or.reduceat(code >> place, firsts)
        over = np.flatnonzero(place + length > 64)
        words[word[over] + 1] |= code[over] << (np.uint64(64) - place[over])
        return starts[::block].astype(np.uint64), words.astype(">u8").tobytes()[: (int(ends[-1]) + 7) // 8]

    def decode(self, n: int, checkpoints: np.ndarray, bits: bytes, block: int = BLOCK) -> np.ndarray:
        """The `n` ids, all blocks side by side, one id of each per step."""
        if not n:
            return np.zeros(0, np.uint32)
        table, widest = self._table
        # Codes are read past the end of a block, so those of the last one past the end of the bits.
        data = np.concatenate((np.frombuffer(bits, np.uint8), np.zeros(block * widest // 8 + 8, np.uint8))).astype(np.uint32)
        quads = data[:-3] << np.uint32(24) | data[1:-2] << np.uint32(16) | data[2:-1] << np.uint32(8) | data[3:]
        spare, mask = np.uint32(32 - widest), np.uint32((1 << widest) - 1)
        at = checkpoints.astype(np.uint32 if len(data) < 1 << 29 else np.int64)
        out = np.empty((min(block, n), len(at)), table.dtype)
        for step in out:
            peeked = quads.take(at >> 3) >> (spare - (at & 7).astype(np.uint32)) & mask
            table.take(peeked, out=step, mode="clip")
            at += (step & LENGTH_MASK).astype(at.dtype)
        return (out.T.ravel()[:n] >> LENGTH_BITS).astype(np.uint32)


def pack_segment(book: Codebook, doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    """Header, document ids and sizes, checkpoints, bits."""
    checkpoints, bits = book.encode(ids, block)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    docs = np.array([d or 0 for d in doc_ids], "<i8")
    head = _HEAD.pack(MAGIC, block, len(doc_ids), len(ids), len(checkpoints), len(bits))
    return b"".join((head, known.tobytes(), docs.tobytes(), sizes.astype("<u8").tobytes(), checkpoints.astype("<u8").tobytes(), bits))


def read_segments(book: Codebook, data: bytes):
    """(document ids, their sizes, all their ids) of each segment of a file."""
    at = 0
    while at < len(data):
        magic, block, n_docs, n_ids, n_blocks, n_bits = _HEAD.unpack_from(data, at)
        if magic != MAGIC or n_blocks != -(-n_ids // block):
            raise ValueError(f"no segment at byte {at}")
        at += _HEAD.size
        known = np.frombuffer(data, "u1", n_docs, at)
        docs = np.frombuffer(data, "<i8", n_docs, at + n_docs)
        sizes = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
        at += 17 * n_docs
        checkpoints = np.frombuffer(data, "<u8", n_blocks, at)
        at += 8 * n_blocks
        if len(data) < at + n_bits or sizes.sum() != n_ids:
            raise ValueError(f"a segment is cut short at byte {at}")
        yield np.ma.masked_array(docs, known == 0).tolist(), sizes, book.decode(n_ids, checkpoints, data[at : at + n_bits], block)
        at += n_bits
