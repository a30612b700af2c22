"""Token ids of texts by a `tokenizers` file, encoded once per distinct word of a task.

Most words of a corpus repeat, and the tokenizer splits a text into pieces that never cross the
space before a word, so the ids of a line are the ids of its words one after the other. That holds
for byte-level tokenizers with the usual splitting pattern and for texts whose white space is
single spaces and single line ends; any other text is given to the tokenizer whole.
"""

from __future__ import annotations

import gc
import json
import os
import re
import string
from array import array
from codecs import charmap_decode

import numpy as np
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side

# White space that the fast path does not know, and characters whose class may differ between libraries.
STRANGE = re.compile(r"[^\n\x20-\x7e¡-ɏΑ-Ωα-ωА-я]")

# Words a worker keeps, the ones that it meets first and so the frequent ones; bounds a worker's memory at about 250 MB.
MOST_WORDS = 1_200_000

# Fixed values of byte-level tokenizers: the splitting pattern, and the letter that stands for each byte.
PIECE = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
_AS_THEY_ARE = {*range(33, 127), *range(161, 173), *range(174, 256)}
LETTERS = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _AS_THEY_ARE)}

ALPHABET = "".join(LETTERS.get(b, chr(b)) for b in range(256))

SPACE = LETTERS[ord(" ")]

# All ASCII marks: neither white space nor letters nor numbers.
MARKS = string.punctuation

_encoders: dict[tuple[str, int], "Encoder"] = {}


def encoder(path: str, width: int = 4) -> "Encoder":
    """The encoder of a tokenizer file, one per Python worker."""
    if (path, width) not in _encoders:
        # Words and ids are in no cycles: looking for some among them ever so often takes a tenth of the time.
        gc.set_threshold(100_000, 50, 100)
        _encoders.clear()
        _encoders[path, width] = Encoder(path, width)
    return _encoders[path, width]


def narrowest(path: str, *more: int) -> int:
    """Bytes that hold every id of a tokenizer file and the ids given: 2 or 4."""
    from tokenizers import Tokenizer

    return 2 if max(*Tokenizer.from_file(path).get_vocab().values(), *more) < 1 << 16 else 4


class _Strange(Exception):
    """A word has characters that only the tokenizer itself may split."""


class _Words(dict):
    """Ids of words; a word that is missing is encoded, and kept while there is room."""

    def __init__(self, model, code: str):
        self.tokenize, self.code = model.tokenize, code

    def __missing__(self, word: str) -> bytes:
        if STRANGE.search(word):
            raise _Strange
        # Letters with the space before them are one piece, and so are the marks after them.
        core = word.rstrip(MARKS)
        if not (core[1:] if core[:1] == " " else core).isalpha():
            return self._kept(word, b"".join(map(self._piece, PIECE.findall(word))))
        if len(core) == len(word):
            return self._kept(word, self._ids(word))
        marks = self._piece(word[len(core) :])
        if (ids := self.get(core)) is not None:
            return self._kept(word, ids + marks)
        # Met for the first time: what stands before the marks is more likely to come again than all of it.
        return self._kept(core, self._ids(core)) + marks

    def _kept(self, word: str, ids: bytes) -> bytes:
        if len(self) < MOST_WORDS:
            self[word] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        found = self.get(piece)
        return self._kept(piece, self._ids(piece)) if found is None else found

    def _ids(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():  # of these, only the space has another letter
            letters = piece.replace(" ", SPACE)
        else:
            letters = charmap_decode(piece.encode(), "strict", ALPHABET)[0]
        return array(self.code, [t.id for t in self.tokenize(letters)]).tobytes()


def _single_spaced(text: str) -> bool:
    return not ("\x00" in text or "  " in text or "\n\n" in text or "\n " in text or " \n" in text)


class Encoder:
    """Ids as `Tokenizer.encode(text, add_special_tokens=False)` gives them, as little-endian numbers of `width` bytes."""

    def __init__(self, path: str, width: int = 4):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = f"<u{width}"
        setup = json.loads(self.tokenizer.to_str())
        options = {k: v for k, v in setup["model"].items() if k not in ("type", "vocab", "merges")}
        self.by_words = (
            setup["model"]["type"] == "BPE"
            and not any(options.values())
            and not setup["normalizer"]
            and setup["pre_tokenizer"]["type"] == "ByteLevel"
            and setup["pre_tokenizer"].get("use_regex", True)
            and not setup["pre_tokenizer"]["add_prefix_space"]
        )
        if self.by_words:
            # The same model without its own cache of pieces: every piece is asked for once.
            merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in setup["model"]["merges"]]
            model = BPE(vocab=setup["model"]["vocab"], merges=merges, cache_capacity=0)
            self.words = _Words(model, {2: "H", 4: "I"}[width])

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of one text. A null is an empty text."""
        if not text:
            return b""
        if not self.by_words or not _single_spaced(text) or any(s in text for s in self.special):
            return self._whole(text)
        # A word keeps the space before it; the first one of a line has none.
        words = text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")
        try:
            return b"".join(map(self.words.__getitem__, words))
        except _Strange:
            return self._whole(text)
