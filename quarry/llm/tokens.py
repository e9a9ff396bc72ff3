"""Token ids of whole texts.

``WordTokenizer`` uses the tokenizers library for vocabularies of lower-cased words that drop white space: a text's ids
are those of its words one after another, so each different word needs the library once and a bounded cache remembers
the recent ones; new runs of plain letters are merged by tiktoken with that vocabulary's ranks. ``ByteTokenizer`` uses tiktoken with the ranks that a byte-level vocabulary file of the tokenizers
library lists (the same merges, four times as fast), and the tokenizers library itself for texts with rare characters,
on whose classes the two libraries' tables might differ. It cuts long texts where the vocabulary's pattern always splits,
at a space between two lower-case letters, so that memory doesn't follow the length of a text of words. Strings of
special tokens in a text are ordinary text.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import sys
from array import array

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words that a worker remembers in each of two generations.
REMEMBERED = 150_000
#: The split pattern of the byte-level vocabulary.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters encoded together, and where a text may be cut after so many.
TOGETHER, CUT = 1 << 15, re.compile(r"(?<=[a-z])(?= [a-z])")
#: Characters whose class and lower case no table disputes: ASCII without controls, Latin-1 letters and signs.
PLAIN = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xac\xae-\xff]")
#: Runs of letters stay whole; between a letter and a sign (but the apostrophe) the word vocabulary always splits.
LETTERS = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+")
#: Without any of these, each comma and each full stop follows a letter, a digit or white space.
SIGNS = (*"!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~", ",,", ",.", ".,", "..")
OTHER = re.compile(r"[\xa1-\xbf\xd7\xf7]")
SIGN = re.compile(r"([a-z\xdf-\xf6\xf8-\xff])([!-&(-/:-@\[-`{-~])")


def _library(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


def byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def letter_merges(path: str):
    """What gives the ids of a run of plain letters' bytes, of which the last one is as ``last`` writes it; or None for a vocabulary whose
    merges don't rank by id or don't mark a word's end. tiktoken merges two tokens wherever the vocabulary has the whole,
    the library only the two that made it: the same, as each token is what its own bytes come to (tests hold this)."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, suffix = model["vocab"], model.get("end_of_word_suffix")
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model.get("merges", [])]
    if not suffix or model["type"] != "BPE" or model.get("continuing_subword_prefix") or any(a >= b for a, b in zip(made, made[1:], strict=False)):
        return None
    letters = {c: b for b, c in byte_letters().items()}
    plain = {*range(97, 123), *range(0x80, 0xC0), 0xC3}
    ranks = {}
    for token, i in vocab.items():
        ends = token.endswith(suffix)
        data = bytes(letters.get(c, 0) for c in token.removesuffix(suffix))
        if data and plain.issuperset(data) and not (ends and data[-1] == 0xC3):
            ranks[data[:-1] + last(data[-1]) if ends else data] = i
    return tiktoken.Encoding("letters", pat_str=r"\p{L}+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


def last(byte: int) -> bytes:
    """A word's last byte as one that plain letters don't have: of a-z the capital, of a letter's second byte its low bits."""
    return bytes([byte - 32 if byte < 0x80 else byte - 0x80])


_LAST = [last(b) if 97 <= b < 123 or 0x80 <= b < 0xC0 else b"" for b in range(256)]


class WordTokenizer:
    """For vocabularies whose normalizer lower-cases and whose words hold no white space."""

    def __init__(self, path: str) -> None:
        self.library = _library(path)
        self.merge = self.library.model.tokenize
        self.width = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.code = struct.Struct(self.width.replace("u2", "H").replace("u4", "I")).pack
        self.kind = "H" if self.width == "<u2" else "I"
        self.letters = byte_letters()
        self.fast = letter_merges(path)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        return array(self.kind, ids).tobytes() if sys.byteorder == "little" else b"".join(map(self.code, ids))

    def _new(self, word: str) -> bytes:
        """A word's ids. What normalizer and splitter leave as it is, a run of plain letters, goes straight to the merges."""
        if (ids := self.older.get(word)) is None:
            if (word.isascii() and word.isalpha() and word.islower()) or LETTERS.fullmatch(word):
                if self.fast is not None:
                    data = word.encode()
                    ids = self.recent[word] = self.pack(self.fast(data[:-1] + _LAST[data[-1]]))
                    return ids
                spelt = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
                found = [t.id for t in self.merge(spelt)]
            else:
                found = self.library.encode(word, add_special_tokens=False).ids
            ids = b"".join(map(self.code, found))
        self.recent[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids, little-endian, ``width`` each."""
        if text.isascii() or not PLAIN.search(text):
            text = text.lower()
            if any(map(text.__contains__, SIGNS)) or (not text.isascii() and OTHER.search(text)):
                text = SIGN.sub(r"\1 \2", text)
            else:
                text = text.replace(",", " ,").replace(".", " .")
        words = text.replace("\n", " ").split(" ")
        if len(self.recent) > REMEMBERED:
            self.older, self.recent = self.recent, {}
        ids = list(map(self.recent.get, words))
        if None in ids:
            for i, x in enumerate(ids):
                if x is None:
                    w = words[i]
                    ids[i] = self.recent.get(w) or self._new(w)
        return b"".join(ids)


class ByteTokenizer:
    """For byte-level vocabularies."""

    def __init__(self, path: str) -> None:
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        letters = {c: b for b, c in byte_letters().items()}
        ranks = {bytes(letters[c] for c in k): v for k, v in vocab.items() if all(c in letters for c in k) and k != "<|endoftext|>"}
        self.fast = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        self.width = "<u4"

    @functools.cached_property
    def library(self):
        """Loaded for the first text that needs it."""
        return _library(self.path)

    def encode(self, text: str) -> bytes:
        """The ids, little-endian, four bytes each."""
        parts, at = [], 0
        while len(text) - at > TOGETHER and (found := CUT.search(text, at + TOGETHER)):
            parts.append(self._encode(text[at : found.start()]))
            at = found.start()
        return b"".join([*parts, self._encode(text[at:] if at else text)])

    def _encode(self, text: str) -> bytes:
        if PLAIN.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()


_loaded: dict[tuple[type, str], WordTokenizer | ByteTokenizer] = {}


def tokenizer(kind: type, path: str) -> WordTokenizer | ByteTokenizer:
    """One a worker process."""
    if (kind, path) not in _loaded:
        _loaded[kind, path] = kind(path)
    return _loaded[kind, path]
