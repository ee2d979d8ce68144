"""Token ids of whole texts by a byte-level vocabulary of the tokenizers library.

The library reaches about one megabyte a second, most of it spent on words it has
seen before. A text can be cut before any single space whose next character is
not white space: the vocabulary's pre-tokenizer always starts a new piece there.
Each cut part is encoded by the library's model once and kept in a dictionary of
bounded size; a plain word with marks after it is its word's ids and the
marks'. Texts with runs of white space, or with a special token, are encoded
whole.
"""

from __future__ import annotations

import re
import string
import struct
from functools import lru_cache

import numpy as np

from areapulse.llm.common import hold_one

VOCABULARY = "byte_bpe_50k.json"
CACHED_WORDS = 350_000
LONGEST_CACHED = 64
CACHED_MARKS = 10_000
#: Letters below this code point are letters to every version of Unicode.
OLD_LETTERS = "ɐ"
ASCII_MARKS = string.punctuation
_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-öø-ɏ]+", r"[!-/:-@\[-`{-~]*"
#: Letters and marks, and perhaps a second such word on the next line: pieces are letters, marks, and the line break.
SHAPE = re.compile(rf"({_LETTERS})({_MARKS})(?:\n({_LETTERS})({_MARKS}))?")


@lru_cache(maxsize=1)
def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}


def _plain(word: str) -> bool:
    return word.isalpha() and (word.isascii() or max(word) < OLD_LETTERS)


_SPACE = _byte_letters()[ord(" ")]
#: The stand-ins of the bytes of each letter below OLD_LETTERS.
_STAND_INS = {c: "".join(map(_byte_letters().get, chr(c).encode())) for c in range(ord(OLD_LETTERS))}


class _Packed(dict):
    """Each id as a little-endian unsigned 32-bit number, made when it is first met."""

    def __missing__(self, number: int) -> bytes:
        made = self[number] = struct.pack("<I", number)
        return made


class _Marks(dict):
    """Ids of marks that follow a word."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, marks: str) -> bytes:
        made = self.make(marks)
        if len(marks) <= LONGEST_CACHED and len(self) < CACHED_MARKS:
            self[marks] = made
        return made


class TextEncoder:
    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # asked for at each use, the library makes these anew
        self.tokenize, self.split = self.tokenizer.model.tokenize, self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.packed, self.marks = _Packed(), _Marks(lambda marks: self._part(marks))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cached_words = cached_words
        # Words by the text after a space; when full, these become the old ones and only what is met again comes back.
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece in stand-in letters."""
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenize(piece)])

    def _part(self, text: str) -> bytes:
        """Ids of a text without special tokens, piece by piece."""
        if _plain(text.removeprefix(" ")):
            # ASCII letters stand for themselves
            letters = text if text.isascii() else text.encode().decode("latin-1").translate(_byte_letters())
            return self._piece(letters.replace(" ", _SPACE))
        return b"".join([self._piece(p) for p, _ in self.split(text)])

    def _stem(self, word: str) -> bytes:
        """Ids of a space and a plain word that is not among the newest."""
        ids = self.old.get(word)
        if ids is None:
            # ASCII letters stand for themselves
            ids = self._piece(_SPACE + (word if word.isascii() else word.translate(_STAND_INS)))
        if len(word) <= LONGEST_CACHED:
            if len(self.words) >= self.cached_words:
                self.old, self.words = self.words, {}
            self.words[word] = ids
        return ids

    def _cached(self, key: str, make) -> bytes:
        ids = self.words.get(key)
        if ids is None:
            ids = self.old.get(key)
            if ids is None:
                ids = make(key)
            if len(key) <= LONGEST_CACHED:
                if len(self.words) >= self.cached_words:
                    self.old, self.words = self.words, {}
                self.words[key] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of a space and ``word``."""
        if word.isascii() and word.isalpha():
            return self._piece(_SPACE + word)
        if (shape := SHAPE.fullmatch(word)) and (shape[2] or shape[3]):
            start, marks, rest, more = shape.groups()
            ids = self._cached(start, self._word)
            if marks:
                ids += self.marks[marks]
            if rest:
                ids += self._cached(" \n", self._unspaced) + self._cached(" " + rest, self._unspaced)
            return ids + self.marks[more] if more else ids
        return self._part(" " + word)

    def _unspaced(self, key: str) -> bytes:
        """Ids of what stands without a space before it; its key starts with one, which no word has."""
        return self._part(key[1:])

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers; none for NULL."""
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self._whole(text)
        first, *rest = text.split(" ")
        found = list(map(self.words.get, rest))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            word = rest[i]
            start = word.rstrip(ASCII_MARKS)
            if start.isalpha() and (start.isascii() or max(start) < OLD_LETTERS):
                # with marks it is not kept itself: its parts are, and most such words are not met again
                ids = self.words.get(start) or self._stem(start)
                found[i] = ids + self.marks[word[len(start) :]] if len(start) < len(word) else ids
                continue
            if not word or word[0].isspace():
                return self._whole(text)
            found[i] = self._cached(word, self._word)
        return (self._part(first) if first else b"") + b"".join(found)


def text_encoder(vocabulary: str = VOCABULARY) -> TextEncoder:
    """The encoder of a vocabulary file, once per Python worker; a bare name is one of the installed public files."""

    def make() -> TextEncoder:
        import public_tokenizers

        return TextEncoder(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))

    return hold_one(("tokens", vocabulary), make)
