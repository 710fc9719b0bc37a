"""Token ids by a public tokenizer, with the ids of repeated words looked up."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

# Each worker remembers the ids of at most so many words, none longer than MAX_WORD characters:
# those met of late, and those met before them. That forgets words, and changes no result.
MAX_WORDS = 800_000
MAX_WORD = 64
# Texts are split so many at a time, fewer where they have so many characters.
AT_ONCE = 2048
AT_ONCE_CHARACTERS = 4_000_000
# New words that are encoded as one text.
TOGETHER = 256

# Control characters and white space beyond ASCII that versions of Unicode see differently, and
# what special tokens begin with. Texts that have any are encoded in one piece.
ODD_ASCII = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")
ODD = (*ODD_ASCII, *map(chr, (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F)))
ODD += tuple(map(chr, (0x2060, 0x3000, 0xFEFF)))
# A word of letters that any version of Unicode calls so, with a blank before it or none.
LETTERS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")

# What bytes of UTF-8 are. An apostrophe is no mark: with the letters after it, it may be a part of its own.
SPACE, LETTER, MARK = 1, 2, 4
# The letters from À to ÿ are two bytes, of which the first is this; × and ÷, which lie among them, are none.
TWO_BYTES, NO_LETTERS = 0xC3, (0x97, 0xB7)


def _kind(char: str) -> int:
    if char in "\t\n\x0b\x0c\r ":
        return SPACE
    if char.isalpha():
        return LETTER
    return MARK if char in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~" else 0


KINDS = bytes(_kind(chr(b)) for b in range(128)) + bytes(128)
BLANKS = bytes(32 if kind == SPACE else b for b, kind in enumerate(KINDS))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def odd(text: str) -> bool:
    return any(x in text for x in (ODD_ASCII if text.isascii() else ODD))


def _lower(text: str) -> str:
    """Lower case where any version of Unicode has the same, the text as it is elsewhere."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text.lower()


def _starts(data: bytes, texts: np.ndarray) -> np.ndarray:
    """Where the parts of texts begin that stand in UTF-8 one after the other, the first byte of each at `texts`.

    A tokenizer that is byte-level puts one blank with the word after it, and of more white space all but the
    last character on its own. Letters and marks are never in one part.
    """
    chars, kinds = np.frombuffer(data, np.uint8), np.frombuffer(data.translate(KINDS), np.uint8)
    space, letter, mark = (kinds == kind for kind in (SPACE, LETTER, MARK))
    two = np.flatnonzero(chars[:-1] == TWO_BYTES)
    two = two[~np.isin(chars[two + 1], NO_LETTERS)]
    letter[two] = letter[two + 1] = True
    first = np.zeros(len(chars) + 1, bool)
    first[texts] = True
    ended = first[1:].copy()  # a text's last byte
    ended[-1:] = True
    here = first[:-1]
    here[1:] |= letter[1:] & mark[:-1] | mark[1:] & letter[:-1]
    here[1:] |= space[1:] & ~space[:-1] | ~space[1:] & space[:-1] & (chars[:-1] != 32)
    here[:-1] |= space[:-1] & ~space[1:] & ~ended[:-1]
    return np.flatnonzero(here)


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    Texts are split where the tokenizer always splits, so that its ids for the parts, put together,
    are its ids for the whole. A tokenizer that is not `byte_level` drops white space.
    """

    def __init__(self, path: str, byte_level: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.byte_level = byte_level
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        # What is put between words of letters: its id is in none of them.
        self.between = "\n" if byte_level else "."
        # The same tokenizer for words of small letters alone, or of any letters where it is byte-level: there is
        # nothing in them to normalise and nowhere to split them.
        self.words = Tokenizer(self.tokenizer.model)
        split = pre_tokenizers.Split(self.between, "isolated")
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        (self.mark,) = self.words.encode(self.between, add_special_tokens=False).ids

    def whole(self, texts: list[str]) -> list[bytes]:
        """Each text in one piece."""
        return [_packed(x.ids) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _split(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """(parts, number of parts before each text and after the last)."""
        own = [(text if self.byte_level else _lower(text)).encode() for text in texts]
        data = b"".join(own)
        if not self.byte_level:
            data = data.translate(BLANKS)
        bounds = np.append(0, np.cumsum(np.fromiter(map(len, own), np.int64, len(own))))
        starts = _starts(data, bounds[:-1])
        offsets = pa.py_buffer(np.append(starts, len(data)))
        parts = pa.LargeStringArray.from_buffers(len(starts), offsets, pa.py_buffer(data))
        return parts.dictionary_encode(), np.searchsorted(starts, bounds)

    def _letters(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words of letters; many are encoded as one text."""
        texts = [words[start : start + TOGETHER] for start in range(0, len(words), TOGETHER)]
        joined = [self.between.join(some) for some in texts]
        for some, found in zip(texts, self.words.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = np.flatnonzero(ids == self.mark).tolist()
            if len(ends) != len(some) - 1:
                raise ValueError("the tokenizer has no token of its own for what stands between words")
            ids = ids.tobytes()
            yield from (ids[4 * a : 4 * b] for a, b in zip([0, *(x + 1 for x in ends)], [*ends, len(ids) // 4]))

    def _learned(self, keys: list[str]) -> dict[str, bytes]:
        """Ids of new keys."""
        letters = list(filter(LETTERS.fullmatch, keys))
        # A word tokenizer lower-cases, so it has the same ids for a word in any case.
        words = letters if self.byte_level else [key.strip().lower() for key in letters]
        found = dict(zip(letters, self._letters(words)))
        others = [key for key in keys if key not in found]
        for start in range(0, len(others), 4096):
            some = others[start : start + 4096]
            found.update(zip(some, self.whole(some)))
        return found

    def _found(self, keys: list[str]) -> list[bytes]:
        """Ids of distinct keys."""
        found = list(map(self.known.get, keys))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if not missing:
            return found
        earlier = self.earlier
        learned = self._learned([key for key in (keys[i] for i in missing) if key not in earlier])
        for i in missing:
            key = keys[i]
            ids = found[i] = learned[key] if key in learned else earlier[key]
            if len(key) <= MAX_WORD:
                if len(self.known) >= MAX_WORDS // 2:
                    self.known, self.earlier = {}, self.known
                self.known[key] = ids
        return found

    def _joined(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of texts that are not odd, by their parts."""
        parts, before = self._split(texts)
        keys = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = pa.array(self._found(keys), pa.large_binary()).take(parts.indices)
        if not len(found):
            yield from (b"" for _ in texts)
            return
        _, ends, data = found.buffers()
        bounds = np.frombuffer(ends, np.int64)[before].tolist()
        data = memoryview(data)
        yield from (bytes(data[a:b]) for a, b in zip(bounds, bounds[1:]))

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text, in order."""
        for some in _some(texts):
            odds = list(map(odd, some))
            found = self._joined([text for text, o in zip(some, odds) if not o])
            for text, o in zip(some, odds):
                yield self.whole([text])[0] if o else next(found)


def _some(texts: Iterable[str]) -> Iterator[list[str]]:
    """Texts in order, as many as are split at a time."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if len(some) == AT_ONCE or size >= AT_ONCE_CHARACTERS:
            yield some
            some, size = [], 0
    if some:
        yield some


def give_back() -> None:
    """Return to the system what a worker's earlier tasks have freed; Arrow and the C library keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


@lru_cache(maxsize=4)
def encoder(path: str, byte_level: bool) -> Encoder:
    """One encoder for all tasks of a worker, which makes room for its words first."""
    give_back()
    return Encoder(path, byte_level)
