"""Token ids of texts by a public tokenizer file, with the distinct words of a task encoded once.

The tokenizer drops white space and never lets a token cross it, so a text's ids are those
of its words, one after the other. Each Python worker keeps a bounded cache from words to
ids; only words it hasn't seen reach the tokenizer.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

#: Words a worker remembers; the cache starts anew beyond that (some 200 MB).
CACHE_WORDS = 600_000
#: Bytes of a text that are split into words at a time.
SLICE = 1 << 20

# Words made of these characters alone are cut into runs of letters, single digits and runs of
# signs exactly as the tokenizer cuts them, and go straight to its merges; all other words go to
# the whole tokenizer.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f'[{_LETTERS}]+|[0-9]|[.,;:!?*&%$#()"]+')
_ALL_PLAIN = re.compile(f'[{_LETTERS}0-9.,;:!?*&%$#()"]+')
_LOADED: dict[str, WordTokenizer] = {}


def _byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordTokenizer(dict):
    """A byte-level tokenizer file that lower-cases and whose pre-tokenizer drops white space.

    As a dictionary it maps words, as UTF-8, to their ids in bytes, and learns missing ones.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.packed = [i.to_bytes(4, "little") for i in range(self.size)]
        self.characters = _byte_characters()
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        """Ids of a run of letters, a digit or a run of signs, lower-cased."""
        ids = self.parts.get(part)
        if ids is None:
            shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.characters)
            packed = self.packed
            ids = self.parts[part] = b"".join([packed[t.id] for t in self.merge(shown)])
        return ids

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if text.isascii() and text.isalpha():
            ids = self._part(text.lower())
        elif _ALL_PLAIN.fullmatch(text):
            ids = b"".join(map(self._part, _PLAIN.findall(text.lower())))
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        return ids

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit values."""
        for text in texts:
            yield b"".join(map(self._ids, _slices(text.encode())))

    def _ids(self, data: bytes) -> bytes:
        for cache in (self, self.parts):
            if len(cache) > CACHE_WORDS:
                cache.clear()
        return b"".join(map(self.__getitem__, data.split()))


def _slices(data: bytes) -> Iterator[bytes]:
    """A long text in pieces that end at a space or line break."""
    at = 0
    while at < len(data):
        end = min(len(data), at + SLICE)
        while end < len(data) and data[end] not in b" \n":
            end += 1
        yield data[at:end]
        at = end


def loaded(path: str) -> WordTokenizer:
    """The tokenizer of a file, read once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
