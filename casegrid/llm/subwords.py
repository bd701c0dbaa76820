"""Token ids by a public tokenizer file, word by word through a bounded cache.

`Subwords` gives exactly the ids that ``Tokenizer.encode(text, add_special_tokens=False)`` gives for a
tokenizer that drops white space. Words (maximal runs without ASCII white space) are then independent of
each other. A word of plain letters followed by plain punctuation is lower-cased, and its two parts have the
ids that they have as words; those go to the library's BPE model. Every other word goes through the library's
whole ``encode``.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
from tokenizers import Tokenizer

from casegrid.llm.common import OTHER_CACHES, forget_hashes

#: Words of the newer and of the older half of the cache.
CACHED_WORDS = 80_000

#: Letters of ASCII and Latin-1 (composed, with simple lower case), then ASCII punctuation without ' and <.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:;=-@\[-`{-~]*)")
_PUNCTUATION = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b not in b"'<")


def _byte_symbols() -> list[str]:
    """The printable character that byte-level BPE files write for each byte (a fixed convention)."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    symbols, spare = [""] * 256, 256
    for byte in range(256):
        symbols[byte] = chr(byte if byte in shown else spare)
        spare += byte not in shown
    return symbols


class Subwords:
    """Token ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, tokenizer_file: str):
        self._tokenizer = Tokenizer.from_file(tokenizer_file)
        self._model = self._tokenizer.model
        self._symbols = _byte_symbols()
        self._words = _Words(self)
        OTHER_CACHES.append(self._words)
        with open(tokenizer_file, encoding="utf-8") as file:
            spec = json.load(file)
        self._splits = _drops_white_space(spec)

    @property
    def vocabulary(self) -> int:
        return self._tokenizer.get_vocab_size()

    def encode(self, text: bytes | None) -> bytes:
        """The ids of a whole text; none for None."""
        if not text:
            return b""
        if not self._splits:
            return _packed(self._tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)
        return b"".join(map(self._words.__getitem__, text.split()))

    def _word(self, word: bytes) -> bytes:
        letters = word.rstrip(_PUNCTUATION)
        if letters.isalpha() or not letters:  # ASCII
            lowered, rest = letters.lower(), word[len(letters) :]
        else:
            text = word.decode("utf-8", "replace")
            plain = _PLAIN.fullmatch(text)
            if plain is None:
                return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids)
            lowered, rest = plain[1].lower().encode(), plain[2].encode()
        if lowered and (rest or lowered != word):
            return self._words.composed(word, self._words[lowered] + self._words[rest] if rest else self._words[lowered])
        symbols = word.decode() if word.isascii() else "".join(map(self._symbols.__getitem__, word))
        return _packed([token.id for token in self._model.tokenize(symbols)])


class _Words(dict):
    """The ids of words. When it is full, the words become the older half and what was there is forgotten; an older
    word that is met again is among the newer ones. Words put together from other words' ids are soon made again, so
    that fewer of them are kept, apart."""

    def __init__(self, owner: Subwords):
        super().__init__()
        self._owner, self._older, self._composed = owner, {}, {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self._composed.get(word)
        if ids is not None:
            return ids
        ids = self._older.get(word)
        if ids is None:
            ids = self._owner._word(word)
            if word in self._composed:
                return ids
        if len(self) >= CACHED_WORDS:
            self._older = dict(self)
            super().clear()
        self[word] = ids
        return ids

    def composed(self, word: bytes, ids: bytes) -> bytes:
        if len(self._composed) >= CACHED_WORDS // 2:
            self._composed.clear()
        self._composed[word] = ids
        return ids

    def clear(self) -> None:
        super().clear()
        self._older, self._composed = {}, {}


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes() if len(ids) > 16 else array("I", ids).tobytes()


def _drops_white_space(spec: dict) -> bool:
    """Whether the file lower-cases, splits letters from the rest and drops white space before BPE."""
    steps = [step.get("type") for step in (spec.get("normalizer") or {}).get("normalizers", [])]
    split = [step for step in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if step.get("type") == "Split"]
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and len(split) == 1
        and bool(split[0].get("invert"))
        and split[0]["behavior"] == "Removed"
        and r"[\p{L}]+" in split[0]["pattern"].get("Regex", "")
        and r"[^\s\p{L}\p{N}]+" in split[0]["pattern"].get("Regex", "")
    )


_LOADED: dict[str, Subwords] = {}


def subwords(tokenizer_file: str) -> Subwords:
    """One encoder per file and Python worker."""
    forget_hashes()
    if tokenizer_file not in _LOADED:
        _LOADED[tokenizer_file] = Subwords(tokenizer_file)
    return _LOADED[tokenizer_file]
