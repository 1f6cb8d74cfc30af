"""Token ids of whole texts, a part at a time.

A tokenizer that drops white space gives a text the ids of its pre-tokenized parts
one after another, so each distinct part is tokenized once a worker and then looked up.
A text of ASCII and Latin-1 letters, which its normalizer only lower-cases, is cut
into parts at once; of any other text, words of such letters are, and any other
word takes the full tokenizer.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
from tokenizers import Tokenizer
from tokenizers.models import BPE

#: Parts that a worker holds at a time, and words of other texts: as many again of
#: those it held before.
HELD, HELD_WORDS = 300_000, 30_000

_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PLAIN_TEXT = re.compile(r"[\t-\r !-~À-ÖØ-öø-ÿ]*")
_LETTERS = "a-zA-ZÀ-ÖØ-öø-ÿ"
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9\s]+")
#: The pre-tokenizer pattern that _PARTS stands for, on plain words.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level merge tables."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        self.full = Tokenizer.from_file(path)
        steps = json.loads(self.full.normalizer.__getstate__()) if self.full.normalizer else {}
        cuts = json.loads(self.full.pre_tokenizer.__getstate__()) if self.full.pre_tokenizer else {}
        first = cuts.get("pretokenizers", [{}])[0]
        self.by_word = [x.get("type") for x in steps.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] \
            and first.get("pattern") == {"Regex": _PATTERN} and bool(first.get("invert")) and isinstance(self.full.model, BPE)
        self.special = re.compile(b"|".join(re.escape(x.content.encode()[:2]) for x in self.full.get_added_tokens_decoder().values()) or b"(?!)")
        self.model, self.letters = self.full.model, _byte_letters()
        self.words: dict[bytes, bytes] = {}
        self.words_before: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.parts_before: dict[str, bytes] = {}

    def _all(self, text: str) -> bytes:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.parts_before.get(part)
            if ids is None:
                shown = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
                ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            if len(self.parts) >= HELD:
                self.parts_before, self.parts = self.parts, {}
            self.parts[part] = ids
        return ids

    def _word(self, word: bytes) -> bytes:
        ids = self.words_before.get(word)
        if ids is None:
            text = word.decode()
            if _PLAIN.fullmatch(text) and not self.special.search(word):
                ids = b"".join(map(self._part, _PARTS.findall(text.lower())))
            else:
                ids = self._all(text)
        if len(self.words) >= HELD_WORDS:
            self.words_before, self.words = self.words, {}
        self.words[word] = ids
        return ids

    def __call__(self, text: bytes) -> bytes:
        if not self.by_word:
            return self._all(text.decode())
        plain = text.decode()
        if _PLAIN_TEXT.fullmatch(plain) and not self.special.search(text):
            held = self.parts.get
            return b"".join([held(p) or self._part(p) for p in _PARTS.findall(plain.lower())])
        known = self.words.get
        return b"".join([known(w) or self._word(w) for w in text.split()])


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One tokenizer a worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
