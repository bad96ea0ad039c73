"""Token ids of whole texts, with a bounded cache of white-space separated words.

The normaliser and pre-tokeniser of ``word_bpe_49k.json`` never join characters
across white space and drop it, so a text's ids are the ids of its words one
after the other.  Words repeat; each is given to the ``tokenizers`` library
once per Python worker.  The cache holds two generations of ``CACHE_WORDS``:
when the younger is full it becomes the older, and words met again move up.

A word of plain Latin letters (below U+0250), is one pre-token and a run of
``MARKS`` behind it another, so the library's BPE model gets them without the
normaliser in front; every other word takes the library's whole way.  That holds
for a file with this normaliser and pre-tokeniser only (compared when it is read);
texts for any other file take the library's whole way."""

from __future__ import annotations

import gc
import json
import sys
from array import array

import numpy as np

CACHE_WORDS = 200_000
LONG_WORD = 40
MARKS = ".,!?;:%$#&*|"
# --- fixed values: what the short cuts rely on in a tokeniser file -------------
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
                                                  {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The printable character that byte-level BPE writes for each byte: the byte's
    own character where it is printable, else the next one from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordEncoder(dict):
    """Encodes texts to little-endian unsigned 32-bit ids (no special tokens added).

    The mapping itself is the cache: word (UTF-8) -> ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        self.by_word = parts["normalizer"] == NORMALIZER and parts["pre_tokenizer"] == PRE_TOKENIZER and parts["model"]["type"] == "BPE"
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.older: dict[bytes, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _letters(self, word: str) -> bytes:
        word = word.lower()
        if not word.isascii():
            word = "".join([self.letters[b] for b in word.encode()])
        ids = array("I", [t.id for t in self.model.tokenize(word)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _ids(self, raw: bytes) -> bytes:
        word = raw.decode()
        stem = word.rstrip(MARKS)
        if stem.isalpha() and (stem.isascii() or max(stem) < "ɐ" and "İ" not in stem):
            marks = word[len(stem):]
            return self._letters(stem) + (self[marks.encode()] if marks else b"")
        return self.whole(word)

    def __missing__(self, raw: bytes) -> bytes:
        ids = self.older.get(raw)
        if ids is None:
            ids = self._ids(raw)
        if len(self) >= CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        if len(raw) <= LONG_WORD:
            self[raw] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_word:
            return self.whole(text)
        raw = text.encode()
        # ASCII lower case shares cache entries; not where a combining mark may
        # follow the letter (U+0300 to U+037F) or a special token may be spelled
        if b"\xcc" not in raw and b"\xcd" not in raw and b"<|" not in raw:
            raw = raw.lower()
        return b"".join(map(self.__getitem__, raw.split()))


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and tokeniser file.  The package travels to the
    workers by value, anew for each task, so what outlives a task is kept on a
    module that the worker imports itself."""
    import tokenizers

    kept = vars(tokenizers).setdefault("word_encoders_by_file", {})
    if path not in kept:
        kept[path] = WordEncoder(path)
        gc.freeze()  # once: the collector need not walk the cache each time
    return kept[path]
