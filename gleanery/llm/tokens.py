"""Token ids by the tokenizers library, with a bounded cache of words per Python worker.

Merges never cross a word border of the tokenizer's own pre-tokenizer, so the ids of a text are the
ids of its words one after another. Words repeat a lot; each worker encodes a word once and keeps
its ids until the cache is full. The two word splitters below cut only where the pre-tokenizer of
their kind of file always cuts; a text with separators on which Python's and the library's notion
of white space differ is encoded as it stands.
"""

from __future__ import annotations

import gc
import json
import os
import re
from itertools import chain

import numpy as np

from .common import release

MAX_WORDS, MAX_IDS = 900_000, 8_000_000  # a few hundred bytes a word, in every worker
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Letter runs before white space, a comma or a full stop stand alone; what follows is as the file's own pattern has it.
_LEADING = re.compile(rf"[ ]?[{_LATIN}]+(?=[\s.,]|$)|\n(?=\S)|[ \n]?\S+|\s+(?!\S)|\s+")
_BARE = re.compile(rf"[{_LATIN}]+(?=[\s.,]|$)|\S+")
_ODD = re.compile("[\x1c-\x1f]")
#: The public byte alphabet of byte-level vocabularies: printable bytes stand for themselves, the others for 256 and up.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}


class WordEncoder:
    """Encodes batches of whole texts; one per worker and tokenizer file."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        self.max_words = max_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.split, self.plain = _splitter(path)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def ids_of(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; plain words are one pre-token, so the library's model takes them as they are."""
        out: list = [None] * len(words)
        rest = []
        tokenize, plain = self.model.tokenize, self.plain
        for i, w in enumerate(words):
            known = plain and plain(w)
            if known:
                out[i] = [t.id for t in tokenize(known)]
            else:
                rest.append(i)
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def learn(self, words: list[str]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.index]
        if not new:
            return
        ids = self.ids_of(new)
        at = len(self.index)
        self.index.update(zip(new, range(at, at + len(new))))
        ends = self.starts[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        self.starts = np.concatenate([self.starts, ends])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(ends[-1] - len(self.flat)))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one text after another, and where each text's ids start (one more at the end)."""
        if len(self.index) > self.max_words or len(self.flat) > MAX_IDS:
            self.clear()
        words: list[str] = []
        upto = np.zeros(len(texts) + 1, np.int64)
        for i, t in enumerate(texts):
            words += self.split(t) if self.split and not _ODD.search(t) else [t]
            upto[i + 1] = len(words)
        self.learn(words)
        place = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        lengths = self.starts[place + 1] - self.starts[place]
        total = np.zeros(len(words) + 1, np.int64)
        np.cumsum(lengths, out=total[1:])
        ids = self.flat[np.repeat(self.starts[place] - total[:-1], lengths) + np.arange(total[-1])]
        return ids, total[upto]


def _spaced(word: str) -> str | None:
    """The byte alphabet's form of a letter run with at most one leading space, else None."""
    if not word.lstrip(" ").isalpha():
        return None
    if word.isascii():
        return word.replace(" ", "\u0120")
    return "".join(map(_ALPHABET.__getitem__, word.encode())) if max(word) <= "\xff" else None


def _lowered(word: str) -> str | None:
    if not word.isalpha():
        return None
    if word.isascii():
        return word.lower()
    return "".join(map(_ALPHABET.__getitem__, word.lower().encode())) if max(word) <= "\xff" and not _NOT_LETTERS & set(word) else None


#: Latin-1 characters that isalpha() takes but that the splitters above leave to the library.
_NOT_LETTERS = {"\xaa", "\xb5", "\xba"}


def _splitter(path: str):
    """(split, plain form) that are safe for this file's pre-tokenizer, or (None, None): whole texts are then encoded."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, normalizer = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not normalizer:
        return _LEADING.findall, _spaced
    steps = pre.get("pretokenizers") or [{}]
    pattern = steps[0].get("pattern", {}).get("Regex", "")
    kinds = [x.get("type") for x in (normalizer or {}).get("normalizers", [])]
    if steps[0].get("type") == "Split" and steps[0].get("invert") and steps[0].get("behavior") == "Removed" and pattern.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+") and kinds == ["NFC", "Replace", "Lowercase"]:
        return _BARE.findall, _lowered
    return None, None


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str, max_words: int = MAX_WORDS) -> WordEncoder:
    """The worker's encoder for this file; what earlier tasks of the worker have freed goes back to the system."""
    gc.collect()
    release()
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    _encoders[path].max_words = max_words
    return _encoders[path]
