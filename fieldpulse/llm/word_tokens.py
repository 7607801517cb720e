"""Whole texts through a tokenizer that drops white space, word by word.

Such a tokenizer gives a text the ids of its words in order, so each distinct word is encoded
once while it stays in memory.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache
from itertools import compress
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_KEPT = 650_000  # words in memory, about 150 bytes each, and as many from before; a batch more still fits 2^20 slots
_TOGETHER = 300
_MARKS = b".,;:!?"
_ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_SPECIAL = b"<|"


def _visible_bytes() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself,
    or for bytes without one, the next from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Known(dict):
    """Ids by word, and those known before; words that both lack are noted and answered by None.

    The empty word, which texts with white space at an end have, is always known: it has no ids.
    """

    def __init__(self, before: _Known | None = None):
        self.before = {} if before is None else before
        if before is not None:
            before.before = {}
        self.lacking: set[bytes] = set()

    def __missing__(self, word: bytes) -> bytes | None:
        ids = self.before.get(word) if word else b""
        if ids is None:
            self.lacking.add(word)
        else:
            self[word] = ids
        return ids


class WordTokenizer:
    """Words through the tokenizers library, each distinct one once.

    A mark behind a letter or digit is a token of its own, so it is split off first; where the
    tokenizer folds case, so do the keys. A word of composed lower-case Latin letters passes
    normalisation and splitting unchanged and goes straight to the library's model, where a
    trial at the start shows the same ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known = _Known()
        self.folds = self._ids(b"AbC") == self._ids(b"abc")
        self.code = "H" if self.kind.itemsize == 2 else "I"  # as little-endian machines store them
        self.model = self.tokenizer.model
        self.letters = _visible_bytes()
        trial = ["a", "word", "thionatingly", "été", "straße", "ñandúes", "ÿþ", "zzzzqqqqxxxx"]
        self.direct = all(self._modelled(w.encode()) == self._ids(w.encode()) for w in trial)
        self.marks = {m: self._ids(bytes([m])) for m in _MARKS}
        self.splits = all(self._ids(b"word" + bytes([m])) == self._ids(b"word") + i for m, i in self.marks.items())

    def _ids(self, word: bytes) -> bytes:
        done = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False)
        return np.array(done.ids, self.kind).tobytes()

    def _modelled(self, word: bytes) -> bytes:
        shown = word.decode("latin-1")
        if not word.isalnum():  # of ASCII letters and digits, each stands for itself
            shown = shown.translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()

    @staticmethod
    def _is_plain(word: str) -> bool:
        """Only letters below U+0250 that lower case and composition leave as they are."""
        if not word.isalpha():
            return False
        if word.isascii():
            return word.islower()
        return max(word) < "\u0250" and word == word.lower() and is_normalized("NFC", word)

    def _learn(self, words: set[bytes]) -> None:
        """Encodes new words together and shares the ids out by their places."""
        known, marks = self.known, self.marks if self.splits else {}
        core_of = {
            w: w[:-1] if w[-1] in marks and len(w) > 1 and w[-2] in _ALNUM else w for w in words
        }
        fresh = [w for w in set(core_of.values()) if known[w] is None]  # from before, or noted once more
        texts = [w.decode("utf-8", "replace") for w in fresh]
        plain = [self.direct and self._is_plain(t) for t in texts]
        tokenize, code, letters = self.model.tokenize, self.code, self.letters
        for word in compress(fresh, plain):
            shown = word.decode("latin-1")
            if not word.isalnum():  # of ASCII letters and digits, each stands for itself
                shown = shown.translate(letters)
            known[word] = array(code, [t.id for t in tokenize(shown)]).tobytes()
        cores = [(w, t) for w, t, p in zip(fresh, texts, plain, strict=True) if not p]
        for start in range(0, len(cores), _TOGETHER):
            part = cores[start : start + _TOGETHER]
            done = self.tokenizer.encode(" ".join(t for _, t in part), add_special_tokens=False)
            first = np.cumsum([0, *(len(t) + 1 for _, t in part)])
            owner = np.searchsorted(first, [o[0] for o in done.offsets], "right") - 1
            edges = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(part))))) * self.kind.itemsize
            packed = np.array(done.ids, self.kind).tobytes()
            for (word, _), a, b in zip(part, edges.tolist(), edges[1:].tolist(), strict=False):
                known[word] = packed[a:b]
        for word, core in core_of.items():
            if core is not word:
                known[word] = known[core] + marks[word[-1]]
        known.lacking = set()

    def packed(self, texts: list[bytes], span: int = 1 << 22) -> list[bytes]:
        """Ids of each text as packed little-endian numbers of ``kind``."""
        if sum(map(len, texts)) > span:
            return [b"".join(self._run(p) for p in _parts(t, span)) for t in texts]
        return self._together(texts)

    def _run(self, text: bytes) -> bytes:
        return self._together([text])[0]

    def _together(self, texts: list[bytes]) -> list[bytes]:
        """Each distinct word of the texts is looked up once; ids are gathered by its number."""
        if len(self.known) > _KEPT:
            self.known = _Known(self.known)
        split = pa.array(texts, pa.binary()).view(pa.string())  # any bytes: nothing looks at characters
        if self.folds:
            if any(_SPECIAL in t for t in texts):
                split = pa.array([t if _SPECIAL in t else t.lower() for t in texts], pa.binary()).view(pa.string())
            else:
                split = pc.ascii_lower(split)
        split = pc.ascii_split_whitespace(split)
        coded = split.values.dictionary_encode()
        words = coded.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.__getitem__, words))
        if self.known.lacking:
            self._learn(self.known.lacking)
            known = self.known
            found = [known[w] if x is None else x for w, x in zip(words, found, strict=True)]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        ids = np.frombuffer(b"".join(found), self.kind)
        own = coded.indices.to_numpy()
        edges = np.concatenate(([0], np.cumsum(sizes[own])))
        starts = np.cumsum(sizes) - sizes
        ids = ids[np.repeat(starts[own] - edges[:-1], sizes[own]) + np.arange(edges[-1])]
        cuts = edges[split.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]


def _parts(text: bytes, span: int):
    """A text in parts of about ``span`` bytes, cut at white space."""
    start = 0
    while start < len(text):
        stop = min(start + span, len(text))
        while stop < len(text) and text[stop] not in b" \t\n\r\x0b\x0c":
            stop += 1
        yield text[start:stop]
        start = stop


@lru_cache(maxsize=4)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
