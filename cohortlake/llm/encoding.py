"""Token ids of whole texts, from a vocabulary file of the tokenizers library.

A byte-level tokenizer splits a text before it merges bytes. Of a run of white
space it takes all but the last character as one piece, and a last space belongs
to the word behind it. So a text can be cut before each space that follows no
white space or precedes none; the pieces are those of the whole text. Every
distinct cut is encoded once for the texts that hold it, many cuts in one call,
and the ids are joined. Strings of added tokens are taken out of the text first,
as the library does.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np

from .common import remember_only

#: Cuts of one generation that a worker remembers; it keeps two, of about 220 bytes a cut, so at most some 30 MB with the last batch.
MOST_REMEMBERED = 60_000
#: Characters of text that are cut at once.
CHUNK_CHARS = 500_000
#: Cuts that one call of the library encodes as one text.
JOINED = 200
# The white space of the tokenizer's patterns.
_WHITE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_UNSAFE = re.compile(rf" (?<=[{_WHITE}] )(?:[{_WHITE}]|\Z)")
_SAFE = re.compile(rf"(?<![{_WHITE}]) | (?=[^{_WHITE}])")
# Marks that end words; one or two of them behind a Latin letter are a piece of their own.
_MARKS = ".,;:!?)\""
_LATIN_END = 0x250
_LOADED: dict[str, Encoder] = {}


def _bytes(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def cut(text: str) -> list[str]:
    """The text's cuts, each but the first without its leading space."""
    return _SAFE.split(text) if _UNSAFE.search(text) else text.split(" ")


class Encoder:
    def __init__(self, path: str, most: int = MOST_REMEMBERED):
        self.most = most
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        self.added = re.compile("(" + "|".join(re.escape(x.content) for x in sorted(added, key=lambda x: -len(x.content))) + ")") if added else None
        if any(x.lstrip or x.rstrip or x.single_word for x in added):
            raise ValueError("an added token of this vocabulary takes in what surrounds it")
        words = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(words.values()) + 1, bool)  # tokens that begin with a space
        self.spaced[[i for word, i in words.items() if word.startswith("Ġ")]] = True
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str if self.tokenizer.pre_tokenizer else lambda x: [x]
        tails = [*_MARKS, *(a + b for a in _MARKS for b in _MARKS)]
        self.tails = dict(zip(tails, self.whole(tails), strict=True)) if all(len(split(" a" + x)) == 2 for x in tails) else {}
        self.known: dict[str, bytes] = {}  # by the cut without its leading space
        self.old: dict[str, bytes] = {}

    def segments(self, text: str) -> list[str]:
        """The text between added tokens, and these."""
        return [x for x in self.added.split(text) if x] if self.added and self.added.search(text) else [text]

    def whole(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, by the library alone."""
        return [_bytes(x.ids) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, cut: str) -> tuple[str, str] | None:
        """The word and the marks behind it, where the tokenizer parts them."""
        word = cut.rstrip(_MARKS)
        tail = cut[len(word) :]
        return (word, tail) if word and tail in self.tails and word[-1].isalpha() and ord(word[-1]) < _LATIN_END else None

    def _learn(self, cuts: set[str]) -> None:
        """Encode cuts that are not known: words once for all the marks that follow them."""
        parted = {x: parts for x in cuts if x and x[-1] in _MARKS and (parts := self._parts(x))}
        words = {word for word, _ in parted.values()}.difference(self.known)
        back = {x: self.old[x] for x in words if x in self.old}
        self.known.update(back)
        self._encode(cuts.difference(parted) | words.difference(back))
        self.known.update((x, self.known[word] + self.tails[tail]) for x, (word, tail) in parted.items())

    def _encode(self, cuts: set[str]) -> None:
        """Encode cuts by the library; those without white space at their ends or spaces inside share calls."""
        plain = [x for x in cuts if x and x.strip(_WHITE) == x and " " not in x]
        other = list(cuts.difference(plain))
        groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast([" " + " ".join(x) for x in groups], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            raw, at = ids.tobytes(), (4 * np.flatnonzero(self.spaced[ids])).tolist()
            self.known.update(zip(group, [raw[i:j] for i, j in zip(at, [*at[1:], len(raw)], strict=True)], strict=True))
        self.known.update(zip(other, self.whole([" " + x for x in other]), strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        owner, begin, rest = [], [], []
        for i, text in enumerate(texts):
            for segment in self.segments(text) if text else ():
                first, *others = cut(segment)
                owner.append(i)
                begin.append(first)
                rest.append(others)
        # One look at every cut: those that are not known leave gaps, which are filled when they are learned.
        get = self.known.get
        found = [list(map(get, others)) for others in rest]
        gaps = [[k for k, ids in enumerate(x) if ids is None] for x in found]
        new = {others[k] for others, gap in zip(rest, gaps, strict=True) for k in gap}
        back = {x: self.old[x] for x in new if x in self.old}
        self.known.update(back)
        self._learn(new.difference(back))
        for others, x, gap in zip(rest, found, gaps, strict=True):
            for k in gap:
                x[k] = self.known[others[k]]
        out = [b""] * len(texts)
        for i, first, x in zip(owner, self.whole(begin) if begin else (), found, strict=True):
            ids = first + b"".join(x)
            out[i] = out[i] + ids if out[i] else ids
        if len(self.known) > self.most:
            self.old, self.known = self.known, {}
        return out


def encoder(path: str, most: int = MOST_REMEMBERED) -> Encoder:
    """The worker's encoder of this vocabulary file, which remembers at most two generations of `most` cuts."""
    remember_only("encoder", _LOADED.clear)
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    _LOADED[path].most = most
    return _LOADED[path]
