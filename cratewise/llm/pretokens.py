"""Pre-tokens ("words") of the lower-case word BPE vocabulary as arrays.

The vocabulary's text pipeline (NFC, white space, lower case, split) leaves
words that are merged independently of each other, so a text's ids are the ids
of its words one behind the other. Words are cut from the code points of many
texts at once, looked up by a 64-bit hash, compared character by character with
what the hash found, and encoded once per task.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
from tokenizers import Tokenizer

from cratewise.llm.words import U, characters, word_hashes

# Fixed values of the vocabulary file: white space, the strings that are one
# token, and the endings that form a word after an apostrophe.
SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPECIAL_TOKENS = {"<|startoftext|>", "<|endoftext|>"}
SPECIAL = re.compile("(" + "|".join(map(re.escape, sorted(SPECIAL_TOKENS))) + ")")
SHORT, LONG = "stmd", ("re", "ve", "ll")

# Words a task remembers before it starts anew, and code points of a slice.
REMEMBERED = 1_000_000
SLICE = 1 << 18

_BLANK, _LETTER, _NUMBER, _OTHER, _UNKNOWN = range(5)


@cache
def _kinds() -> np.ndarray:
    """The kind of every code point; one that this Unicode version does not know is marked."""
    kind = {"L": _LETTER, "N": _NUMBER}
    out = np.fromiter(
        (_UNKNOWN if (c := unicodedata.category(chr(i))) == "Cn" else kind.get(c[0], _OTHER) for i in range(sys.maxunicode + 1)),
        dtype=np.uint8, count=sys.maxunicode + 1,
    )
    out[SPACE] = _BLANK
    return out


def normal(text: str) -> str:
    """NFC and lower case, character by character (no rule for a last sigma)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def cut(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of lower-cased code points."""
    n = len(code)
    kind = _kinds()[code]
    change = np.r_[True, kind[1:] != kind[:-1]] if n else np.zeros(0, dtype=bool)
    opens = change | (kind == _NUMBER)
    ahead = np.r_[code, 0, 0]
    one, two = ahead[1 : n + 1], ahead[2 : n + 2]
    mark = np.flatnonzero((code == ord("'")) & change)
    short = np.isin(one[mark], [ord(c) for c in SHORT])
    long = np.zeros(len(mark), dtype=bool)
    for a, b in LONG:
        long |= (one[mark] == ord(a)) & (two[mark] == ord(b))
    for at, size in ((mark[short], 2), (mark[long], 3)):
        opens[at + 1] = False
        rest = at + size
        rest = rest[rest < n]
        opens[rest[kind[rest] == _LETTER]] = True
    blank = kind == _BLANK
    starts = np.flatnonzero(opens & ~blank)
    edge = np.flatnonzero(opens | blank)
    nxt = np.searchsorted(edge, starts, side="right")
    ends = np.r_[edge, n][nxt]
    return starts, ends


def _equal(code: np.ndarray, start: np.ndarray, end: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Whether each word has the characters of the word that ``like`` names."""
    same = (end - start) == (end - start)[like]
    if not len(start):
        return same
    first, place, at = characters(start, np.where(same, end, start + 1))
    model = np.repeat(start[like], np.diff(np.r_[first, len(place)])) + place
    return same & np.logical_and.reduceat(code[at] == code[model], first)


class WordTable:
    """Words a task has met, by hash, with what ``encode`` says of each."""

    def __init__(self, spec: str, encode: Callable[[list[str]], list]):
        self.tokenizer, self.encode = Tokenizer.from_str(spec), encode
        self.clear()

    def clear(self) -> None:
        self.keys, self.place, self.values = np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64), []
        self.words: dict[int, str] = {}

    def _add(self, keys: np.ndarray, words: list[str]) -> None:
        if len(self.keys) + len(keys) > REMEMBERED:
            self.clear()
        place = np.r_[self.place, len(self.values) + np.arange(len(keys))]
        self.words.update(zip(place[len(self.place):].tolist(), words))
        self.values.extend(self.encode(words))
        keys = np.r_[self.keys, keys]
        order = np.argsort(keys, kind="stable")
        self.keys, self.place = keys[order], place[order]

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, hashes), max(len(self.keys) - 1, 0))
        known = self.keys[at] == hashes if len(self.keys) else np.zeros(len(hashes), dtype=bool)
        return at, known

    def places(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(start, index into ``values``) of every word of normalized text."""
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        start, end = cut(code)
        hashes = word_hashes(code, start, end)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        _, known = self._find(distinct)
        if not known.all():
            if len(self.keys) + len(distinct) > REMEMBERED:
                self.clear()
                known = np.zeros(len(distinct), dtype=bool)
            new = np.flatnonzero(~known)
            self._add(distinct[new], [text[start[i] : end[i]] for i in first[new]])
        at, _ = self._find(distinct)
        places = self.place[at]
        other = ~_equal(code, start, end, first[inverse])
        meant = np.fromiter((self.words[p] == text[start[i] : end[i]] for p, i in zip(places.tolist(), first)), dtype=bool, count=len(first))
        other |= ~meant[inverse]
        found = places[inverse]
        if other.any():  # another word with the same hash: such words are encoded where they stand
            odd = np.flatnonzero(other)
            found[odd] = len(self.values) + np.arange(len(odd))
            self.values.extend(self.encode([text[start[i] : end[i]] for i in odd]))
        return start, found

    def _odd(self, text: str) -> list[str]:
        """Words of a text with special strings, or with characters only the library knows."""
        back = {c: b for b, c in enumerate(byte_symbols())}
        out = []
        for part in SPECIAL.split(text):
            if SPECIAL.fullmatch(part):
                out.append(part)
            elif part:
                shown = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(part))
                out.extend(bytes(back[c] for c in word).decode() for word, _ in shown)
        return out

    def rows(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The indices of each text's words, in order. Use them before the next one is asked for."""
        done = 0
        while done < len(texts):
            stop, size = done, 0
            while stop < len(texts) and (stop == done or size + len(texts[stop]) <= SLICE):
                size += len(texts[stop]) + 1
                stop += 1
            part = texts[done:stop]
            done = stop
            clean = [normal(x) for x in part]
            joined = "\n".join(clean)
            odd = "<|" in joined or not joined.isascii()
            strange = set()
            if odd:
                strange = {i for i, x in enumerate(part) if "<|" in x and SPECIAL.search(x)}
                strange |= {i for i, x in enumerate(part) if _unknown(x)}
                clean = ["" if i in strange else x for i, x in enumerate(clean)]
                joined = "\n".join(clean)
            start, place = self.places(joined)
            edges = np.searchsorted(start, np.cumsum([0] + [len(x) + 1 for x in clean]))
            found = [place[a:z] for a, z in zip(edges, edges[1:])]
            for i in sorted(strange):
                found[i] = None
            for i, own in enumerate(found):
                if own is None:
                    words = self._odd(part[i])
                    base = len(self.values)
                    self.values.extend(self.encode(words))
                    own = base + np.arange(len(words))
                yield own


def _unknown(text: str) -> bool:
    if text.isascii() or not _LATER.search(text):
        return False
    return bool((_kinds()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)] == _UNKNOWN).any())


# No code point below this one is unassigned.
_LATER = re.compile("[͸-\U0010ffff]")


@cache
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]
