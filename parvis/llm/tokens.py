"""Token ids of many texts at once, equal to those of the tokenizer file.

The tokenizer lower-cases a text, cuts it by a pattern and encodes each cut on its own. For
texts of Latin letters the cuts are found here with arrays, hashed, and looked up among the
cuts already encoded, whose letters are compared; the tokenizer encodes each new one once.
Cuts of more than ``LONGEST`` letters, and those whose hash belongs to other letters, are
encoded every time. Any other text, and one that may hold a special token, goes through the
whole tokenizer.
"""

from __future__ import annotations

import re
import sys
import types
import unicodedata

import numpy as np

SPACE, LETTER, DIGIT, OTHER = range(4)
BASE = 0x9E3779B97F4A7C15
SPAN = 1 << 18
"""Characters looked at together."""


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def word_tokens(path: str) -> WordTokens:
    """One instance per process, so that the tasks of a worker share what it has encoded."""
    held = sys.modules.setdefault("parvis_llm_word_tokens", types.ModuleType("parvis_llm_word_tokens"))
    if path not in held.__dict__:
        held.__dict__[path] = WordTokens(path)
    return held.__dict__[path]


class WordTokens:
    CACHE = 500_000
    """Cuts remembered; beyond that the memory starts anew."""
    LONGEST = 64
    """Letters of a cut that is remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.words = Tokenizer(self.full.model)
        self.words.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)
        self.unusual = re.compile("[^\\x00-\\u012f\\u0131-\\u017f]").search
        kinds = {"L": LETTER, "N": DIGIT}
        self.kind = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x180)], np.uint8)
        self.kind[[*range(9, 14), 32, 0x85, 0xA0]] = SPACE
        self.power = np.cumprod(np.append(np.uint64(1), np.full(SPAN, BASE, np.uint64)), dtype=np.uint64)
        self.inverse = np.cumprod(np.append(np.uint64(1), np.full(SPAN, pow(BASE, -1, 2**64), np.uint64)), dtype=np.uint64)
        self.forget()

    def forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.at, self.count = np.empty(0, np.int32), np.empty(0, np.int32)
        self.flat = np.empty(0, "<u4")
        self.size, self.letters_at, self.letters = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, "<u2")

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        found: list = [None] * len(texts)
        group, size = [], 0
        for i, text in enumerate(texts):
            special = "<|" in text or (not text.isascii() and self.unusual(text))
            if special or len(text) >= SPAN - 1:
                found[i] = np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4")
                continue
            if size + len(text) + 1 > SPAN:
                self._together(texts, group, found)
                group, size = [], 0
            group.append(i)
            size += len(text) + 1
        self._together(texts, group, found)
        return found

    def _together(self, texts: list[str], group: list[int], found: list) -> None:
        if not group:
            return
        lowered = [texts[i].lower() for i in group]
        whole = " ".join(lowered)
        codes = np.frombuffer(whole.encode("utf-16-le"), "<u2")
        starts, ends = self.cuts(codes)
        hashes = self.hashes(codes, starts, ends)
        place = self.look_up(whole, codes, starts, ends, hashes)
        direct = np.flatnonzero(place < 0)
        encoded, sizes = self.encode([whole[a:b] for a, b in zip(starts[direct].tolist(), ends[direct].tolist())])
        held = np.flatnonzero(place >= 0)
        count = np.empty(len(starts), np.int64)
        count[held], count[direct] = self.count[place[held]], sizes
        until = np.cumsum(count)
        flat = np.empty(int(until[-1]) if len(until) else 0, "<u4")
        remembered = np.repeat(place >= 0, count)
        flat[remembered] = self.flat[_runs(self.at[place[held]], count[held])]
        flat[~remembered] = encoded
        lengths = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
        # Ids before the first cut that starts at or after the end of each text.
        stop = np.append(0, until)[np.searchsorted(starts, np.cumsum(lengths))]
        for i, a, b in zip(group, np.append(0, stop[:-1]).tolist(), stop.tolist()):
            found[i] = flat[a:b]

    def cuts(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of 's|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+ (fixed) in lower-case text."""
        kind = self.kind[codes]
        n = len(kind)
        first = np.empty(n + 1, bool)
        first[0] = first[n] = True
        first[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        quotes = np.flatnonzero(codes == ord("'"))
        quotes = quotes[(quotes == 0) | (kind[quotes - 1] != OTHER)]
        padded = np.append(codes, np.zeros(2, codes.dtype))
        one, two = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quotes), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        for which, size in ((short, 2), (long, 3)):
            first[quotes[which] + 1] = False
            first[quotes[which] + size] = True
        at = np.flatnonzero(first)
        starts, ends = at[:-1], at[1:]
        words = kind[starts] != SPACE
        return starts[words], ends[words]

    def hashes(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total = np.empty(len(codes) + 1, np.uint64)
        total[0] = 0
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.power[: len(codes)], out=total[1:])
        value = (total[ends] - total[starts]) * self.inverse[starts]
        value ^= value >> np.uint64(29)
        return value * np.uint64(0xBF58476D1CE4E5B9) + (ends - starts).astype(np.uint64)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all cuts one after the other, and their number for each."""
        encoded = self.words.encode(words, is_pretokenized=True, add_special_tokens=False)
        return np.array(encoded.ids, "<u4"), np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(words))

    def look_up(self, whole: str, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Where each cut is kept, after encoding the new ones; -1 for those that are not."""
        if len(self.keys) > self.CACHE:
            self.forget()
        size = ends - starts
        place = np.searchsorted(self.keys, hashes)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == hashes[known]
        missing = np.flatnonzero(~known & (size <= self.LONGEST))
        if len(missing):
            new, which = np.unique(hashes[missing], return_index=True)
            which = missing[which]
            ids, count = self.encode([whole[a:b] for a, b in zip(starts[which].tolist(), ends[which].tolist())])
            at = len(self.flat) + np.cumsum(count) - count
            letters_at = len(self.letters) + np.cumsum(size[which]) - size[which]
            self.flat = np.append(self.flat, ids)
            self.letters = np.append(self.letters, codes[_runs(starts[which], size[which])])
            where = np.searchsorted(self.keys, new)
            self.keys, self.at, self.count = np.insert(self.keys, where, new), np.insert(self.at, where, at), np.insert(self.count, where, count)
            self.size, self.letters_at = np.insert(self.size, where, size[which]), np.insert(self.letters_at, where, letters_at)
        if not len(self.keys):
            return np.full(len(starts), -1)
        place = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        place[(self.size[place] != size) | (size > self.LONGEST)] = -1
        some = np.flatnonzero(place >= 0)
        same = codes[_runs(starts[some], size[some])] == self.letters[_runs(self.letters_at[place[some]], size[some])]
        if not same.all():
            place[some[~np.logical_and.reduceat(same, np.cumsum(size[some]) - size[some])]] = -1
        return place


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of runs with these starts and sizes, one run after the other."""
    before = np.cumsum(sizes) - sizes
    places = np.repeat((starts - before).astype(np.int32), sizes)
    places += np.arange(len(places), dtype=np.int32)
    return places
