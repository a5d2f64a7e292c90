"""Exact tokenizing with a cache of words.

Both public BPE vocabularies split a text before merging, and never across the gap between a
non-space and a single following blank or line feed. So the ids of a text are the ids of its words,
one after another, and a bounded cache of words answers nearly all of them. A word-end vocabulary
drops white space, so any text is its words. For a byte-level one, blanks count: texts with other
white space than single blanks and line feeds between words are encoded whole, and so are texts with
what may be a special token.
"""

from __future__ import annotations

import gc
import os
import re

import numpy as np

from . import common

#: Words in one generation of the cache; at most two generations are held: a bound on a worker's memory
#: (some 15 MB for 100,000 words). Ids do not depend on it.
CACHE_WORDS = 600_000
#: Longer words are encoded, not kept.
LONGEST_KEPT = 48
#: New words that are encoded as one text.
TOGETHER = 500
#: A word that has this (what any tokenizer may take for white space, what may be a special token), or
#: nothing but a line feed, does not stand for itself.
ODD = re.compile(r"^\n?$|.\n|[^\S\n]|[\x00-\x09\x0b-\x1f\x7f-\xa0\xad\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]|<\|", re.S)

#: A word and the ASCII marks after it, which both vocabularies part before they merge.
ENDING = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]{1,4})")


def tokenizer_path(name: str) -> str:
    """Path of a public vocabulary file; the package is outside the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """ids(texts) for a byte-level BPE (blanks_count: a blank belongs to the word after it) or a
    word-end BPE (white space is dropped). Results equal encode_batch of whole texts."""

    def __init__(self, path: str, blanks_count: bool, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.blanks_count, self.cache_words = blanks_count, cache_words
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.endings: dict[str, bytes] = {}
        feed = self._encode(["\n"])[0] if blanks_count else b""
        self.feed = len(feed)
        #: the single id of what parts words that are encoded together, where it has one
        mark = feed if blanks_count else self._encode(["\x01"])[0]
        self.mark = int.from_bytes(mark, "little") if len(mark) == 4 else None

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, text: str) -> list[str]:
        """The words, where blanks count the first of a line with the line feed before it."""
        if self.blanks_count:
            return f"\n{text}".replace("\n", " \n").split(" ")[1:] if text else []
        return text.replace("\n", " ").split(" ")

    def _together(self, table: dict[str, bytes], words: list[str], before: str, alone: str, keep: int) -> None:
        """Add words and their ids to table, many encoded as one text: each has `before` before it, which
        holds the mark, and its ids begin `keep` bytes after the mark. Where the marks do not show,
        each is encoded with `alone` before it."""
        for k in range(0, len(words), TOGETHER):
            part = words[k : k + TOGETHER]
            ids = np.frombuffer(self._encode(["".join([before + w for w in part])])[0], "<u4")
            at = np.flatnonzero(ids == self.mark).tolist() if self.mark is not None else []
            if len(at) == len(part):
                raw = ids.tobytes()
                table.update(zip(part, [raw[4 * a + keep : 4 * b] for a, b in zip(at, [*at[1:], len(ids)], strict=True)], strict=True))
            else:
                table.update(zip(part, self._encode([alone + w for w in part]), strict=True))

    def _add(self, table: dict[str, bytes], words: list[str]) -> None:
        """Add new words and their ids, each after a blank where blanks count, or after its line feed."""
        if self.blanks_count:
            self._together(table, [w for w in words if w[:1] != "\n"], "\n ", " ", 4)
            self._together(table, [w for w in words if w[:1] == "\n"], "", "", 0)
        else:
            self._together(table, [w for w in words if w and "\x01" not in w], " \x01 ", "", 4)
            rest = [w for w in words if not w or "\x01" in w]
            table.update(zip(rest, self._encode(rest), strict=True))

    def _ending(self, marks: str) -> bytes:
        """The ids of marks that follow a letter."""
        if (ids := self.endings.get(marks)) is None:
            if len(self.endings) > 10_000:
                self.endings.clear()
            ids = self.endings[marks] = self._encode([marks])[0]
        return ids

    def _learn(self, pieces: list[list[str]]) -> tuple[dict[str, bytes], set[str]]:
        """A table that has every piece that stands for itself, and the pieces that do not; what is
        worth it stays for later calls."""
        young, old, blanks = self.young, self.old, self.blanks_count
        if len(young) > self.cache_words:
            self.old, self.young = old, young = young, {}
        wanted: set[str] = set()
        for p in pieces:
            wanted.update(p)
        wanted.difference_update(young.keys())
        fresh, odd, derived = set(), set(), []
        for w in wanted:
            if (ids := old.get(w)) is not None:
                young[w] = ids
            elif blanks and not (w.isprintable() and w and "<|" not in w) and ODD.search(w):
                odd.add(w)
            else:
                m = ENDING.fullmatch(w)
                stem, marks = m.groups() if m else (w, "")
                if not blanks and stem.isascii():  # the word-end vocabulary knows no case
                    stem = stem.lower()
                if stem is w:
                    fresh.add(w)
                else:
                    derived.append((w, stem, marks))
                    if stem not in young:
                        if (ids := old.get(stem)) is not None:
                            young[stem] = ids
                        else:
                            fresh.add(stem)
        long: dict[str, bytes] = {}
        self._add(young, [w for w in fresh if len(w) <= LONGEST_KEPT])
        self._add(long, [w for w in fresh if len(w) > LONGEST_KEPT])
        for w, stem, marks in derived:
            ids = young[stem] if stem in young else long[stem]
            (young if len(w) <= LONGEST_KEPT else long)[w] = ids + self._ending(marks) if marks else ids
        return ({**young, **long} if long else young), odd

    def ids(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        collects = gc.isenabled()
        gc.disable()  # what is made here has no cycles, and there is much of it
        try:
            return self._ids(texts)
        finally:
            if collects:
                gc.enable()

    def _ids(self, texts: list[str]) -> list[bytes]:
        pieces = [self._pieces(t) for t in texts]
        table, odd = self._learn(pieces)
        get, skip = table.__getitem__, self.feed
        whole = [bool(odd) and not odd.isdisjoint(p) for p in pieces]
        hard = iter(self._encode([t for t, w in zip(texts, whole, strict=True) if w]))
        return [next(hard) if w else b"".join(map(get, p))[skip:] for p, w in zip(pieces, whole, strict=True)]


_encoders: dict[tuple[str, bool, int], Encoder] = {}


def encoder(path: str, blanks_count: bool, cache_words: int = CACHE_WORDS) -> Encoder:
    """This worker's encoder: tasks that follow one another in a worker share its cache."""
    key = (path, blanks_count, cache_words)
    common.hold(f"encoder {key}", _encoders.clear)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def forget() -> None:
    """Release this worker's encoder and its cache."""
    _encoders.clear()
