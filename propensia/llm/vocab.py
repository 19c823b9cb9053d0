"""Encoding whole texts by way of their distinct chunks.

A text is cut only where the tokenizer itself always cuts, so the ids of the
text are the ids of its chunks one after the other. Each distinct chunk is
encoded by the tokenizer library when a Python worker first meets it; the chunk
table is a cache (when it is full, chunks met only once leave it) and never changes a result.
A Python worker outlives its task and serves other operators after it: it holds the table of one
operator at a time, bounded in bytes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from itertools import chain, repeat

import numpy as np

#: A space between two characters that aren't white space: byte-level patterns
#: start a match at that space, whatever stands around it.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r"\s\s|^\s|\s$|[\x1c-\x1f]")

#: Punctuation that tokenizers split off after a letter (the apostrophe, which starts contractions, isn't in it).
TAIL = ".,!?;:*#$%&|()[]{}<>-_=+/\\\"~^@"


#: Estimated bytes of a table beyond its chunks' characters and ids, for each chunk; and the most of a table in all.
CHUNK_BYTES, TABLE_BYTES = 160, 88 << 20

_held: ChunkTable | None = None   # the table that this worker used last


Runs = tuple[list[str], np.ndarray, np.ndarray]   # chunks, all their ids, number of ids of each


def runs(chunks: list[str], ids: Sequence[Sequence[int]]) -> Runs:
    lens = np.fromiter(map(len, ids), np.int64, len(ids))
    return chunks, np.fromiter(chain.from_iterable(ids), np.uint32, int(lens.sum())), lens


class ChunkTable:
    """chunk -> run of ids. encode gets chunks that are not in the table and
    returns them, in any order, with their ids.
    tails: if not None, a letter and the punctuation after it are encoded apart,
    the punctuation as a chunk that has this string before it."""

    def __init__(self, encode: Callable[[list[str]], Runs], tails: str | None = None, limit: int = TABLE_BYTES):
        self.encode, self.tails, self.limit = encode, tails, limit
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.size = 0                        # estimated bytes
        self.met = np.zeros(0, np.int64)     # times that each chunk was met
        self.start = np.zeros(1, np.int64)   # start of each chunk's ids, then the end
        self.flat = np.empty(0, np.uint32)

    def _add(self, chunks: list[str], flat: np.ndarray, lens: np.ndarray) -> None:
        base = len(self.index)
        self.flat = np.concatenate([self.flat, flat])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(lens)])
        self.index.update(zip(chunks, range(base, base + len(chunks))))
        self.size += CHUNK_BYTES * len(chunks) + sum(map(len, chunks)) + flat.nbytes

    def shrink(self) -> None:
        """Drop chunks met once since the last time, or all if that leaves the table more than half full."""
        often = np.flatnonzero(self.met > 1)
        chunks = list(self.index)
        lens, flat = self.start[often + 1] - self.start[often], self.ids(often)
        chunks = [chunks[i] for i in often]
        self.clear()
        self._add(chunks, flat, lens)
        if 2 * self.size > self.limit:
            self.clear()

    def learn(self, new: set[str]) -> None:
        parts: dict[str, tuple[str, str]] = {}
        if self.tails is not None:
            for c in new:
                core = c.rstrip(TAIL)
                if len(core) < len(c) and core and core[-1].isalpha() and core[-1] < "\u0100":   # others may be normalised into marks
                    parts[c] = (core, self.tails + c[len(core):])
        plain = sorted(set(chain.from_iterable(parts.values())).difference(self.index).union(new.difference(parts)))
        if plain:
            self._add(*self.encode(plain))
        if rest := [c for c in parts if c not in self.index]:
            pairs = np.fromiter((self.index[p] for c in rest for p in parts[c]), np.int64, 2 * len(rest))
            lens = (self.start[pairs + 1] - self.start[pairs]).reshape(-1, 2).sum(1)
            self._add(rest, self.ids(pairs), lens)

    def hold(self) -> None:
        """Release the table of the operator that this worker served before."""
        global _held
        if _held is not self:
            if _held is not None:
                _held.clear()
            _held = self

    def slots(self, docs: list[list[str]]) -> np.ndarray:
        """The places of all chunks of all lists, one after the other."""
        self.hold()
        n = sum(map(len, docs))
        slots = np.fromiter(map(self.index.get, chain.from_iterable(docs), repeat(-1)), np.int64, n)
        lost = np.flatnonzero(slots < 0)
        if len(lost):
            chunks = list(chain.from_iterable(docs))
            new = {chunks[i] for i in lost}
            more = CHUNK_BYTES * len(new) + sum(map(len, new))
            if self.size + 2 * more > self.limit and self.index:
                self.shrink()
                return self.slots(docs) if self.size + more <= self.limit else self._fresh(docs)
            self.learn(new)
            slots[lost] = [self.index[chunks[i]] for i in lost]
        self.met = np.pad(self.met, (0, len(self.index) - len(self.met))) + np.bincount(slots, minlength=len(self.index))
        return slots

    def _fresh(self, docs: list[list[str]]) -> np.ndarray:
        self.clear()
        return self.slots(docs)

    def ids(self, slots: np.ndarray) -> np.ndarray:
        n = self.start[slots + 1] - self.start[slots]
        ends = np.cumsum(n)
        if not len(n) or not ends[-1]:
            return np.empty(0, np.uint32)
        return self.flat[np.repeat(self.start[slots] - ends + n, n) + np.arange(ends[-1])]

    def encode_docs(self, docs: list[list[str]]) -> list[np.ndarray]:
        """The ids of each list of chunks."""
        slots = self.slots(docs)
        ends = np.cumsum(np.concatenate([[0], self.start[slots + 1] - self.start[slots]]))
        at = ends[np.cumsum([0, *map(len, docs)])]
        flat = self.ids(slots)
        return [flat[a:b] for a, b in zip(at, at[1:])]


def space_chunks(text: str) -> list[str]:
    """Cut for byte-level vocabularies, whose words take the single space before
    them: that space is left out here, and a chunk that has none in the text is
    marked by a space put before it (see chunk_text)."""
    if not text:
        return []
    if _ODD.search(text):
        at = [m.start() for m in _CUT.finditer(text)]
        return [" " + text[:at[0] if at else None], *(text[a + 1:b] for a, b in zip(at, [*at[1:], len(text)]))]
    parts = text.split(" ")
    parts[0] = " " + parts[0]
    return parts


def chunk_text(chunk: str) -> str:
    """The text that a chunk of space_chunks stands for."""
    return chunk[1:] if chunk[0] == " " else " " + chunk
