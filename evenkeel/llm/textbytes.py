"""Whole texts of an Arrow column as bytes, in runs of bounded size, and counting in arrays.

A run holds consecutive texts of at most ``max_bytes`` together. A longer text is cut behind a
gap between words into several runs, so nothing is lost and memory stays bounded however long a
text is; only a single word longer than a run makes the run longer. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 20
IS_GAP = np.zeros(256, bool)
IS_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass(frozen=True)
class Run:
    """``rows[i]``'s text, or a piece of it, is ``data[starts[i]:ends[i]]``; pieces lie side by side."""

    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    last: np.ndarray
    data: np.ndarray

    @property
    def region(self) -> np.ndarray:
        return self.data[self.starts[0] : self.ends[-1]]

    @property
    def bounds(self) -> np.ndarray:
        """Where each piece starts in ``region``."""
        return self.starts - self.starts[0]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return offsets.astype(np.int64), np.frombuffer(data, np.uint8)


def gap_before(data: np.ndarray, start: int, stop: int, end: int, step: int = 1 << 16) -> int:
    """The end of the piece that starts at ``start``: behind a gap, at ``stop`` or as near as can be."""
    for low in range(stop - step, start - step, -step):
        gaps = np.flatnonzero(IS_GAP[data[max(low, start) : low + step]])
        if gaps.size:
            return max(low, start) + int(gaps[-1]) + 1
    for low in range(stop, end, step):
        gaps = np.flatnonzero(IS_GAP[data[low : min(low + step, end)]])
        if gaps.size:
            return low + int(gaps[0]) + 1
    return end


def runs(column: pa.Array, max_bytes: int = RUN_BYTES) -> Iterator[Run]:
    offsets, data = utf8(column)
    row, n = 0, len(column)
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + max_bytes, side="right")) - 1
        if stop > row:
            whole = np.ones(stop - row, bool)
            yield Run(np.arange(row, stop), offsets[row:stop], offsets[row + 1 : stop + 1], whole, whole, data)
            row = stop
            continue
        at, end = int(offsets[row]), int(offsets[row + 1])
        start = at
        while at < end:
            to = end if end - at <= max_bytes else gap_before(data, at, at + max_bytes, end)
            one = (np.array([x]) for x in (row, at, to, at == start, to == end))
            yield Run(*one, data)
            at = to
        row += 1


def word_spans(run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in ``run.region``, and which piece of the run it is in."""
    in_word = ~IS_GAP[run.region]
    if not in_word.size:
        none = np.zeros(0, np.int64)
        return none, none, none
    opens = in_word.copy()
    opens[1:] &= ~in_word[:-1]
    cuts = run.bounds[run.bounds < in_word.size]
    opens[cuts] = in_word[cuts]
    closes = in_word.copy()
    closes[:-1] &= ~in_word[1:] | opens[1:]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(run.bounds, starts, side="right") - 1


@lru_cache(maxsize=1)
def powers(size: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(size, 0x9E3779B97F4A7C15, np.uint64))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def word_hashes(region: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not starts.size:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    heads = np.append(0, starts)
    place = np.arange(region.size) - np.repeat(heads, np.diff(np.append(heads, region.size)))
    longest = 1 << max(6, int(lengths.max()).bit_length())
    weights = powers(longest)
    values = np.where(IS_GAP[region], 0, region.astype(np.uint64) + np.uint64(1))
    values *= weights[np.minimum(place, longest - 1)]
    return mixed(np.add.reduceat(values, starts) + lengths.astype(np.uint64))


class Tally:
    """Counts of 64-bit keys; ``add`` returns a table to pass on when more than ``limit`` keys are held."""

    def __init__(self, limit: int = 1 << 21) -> None:
        self.limit, self.parts, self.held = limit, [], 0

    def add(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        if keys.size:
            part = np.unique(keys, return_counts=True)
            self.parts.append(part)
            self.held += part[0].size
        if self.held <= self.limit:
            return None
        self.merge()
        return self.take() if self.held > self.limit // 2 else None

    def merge(self) -> None:
        keys = np.concatenate([k for k, _ in self.parts])
        counts = np.concatenate([c for _, c in self.parts])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.parts = [(keys[heads], np.add.reduceat(counts, heads))]
        self.held = heads.size

    def take(self) -> tuple[np.ndarray, np.ndarray] | None:
        if not self.parts:
            return None
        self.merge()
        table, self.parts, self.held = self.parts[0], [], 0
        return table


def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key in a sorted table; -1 where it isn't."""
    if not table.size:
        return np.full(keys.size, -1)
    at = np.searchsorted(table, keys)
    at[at == table.size] = 0
    return np.where(table[at] == keys, at, -1)
