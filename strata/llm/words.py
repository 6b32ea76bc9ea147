"""Hashes of words, computed on the bytes of many texts at once.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. Its hash is a polynomial of its bytes modulo 2^64, read off a running sum, and mixed
with its length. Texts are taken in slices of about ``SLICE`` bytes; a longer text is read in
pieces that end between words, so memory does not grow with the length of a text beyond eight
bytes per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 19
# Fixed value: an odd number, so that it has an inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15 | 1
_ONE = np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def white_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


@dataclass
class Words:
    """Words of the texts ``first`` to ``last - 1`` of an array.

    ``offsets`` has the number of words before each of these texts, and at last of all;
    ``starts`` and ``ends`` are places in ``data``.
    """

    first: int
    last: int
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    data: np.ndarray


class WordReader:
    """Keeps the tables; one per task. ``white`` marks other bytes as ones between words."""

    def __init__(self, white: np.ndarray | None = None) -> None:
        self._white = white_table() if white is None else white
        bytes_ = mix(np.arange(1, 257, dtype=np.uint64))
        self._value = bytes_ | _ONE
        self._power = self._inverse = np.ones(0, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self._power):
            inverse = pow(_BASE, -1, 1 << 64)
            for name, base in (("_power", _BASE), ("_inverse", inverse)):
                powers = np.full(n, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers))

    def _piece(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Hashes, starts and ends of the words of ``data``; texts begin at ``cuts``."""
        n = len(data)
        self._grow(n + 1)
        black = ~self._white[data]
        begins = black.copy()
        begins[1:] &= ~black[:-1]
        inner = cuts[(cuts > 0) & (cuts < n)]
        begins[inner] = black[inner]
        stops = black.copy()
        stops[:-1] &= ~black[1:]
        stops[inner - 1] = black[inner - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        running = np.zeros(n + 1, np.uint64)
        np.cumsum(self._value[data] * self._power[:n], out=running[1:])
        hashes = (running[ends] - running[starts]) * self._inverse[starts]
        return mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(_BASE)), starts, ends

    def read(self, texts: pa.Array) -> Iterator[Words]:
        """Words of all texts, in slices of whole texts; null is empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[
            texts.offset : texts.offset + len(texts) + 1
        ]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1
            last = max(min(last, len(texts)), first + 1)
            yield self._slice(data, offsets, first, last)
            first = last

    def _slice(self, data: np.ndarray, offsets: np.ndarray, first: int, last: int) -> Words:
        low, high = int(offsets[first]), int(offsets[last])
        parts, at = [], low
        while at < high or not parts:
            end = high
            if high - at > 2 * SLICE:  # one long text: end a piece between words
                end = at + SLICE
                while end < high and not self._white[data[end]]:
                    end += 1
            hashes, starts, ends = self._piece(data[at:end], offsets[first:last] - at)
            parts.append((hashes, starts + at, ends + at))
            at = max(end, at + 1)
        hashes, starts, ends = (np.concatenate(p) for p in zip(*parts, strict=True))
        counts = np.searchsorted(starts, offsets[first : last + 1])
        return Words(first, last, hashes, starts, ends, counts, data)


def windows(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n words from each place, and whether they all belong to one text."""
    size = max(len(hashes) - n + 1, 0)
    total = np.zeros(size, np.uint64)
    for i in range(n):
        factor = int(mix(np.array([i + 1], np.uint64))[0]) | 1
        total += hashes[i : i + size] * np.uint64(factor)
    inside = np.ones(len(hashes), bool)
    for i in range(1, n):
        back = offsets[1:] - i
        inside[back[back >= offsets[:-1]]] = False
    # Texts shorter than n words have no window at all.
    return mix(total), inside[:size]
