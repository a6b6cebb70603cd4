"""Words and word shingles as 64-bit hashes, computed for many texts at once.

A word is a run of letters a-z (A-Z count as their lower case), digits and
characters outside ASCII.  A text of fewer words than a shingle takes has one
shingle of all its words; a text without words has none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_U = np.uint64
_FOLD = np.zeros(256, np.uint8)
for _c in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _FOLD[_c] = _c
for _c in range(0x41, 0x5B):
    _FOLD[_c] = _c + 32
BYTE_STEP = _U(0x9E3779B97F4A7C15)
WORD_STEP = _U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(step: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), step, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """Hashes of a run of texts' words; ``bounds`` are each text's first word and the end."""

    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray = _FOLD) -> Words:
    """Hash every word; starts and ends are its bytes' places in ``data``.

    ``fold`` gives what each byte counts as, 0 for those between words.
    """
    folded = fold[data]
    inside = folded != 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none)
    places = np.flatnonzero(inside)
    lengths = np.diff(np.append(np.flatnonzero(first[places]), len(places)))
    own = places - np.repeat(starts, lengths)
    values = mix(folded[places].astype(np.uint64) + _U(1)) * _powers(BYTE_STEP, int(own.max()) + 1)[own]
    at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    hashes = mix(np.add.reduceat(values, at))
    return Words(hashes, np.searchsorted(starts, offsets), starts, starts + lengths)


def shingles(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words and each text's bounds in them."""
    counts = np.diff(found.bounds)
    if not len(found.hashes):
        return found.hashes, np.zeros(len(counts) + 1, np.int64)
    powers = _powers(WORD_STEP, n)
    total = len(found.hashes)
    runs = np.zeros(max(total - n + 1, 0), np.uint64)
    for i in range(n):
        runs += found.hashes[i : total - n + 1 + i] * powers[i] if len(runs) else runs
    made = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(made)))
    out = np.empty(bounds[-1], np.uint64)
    owner = np.repeat(np.arange(len(counts)), made)
    place = found.bounds[:-1][owner] + (np.arange(len(owner)) - bounds[:-1][owner])
    whole = counts[owner] >= n
    out[whole] = runs[place[whole]]
    for i in np.flatnonzero(~whole):
        at = found.bounds[owner[i]]
        few = found.hashes[at : at + counts[owner[i]]]
        out[i] = np.sum(few * powers[: len(few)], dtype=np.uint64) + _U(len(few))
    return mix(out), bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values, ascending, and the new bounds."""
    if not len(values):
        return values, bounds
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, owner))
    values = values[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    sums = np.concatenate(([0], np.cumsum(keep)))
    return values[keep], sums[bounds]


def per_text(values: np.ndarray, bounds: np.ndarray, op: np.ufunc, empty: int) -> np.ndarray:
    """Reduce each text's values; texts without any get ``empty``."""
    out = np.full(len(bounds) - 1, empty, values.dtype)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = op.reduceat(values, bounds[some])
    return out
