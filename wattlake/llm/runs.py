"""Stretches of a text that repeat themselves, found as runs of its word sequence.

A run is a stretch with smallest period q, at least ``times`` periods and ``least`` words
long, that no neighbouring word extends.  Every run holds a Lyndon root: a word that is
the longest Lyndon word from its place under the order of words or its reverse.  So the
longest Lyndon word of every place is found under both orders, and each is extended to
both sides as far as the text keeps its period.

The Lyndon words come from the first phase of Baier's suffix sorter: suffixes are grouped
by a shared beginning, groups are taken from the highest to the lowest, and whatever
stands before a finished group is extended by that group's beginning.  At the end every
suffix is in the group of its longest Lyndon word; the second phase is not needed.
Extensions are looked up in ranks of all factors of 1, 2, 4, ... words (exact, no
fingerprints of texts).

Before that, a text is cut where no run can pass: every triple of words of a run comes
back in it, so a triple that is too rare in its stretch parts the stretch, until all
triples left are frequent enough in theirs.  The cut loses no run and shortens none.

A task works on a few megabytes of whole texts at a time; a longer text is handled alone.
Memory is some hundred bytes for each word of the texts in hand that is left after the cut.

Defined cases: NULL and empty texts have no words and no runs, their collapsed text is
empty; rows with one id, or none, are separate rows; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
CHUNK_WORDS = 400_000
FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string"


def words_of(text: Column) -> Column:
    """The words of a text: whatever stands between white space."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def lyndon_lengths(codes: list[int]) -> list[int]:
    """Length of the longest Lyndon word from each place; the end is lower than any code."""
    n = len(codes)
    alphabet = sorted(set(codes))
    names = {code: g for g, code in enumerate(alphabet)}
    group = [names[code] for code in codes]
    members: list[list[int]] = [[] for _ in alphabet]
    for place, g in enumerate(group):
        members[g].append(place)
    below = list(range(-1, len(alphabet) - 1))
    above = [*range(1, len(alphabet)), -1]
    # Places that are not finished, each linked with the next one on both sides.
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    length = [0] * n
    g = len(alphabet) - 1
    while g >= 0:
        extended: dict[tuple[int, int], list[int]] = {}
        for place in members[g]:
            before = left[place]
            if group[place] != g or (before >= 0 and group[before] == g):
                continue  # moved to a higher group, or not the first of its row
            after, times = place, 0
            while after < n and group[after] == g:
                following = right[after]
                length[after] = following - after
                after = following
                times += 1
            if after < n:
                left[after] = before
            if before >= 0:
                right[before] = after
                extended.setdefault((times, group[before]), []).append(before)
        # A beginning that this group follows more often is higher: placed first, further up.
        for times, old in sorted(extended, reverse=True):
            places = extended[times, old]
            new, upper = len(members), above[old]
            members.append(places)
            below.append(old)
            above.append(upper)
            above[old] = new
            if upper >= 0:
                below[upper] = new
            for place in places:
                group[place] = new
        g = below[g]
    return length


def factor_ranks(codes: np.ndarray, longest: int) -> list[np.ndarray]:
    """Ranks of all factors of 1, 2, 4, ... codes, up to the ``longest`` that can come twice."""
    ranks = [np.unique(codes, return_inverse=True)[1].astype(np.int64)]
    while 2 ** len(ranks) <= longest:
        half, last = 2 ** (len(ranks) - 1), ranks[-1]
        if len(last) <= half:
            break
        kinds, rank = np.unique(last[:-half] * (last.max() + 1) + last[half:], return_inverse=True)
        if len(kinds) == len(rank):
            break
        ranks.append(rank)
    return ranks


def common_extension(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many codes agree from places ``a`` and ``b`` (a < b) on, forwards (1) or backwards (-1)."""
    a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for level in reversed(range(len(ranks))):
        size, rank = 2**level, ranks[level]
        x, y = (a, b) if step > 0 else (a - size + 1, b - size + 1)
        inside = np.flatnonzero((x >= 0) & (y < len(rank)))
        same = inside[rank[x[inside]] == rank[y[inside]]]
        out[same] += size
        a[same] += step * size
        b[same] += step * size
    return out


def _stretches(codes: np.ndarray, text: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Parts of the texts, from and to, outside of which and across which no run lies."""
    # A run of q-word periods has least(times * q, least) words, so each of its triples
    # comes at least times - 1 times, and least - 2 times if q is 1.
    often = min(times - 1, max(least, times) - 2)
    at = np.flatnonzero(text[:-2] == text[2:])
    if len(at) and often > 1:
        kinds = int(codes.max()) + 1
        pair = np.unique(codes[at].astype(np.int64) * kinds + codes[at + 1], return_inverse=True)[1]
        triple = np.unique(pair * kinds + codes[at + 2], return_inverse=True)[1]
        while len(at):
            start = np.concatenate(([True], np.diff(at) != 1))
            own = np.cumsum(start) - 1
            _, kind, count = np.unique(own * (int(triple.max()) + 1) + triple, return_inverse=True, return_counts=True)
            keep = (count[kind] >= often) & (np.bincount(own)[own] >= least - 2)
            if keep.all():
                break
            at, triple = at[keep], triple[keep]
        edges = np.flatnonzero(np.diff(at) != 1)
        firsts, lasts = np.concatenate((at[:1], at[edges + 1])), np.concatenate((at[edges], at[-1:]))
        return [(int(a), int(b) + 3) for a, b in zip(firsts, lasts, strict=True)]
    bounds = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1], [True]))) if len(text) else np.zeros(1, int)
    return [(int(a), int(b)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def find_runs(codes: np.ndarray, text: np.ndarray, least: int, times: int) -> np.ndarray:
    """Rows (start, length, period) of all runs of texts laid end to end, by start and period.

    ``text`` numbers the text of each code; no run passes from one to the next.
    """
    parts = _stretches(codes, text, least, times)
    if not parts:
        return np.zeros((0, 3), np.int64)
    sizes = np.array([b - a for a, b in parts])
    firsts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    # The stretches in a row, a code of its own behind each.
    row = np.full(int((sizes + 1).sum()), -1, np.int64)
    places, periods = [], []
    for first, (a, b) in zip(firsts, parts, strict=True):
        own = codes[a:b].astype(np.int64)
        row[first : first + b - a] = own
        for ordered in (own, -own):
            found = np.array(lyndon_lengths(ordered.tolist()))
            fits = np.flatnonzero(found * times <= b - a)
            places.append(fits + first)
            periods.append(found[fits])
    breaks = np.flatnonzero(row < 0)
    row[breaks] = int(codes.max()) + 1 + np.arange(len(breaks))
    place, period = np.concatenate(places), np.concatenate(periods)
    ranks = factor_ranks(row, int(sizes.max()))
    onward = common_extension(ranks, place, place + period, 1)
    back = common_extension(ranks, place - 1, place + period - 1, -1)
    length = back + period + onward
    long = length >= np.maximum(least, times * period)
    start, length, period = (place - back)[long], length[long], period[long]
    part = np.searchsorted(firsts, start, "right") - 1
    start += np.array([a for a, _ in parts])[part] - firsts[part]
    return np.unique(np.stack((start, period, length), axis=1), axis=0)[:, [0, 2, 1]]


def _batches(least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            ends = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)))).astype(np.int64)
            flat = lists.flatten()
            first = 0
            while first < len(lists):
                last = int(np.searchsorted(ends, ends[first] + CHUNK_WORDS, "right")) - 1
                last = min(max(last, first + 1), len(lists))
                yield _chunk(ids.slice(first, last - first), flat.slice(ends[first], ends[last] - ends[first]), ends[first : last + 1] - ends[first])
                first = last

    def _chunk(ids: pa.Array, words: pa.Array, bounds: np.ndarray) -> pa.RecordBatch:
        sizes = np.diff(bounds)
        text = np.repeat(np.arange(len(sizes)), sizes)
        codes = pc.dictionary_encode(words).indices.to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, np.int32)
        runs = find_runs(codes, text, least, times)
        start, length, period = runs.T
        depth = np.zeros(len(codes) + 1, np.int64)
        np.add.at(depth, start + period, 1)
        np.add.at(depth, start + length, -1)
        keep = np.cumsum(depth)[:-1] == 0
        kept = np.concatenate(([0], np.cumsum(keep)))[bounds]
        listed = pa.ListArray.from_arrays(pa.array(kept, pa.int32()), words.filter(pa.array(keep)).cast(pa.string()))
        owner = text[start] if len(start) else np.zeros(0, np.int64)
        spans = pa.StructArray.from_arrays([pa.array(start - bounds[owner]), pa.array(length), pa.array(period)], ["start", "length", "period"])
        per_text = np.searchsorted(owner, np.arange(len(sizes) + 1))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes), pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), spans), pc.binary_join(listed, " ")],
            ["doc_id", "n_words", "runs", "text"],
        )

    return run


def periodic_runs(docs: DataFrame, id: str = "doc_id", words: str = "words", least: int = 6, times: int = 4) -> DataFrame:
    """One row for each row of ``docs``: its runs and its text without their repetitions.

    ``words`` holds each text's words (:func:`words_of`).  Columns: doc_id, n_words, runs
    (start, length, period in words, by start and period), text (the words joined by one
    blank, without those that a run holds after its first period).  Rows stay where they
    are: nothing is shuffled.
    """
    if least < 2 or times < 2:
        raise ValueError("a run holds two periods at least")
    rows = docs.select(docs[f"`{id}`"].cast("long").alias("doc_id"), docs[f"`{words}`"].alias("words"))
    return rows.mapInArrow(_batches(least, times), FOUND)
