"""Passages of a benchmark in documents: n-gram seeds, then Smith-Waterman.

Every n-gram of a test item is a seed, however frequent, and is looked for in all
documents, so any ``n`` words in a row that are left of an item are enough, whatever
other documents hold.  Where a document holds a seed, the words around it are aligned
with the item by Smith-Waterman (match 2, mismatch and gap -1); the score is the best
local alignment's share of the item aligned with itself.  Words around a seed of which
too few are the item's to reach ``least`` in any order are not aligned.  A copy in which
no ``n`` words in a row are left is not found.

Documents are read once.  Their n-grams are tested against a bitmap of fixed size that
holds the items' n-grams; documents with a hit are written with their hits, and the
seeds meet them in a join, so the benchmark may be of any size.  A document is aligned
with the items it shares seeds with, in one row; nothing is gathered by item.

Defined cases: items and documents of fewer words than ``n`` only match if all their
words are the same; NULL texts and such without words match nothing; an item that stands
several times in a document is reported once, at its best place (the first of equals);
repeated rows are reported each; empty tables give an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import text_chunks, written
from wattlake.llm.tokens import shingles, words

MATCH, MISMATCH, GAP = 2, -1, -1
BITMAP_BITS = 24
TOUCHED = "doc_id long, text string, grams array<bigint>, places array<int>"


def _grams(n: int):
    """(id, text) to one row for each n-gram: id, its hash, its place, the item's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                found = words(data, offsets)
                values, bounds = shingles(found, n)
                made = np.diff(bounds)
                owner = np.repeat(np.arange(len(made)), made)
                places = np.arange(len(values)) - bounds[:-1][owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(made)).take(pa.array(owner)),
                        pa.array(values.view(np.int64)),
                        pa.array(places.astype(np.int32)),
                        pa.array(np.diff(found.bounds)[owner].astype(np.int32)),
                    ],
                    ["item_id", "gram", "place", "length"],
                )

    return run


def _bitmap(grams: DataFrame, bits: int) -> np.ndarray:
    """The n-grams' hashes in ``2**bits`` bits; at most ``2**(bits - 6)`` words reach the driver."""
    slot = F.expr(f"shiftrightunsigned(gram, {64 - bits})")
    cells = grams.select(F.expr(f"shiftright(shiftrightunsigned(gram, {64 - bits}), 6)").alias("cell"), slot.alias("slot"))
    # The bits of a cell as one number, each counted once.
    masks = cells.distinct().groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("mask"))
    out = np.zeros(1 << (bits - 6), np.int64)
    for cell, mask in masks.collect():
        out[cell] = mask
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool)


def _touch(n: int, bitmap: np.ndarray, bits: int):
    """Documents with an n-gram in the bitmap, with those n-grams and their places."""
    shift = np.uint64(64 - bits)
    packed = np.packbits(bitmap, bitorder="little").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                values, bounds = shingles(words(data, offsets), n)
                hits = np.flatnonzero(held[values >> shift])
                if not len(hits):
                    continue
                owner = np.searchsorted(bounds, hits, "right") - 1
                rows, starts = np.unique(owner, return_index=True)
                ends = np.append(starts[1:], len(hits)).astype(np.int32)
                at = pa.array(np.append(0, ends).astype(np.int32))
                take = pa.array(rows + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.ListArray.from_arrays(at, pa.array(values[hits].view(np.int64))),
                        pa.ListArray.from_arrays(at, pa.array((hits - bounds[owner]).astype(np.int32))),
                    ],
                    ["doc_id", "text", "grams", "places"],
                )

    return run


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of ``a`` in ``b``: score, and where it ends in each (exclusive)."""
    ramp = np.arange(len(b) + 1)
    row = np.zeros(len(b) + 1, np.int64)
    best = (0, 0, 0)
    for i in range(len(a)):
        step = np.where(b == a[i], MATCH, MISMATCH)
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + step)
        # A gap of any length from the left: the running best, less its length.
        row = np.maximum.accumulate(new - GAP * ramp) + GAP * ramp
        top = int(row.argmax())
        if row[top] > best[0]:
            best = (int(row[top]), i + 1, top)
    return best


def span(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Score of the best local alignment and its words in ``b``, from and to (exclusive)."""
    score, a_end, b_end = align(a, b)
    if not score:
        return 0, 0, 0
    _, _, length = align(a[:a_end][::-1], b[:b_end][::-1])
    return score, b_end - length, b_end


def windows(diagonals: list[int], length: int, total: int) -> list[tuple[int, int]]:
    """Stretches of a document to align with an item, from where it would begin; merged."""
    slack = max(4, length // 2)
    out: list[tuple[int, int]] = []
    for d in sorted(set(diagonals)):
        low, high = max(0, d - slack), min(total, d + length + slack)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        elif low < high:
            out.append((low, high))
    return out


def _aligned(least: float):
    """A document and the items it shares seeds with, to one row for each item that aligns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, candidates in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                own = words(data, np.array([0, len(data)])).hashes
                for c in candidates:
                    raw = np.frombuffer(c["text"].encode(), np.uint8)
                    item = words(raw, np.array([0, len(raw)])).hashes
                    best = (0, 0, 0)
                    for low, high in windows(c["diagonals"], len(item), len(own)):
                        # No alignment scores more than the item's words that stand here at all.
                        if np.isin(item, own[low:high]).sum() / len(item) < least:
                            continue
                        score, start, end = span(item, own[low:high])
                        if score > best[0]:
                            best = (score, low + start, low + end)
                    share = best[0] / (MATCH * len(item))
                    if share >= least:
                        out.append((doc_id, c["item_id"], share, best[1], best[2], len(set(c["diagonals"]))))
            names = ["doc_id", "item_id", "score", "first_word", "end_word", "n_places"]
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return run


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = 4,
    least: float = 0.5,
    bits: int = BITMAP_BITS,
) -> DataFrame:
    """One row for each document and test item whose alignment scores ``least`` or more.

    Columns: doc_id, item_id, score (0 to 1), first_word and end_word (the aligned words
    of the document, counted from 0, end exclusive), n_places (diagonals with a seed).
    """
    items = benchmark.select(benchmark[f"`{item_id}`"].cast("long").alias("item_id"), benchmark[f"`{item_text}`"].alias("text"))
    items = items.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).dropDuplicates(["item_id"])
    grams = written(items.mapInArrow(_grams(n), "item_id long, gram long, place int, length int"), "leak-grams")
    bitmap = _bitmap(grams, bits)
    rows = docs.select(docs[f"`{id}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].alias("text"))
    touched = written(rows.mapInArrow(_touch(n, bitmap, bits), TOUCHED).withColumn("row", F.monotonically_increasing_id()), "leak-touched")
    hits = touched.select("row", F.explode(F.arrays_zip("grams", "places")).alias("hit")).select(
        "row", F.col("hit.grams").alias("gram"), F.col("hit.places").alias("at")
    )
    seeds = grams.select("gram", "item_id", "place")
    met = hits.join(seeds, "gram").select("row", "item_id", (F.col("at") - F.col("place")).alias("diagonal"))
    pairs = met.groupBy("row", "item_id").agg(F.collect_set("diagonal").alias("diagonals"))
    candidates = pairs.join(items.withColumnRenamed("text", "item_text"), "item_id")
    by_row = candidates.groupBy("row").agg(F.collect_list(F.struct("item_id", F.col("item_text").alias("text"), "diagonals")).alias("candidates"))
    together = touched.select("row", "doc_id", "text").join(by_row, "row").select("doc_id", "text", "candidates")
    schema = "doc_id long, item_id long, score double, first_word long, end_word long, n_places long"
    return together.mapInArrow(_aligned(least), schema)
