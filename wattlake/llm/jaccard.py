"""Pairs of texts whose word shingles overlap, by MinHash with Bayesian pruning.

Texts with the same set of shingles are one class.  MinHash values of a class are cut
into bands; classes that agree in a band are candidates, and candidates that hang
together form a group.  Within a group, blocks of classes meet in pairs: their MinHash
values are compared a few at a time, and a pair is dropped as soon as the posterior
probability that its similarity reaches the threshold, given the matches so far and a
uniform prior, falls below the tolerance.  What is left is verified on the shingles.

A pair at the threshold 0.8 shares none of 32 bands of 5 values with probability
3e-6; the tolerance adds less than that.

A class is compared once with every class of its group, however many bands they share.
Groups are cut into blocks of bounded weight, two blocks to a task, so neither a task
nor the driver holds a group; a task gives back one row for each class it saw, with its
links and the class it hangs on, never the pairs.

Defined cases: a text of fewer words than a shingle has one shingle of all of them;
NULL texts and such without words link to nothing; repeated rows are separate rows of
one class; rows without an id are linked like others, and a class that only they reach has
no id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import text_chunks, written
from wattlake.llm.components import components
from wattlake.llm.tokens import distinct, mix, per_text, shingles, words

BANDS, ROWS = 32, 5
STEP = 16
SIGNED = "row_id long, n long, hi long, lo long, signature binary"


def _factors(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, (2, count), dtype=np.uint64) | np.uint64(1)


def _signatures(values: np.ndarray, bounds: np.ndarray, count: int, seed: int) -> np.ndarray:
    """``count`` MinHash values of each text that has shingles (rows without: all ones)."""
    out = np.empty((len(bounds) - 1, count), np.uint32)
    for i, (a, b) in enumerate(_factors(count, seed).T):
        out[:, i] = per_text(((values * a + b) >> np.uint64(32)).astype(np.uint32), bounds, np.minimum, 2**32 - 1)
    return out


def least_matches(compared: int, threshold: float, tolerance: float) -> int:
    """Fewest matches among ``compared`` values that keep a pair.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1); its part above the
    threshold is the chance of at most m successes in n + 1 trials.
    """
    tail = 0.0
    for m in range(compared + 1):
        tail += math.comb(compared + 1, m) * threshold**m * (1 - threshold) ** (compared + 1 - m)
        if tail >= tolerance:
            return m
    return compared + 1


def _sign(n: int, count: int, seed: int, sets: bool):
    """Batches of (row_id, text) to shingle set digests with signatures, or with the sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                values, bounds = distinct(*shingles(words(data, offsets), n))
                sizes = np.diff(bounds)
                hi = per_text(mix(values), bounds, np.add, 0).view(np.int64)
                lo = per_text(mix(values ^ np.uint64(0x5851F42D4C957F2D)), bounds, np.add, 0).view(np.int64)
                if sets:
                    blob = values.tobytes()
                    last = [blob[8 * a : 8 * b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                else:
                    signature = _signatures(values, bounds, count, seed)
                    last = [row.tobytes() for row in signature]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(sizes)), pa.array(sizes), pa.array(hi), pa.array(lo), pa.array(last, pa.binary())],
                    ["row_id", "n", "hi", "lo", "shingles" if sets else "signature"],
                )

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, signature) to (bucket, cls): one hash of each band's values."""
    for batch in batches:
        for start in range(0, batch.num_rows, 2048):
            part = batch.slice(start, 2048)
            signature = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(part.num_rows, BANDS, ROWS)
            bucket = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (part.num_rows, BANDS)).copy()
            for i in range(ROWS):
                bucket = mix(bucket * np.uint64(0x9E3779B97F4A7C15) + signature[:, :, i])
            cls = np.repeat(part.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(bucket.reshape(-1).view(np.int64)), pa.array(cls)], ["bucket", "cls"])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each node's component, for nodes 0 to n - 1."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _compare(threshold: float, tolerance: float, count: int):
    """Links between two blocks of a group, or within one."""
    steps = [(m, least_matches(m, threshold, tolerance)) for m in range(STEP, count + 1, STEP)]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        cls = rows["cls"].to_numpy()
        weight = rows["weight"].to_numpy()
        side = (rows["block"] != rows["low"]).to_numpy()
        own = bool((rows["low"] == rows["high"]).iloc[0])
        signature = np.frombuffer(b"".join(rows["signature"]), np.uint32).reshape(len(rows), count)
        sizes = rows["n"].to_numpy()
        # Codes of the shingles that stand in more than one text; no other can be shared.
        values = np.frombuffer(b"".join(rows["shingles"]), np.uint64)
        kinds, code, times = np.unique(values, return_inverse=True, return_counts=True)
        shared = times[code] > 1
        owner = np.repeat(np.arange(len(rows)), sizes)[shared]
        code = code[shared]
        at = np.searchsorted(owner, np.arange(len(rows) + 1))
        marked = np.zeros(len(kinds), bool)
        links = np.zeros(len(rows), np.int64)
        left, right = [], []
        for i in range(len(rows)):
            if own:
                others = np.arange(i + 1, len(rows))
            elif side[i]:
                continue
            else:
                others = np.flatnonzero(side)
            low, high = np.minimum(sizes[i], sizes[others]), np.maximum(sizes[i], sizes[others])
            others = others[low >= threshold * high - 1e-9]
            matches, seen = np.zeros(len(others), np.int64), 0
            for upto, least in steps:
                matches += (signature[others, seen:upto] == signature[i, seen:upto]).sum(axis=1)
                keep = matches >= least
                others, matches, seen = others[keep], matches[keep], upto
            others = others[at[others + 1] > at[others]]
            if not len(others) or at[i] == at[i + 1]:
                continue
            marked[code[at[i] : at[i + 1]]] = True
            lengths = at[others + 1] - at[others]
            ends = np.cumsum(lengths)
            flat = np.repeat(at[others] - (ends - lengths), lengths) + np.arange(ends[-1])
            common = np.add.reduceat(marked[code[flat]].astype(np.int64), ends - lengths)
            marked[code[at[i] : at[i + 1]]] = False
            alike = others[common >= threshold * (sizes[i] + sizes[others] - common) - 1e-9]
            links[i] += weight[alike].sum()
            links[alike] += weight[i]
            left.append(np.full(len(alike), i))
            right.append(alike)
        a = np.concatenate(left) if left else np.zeros(0, np.int64)
        b = np.concatenate(right) if right else np.zeros(0, np.int64)
        root = _roots(len(rows), a, b)
        some = links > 0
        return pd.DataFrame({"cls": cls[some], "links": links[some], "root": cls[root[some]]})

    return run


def jaccard_join(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    tolerance: float = 1e-7,
    block: int = 400_000,
    seed: int = 5,
) -> DataFrame:
    """One row for each row of ``docs``: its class of linked texts and its links.

    Two rows are linked if the Jaccard similarity of their sets of ``n``-word shingles
    is at least ``threshold``.  Columns: doc_id, class_id (least id of all rows it is
    linked to over any number of links), n_links (rows linked to it directly),
    n_copies (of these, rows with the same set).  A row without links is its own class.
    """
    count = BANDS * ROWS
    rows = docs.select(docs[f"`{id}`"].cast("long").alias("row_id"), docs[f"`{text}`"].alias("text"))
    signed = written(rows.mapInArrow(_sign(n, count, seed, False), SIGNED), "jaccard-rows")
    filled = signed.where(F.col("n") > 0)
    classes = written(
        filled.groupBy("hi", "lo")
        .agg(F.min("row_id").alias("least_id"), F.count("*").alias("weight"), F.first("n").alias("n"), F.first("signature").alias("signature"))
        .withColumn("cls", F.monotonically_increasing_id()),
        "jaccard-classes",
    )
    buckets = classes.select("cls", "signature").mapInArrow(_bands, "bucket long, cls long")
    met = written(buckets, "jaccard-buckets")
    heads = met.groupBy("bucket").agg(F.min("cls").alias("head"), F.count("*").alias("size")).where("size > 1").select("bucket", "head")
    candidates = components(met.join(heads, "bucket").where("cls != head").select("cls", "head").distinct(), "cls", "head")
    groups = written(candidates, "jaccard-groups")

    grouped = written(
        classes.join(groups, classes["cls"] == groups["node"]).select("cls", "hi", "lo", "least_id", "weight", "n", "signature", "component"),
        "jaccard-candidates",
    )
    parts = grouped.groupBy("component").agg(F.expr(f"cast(1 + sum(n) div {int(block)} as int)").alias("parts"))
    # One row of each candidate class lends its text; equal digests are equal sets.
    wanted = grouped.select(F.col("least_id").alias("row_id")).distinct()
    lent = rows.join(wanted.withColumnRenamed("row_id", "lent_id"), F.col("row_id").eqNullSafe(F.col("lent_id")), "left_semi").mapInArrow(_sign(n, count, seed, True), "row_id long, n long, hi long, lo long, shingles binary")
    sets = lent.join(grouped.drop("n"), lent["row_id"].eqNullSafe(grouped["least_id"]) & (lent["hi"] == grouped["hi"]) & (lent["lo"] == grouped["lo"])).select(
        "cls", "n", "shingles", "weight", "signature", "component"
    ).dropDuplicates(["cls"])
    blocked = sets.join(parts, "component").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    # Each class meets its own block and every other one once.
    paired = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keyed = paired.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    found = written(
        keyed.select("component", "low", "high", "block", "cls", "n", "weight", "signature", "shingles")
        .groupBy("component", "low", "high")
        .applyInPandas(_compare(threshold, tolerance, count), "cls long, links long, root long"),
        "jaccard-links",
    )
    joined = components(found.select("cls", "root"), "cls", "root")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    owners = (
        classes.select("hi", "lo", "cls", "least_id", "weight")
        .join(links, "cls", "left")
        .join(joined.withColumnRenamed("node", "cls"), "cls", "left")
    )
    owners = written(
        owners.select(
            F.col("hi").alias("own_hi"), F.col("lo").alias("own_lo"), "least_id", "weight",
            F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "cls").alias("component"),
        ),
        "jaccard-owners",
    )
    names = owners.groupBy("component").agg(F.min("least_id").alias("class_id"))
    named = owners.join(names, "component")
    member = filled.join(named, (filled["hi"] == named["own_hi"]) & (filled["lo"] == named["own_lo"])).select(
        F.col("row_id").alias("doc_id"),
        "class_id",
        (F.col("links") + F.col("weight") - 1).alias("n_links"),
        (F.col("weight") - 1).alias("n_copies"),
    )
    alone = signed.where(F.col("n") == 0).select(
        F.col("row_id").alias("doc_id"),
        F.col("row_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(0).cast("long").alias("n_copies"),
    )
    return member.unionByName(alone)
