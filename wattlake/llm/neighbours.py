"""Approximate nearest neighbours by a forest of hash prefixes.

Every tree hashes a vector to a long string of bits, the sides of random hyperplanes,
and keeps the strings in sorted order.  Two vectors at an angle ``a`` agree in a bit
with probability ``1 - a / pi``, so near vectors share long prefixes.

A search first descends: in each tree it scores the entries next to the query's place,
which hold its longest prefix matches.  The k-th best angle found bounds the true one
from above, and from it follows the prefix length at which all trees together miss a
neighbour at that angle with probability ``miss`` at most.  The search then ascends in
all trees at once to that length and scores every entry that shares the prefix.  Close
neighbours thus need few candidates, far ones many; no count is capped.

On the cluster a tree is cut into blocks by the leading bits, about ``block`` entries
each, and a block that holds more than ``large`` is dealt out to several.  A block is
one row of sorted arrays; queries visit the blocks under their prefix, and only each
block's best hits leave it.  Equal vectors are one entry with their ``k + 1`` smallest
ids, which is all a search can return of them.

Defined cases: NULL and zero vectors, such with NULL or non-finite components, rows without
an id, and vectors of another length than most of the others (the longer, if two lengths are
as frequent) take no part; rows of one id with different vectors are asked for apart, each
with ranks of its own, and are not each other's neighbours; ties go to the smaller id; fewer
candidates than ``k`` are all returned; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.llm.common import written

BITS = 60
HITS = "query long, score double, vec_id long"


def _planes(dim: int, trees: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, trees * BITS))


def _codes(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """The bit strings of each vector in each tree, as integers."""
    side = (x @ planes > 0).reshape(len(x), -1, BITS)
    return side @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def usable(vector: Column, dim: int | Column) -> Column:
    """No NULL, no NaN, no infinity, the right length, not all zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) == dim) & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda v: v != 0)


def _top(scores: np.ndarray, exact, ids: np.ndarray, held: np.ndarray, want: int) -> list[tuple[float, int]]:
    """The best ``want`` ids by exact score, ties to the smaller id."""
    if len(scores) > want:
        least = np.partition(scores, len(scores) - want)[len(scores) - want]
        near = np.flatnonzero(scores >= least - 1e-9)
    else:
        near = np.arange(len(scores))
    best = exact(near)
    pairs = [(-s, int(i)) for s, row, n in zip(best, ids[near], held[near], strict=True) for i in row[:n]]
    return sorted(pairs)[:want]


def _visitor(k: int, dim: int, reach: int, kind: type):
    """Search one block for the queries that visit it."""

    def visit(blocks: pd.DataFrame, visits: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, float, int]] = []
        if len(blocks) and len(visits):
            block = blocks.iloc[0]
            codes = np.frombuffer(block.codes, np.int64)
            vectors = np.frombuffer(block.vectors, kind).reshape(-1, dim).astype(np.float64)
            held = np.frombuffer(block.held, np.int64)
            ids = np.frombuffer(block.ids, np.int64).reshape(-1, k + 1)
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            for query, code, level, blob in zip(visits["query"], visits["code"], visits["level"], visits["vector"], strict=True):
                q = np.frombuffer(blob, kind).astype(np.float64)
                if level < 0:
                    at = int(np.searchsorted(codes, code))
                    low, high = max(at - reach, 0), min(at + reach + 1, len(codes))
                else:
                    shift = BITS - int(level)
                    low = int(np.searchsorted(codes, (int(code) >> shift) << shift))
                    high = int(np.searchsorted(codes, ((int(code) >> shift) + 1) << shift))
                if low >= high:
                    continue
                part, size = vectors[low:high], norms[low:high]
                length = math.sqrt((q * q).sum())

                def exact(rows, part=part, size=size, q=q, length=length):
                    return (part[rows] * q).sum(axis=1) / (size[rows] * length)

                for score, i in _top((part @ q) / (size * length), exact, ids[low:high], held[low:high], k + 1):
                    out.append((query, -score, i))
        return pd.DataFrame(out, columns=["query", "score", "vec_id"])

    return visit


def _best(hits: DataFrame, want: int) -> DataFrame:
    """Each query's best ids over all blocks, numbered from 1."""
    once = hits.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= want)


def nearest(
    vectors: DataFrame,
    queries: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    trees: int = 32,
    miss: float = 0.08,
    reach: int = 32,
    block: int = 2048,
    large: int = 16384,
    seed: int = 11,
) -> DataFrame:
    """The ``k`` nearest rows by cosine of each row for which ``queries`` holds.

    ``queries`` is a condition on the column ``vec_id`` (the id).  Returns query_id,
    rank, vec_id, score.
    """
    # Blocks hold the components as given; all arithmetic is in double precision.
    single = vectors.schema[vector].dataType == T.ArrayType(T.FloatType())
    kind, stored = (np.float32, "array<float>") if single else (np.float64, "array<double>")
    rows = vectors.select(vectors[f"`{id}`"].cast("long").alias("vec_id"), vectors[f"`{vector}`"].cast(stored).alias("vector"))
    rows = rows.where(usable(F.col("vector"), F.size("vector")) & F.col("vec_id").isNotNull())
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length"))
    dim = (lengths.first() or [1])[0]
    rows = rows.where(F.size("vector") == dim)
    smallest = F.row_number().over(W.partitionBy("vector").orderBy("vec_id"))
    entries = written(
        rows.withColumn("place", smallest)
        .where(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("entry", F.monotonically_increasing_id()),
        "ann-entries",
    )
    asked = rows.where(queries).join(entries.select("vector", "entry"), "vector").select("vec_id", "entry")
    asked = written(asked, "ann-queries")
    count = entries.count()
    lead = max(0, math.ceil(math.log2(count / block))) if count else 0

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = _planes(dim, trees, seed)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                x = np.asarray(part.column(1).flatten(), np.float64).reshape(-1, dim)
                ids = part.column(2).to_pylist()
                n, codes = len(x), _codes(x, planes)
                padded = [np.asarray((i + [0] * (k + 1))[: k + 1], np.int64).tobytes() for i in ids]
                blobs = [v.tobytes() for v in x.astype(kind)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(part.column(0).to_numpy(), trees)),
                        pa.array(np.tile(np.arange(trees, dtype=np.int32), n)),
                        pa.array(codes.reshape(-1)),
                        pa.array(codes.reshape(-1) >> (BITS - lead)),
                        pa.array(np.repeat([len(i) for i in ids], trees).astype(np.int64)),
                        pa.array([p for p in padded for _ in range(trees)], pa.binary()),
                        pa.array([b for b in blobs for _ in range(trees)], pa.binary()),
                    ],
                    ["entry", "tree", "code", "prefix", "held", "ids", "vector"],
                )

    schema = "entry long, tree int, code long, prefix long, held long, ids binary, vector binary"
    index = entries.select("entry", "vector", "ids").mapInArrow(hashed, schema)

    # Blocks with too many entries are dealt out; usually there is none.
    crowded = written(
        index.groupBy("tree", "prefix").count().where(F.col("count") > large).select(
            F.col("tree").alias("in_tree"), F.col("prefix").alias("in_prefix"), F.expr(f"cast(count div {block} + 1 as int)").alias("parts")
        ),
        "ann-crowded",
    )

    def spread(df: DataFrame) -> DataFrame:
        return df.join(crowded, (df["tree"] == crowded["in_tree"]) & (df["prefix"] == crowded["in_prefix"]), "left").withColumn(
            "parts", F.coalesce("parts", F.lit(1))
        )

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["code", "entry"])
        return pd.DataFrame(
            {
                "tree": [rows["tree"].iloc[0]],
                "prefix": [rows["prefix"].iloc[0]],
                "part": [rows["part"].iloc[0]],
                "codes": [rows["code"].to_numpy(np.int64).tobytes()],
                "held": [rows["held"].to_numpy(np.int64).tobytes()],
                "ids": [b"".join(rows["ids"])],
                "vectors": [b"".join(rows["vector"])],
            }
        )

    blocks = written(
        spread(index)
        .withColumn("part", F.pmod(F.xxhash64("entry"), F.col("parts")).cast("int"))
        .select("tree", "prefix", "part", "code", "entry", "held", "ids", "vector")
        .groupBy("tree", "prefix", "part")
        .applyInPandas(pack, "tree int, prefix long, part int, codes binary, held binary, ids binary, vectors binary"),
        "ann-blocks",
    )
    wanted = asked.select("entry").distinct().withColumnRenamed("entry", "query")
    search = index.join(wanted, index["entry"] == wanted["query"]).select("query", "tree", "code", "prefix", "vector")

    def visited(visits: DataFrame) -> DataFrame:
        dealt = spread(visits).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        own = dealt.select("tree", "prefix", "part", "query", "code", "level", "vector")
        keys = ["tree", "prefix", "part"]
        return blocks.groupBy(*keys).cogroup(own.groupBy(*keys)).applyInPandas(_visitor(k, dim, reach, kind), HITS)

    descent = _best(visited(search.withColumn("level", F.lit(-1))), k + 1)
    # Bits that a neighbour at the k-th best angle shares in some tree with probability 1 - miss.
    share = math.log(1 - miss ** (1 / trees))
    agree = 1 - F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.min("score")))) / math.pi
    depth = F.when(F.count("*") <= k, F.lit(0)).when(agree >= 1, F.lit(BITS)).otherwise(F.least(F.lit(BITS), F.floor(F.lit(share) / F.log(F.greatest(agree, F.lit(1e-9))))))
    levels = written(descent.groupBy("query").agg(depth.cast("int").alias("level")), "ann-levels")
    ascent = search.join(levels, "query")
    if lead:
        under = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.lit(lead) - F.col("level"))).cast("long")
        first = F.expr(f"shiftleft(shiftright(prefix, greatest(0, {lead} - level)), greatest(0, {lead} - level))")
        ascent = ascent.withColumn("prefix", F.explode(F.sequence(first, first + under - 1)))
    found = _best(visited(ascent.select("query", "tree", "code", "prefix", "vector", "level")), k + 1)
    pairs = asked.withColumnRenamed("vec_id", "query_id").join(found, F.col("entry") == F.col("query")).where(F.col("query_id") != F.col("vec_id"))
    rank = F.row_number().over(W.partitionBy("query_id", "entry").orderBy(F.col("score").desc(), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
