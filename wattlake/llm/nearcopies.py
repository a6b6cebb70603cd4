"""Near copies by MinHash bands, with candidates checked in sequence until proof.

Texts with the same set of word shingles are one class.  A class's MinHash values are cut
into bands; classes that agree in a band are in one bucket and candidates.  The values of
two candidates are compared a batch at a time: after each batch the posterior of their
similarity given the matches so far (uniform prior, one byte of each value, so that unequal
values agree by chance too) bounds the chance that it reaches the threshold, and a pair
whose chance falls under the tolerance is dropped.  Pairs that no batch drops are
survivors.  Classes that survivors tie together form a group, whose shingle sets are
fetched, and every link is confirmed on full sets.

Only who is reachable from whom matters, so a pair is not checked once both ends are known
to be connected.  No pair leaves a task: it gives back, for each class with a link, one
class it hangs on.  Whatever is compared is cut into blocks.  The first check holds each
block against itself and against one other, whose work grows with the number of classes;
only what that leaves unconnected meets the rest of its buckets or of its group.

A pair at the threshold 0.8 shares none of 48 bands of 6 values with probability 5e-7; the
tolerance adds less than that.

Defined cases: a text of fewer words than a shingle has one shingle of all of them; NULL
texts and such without words have none and are linked with nothing; repeated rows are
separate rows of one class; rows without an id are linked like others, a component is named
by its least id, NULL if it has none, and such a row is kept only then; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import text_chunks, written
from wattlake.llm.components import components
from wattlake.llm.tokens import distinct, mix, per_text, shingles, words

BANDS, ROWS = 48, 6
STEP = 24
#: Candidates that hang together are all compared if they fill this many blocks at most.
WHOLE = 16
SIGNED = "row_id long, n long, hi long, lo long, buckets binary, signature binary"
SETS = "row_id long, hi long, lo long, shingles binary"

# Bytes that separate words are 0, any other is one more than itself, A-Z in lower case.
_WORD_BYTES = np.arange(1, 257, dtype=np.uint16)
_WORD_BYTES[0x41:0x5B] += 32
_WORD_BYTES[[0x20, *range(0x09, 0x0E)]] = 0


def _sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct shingles, their bounds, and two digests of the set."""
    values, bounds = distinct(*shingles(words(data, offsets, _WORD_BYTES), n))
    hi = per_text(mix(values), bounds, np.add, 0).view(np.int64)
    lo = per_text(mix(values ^ np.uint64(0x5851F42D4C957F2D)), bounds, np.add, 0).view(np.int64)
    return values, bounds, hi, lo


def _cut(blob: bytes, bounds: np.ndarray, width: int) -> pa.Array:
    return pa.array([blob[width * a : width * b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())


def _sign(n: int, seed: int):
    """Rows of id and text with the digests, buckets and signature of their shingles."""
    factors = np.random.default_rng(seed).integers(1, 2**63, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                values, bounds, hi, lo = _sets(data, offsets, n)
                count = len(bounds) - 1
                signature = np.empty((count, BANDS * ROWS), np.uint8)
                buckets = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (count, BANDS)).copy()
                for i, (a, b) in enumerate(factors.T):
                    least = per_text(((values * a + b) >> np.uint64(32)).astype(np.uint32), bounds, np.minimum, 2**32 - 1)
                    signature[:, i] = mix(least) & np.uint64(255)
                    buckets[:, i // ROWS] = mix(buckets[:, i // ROWS] * np.uint64(0x9E3779B97F4A7C15) + least)
                each = np.arange(count + 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, count), pa.array(np.diff(bounds)), pa.array(hi), pa.array(lo), _cut(buckets.tobytes(), each, 8 * BANDS), _cut(signature.tobytes(), each, BANDS * ROWS)],
                    ["row_id", "n", "hi", "lo", "buckets", "signature"],
                )

    return run


def _shingled(n: int):
    """Rows of id and text with the digests and all shingles of their set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                values, bounds, hi, lo = _sets(data, offsets, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(bounds) - 1), pa.array(hi), pa.array(lo), _cut(values.tobytes(), bounds, 8)],
                    ["row_id", "hi", "lo", "shingles"],
                )

    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, buckets) to one row for each bucket."""
    for batch in batches:
        cls = np.repeat(batch.column(0).to_numpy(), BANDS)
        bucket = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(cls)], ["bucket", "cls"])


def least_matches(compared: int, percent: int, tolerance: float, grid: int = 4000) -> int:
    """Fewest matches among ``compared`` bytes that keep a pair.

    Bytes of values of texts with similarity s agree with chance s + (1 - s) / 256; the
    prior of s is uniform.  A pair is kept while the posterior of s >= percent / 100 is at
    least the tolerance.
    """
    s = (np.arange(grid) + 0.5) / grid
    agree = s + (1 - s) / 256
    high = s >= percent / 100
    for matches in range(compared + 1):
        weight = matches * np.log(agree) + (compared - matches) * np.log1p(-agree)
        weight = np.exp(weight - weight.max())
        if weight[high].sum() >= tolerance * weight.sum():
            return matches
    return compared + 1


def _signatures(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint8).reshape(rows.num_rows, -1)


class _Forest:
    """Which classes of a task are connected; ``root`` is the first of each one's component."""

    def __init__(self, rows: pa.Table):
        self.cls = rows["cls"].to_numpy()
        _, first, own = np.unique(rows["component"].to_numpy(), return_index=True, return_inverse=True)
        self.root = first[own]
        self.known = self.root.copy()

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        return others[self.root[others] != self.root[i]]

    def join(self, i: int, others: np.ndarray) -> None:
        if len(others):
            roots = np.unique(self.root[np.append(others, i)])
            self.root[np.isin(self.root, roots)] = roots[0]

    def new_links(self) -> pa.Table:
        """One link for each component that has become part of another."""
        heads = np.unique(self.known)
        moved = heads[self.root[heads] != heads]
        return pa.Table.from_arrays([pa.array(self.cls[moved]), pa.array(self.cls[self.root[moved]])], ["a", "b"])


def _meetings(rows: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Each row with those it is to be held against: of the other block, or the later ones of its own."""
    side = rows["block"].to_numpy() != rows["low"].to_numpy()
    if rows["low"][0].as_py() == rows["high"][0].as_py():
        for i in range(len(side)):
            yield i, np.arange(i + 1, len(side))
    else:
        other = np.flatnonzero(side)
        for i in np.flatnonzero(~side):
            yield i, other


def _likely(sizes: np.ndarray, i: int, others: np.ndarray, percent: int) -> np.ndarray:
    """Those whose number of shingles allows the similarity."""
    low, high = np.minimum(sizes[i], sizes[others]), np.maximum(sizes[i], sizes[others])
    return others[100 * low >= percent * high]


def _checks(percent: int, tolerance: float) -> list[tuple[int, int]]:
    """After how many values a pair is looked at, and the matches it needs then."""
    return [(upto, least_matches(upto, percent, tolerance)) for upto in range(STEP, BANDS * ROWS + 1, STEP)]


def _kept(signature: np.ndarray, i: int, others: np.ndarray, checks: list[tuple[int, int]]) -> np.ndarray:
    """Those that no batch of values drops."""
    matches, seen = np.zeros(len(others), np.int64), 0
    for upto, least in checks:
        matches += (signature[others, seen:upto] == signature[i, seen:upto]).sum(axis=1)
        keep = matches >= least
        others, matches, seen = others[keep], matches[keep], upto
    return others


def _survivors(percent: int, tolerance: float):
    """Ties between the classes of a bucket that no batch of values can drop."""
    checks = _checks(percent, tolerance)

    def run(rows: pa.Table) -> pa.Table:
        signature, sizes, forest = _signatures(rows), rows["n"].to_numpy(), _Forest(rows)
        for i, others in _meetings(rows):
            others = _likely(sizes, i, forest.apart(i, others), percent)
            forest.join(i, _kept(signature, i, others, checks))
        return forest.new_links()

    return run


def _proven(percent: int, tolerance: float):
    """Links between classes of a group, confirmed on their full sets."""
    checks = _checks(percent, tolerance)

    def run(rows: pa.Table) -> pa.Table:
        signature, sizes, forest = _signatures(rows), rows["n"].to_numpy(), _Forest(rows)
        sets = [np.frombuffer(blob, np.uint64) for blob in rows["shingles"].to_pylist()]
        for i, others in _meetings(rows):
            for j in _kept(signature, i, _likely(sizes, i, forest.apart(i, others), percent), checks):
                if forest.root[i] == forest.root[j]:
                    continue
                at = np.minimum(np.searchsorted(sets[i], sets[j]), len(sets[i]) - 1)
                common = int((sets[i][at] == sets[j]).sum())
                if 100 * common >= percent * (sizes[i] + sizes[j] - common):
                    forest.join(i, np.array([j]))
        return forest.new_links()

    return run


def _met(blocked: DataFrame, others: Column, check) -> DataFrame:
    """Links (a, b) that the check finds, two blocks of a key to a task.

    ``blocked`` has key, block, cls, component and what the check reads; ``others`` are
    the blocks that a row's block meets.
    """
    pairs = blocked.withColumn("other", F.explode(others))
    pairs = pairs.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    read = [c for c in ("key", "low", "high", "block", "cls", "component", "n", "signature", "shingles") if c in pairs.columns]
    return written(pairs.select(*read).groupBy("key", "low", "high").applyInArrow(check, "a long, b long"), "nearcopies-links")


def _in_blocks(rows: DataFrame, weights: DataFrame, limit: int) -> DataFrame:
    """Rows with the block of their key that they are in, and how many there are.

    ``weights`` has the key and weight of every row: wide rows are not read for it.
    """
    parts = weights.groupBy("key").agg(F.expr(f"cast(1 + sum(weight) div {limit} as int)").alias("parts"))
    return rows.join(parts, "key").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))


def _met_first(rows: DataFrame, weights: DataFrame, check, limit: int, whole: int) -> DataFrame:
    """All links in keys of up to ``whole`` blocks; in larger ones those within each block and
    with the first one, whose work grows with the key."""
    blocked = _in_blocks(rows, weights, limit).withColumn("component", F.col("cls"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    others = F.when((F.col("parts") <= whole) | (F.col("block") == 0), every).otherwise(F.array(F.lit(0), F.col("block")))
    return _met(blocked, others, check)


def _met_across(rows: DataFrame, weights: DataFrame, check, limit: int, guests: bool) -> DataFrame:
    """Links between the guests and the others of each key, and with ``guests`` among the guests too."""
    sizes = weights.groupBy("key").agg(
        *[F.expr(f"cast(1 + coalesce(sum(weight) FILTER (WHERE {side}), 0) div {limit} as int)").alias(name) for side, name in (("guest", "outer"), ("NOT guest", "inner"))]
    )
    spread = F.xxhash64("cls")
    block = F.when(F.col("guest"), F.pmod(spread, F.col("outer"))).otherwise(F.col("outer") + F.pmod(spread, F.col("inner")))
    begin = F.lit(0) if guests else F.col("outer")
    others = F.when(F.col("guest"), F.sequence(begin, F.col("outer") + F.col("inner") - 1)).otherwise(F.sequence(F.lit(0), F.col("outer") - 1))
    return _met(rows.join(sizes, "key").withColumn("block", block.cast("int")), others, check)


def _with_component(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with the component of their class; a class without links is its own."""
    joined = rows.join(found.withColumnRenamed("node", "cls"), "cls", "left")
    return joined.withColumn("component", F.coalesce("component", "cls"))


def _ties(classes: DataFrame, met: DataFrame, check, limit: int) -> DataFrame:
    """Links between classes of one bucket that the check finds, such that all it would find are connected.

    ``met`` has (bucket, cls).  What hangs together over buckets is held against itself, all
    of it if that is up to ``WHOLE`` blocks, else block by block and against one block.
    Buckets that hold several components after that are looked at by components: all of
    the bucket's largest one against all of the others, and the others' members in the
    bucket against each other.
    """
    signed = classes.select("cls", "n", "signature")
    heads = met.groupBy("bucket").agg(F.count("*").alias("size"), F.min("cls").alias("head")).where("size > 1").select("bucket", "head")
    shared = met.join(heads, "bucket")
    whole = written(components(shared.where("cls != head").select("cls", "head").distinct(), "cls", "head").select(F.col("node").alias("cls"), F.col("component").alias("key")), "nearcopies-whole")
    one = F.lit(1).alias("weight")
    # Lists of classes grow with the input: they are not broadcast, however short.
    first = _met_first(signed.join(whole.hint("merge"), "cls"), whole.select("key", one), check, limit, WHOLE)
    large = whole.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") >= WHOLE * limit).select("key")
    if large.isEmpty():
        return first

    shared = shared.join(whole.join(large, "key").select("cls"), "cls")
    known = written(_with_component(classes.select("cls"), components(first)), "nearcopies-known")
    held = shared.select("bucket", "cls").join(known, "cls")
    parts = held.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    mains = parts.groupBy("bucket").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count("*").alias("kinds")).where("kinds > 1")
    apart = written(held.join(mains, "bucket").where("component != main"), "nearcopies-apart")
    relations = apart.select("main", "component").distinct()
    if apart.isEmpty():
        return first
    main = known.join(relations.select(F.col("main").alias("component")).distinct(), "component").select(F.col("component").alias("key"), "cls", "component", F.lit(False).alias("guest"))
    guest = known.join(relations, "component").select(F.col("main").alias("key"), "cls", "component", F.lit(True).alias("guest"))
    met = main.unionByName(guest)
    across = _met_across(met.hint("merge").join(signed, "cls"), met.select("key", "guest", one), check, limit, guests=False)

    # Buckets in which the same classes are left are one.
    left = apart.where("kinds > 2").select("bucket", "cls", "component")
    sums = [F.count("*").alias("size"), F.min("cls").alias("first"), *(F.bit_xor(F.xxhash64(F.lit(s), "cls")).alias(f"sum{s}") for s in (1, 2))]
    kinds = left.groupBy("bucket").agg(*sums).groupBy("size", "first", "sum1", "sum2").agg(F.min("bucket").alias("bucket")).select("bucket")
    rest = left.join(kinds, "bucket").select(F.col("bucket").alias("key"), "cls", "component")
    blocked = _in_blocks(rest.join(signed, "cls"), rest.select("key", one), limit)
    among = _met(blocked, F.sequence(F.lit(0), F.col("parts") - 1), check)
    return first.unionByName(across).unionByName(among)


def _links(candidates: DataFrame, grouped: DataFrame, check, limit: int) -> DataFrame:
    """Links that the check finds in groups (key), such that all it would find are connected.

    ``grouped`` has key, cls and weight of the candidates, without their sets.
    """
    first = _met_first(candidates, grouped, check, limit, 1)
    # Groups of one block are done; in the others, whatever is outside of the largest component meets all.
    large = grouped.groupBy("key").agg(F.sum("weight").alias("total")).where(F.col("total") >= limit).select("key")
    if large.isEmpty():
        return first
    known = _with_component(grouped.join(large, "key"), components(first))
    sizes = known.groupBy("key", "component").agg(F.sum("weight").alias("held"))
    mains = sizes.groupBy("key").agg(F.max_by("component", F.struct("held", "component")).alias("main"), F.count("*").alias("kinds")).where("kinds > 1")
    mixed = written(known.join(mains, "key").select("key", "cls", "component", "weight", (F.col("component") != F.col("main")).alias("guest")), "nearcopies-mixed")
    if mixed.isEmpty():
        return first
    return first.unionByName(_met_across(candidates.drop("key").join(mixed, "cls"), mixed, check, limit, guests=True))


def near_copies(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    n: int = 4,
    percent: int = 80,
    miss: float = 1e-7,
    bucket: int = 4096,
    block: int = 200_000,
    seed: int = 12,
) -> DataFrame:
    """One row for each row of ``docs``: the size of its set and its component of linked texts.

    Two rows are linked if their sets of ``n``-word shingles share at least ``percent`` of
    their union.  Columns: doc_id, n_shingles, component_id (least id reachable over links),
    kept (whether the row has that id).  A pair at the threshold is dropped by the
    sequential check with probability ``miss`` at most.  ``bucket`` classes or ``block``
    shingles are held against as many at once; neither changes the result.
    """
    given = docs[f"`{text}`"]
    rows = docs.select(docs[f"`{id}`"].cast("long").alias("row_id"), given.alias("text"))
    signed = written(rows.mapInArrow(_sign(n, seed), SIGNED), "nearcopies-rows")
    filled = signed.where("n > 0")
    classes = written(
        filled.groupBy("hi", "lo")
        .agg(F.min("row_id").alias("least_id"), F.first("n").alias("n"), F.first("buckets").alias("buckets"), F.first("signature").alias("signature"))
        .withColumn("cls", F.monotonically_increasing_id()),
        "nearcopies-classes",
    )
    met = written(classes.select("cls", "buckets").mapInArrow(_spread, "bucket long, cls long"), "nearcopies-buckets")
    ties = _ties(classes, met, _survivors(percent, miss), bucket)
    grouped = written(
        components(ties).withColumnRenamed("node", "cls").join(classes.drop("buckets"), "cls").withColumnRenamed("component", "key"), "nearcopies-groups"
    )

    # The text with a class's least id lends its set, or one without an id if no other has one.
    # The ids grow with the input: they are not broadcast, however few.
    lender = grouped.select(F.col("least_id").alias("lent_id"), F.col("hi").alias("own_hi"), F.col("lo").alias("own_lo"))
    lent = rows.join(lender.select("lent_id").distinct().hint("merge"), F.col("row_id").eqNullSafe(F.col("lent_id")), "left_semi")
    sets = lent.mapInArrow(_shingled(n), SETS).select("hi", "lo", "shingles").dropDuplicates(["hi", "lo"])
    candidates = written(sets.join(grouped, ["hi", "lo"]).select("key", "cls", "n", "signature", "shingles"), "nearcopies-candidates")
    links = _links(candidates, grouped.select("key", "cls", F.col("n").alias("weight")), _proven(percent, miss), block)

    owners = classes.select("hi", "lo", "cls", "least_id").join(components(links).withColumnRenamed("node", "cls"), "cls", "left")
    owners = written(owners.withColumn("component", F.coalesce("component", "cls")), "nearcopies-owners")
    names = owners.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = owners.join(names, "component").select("hi", "lo", "component_id")
    member = filled.select("row_id", "n", "hi", "lo").join(named, ["hi", "lo"]).select("row_id", "n", "component_id")
    alone = signed.where("n = 0").select("row_id", "n", F.col("row_id").alias("component_id"))
    return member.unionByName(alone).select(
        F.col("row_id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.col("row_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
