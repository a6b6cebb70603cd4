"""A hash manifest of a dataset: one tree for each group of rows and one over the groups.

In a tree every two consecutive nodes become one by hashing; the last of a level, if it
has no partner, is hashed alone.  So node ``index`` of ``level`` stands over the leaves
from ``index << level`` on, and a block of 2**height leaves that begins at a multiple of
that size makes its nodes without knowing any other.  One task builds one block and
appends its nodes to the log in the order in which they are completed: a leaf, then each
node that the leaf completes.  The tops of the blocks are the leaves of the next round.

A node's position in the log of its tree follows from the sizes of the subtrees before
it: ahead of leaf i stand i leaves and i - popcount(i) complete nodes, and a node of
level L comes L places after the last leaf below it (:func:`position`).  Proofs are read
out of the log by these positions: a block finds the siblings of its leaves in its own
part of the log, and what is above the block comes down to it as one row.

Leaves are numbered by a range shuffle on group and order and by the counts of its
partitions, never by one task for a group; equal rows are dealt out, as they are
interchangeable.  Only ids and digests are shuffled, texts are hashed where they are read.

Defined cases: a NULL value is hashed as ``-``, apart from an empty one; NULL is a group of
its own, before all others; a NULL id comes first, rows of one id follow by their hash;
repeated rows are separate leaves with separate proofs; an empty table has no nodes, no
root and no proofs.  Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattlake.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEIGHT = 12
NODES = "tree string, block long, position long, level int, index long, hash string, n long, doc_id long, presented string"


def digest(*values: Column | str) -> Column:
    """Hex hash of values: each as ``-`` if NULL, else its length in bytes, a colon and itself."""
    told = []
    for value in values:
        value = (F.col(value) if isinstance(value, str) else value).cast("string")
        told += [F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))]
    return F.sha2(F.concat(*told).cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give; a level without a sibling hashes the node alone."""

    def step(node: Column, sibling: Column) -> Column:
        other = F.coalesce(sibling["hash"], F.lit(""))
        pair = F.when(sibling["first"], F.concat(other, node)).otherwise(F.concat(node, other))
        return F.sha2(pair.cast("binary"), 256)

    return F.aggregate(proof, leaf, step)


def nodes_at(n: int, level: int) -> int:
    """How many nodes a level of a tree of ``n`` leaves has."""
    return -(-n // 2**level)


def position(n: str, level: str, index: str) -> str:
    """Place in the log of a tree of ``n`` leaves, from 0, of a node, as SQL over columns."""
    last = f"(least(shiftleft({index} + 1, {level}), {n}) - 1)"
    return f"(2 * {last} - bit_count({last}) + {level})"


def _build(nodes: DataFrame, height: int, base: int) -> DataFrame:
    """The nodes of all blocks, from the nodes of level ``base`` that they begin with."""
    own = F.array_sort(F.collect_list(F.struct("index", "hash", "doc_id", "presented")))
    blocks = nodes.groupBy("tree", F.shiftright("index", height).alias("block")).agg(F.max("n").alias("n"), own.alias("own"))
    pairs = "sequence(0, (size(element_at(done, -1)) - 1) div 2)"
    pair = "concat(element_at(done, -1)[2 * i], coalesce(get(element_at(done, -1), 2 * i + 1), ''))"
    above = f"transform({pairs}, i -> sha2(cast({pair} AS binary), 256))"
    more = f"IF(n > shiftleft(1L, {base - 1} + step), concat(done, array({above})), done)"
    levels = f"aggregate(sequence(1, {height}), array(transform(own, x -> x.hash)), (done, step) -> {more})"
    # The index of a block's first node halves from level to level.
    at = f"shiftleft(block, {height} - step) + i"
    made = f"""named_struct('position', {position("n", f"({base} + step)", f"({at})")}, 'level', {base} + step, 'index', {at}, 'hash', hash,
        'doc_id', IF(step = 0, get(own, i).doc_id, NULL), 'presented', IF(step = 0, get(own, i).presented, NULL))"""
    log = f"array_sort(flatten(transform(levels, (hashes, step) -> transform(hashes, (hash, i) -> {made}))))"
    # A block is never empty; for a plain inline Spark would infer a filter with all of its work in it.
    built = blocks.withColumn("levels", F.expr(levels)).select("tree", "block", "n", F.inline_outer(F.expr(log)))
    return built.select(*[F.col(f.split()[0]).cast(f.split()[1]) for f in NODES.split(", ")])


def _extract(log: DataFrame, tops: DataFrame, height: int, base: int) -> DataFrame:
    """Proofs of the nodes that blocks begin with, from their parts of the log and the proofs of their tops."""
    held = F.array_sort(F.collect_list(F.struct("level", "index", "hash", "doc_id", "presented")))
    blocks = log.groupBy("tree", "block").agg(F.max("n").alias("n"), held.alias("held"))
    blocks = blocks.withColumn("levels", F.expr(f"transform(sequence({base}, element_at(held, -1).level), at -> transform(filter(held, x -> x.level = at), x -> x.hash))"))
    steps = "IF(size(levels) > 1, sequence(0, size(levels) - 2), CAST(array() AS array<int>))"
    sibling = "(shiftright(leaf.index, step) ^ 1L)"
    # The siblings of a block's leaves lie in it; the last of a level may have none.
    hash = f"get(get(levels, step), CAST({sibling} - shiftleft(block, {height} - step) AS int))"
    proof = f"transform({steps}, step -> named_struct('first', {sibling} % 2 = 0, 'hash', {hash}))"
    paths = f"transform(filter(held, x -> x.level = {base}), leaf -> named_struct('index', leaf.index, 'doc_id', leaf.doc_id, 'leaf', leaf.hash, 'presented', leaf.presented, 'proof', {proof}))"
    found = blocks.withColumn("paths", F.expr(paths)).select("tree", "block", "n", F.inline_outer("paths"))
    # What is above the block is the same for all its leaves.
    above = tops.select("tree", "block", F.col("proof").alias("above"), "subroot", "root")
    return found.join(above, ["tree", "block"]).select("tree", "index", "n", "doc_id", "leaf", "presented", F.concat("proof", "above").alias("proof"), "subroot", "root")


@dataclass
class Manifest:
    """The logs of all groups' trees by round, and of the tree over the groups."""

    groups: list[DataFrame]
    top: list[DataFrame]
    height: int

    def log(self) -> DataFrame:
        """All nodes of the groups' trees with their positions; ``tree`` is the group's key."""
        out = self.groups[0]
        for turn, more in enumerate(self.groups[1:], 1):
            # A round begins with the tops of the one before.
            out = out.unionByName(more.where(F.col("level") > turn * self.height))
        return out

    def subroots(self) -> DataFrame:
        """Each group's key and the top of its tree."""
        return _tops(self.groups, self.height)

    def root(self) -> DataFrame:
        """One row with the root over all groups, none if there are no rows."""
        return _tops(self.top, self.height).select(F.col("hash").alias("root"))

    def proofs(self) -> DataFrame:
        """One row for each leaf: tree, index, n, doc_id, leaf, presented, proof, subroot, root.

        ``proof`` holds the siblings from the leaf's level to the root: whether the sibling
        comes first, and its hash (NULL if the node is hashed alone).
        """
        none = F.array().cast("array<struct<first: boolean, hash: string>>")
        above = _tops(self.top, self.height).select("tree", none.alias("proof"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
        whole = _paths(self.top, above, self.height)
        return _paths(self.groups, whole.select(F.col("presented").alias("tree"), "proof", F.col("leaf").alias("subroot"), "root"), self.height)


def _tops(rounds: list[DataFrame], height: int) -> DataFrame:
    """The one node of each tree's highest level."""
    out = None
    for log in rounds:
        found = log.where((F.col("index") == 0) & (F.col("n") <= F.expr("shiftleft(1L, level)")) & ((F.col("level") == 0) | (F.col("n") > F.expr("shiftleft(1L, level - 1)"))))
        found = found.select("tree", "hash", "n")
        out = found if out is None else out.unionByName(found)
    return out


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with ``index``, their place in their tree from 0, and ``n``, their tree's size."""
    by = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order], F.col("tie")]
    laid = rows.withColumn("tie", F.rand(13)).repartitionByRange(*by).sortWithinPartitions(*by)
    laid = written(laid.drop("tie").withColumn("at", F.monotonically_increasing_id()), "merkle-leaves")
    laid = laid.withColumn("part", F.shiftright("at", 33))
    # One row for each tree in each partition of the range shuffle.
    parts = laid.groupBy("tree", "part").agg(F.min("at").alias("begin"), F.count("*").alias("rows"))
    ahead = F.sum("rows").over(W.partitionBy("tree").orderBy("part")) - F.col("rows")
    sizes = parts.select("tree", "part", "begin", ahead.alias("ahead"), F.sum("rows").over(W.partitionBy("tree")).alias("n"))
    return laid.join(sizes, ["tree", "part"]).select(*rows.columns, (F.col("at") - F.col("begin") + F.col("ahead")).alias("index"), "n")


def _rounds(leaves: DataFrame, height: int) -> list[DataFrame]:
    """The log of numbered leaves, one table for each round of blocks."""
    nodes, logs, base = leaves, [], 0
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while True:
        logs.append(written(_build(nodes, height, base), f"merkle-log-{len(logs)}"))
        base += height
        if nodes_at(largest, base) <= 1:
            return logs
        unfinished = (F.col("level") == base) & (F.col("n") > F.lit(2**base))
        nodes = logs[-1].where(unfinished).select("tree", "doc_id", "presented", "hash", "index", "n")


def _paths(rounds: list[DataFrame], above: DataFrame, height: int) -> DataFrame:
    """Proofs of all leaves, where ``above`` has each tree's proof of its top."""
    below = None
    for turn in reversed(range(len(rounds))):
        base = turn * height
        log = rounds[turn]
        # A tree that this round ends gets what is above it, any other the proofs of its blocks' tops.
        ends = log.where((F.col("n") <= F.lit(2 ** (base + height))) & (F.col("level") == base) & (F.col("index") == 0))
        tops = ends.select("tree", "block").join(above, "tree")
        if below is not None:
            tops = tops.unionByName(below.select("tree", F.col("index").alias("block"), "proof", "subroot", "root"))
        below = _extract(log, tops, height, base)
        if turn:
            below = written(below, f"merkle-paths-{turn}")
    return below


def leaves(docs: DataFrame, group: str = "lang", id: str = "doc_id", fields: tuple[str, ...] = FIELDS, presented: Column | None = None) -> DataFrame:
    """Each row as a leaf: tree, doc_id, hash, and the hash that somebody presents for it."""
    named = docs[f"`{group}`"].cast("string")
    tree = F.when(named.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), named))
    shown = F.lit(None).cast("string") if presented is None else presented
    return docs.select(tree.alias("tree"), docs[f"`{id}`"].cast("long").alias("doc_id"), shown.alias("presented"), digest(*[docs[f"`{c}`"] for c in fields]).alias("hash"))


def merkle_manifest(hashed: DataFrame, height: int = HEIGHT) -> Manifest:
    """The manifest of rows with tree, doc_id, hash and presented (:func:`leaves`).

    Blocks take 2**height leaves.  The logs are written to the shared folder.
    """
    hashed = written(hashed.select("tree", "doc_id", "presented", "hash"), "merkle-hashed")
    groups = _rounds(_numbered(hashed, ["doc_id", "hash"]), height)
    # In the tree over the groups a leaf presents its group's key.
    over = _tops(groups, height).select(F.lit("").alias("tree"), F.lit(None).cast("long").alias("doc_id"), F.col("tree").alias("presented"), "hash")
    return Manifest(groups, _rounds(_numbered(over, ["presented"]), height), height)
