"""Fuzzy line deduplication: MinHash signatures, banding, exact check, union-find.

A line's shingles are all runs of ``SHINGLE`` characters in it; a shorter line is its own
shingle.  Two lines are linked if they share at least 0.8 of the union of their shingles.
Every shingle has one hash.  A band is the next few hashes, in their order around a circle,
behind one of several places of the circle, so one pass over a line gives all its bands; a
short line is put in order several times, by other hashes.  Lines that share a band are
candidates; two lines at 0.8 share none with probability 8e-4 or so (``LEVELS``).

Equal lines are one entry, so only different texts are signed and compared.  In each band
entries are first checked against its smallest entry only: a band of any size costs one
check for each entry.  What is still apart in a band then meets: entries outside of its
largest component against all others, block by block inside arrays, which give back one
link for each two components that belong together.  So no link between two groups is
missed, and no pair is a row but those with a band's smallest entry.  Two entries of an
array are compared by their least hashes first (``FEW``).  Checks count common shingles
exactly.

Everything is DataFrame functions.

Defined cases: blank lines are no lines, they are neither counted nor removed; a NULL text
has no lines; of lines alike the first by document id and place stays, of repeated rows
any one; rows without an id take part, and as NULL sorts first theirs stay; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import written
from wattlake.llm.components import components

SHINGLE = 5
#: Lines of ``low`` to below ``high`` shingles: how often they are put in order, places of a
#: circle, hashes of a band.  Two lines at 0.8 have a level in common, as each ``high`` is at
#: least 1.25 times the next ``low``.
LEVELS = ((0, 12, 8, 1, 2), (10, 36, 18, 1, 4), (29, 190, 4, 5, 5), (150, 1 << 30, 1, 18, 5))
#: Characters of each of two sides that meet in one array at most, but for longer single lines.
BLOCK = 100_000
#: So many least hashes of two lines tell which pairs of a band are worth an exact check.
FEW = 64
#: Shuffle files go when their query ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _hashes(line: Column, length: int) -> Column:
    """Hashes of the shingles of a line in their order, repeated ones too."""

    # Four bytes a character: a shingle is found by its place.  The array holds the bytes once for all places.
    def every(codes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.octet_length(codes) - (4 * length - 1), F.lit(1)), F.lit(4))
        return F.transform(starts, lambda i: F.xxhash64(F.substring(codes, i, F.lit(4 * length))))

    return F.get(F.transform(F.array(F.encode(line, "UTF-32")), every), F.lit(0))


def shingles(line: Column, length: int = SHINGLE) -> Column:
    """Hashes of the different shingles of a line."""
    return F.array_distinct(_hashes(line, length))


def _banded(entries: DataFrame, length: int, levels: tuple) -> DataFrame:
    """One row (band, entry, n) for each band of an entry's line of n shingles."""
    names = ("low", "high", "orders", "places", "rows")
    kinds = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in zip(names, level, strict=True))) for level in levels))
    signed = entries.where("entry IS NOT NULL").select("entry", F.sort_array(shingles(F.col("line"), length)).alias("hashes"))
    n = F.size("hashes")
    dealt = signed.select("entry", n.alias("n"), "hashes", F.explode(F.filter(kinds, lambda k: (n >= k["low"]) & (n < k["high"]))).alias("kind"))
    dealt = dealt.select("entry", "n", "hashes", "kind.places", "kind.rows", F.explode(F.sequence(F.lit(0), F.col("kind.orders") - 1)).alias("order"))
    again = F.sort_array(F.transform("hashes", lambda h: F.xxhash64(h, F.col("order"))))
    ordered = dealt.select("entry", "n", "places", "rows", F.when(F.col("order") == 0, F.col("hashes")).otherwise(again).alias("ring"))
    # Of an array by name Spark first asks whether it is empty, and makes it again for that.
    places = ordered.select("*", F.explode(F.sequence(F.lit(0), F.size("ring") - 1)).alias("at")).withColumn("hash", F.get("ring", "at"))

    def part(hash: Column) -> Column:
        return F.shiftright((F.shiftright(hash, 33) + F.lit(1 << 30)) * F.col("places"), 31)

    def ahead(k: int) -> Column:
        return F.get("ring", F.pmod(F.col("at") + k, F.size("ring")))

    begins = (F.col("at") == 0) | (part(F.col("hash")) != part(F.get("ring", F.col("at") - 1)))
    most = max(level[-1] for level in levels)
    own = [F.when(F.col("rows") > k, ahead(k)) for k in range(1, most)]
    return places.where(begins).select(F.xxhash64("places", "hash", *own).alias("band"), "entry", "n")


def _linked(pairs: DataFrame, entries: DataFrame, percent: int, length: int) -> DataFrame:
    """The pairs (a, b) of entries whose lines, of na and nb shingles, are linked."""
    left, right = (entries.select(F.col("entry").alias(e), F.col("line").alias(name)) for e, name in (("a", "la"), ("b", "lb")))
    sets = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", _hashes(F.col("la"), length).alias("sa"), _hashes(F.col("lb"), length).alias("sb"))
    # A column of its own: inside of the generator it would be made for each time it is named.
    met = sets.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("common"))
    near = (100 + percent) * F.col("common") >= percent * (F.col("na") + F.col("nb"))
    # A filter would be moved below and make the sets again for each time it names them.
    return met.select("a", "b", F.explode(F.when(near, F.array(F.lit(True)))).alias("near")).select("a", "b")


def _lines(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Every line that is not blank, with two hashes of its text."""
    rows = docs.select(docs[f"`{id}`"].alias("doc_id"), docs[f"`{text}`"].alias("body")).withColumn("row", F.monotonically_increasing_id())
    return (
        rows.select("doc_id", "row", F.posexplode(F.split("body", "\n")).alias("pos", "line"))
        .where(F.col("line").rlike(r"\S"))
        .withColumn("h1", F.xxhash64("line"))
        .withColumn("h2", F.xxhash64(F.lit(7), F.col("line")))
    )


def _fewest(percent: int) -> int:
    """Of the FEW least hashes of two linked lines so many at least are common, but for one pair in millions.

    Those of the union are a sample of it, and as many of them are common as a binomial law gives.
    """
    share = percent / 100
    return max(0, int(FEW * share - 6 * (FEW * share * (1 - share)) ** 0.5))


def _across(rows: DataFrame, entries: DataFrame, percent: int, length: int, limit: int) -> DataFrame:
    """Links between the components of a band's guests and of all its entries.

    A band of two blocks or more is cut, two blocks of it to an array.
    """

    def parts(side: Column) -> Column:
        return (1 + F.coalesce(F.sum(F.when(side, F.col("size"))), F.lit(0)) / limit).cast("int")

    guest, large = F.col("guest"), F.col("total") > limit
    sizes = rows.groupBy("band").agg(F.sum("size").alias("total"), parts(guest).alias("outer"), parts(~guest).alias("inner"))
    spread = F.xxhash64("entry")
    block = F.when(~large, 0).when(guest, F.pmod(spread, F.col("outer"))).otherwise(F.col("outer") + F.pmod(spread, F.col("inner")))
    last = F.when(large, F.col("outer") + F.when(guest, F.col("inner")).otherwise(0) - 1).otherwise(0)
    met = rows.join(sizes, "band").withColumn("block", block.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    met = met.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    met = met.select("low", "high", "band", "block", "entry", "component", "n").join(entries.select("entry", "line"), "entry")
    # Lines are dealt out, their hashes are made where they meet; of those the least are a sample.
    dealt = met.repartition("band", "low", "high").withColumn("all", F.sort_array(_hashes(F.col("line"), length)))
    member = F.struct("entry", "component", "block", "n", "all", F.slice(F.array_distinct(F.slice("all", 1, 3 * FEW)), 1, FEW).alias("few"))
    held = dealt.groupBy("band", "low", "high").agg(F.collect_list(member).alias("held"))

    def near(x: Column, y: Column) -> Column:
        least, most = F.least(x["n"], y["n"]), F.greatest(x["n"], y["n"])
        once = F.when(F.col("low") == F.col("high"), x["entry"] < y["entry"]).otherwise((x["block"] == F.col("low")) & (y["block"] == F.col("high")))
        full = F.least(F.size(x["few"]), F.size(y["few"])) == FEW
        likely = ~full | (F.size(F.array_intersect(x["few"], y["few"])) >= _fewest(percent))
        # common shingles of a union of least + most - common
        enough = (100 + percent) * F.size(F.array_intersect(x["all"], y["all"])) >= percent * (least + most)
        return once & (x["component"] != y["component"]) & (100 * least >= percent * most) & likely & enough

    def links(x: Column) -> Column:
        others = F.filter("held", lambda y: near(x, y))
        return F.transform(others, lambda y: F.struct(F.greatest(x["component"], y["component"]).alias("a"), F.least(x["component"], y["component"]).alias("b")))

    return held.select(F.explode(F.array_distinct(F.flatten(F.transform("held", links)))).alias("link")).select("link.a", "link.b")


def _apart(met: DataFrame, joined: DataFrame) -> DataFrame:
    """Entries of bands that hold several components; ``guest`` if not of the band's largest.

    Bands in which the same entries are left are one.
    """
    of = joined.withColumnRenamed("node", "entry")
    placed = met.select("band", "entry", "n").join(of, "entry", "left").withColumn("component", F.coalesce("component", "entry"))
    sums = [F.bit_xor(F.xxhash64(F.lit(seed), "entry")).alias(f"sum{seed}") for seed in (1, 2)]
    held = placed.groupBy("band", "component").agg(F.count("*").alias("held"), F.min("entry").alias("first"), *sums)
    bands = held.groupBy("band").agg(
        F.max(F.struct("held", "component")).alias("main"), F.count("*").alias("kinds"), F.sum("held").alias("held"),
        F.min("first").alias("first"), *(F.bit_xor(f"sum{seed}").alias(f"sum{seed}") for seed in (1, 2)),
    )
    mixed = bands.where("kinds > 1").groupBy("held", "first", "sum1", "sum2").agg(F.min(F.struct("band", "main.component")).alias("one"))
    mixed = mixed.select("one.band", F.col("one.component").alias("main"))
    return placed.join(mixed, "band").select("band", "entry", "n", "component", (F.col("component") != F.col("main")).alias("guest"))


def _grouped(docs: DataFrame, id: str, text: str, percent: int, length: int, levels: tuple, block: int) -> tuple[DataFrame, DataFrame]:
    """The lines, and for each text that is not alone the line kept of its group and the texts of it."""
    lines = written(_lines(docs, id, text).select("doc_id", "row", "pos", "h1", "h2"), "line-rows")
    texts = _lines(docs, id, text).groupBy("h1", "h2").agg(F.first("line").alias("line"), F.count("*").alias("times"))
    entries = written(texts.withColumn("entry", F.monotonically_increasing_id()).withColumn("size", F.length("line")), "line-entries")

    keyed = _banded(entries, length, levels).repartition("band")
    heads = keyed.groupBy("band").agg(F.min("entry").alias("head"), F.min_by("n", "entry").alias("head_n"), F.count("*").alias("held"))
    met = written(keyed.join(heads.where("held > 1").hint("shuffle_hash"), "band").where("entry != head"), "line-bands")
    sized = met.where(100 * F.least("n", "head_n") >= percent * F.greatest("n", "head_n"))
    stars = sized.select(F.col("entry").alias("a"), F.col("head").alias("b"), F.col("n").alias("na"), F.col("head_n").alias("nb")).distinct()
    joined = written(components(written(_linked(stars, entries, percent, length), "line-links")), "line-first")

    # Second round: entries of one band in different components; heads were checked already.
    apart = written(_apart(met.where("held > 2"), joined).join(entries.select("entry", "size"), "entry"), "line-apart")
    late = written(_across(apart, entries, percent, length, block), "line-late")
    edges = joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(late)
    final = components(edges).withColumnRenamed("node", "entry")

    # Most lines come once and have no near copy; only the others are looked up.
    placed = entries.select("h1", "h2", "times", "entry").join(final, "entry", "left").where("times > 1 OR component IS NOT NULL")
    placed = written(placed.select("h1", "h2", F.coalesce("component", "entry").alias("component")), "line-groups")
    firsts = lines.join(placed, ["h1", "h2"]).groupBy("component").agg(F.min(F.struct("doc_id", "pos", "row")).alias("kept"))
    stays = firsts.join(placed.groupBy("component").agg(F.count("*").alias("texts")), "component")
    return lines, written(placed.join(stays, "component").select("h1", "h2", "kept", "texts"), "line-kept")


def line_groups(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    percent: int = 80,
    length: int = SHINGLE,
    levels: tuple = LEVELS,
    block: int = BLOCK,
) -> DataFrame:
    """One row for each line that is not blank: doc_id, row, pos, keep, and its group.

    The group is named by the document and place of the line of it that is kept.  Lines
    with at least ``percent`` of their ``length``-character shingles in common are linked.
    """
    if length < 1:
        raise ValueError(f"length must be at least 1, not {length}")
    conf = docs.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        lines, verdict = _grouped(docs, id, text, percent, length, levels, block)
    finally:
        conf.set(CLEANUP, before)
    alone = F.col("kept").isNull()
    return lines.join(verdict, ["h1", "h2"], "left").select(
        "doc_id",
        "row",
        "pos",
        (alone | F.struct("doc_id", "pos", "row").eqNullSafe(F.col("kept"))).alias("keep"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("kept.doc_id")).alias("group_doc"),
        F.when(alone, F.col("pos")).otherwise(F.col("kept.pos")).alias("group_pos"),
        F.coalesce("texts", F.lit(1)).alias("texts"),
    )


def line_report(groups: DataFrame) -> DataFrame:
    """One row for each document row with lines: how many, and which are removed for which."""
    gone = F.when(~F.col("keep"), F.struct("pos", "group_doc", "group_pos"))
    return groups.groupBy("doc_id", "row").agg(
        F.count("*").alias("n_lines"),
        F.sum(F.col("keep").cast("long")).alias("n_kept"),
        F.sort_array(F.collect_list(gone)).alias("removed"),
    )


def without_duplicates(docs: DataFrame, groups: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with duplicate lines taken out of the text; ids must be unique."""
    gone = groups.where(~F.col("keep")).groupBy(F.col("doc_id").alias("gone_id")).agg(F.collect_list("pos").alias("gone"))
    # The row is carried as one struct: its columns may have any names.
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    met = row.join(gone, F.col("row").getField(id).eqNullSafe(F.col("gone_id")), "left").withColumn("body", F.col("row").getField(text))
    kept = F.expr("array_join(filter(transform(split(body, '\n'), (l, i) -> CASE WHEN array_contains(gone, i) THEN NULL ELSE l END), l -> l IS NOT NULL), '\n')")
    body = F.when(F.col("gone").isNull(), F.col("body")).otherwise(kept)
    return met.select(*[(body if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])
