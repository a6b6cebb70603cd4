"""Versioned dimensions rebuilt from a history of changes.

:func:`wattlake.operators.scd.scd2_apply` compares one snapshot with the current rows.
Here every change carries its own time, a key may change many times in one batch, and a
change may be older than versions that are stored.  Because equal neighbours are one
version, the stored versions alone forget when a value was confirmed; so changes are kept
(``acq.<dimension>Changes``), and a key that a batch touches is replayed from all it has.
The versions then depend on the changes only, not on their order or their batches.

A key with very many changes is not one group: neighbours are looked up day by day, and
only one row for each day meets the days beside it.

Every step looks at its rows more than once: a neighbour is found beside them, new rows
are counted and numbered.  A caller that can store rows passes ``keep``, so that a step is
not computed again for each look.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.operators.keys import next_start, with_surrogate_keys
from wattlake.operators.scd import Dimension

CHANGED_AT = "changedAt"


def change_table(shape: Dimension) -> str:
    """The stored history of a dimension's changes."""
    return f"acq.{shape.table.split('.')[1]}Changes"


def _beside(rows: DataFrame, at: str, value: str, name: str, later: bool) -> DataFrame:
    """Add ``name``: a struct with the ``value`` of the row before (or after) of the same key.

    NULL where there is no such row.  No two rows of a key share ``at``.
    """
    held = F.struct(F.col(value).alias("value"))
    shift, pick = (F.lead, F.min_by) if later else (F.lag, F.max_by)
    days = rows.withColumn("__day", F.to_date(at))
    within = shift(held).over(Window.partitionBy("__key", "__day").orderBy(at))
    edges = days.groupBy("__key", "__day").agg(pick(held, at).alias("__edge"))
    outer = shift("__edge").over(Window.partitionBy("__key").orderBy("__day"))
    # Days are dealt out as the rows already are; what of them compresses well is not small.
    edges = edges.select(F.col("__key").alias("__k"), F.col("__day").alias("__d"), outer.alias("__edge")).hint("merge")
    joined = days.withColumn(name, within).join(edges, (F.col("__key") == F.col("__k")) & (F.col("__day") == F.col("__d")))
    return joined.withColumn(name, F.coalesce(name, "__edge")).drop("__day", "__k", "__d", "__edge")


def scd2_replay(
    dimension: DataFrame,
    changes: DataFrame,
    shape: Dimension,
    history: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """The whole dimension after ``changes``; each one holds from its time to the next one's.

    ``changes`` has the natural key, ``changedAt``, the tracked and the carried columns;
    ``history`` the changes of earlier batches in the same layout.  A NULL key or time
    stops the run.  Of changes of a key at one time the one with the greatest values
    counts, in a dimension kept by days the last of a day; repeated changes count once.
    Stored versions are changes at their start, and a stored gap stays a gap.

    A version that begins when a stored one began keeps its key and takes its values from
    the replay.  A stored version whose start is no longer a change, because an earlier
    change gives the same values, keeps its row for the facts that name it, with an empty
    interval: it ends when it begins.  Keys that no change touches stay as they are.
    ``keep`` stores rows and reads them back.
    """
    key, fields = shape.natural_key, dimension.schema.fields
    grain = dimension.schema["recordEffectiveDate"].dataType

    def events(df: DataFrame, at: Column, known: bool = True) -> DataFrame:
        value = F.struct(*[F.col(c).cast(dimension.schema[c].dataType).alias(c) for c in shape.tracked])
        carried = F.struct(*[F.col(c).cast(dimension.schema[c].dataType).alias(c) for c in shape.carried])
        return df.select(
            F.col(key).cast(dimension.schema[key].dataType).alias("__key"),
            at.cast("timestamp_ntz").alias("__at"),
            (value if known else F.when(F.lit(False), value)).alias("__value"),
            (carried if known else F.when(F.lit(False), carried)).alias("__carried"),
        )

    wrong = F.col("__key").isNull() | F.col("__at").isNull()
    message = F.raise_error(F.lit(f"a change without {key} or {CHANGED_AT}"))
    given = events(changes, F.col(CHANGED_AT)).withColumn("__key", F.when(wrong, message.cast(dimension.schema[key].dataType)).otherwise(F.col("__key")))
    touched = given.select(F.col("__key").alias("__touched")).distinct()

    stored = dimension.join(touched, F.col(key) == F.col("__touched"), "left_semi")
    lasting = F.col("recordExpirationDate").isNull() | (F.col("recordExpirationDate") > F.col("recordEffectiveDate"))
    live = stored.filter(lasting)
    sources = [
        given,
        events(live, F.col("recordEffectiveDate")),
        # Where a version ends and no other begins, nothing holds.
        events(live.filter(F.col("recordExpirationDate").isNotNull()), F.col("recordExpirationDate"), known=False),
    ]
    if history is not None:
        earlier = events(history, F.col(CHANGED_AT))
        sources.append(earlier.join(touched, F.col("__key") == F.col("__touched"), "left_semi"))
    moments = (
        reduce(DataFrame.unionByName, sources)
        .groupBy("__key", F.col("__at").cast(grain).alias("__from"))
        .agg(F.max(F.struct("__at", "__value", "__carried")).alias("__last"))
        .select("__key", "__from", "__last.__value", "__last.__carried")
    )
    compared = _beside(keep(moments), "__from", "__value", "__before", later=False)
    begun = compared.filter(~F.col("__value").eqNullSafe(F.col("__before.value"))).drop("__before")
    versions = _beside(keep(begun), "__from", "__from", "__after", later=True).filter(F.col("__value").isNotNull())

    # Of stored rows that begin together one lasts at most.
    first = Window.partitionBy(key, "recordEffectiveDate").orderBy(lasting.desc(), F.col(shape.sk).desc())
    ranked = stored.withColumn("__place", F.row_number().over(first))
    same = (F.col("__key") == F.col(key)) & (F.col("__from") == F.col("recordEffectiveDate")) & (F.col("__place") == 1)
    paired = versions.join(ranked, same, "full_outer")
    replayed = F.col("__key").isNotNull()
    until = F.col("__after.value")
    values: dict[str, Column] = {
        key: F.col("__key"),
        **{c: F.col(f"__value.{c}") for c in shape.tracked},
        **{c: F.col(f"__carried.{c}") for c in shape.carried},
        "recordEffectiveDate": F.col("__from"),
        "recordExpirationDate": until,
        "isCurrent": until.isNull(),
    }
    emptied: dict[str, Column] = {"recordExpirationDate": F.col("recordEffectiveDate"), "isCurrent": F.lit(False)}

    def settled(name: str) -> Column:
        if name == shape.sk:
            return F.col(name)
        return F.when(replayed, values[name]).otherwise(emptied.get(name, F.col(name)))

    rows = keep(paired.select(*[settled(f.name).cast(f.dataType).alias(f.name) for f in fields]))
    kept = rows.filter(F.col(shape.sk).isNotNull())
    opened = rows.filter(F.col(shape.sk).isNull()).drop(shape.sk)
    numbered = with_surrogate_keys(opened, shape.sk, [key, "recordEffectiveDate"], next_start(dimension, shape.sk))
    untouched = dimension.join(touched, F.col(key) == F.col("__touched"), "left_anti")
    return untouched.unionByName(kept).unionByName(numbered.select(*dimension.columns))


def lasting_versions(dimension: DataFrame) -> DataFrame:
    """Rows that hold for some time; those emptied by a replay do not."""
    return dimension.filter(
        F.col("recordExpirationDate").isNull() | (F.col("recordExpirationDate") > F.col("recordEffectiveDate"))
    )
