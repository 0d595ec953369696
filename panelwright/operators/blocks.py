"""Ordered scans over series of any length, one time block at a time.

A plain ``Window.partitionBy(keys)`` puts a whole series into one task, which one hot series turns
into the bottleneck of the job. Here a row's group is ``(keys, block)``. What a block has to know
about the rest of its series (rows before it, last known value, tail of values) is a small summary
per block: it is aggregated, scanned in block order per series, and joined back on the same key the
rows are already partitioned by. The rows themselves are shuffled once, however many scans follow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from panelwright.spec import PanelSpec

BLOCK = "_block"


def group(spec: PanelSpec) -> list[str]:
    return [*spec.keys, BLOCK]


def tag(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows with their block. Rows that lack a key or a time belong to no series and are left out."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in spec.natural_key])
    return df.filter(present).withColumn(BLOCK, spec.block(df))


def spread(tagged: DataFrame, spec: PanelSpec) -> DataFrame:
    return tagged.repartition(*group(spec))


def blocked(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows partitioned by series and block; rows that already are stay where they are."""
    return df if BLOCK in df.columns else spread(tag(df, spec), spec)


def attach(rows: DataFrame, carry: DataFrame, spec: PanelSpec, how: str = "inner") -> DataFrame:
    """Joins block summaries to their rows.

    The rows are partitioned by the join key, so only the summaries move. They are hashed partition by
    partition: nothing is broadcast that grows with the data, and the rows keep their order, so the
    next window needs no sort.
    """
    return rows.join(carry.hint("shuffle_hash"), group(spec), how)


def in_block(spec: PanelSpec, newest_first: bool = False) -> WindowSpec:
    order = F.col(spec.time).desc() if newest_first else F.col(spec.time).asc()
    return Window.partitionBy(*group(spec)).orderBy(order)


def across_blocks(spec: PanelSpec, newest_first: bool = False) -> WindowSpec:
    """Window over block summaries: one row per block of a series."""
    order = F.col(BLOCK).desc() if newest_first else F.col(BLOCK).asc()
    return Window.partitionBy(*spec.keys).orderBy(order)


def running_counts(df: DataFrame, spec: PanelSpec, counts: dict[str, Column],
                   totals: dict[str, str] | None = None) -> DataFrame:
    """Adds, per name, how many rows of the series up to this one fulfil the condition.

    ``totals`` maps further names to the names whose count over the whole series they hold. The block
    counts are aggregated before the shuffle.
    """
    tagged = df if BLOCK in df.columns else tag(df, spec)
    rows = blocked(df, spec)
    each = tagged.groupBy(*group(spec)).agg(*[F.count_if(c).alias(f"_in_{n}") for n, c in counts.items()])
    whole = Window.partitionBy(*spec.keys)
    carry = each.select(
        *group(spec),
        *[(F.sum(f"_in_{n}").over(across_blocks(spec)) - F.col(f"_in_{n}")).alias(f"_before_{n}") for n in counts],
        *[F.sum(f"_in_{n}").over(whole).alias(total) for total, n in (totals or {}).items()])
    upto = in_block(spec).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    made = {n: F.col(f"_before_{n}") + F.count_if(c).over(upto) for n, c in counts.items()}
    return attach(rows, carry, spec).withColumns(made).drop(*[f"_before_{n}" for n in counts])


def positions(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Adds ``pos``, the 1-based place of a row in its series, and ``n``, the length of the series."""
    return running_counts(df, spec, {"pos": F.lit(True)}, {"n": "pos"})


def neighbours(rows: DataFrame, spec: PanelSpec, payload: Column) -> DataFrame:
    """Adds ``_prev`` and ``_next``, the nearest non-null payloads at or before and at or after a row."""
    rows = blocked(rows, spec).withColumn("_load", payload)
    known_time = F.when(F.col("_load").isNotNull(), F.col(spec.time))
    ends = rows.groupBy(*group(spec)).agg(
        F.min_by("_load", known_time).alias("_first"),
        F.max_by("_load", known_time).alias("_last"))
    earlier = (Window.unboundedPreceding, -1)
    carry = ends.select(
        *group(spec),
        F.last("_last", True).over(across_blocks(spec).rowsBetween(*earlier)).alias("_before"),
        F.last("_first", True).over(
            across_blocks(spec, newest_first=True).rowsBetween(*earlier)).alias("_after"))
    # A block that nothing borders on, such as that of a series of one block, sends nothing.
    carry = carry.filter(F.col("_before").isNotNull() | F.col("_after").isNotNull())
    upto = (Window.unboundedPreceding, Window.currentRow)
    back = F.last("_load", True).over(in_block(spec).rowsBetween(*upto))
    ahead = F.last("_load", True).over(in_block(spec, newest_first=True).rowsBetween(*upto))
    return (attach(rows, carry, spec, "left")
            .withColumn("_prev", F.coalesce(back, "_before"))
            .withColumn("_next", F.coalesce(ahead, "_after"))
            .drop("_load", "_before", "_after"))
