"""Cubic-spline gap filling with a linear fallback.

The curvature at the known points is the solution of one tridiagonal system per series. Coefficients of the system are column
expressions of a point and its two neighbours on each side. The system is solved exactly, in two levels:

* Points of consecutive blocks are cut into pieces, whose last points separate them. Within a piece the others follow from
  their separators on both sides: all pieces of an Arrow batch are solved together by cyclic reduction, a numpy step for all
  points at a time.
* What is left is a tridiagonal system of the separators alone, one in thousands of points, solved per series.

Evaluation, plausibility check and fallback are column expressions again.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators.blocks import attach, group, in_block, positions, spread
from panelwright.operators.series import linear_value, supervised, with_neighbours
from panelwright.schema import MAX_PRICE
from panelwright.session import cut_lineage, store
from panelwright.spec import CHILI, PanelSpec

PIECE = 8192


def _solver():
    """The solver as a closure: it travels to the executors by value, without this package there."""
    def solve(lower: np.ndarray, main: np.ndarray, upper: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Solutions of tridiagonal systems that follow each other, for each column of ``right``; by cyclic reduction.

        ``lower`` is 0 where a system starts and ``upper`` where it ends. After each step a row refers to rows twice as
        far away, until it refers to none.
        """
        step = 1
        while step < len(main) and (lower.any() or upper.any()):
            down, up = np.zeros_like(main), np.zeros_like(main)
            down[step:] = -lower[step:] / main[:-step]
            up[:-step] = -upper[:-step] / main[step:]
            new_main, new_right = main.copy(), right.copy()
            new_lower, new_upper = np.zeros_like(main), np.zeros_like(main)
            new_main[step:] += down[step:] * upper[:-step]
            new_main[:-step] += up[:-step] * lower[step:]
            new_right[step:] += down[step:, None] * right[:-step]
            new_right[:-step] += up[:-step, None] * right[step:]
            new_lower[step:] = down[step:] * lower[:-step]
            new_upper[:-step] = up[:-step] * upper[step:]
            lower, main, upper, right, step = new_lower, new_main, new_upper, new_right, step * 2
        return right / main[:, None]

    return solve


solve = _solver()


def _equations(known: DataFrame, spec: PanelSpec, part: str | None) -> DataFrame:
    """Known points with their row of the system (``_lower``, ``_main``, ``_upper``, ``_right``), whether they have one
    (``_inner``), and the distances ``_h0`` and ``_h1`` from which the ends of a part extrapolate.

    A part of fewer than four known points has no rows. The third derivative is continuous at the second and the last but one.
    """
    columns = ["pos", spec.value, *([part] if part else [])]
    known = known.withColumn("_point", F.struct(*columns)).select(*group(spec), spec.time, "_point", *columns)
    rows = supervised(known, 2, 3, spec, ["_point"], drop_incomplete=False)
    here = {side: F.col(side)["pos"].isNotNull() for side in ("lag_1", "lag_2", "lead_1", "lead_2")}
    if part:
        here = {side: there & F.col(side)[part].eqNullSafe(F.col(part)) for side, there in here.items()}
    at = {side: F.when(there, F.col(side)["pos"]).cast("double") for side, there in here.items()}
    v = {side: F.col(side)[spec.value].cast("double") for side in here}
    x, y = F.col("pos").cast("double"), F.col(spec.value).cast("double")
    before, after = x - at["lag_1"], at["lead_1"] - x
    rows = rows.withColumns({
        "_before": before, "_after": after, "_slope": 6.0 * ((v["lead_1"] - y) / after - (y - v["lag_1"]) / before),
        "_first": at["lag_2"].isNull(), "_last": at["lead_2"].isNull(), "_lag": at["lag_1"],
        "_head": at["lag_1"].isNull(), "_h0": F.coalesce(F.when(at["lag_1"].isNull(), after), F.when(at["lead_1"].isNull(), before)),
        "_h1": F.coalesce(F.when(at["lag_1"].isNull(), at["lead_2"] - at["lead_1"]),
                          F.when(at["lead_1"].isNull(), at["lag_1"] - at["lag_2"]))})
    h, k = F.col("_before"), F.col("_after")
    inner = h.isNotNull() & k.isNotNull() & ~(F.col("_first") & F.col("_last"))
    first, last = F.col("_first"), F.col("_last")
    none = F.lit(0.0)
    return rows.select(
        *group(spec), spec.time, *columns, "_lag", "_head", "_h0", "_h1", inner.alias("_inner"),
        F.when(inner & ~first, h - F.when(last, k * k / h).otherwise(none)).otherwise(none).alias("_lower"),
        F.when(inner & ~last, k - F.when(first, h * h / k).otherwise(none)).otherwise(none).alias("_upper"),
        F.when(inner, 2.0 * (h + k) + F.when(first, h + h * h / k).otherwise(none)
               + F.when(last, k + k * k / h).otherwise(none)).otherwise(F.lit(1.0)).alias("_main"),
        F.when(inner, F.col("_slope")).otherwise(none).alias("_right"))


# What a piece's first and last point but the separator take from: nothing, the separator before, the piece's own.
ENDS = [f"_{end}{c}" for end in ("f", "e") for c in range(3)]


def _pieces(rows: DataFrame, spec: PanelSpec, part: str | None, piece: int) -> DataFrame:
    """Adds ``_x``, ``_xl`` and ``_xr``: a point's curvature is _x + _xl * left + _xr * right, by the separators around its piece,
    of which ``_sep`` is the position of the right one. Separators get their piece's ends."""
    eliminate = _solver()
    same = [*spec.keys, *([part] if part else [])]
    rows = rows.withColumn("_series", F.xxhash64(*same)).sortWithinPartitions(*spec.keys, spec.time)
    kept = [c for c in rows.columns if c != "_series"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema]
                       + [f"{c} double" for c in ("_x", "_xl", "_xr", *ENDS)] + ["_sep bigint"])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            pos, series = batch["pos"].to_numpy(), batch["_series"].to_numpy()
            lag = batch["_lag"].to_numpy(zero_copy_only=False)
            lower, main, upper, right = (batch[c].to_numpy().copy() for c in ("_lower", "_main", "_upper", "_right"))
            fresh = np.ones(n, dtype=bool)
            fresh[1:] = (series[1:] != series[:-1]) | (lag[1:] != pos[:-1])
            fresh |= np.arange(n) % piece == 0
            start = np.flatnonzero(fresh)
            sep = np.append(start[1:], n) - 1
            sides = np.zeros((n, 3))
            sides[:, 0] = right
            sides[start, 1] = -lower[start]
            lower[start] = 0
            ahead = sep[sep > 0] - 1
            sides[ahead, 2] -= upper[ahead]
            upper[ahead] = 0
            lower[sep], upper[sep], main[sep], sides[sep] = 0, 0, 1, (0, 0, 1)
            x = eliminate(lower, main, upper, sides)
            alone = sep == start
            ends = np.full((n, 6), np.nan)
            ends[sep, :3] = np.where(alone[:, None], (0, 0, 1), x[start])
            ends[sep, 3:] = np.where(alone[:, None], (0, 1, 0), x[sep - 1])
            out = [batch[c] for c in kept]
            out += [pa.array(x[:, i]) for i in range(3)]
            out += [pa.array(ends[:, i], mask=np.isnan(ends[:, i])) for i in range(6)]
            out.append(pa.array(np.repeat(pos[sep], sep - start + 1)))
            yield pa.RecordBatch.from_arrays(out, [*kept, "_x", "_xl", "_xr", *ENDS, "_sep"])

    return rows.mapInArrow(run, schema)


def _separators(pieces: DataFrame, spec: PanelSpec, part: str | None) -> DataFrame:
    """(keys, part, ``_sep``, ``_left``, ``_right``): the curvature at the separators on both sides of every piece."""
    finish = _solver()
    same = [*spec.keys, *([part] if part else [])]
    names = ["_lower", "_main", "_upper", "_rhs", *ENDS]
    rows = pieces.where("pos = _sep").select(*same, "_sep", *[F.col("_right" if c == "_rhs" else c).alias(c) for c in names])
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([f"`{c}` {types[c]}" for c in (*same, "_sep")] + ["_left double", "_right double"])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_sep")
        lower, main, upper, rhs, f0, fl, fr, e0, el, er = (table[c].to_numpy() for c in names)
        after = [np.append(c[1:], 0.0) for c in (f0, fl, fr)]
        s = finish(lower * el, main + lower * er + upper * after[1], upper * after[2],
                   (rhs - lower * e0 - upper * after[0])[:, None])[:, 0]
        return pa.table([*(table[c] for c in (*same, "_sep")), pa.array(np.append(0.0, s[:-1])), pa.array(s)],
                        [*same, "_sep", "_left", "_right"])

    return rows.groupBy(*same).applyInArrow(run, schema)


def _with_curvature(known: DataFrame, spec: PanelSpec, part: str | None, piece: int) -> DataFrame:
    """(keys, block, time, ``_m``) of the known points, partitioned by block; null where a part has too few points."""
    pieces = store(_pieces(_equations(known, spec, part), spec, part, piece), "pieces")
    same = [*spec.keys, *([part] if part else [])]
    between = _separators(pieces, spec, part).withColumnsRenamed({c: f"_s_{c}" for c in same})
    match: Column = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in same])
    points = pieces.drop("_right").withColumnRenamed("_sep", "_piece").join(between, match & (F.col("_piece") == F.col("_sep")))
    inner = F.when(F.col("_inner"), F.col("_x") + F.col("_xl") * F.col("_left") + F.col("_xr") * F.col("_right"))
    points = spread(points.select(*group(spec), spec.time, "pos", "_head", "_h0", "_h1", inner.alias("_m")), spec)
    points = supervised(points, 2, 3, spec, ["_m"], drop_incomplete=False)
    # The ends of a part follow from the two points next to them.
    ratio = F.col("_h0") / F.col("_h1")
    ahead = F.col("lead_1") - ratio * (F.col("lead_2") - F.col("lead_1"))
    behind = F.col("lag_1") - ratio * (F.col("lag_2") - F.col("lag_1"))
    end = F.when(F.col("_h1").isNotNull(), F.when(F.col("_head"), ahead).otherwise(behind))
    return points.select(*group(spec), "pos", F.coalesce("_m", end).alias("_m"))


def fill_spline(df: DataFrame, spec: PanelSpec = CHILI, part: str | None = None,
                step: int | None = None, high: float = MAX_PRICE, piece: int = PIECE) -> DataFrame:
    """Fills gaps of ``value`` by a cubic spline between known points, edges by the nearest known value.

    If the spline of a series (or of its ``part``) is anywhere missing, negative or above ``high``,
    the whole of it is filled linearly. Known values never change. Only known points pass through Python; rows are checkpointed once
    they have their positions, and blocks get the curvature of their points as one array each.
    """
    known = F.col(spec.value).isNotNull()
    rows = df if "pos" in df.columns else positions(df, spec)
    rows = cut_lineage(rows.withColumn(spec.value, F.col(spec.value).cast("double")))
    points = _with_curvature(rows.filter(known), spec, part, piece)
    curves = points.groupBy(*group(spec)).agg(F.sort_array(F.collect_list(F.struct("pos", "_m"))).alias("_curve"))
    curves = store(curves, "curves")
    upto = in_block(spec).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = attach(spread(rows, spec), curves, spec, "left")
    place = (F.count_if(known).over(upto) - 1).cast("int")
    rows = rows.withColumn("_m", F.when(known, F.get("_curve", place)["_m"])).drop("_curve")
    rows = with_neighbours(rows, spec, part, extra=("_m",))

    before, after = F.col("_prev"), F.col("_next")
    width = after["pos"] - before["pos"]
    a = (after["pos"] - F.col("pos")) / width
    b = (F.col("pos") - before["pos"]) / width
    bend = ((a * a * a - a) * before["_m"] + (b * b * b - b) * after["_m"]) * (width * width) / 6.0
    cubic = a * before["value"] + b * after["value"] + bend
    value = F.col(spec.value).cast("double")
    inside = before.isNotNull() & after.isNotNull()
    rows = rows.withColumn("_cubic", F.when(inside, F.coalesce(value, cubic)))
    bad = inside & S.implausible(F.col("_cubic"), high)

    label = F.col(part) if part else F.lit("")
    flags = rows.groupBy(*group(spec)).agg(F.collect_set(F.when(bad, label)).alias("_bad"))
    whole = F.flatten(F.collect_set("_bad").over(Window.partitionBy(*spec.keys)))
    flags = flags.select(*group(spec), F.array_distinct(whole).alias("_bad")).filter(F.size("_bad") > 0)
    rows = attach(rows, flags, spec, "left")

    inner = F.when(F.array_contains("_bad", label), linear_value()).otherwise(F.col("_cubic"))
    filled = F.coalesce(value, inner, before["value"], after["value"])
    if step:
        filled = S.round_to(filled, step)
    return (rows.withColumn(spec.value, filled)
            .drop("_prev", "_next", "_m", "_cubic", "_bad"))
