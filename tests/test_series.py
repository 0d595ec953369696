"""Series operators on small panels; every result must not depend on blocks or partitions."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwright.operators import series as W
from panelwright.operators.blocks import positions
from panelwright.operators.spline import fill_spline, solve
from panelwright.spec import PanelSpec

SPEC = PanelSpec(("k",), "d", "v")
DAY = dt.date(2024, 1, 1)


def day(i: int) -> dt.date:
    return DAY + dt.timedelta(days=i)


def panel(spark, series: dict[str, list], offsets: list[int] | None = None):
    rows = [(k, day(offsets[i] if offsets else i), None if v is None else float(v))
            for k, values in series.items() for i, v in enumerate(values)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "k string, d date, v double")


def values(df, column="v", key="a"):
    return [r[column] for r in df.filter(F.col("k") == key).orderBy("d").collect()]


def test_latest_n(spark):
    df = panel(spark, {"a": [1, 2, 4, 9]}, [1, 2, 4, 9])
    rows = W.latest_n(df, 3, SPEC).orderBy("d").collect()
    assert [r.d for r in rows] == [day(2), day(4), day(9)]


def test_latest_n_limits_rows_before_the_shuffle(spark):
    df = panel(spark, {"a": range(9), "b": range(9)})
    plan = W.latest_n(df, 3, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("as_of, want", [
    (4, [(1, 10), (2, 20), (4, 30)]),
    (6, [(4, 30), (5, 30), (6, 30)]),
    (11, [(9, 30), (10, 30), (11, 30)]),
    (12, [(1, 10), (2, 20), (4, 30)]),
    (3, [(1, 10), (2, 20), (4, 30)]),
])
def test_carry_forward(spark, as_of, want):
    windows = W.latest_windows(panel(spark, {"a": [10, 20, 30]}, [1, 2, 4]), 3, SPEC)
    rows = W.window_rows(W.carry_forward(windows, F.lit(day(as_of)), 3), SPEC).orderBy("d").collect()
    assert [(r.d, r.v) for r in rows] == [(day(d), v) for d, v in want]


@pytest.mark.parametrize("as_of, count", [(5, 2), (6, 3)])
def test_carry_forward_lengthens_a_short_series(spark, as_of, count):
    windows = W.latest_windows(panel(spark, {"a": [30]}, [4]), 3, SPEC)
    assert W.window_rows(W.carry_forward(windows, F.lit(day(as_of)), 3), SPEC).count() == count


def test_supervised(spark):
    rows = W.supervised(panel(spark, {"a": [1, 2, 3, 4]}), 2, 1, SPEC).orderBy("d").collect()
    assert [(r.lag_2, r.lag_1, r.y) for r in rows] == [(1, 2, 3), (2, 3, 4)]


@pytest.mark.parametrize("n, train", [(10, 7), (17, 11), (7, 4)])
def test_temporal_split(spark, n, train):
    rows = W.temporal_split(panel(spark, {"a": range(n)}), SPEC)
    assert values(rows, "split") == ["train"] * train + ["test"] * (n - train)


@pytest.mark.parametrize("known, filled", [
    ([None, 10, None, None, 40, None], [10, 10, 20, 30, 40, 40]),
    ([None, None], [None, None]),
    ([5, None], [5, 5]),
])
def test_fill_linear(spark, known, filled):
    assert values(W.fill_linear(panel(spark, {"a": known}), SPEC)) == filled


@pytest.mark.parametrize("known, filled", [
    ([0, 1, None, 27, 64], [0, 1, 8, 27, 64]),
    ([10, None, 20], [10, 15, 20]),
    ([100, 499000, None, None, 499000, 100], [100, 499000, 499000, 499000, 499000, 100]),
    ([None, 0, 1, None, 27, 64, None], [0, 0, 1, 8, 27, 64, 64]),
    ([None, None], [None, None]),
])
def test_fill_spline(spark, known, filled):
    assert values(fill_spline(panel(spark, {"a": known}), SPEC)) == pytest.approx(filled)


def test_parts_are_filled_apart(spark):
    df = panel(spark, {"a": [1, 2, None, None, 50, 60]})
    for fill in (W.fill_linear, fill_spline):
        rows = fill(W.temporal_split(df, SPEC, share=0.5), SPEC, part="split")
        assert values(rows) == [1, 2, 2, 50, 50, 60]


def test_lags_of_the_whole_series_give_the_first_test_windows(spark):
    rows = W.supervised(W.temporal_split(panel(spark, {"a": range(1, 10)}), SPEC, 0.8), 7, 1, SPEC)
    got = rows.filter("split = 'test'").orderBy("d").collect()
    assert [(r.lag_7, r.lag_1, r.y) for r in got] == [(1, 7, 8), (2, 8, 9)]


def test_systems_that_follow_each_other_are_solved_at_once():
    rng = np.random.default_rng(1)
    sizes = [1, 2, 3, 7, 64, 65, 200]
    lower, upper = rng.random((2, sum(sizes)))
    main, right = 4 + rng.random(sum(sizes)), rng.random((sum(sizes), 2))
    start = np.cumsum([0, *sizes[:-1]])
    lower[start], upper[np.cumsum(sizes) - 1] = 0, 0
    want = np.linalg.solve(np.diag(main) + np.diag(lower[1:], -1) + np.diag(upper[:-1], 1), right)
    np.testing.assert_allclose(solve(lower, main, upper, right), want, rtol=1e-13)


def whole_spline(y: list) -> list:
    """One unblocked spline over a whole series, by a dense solve."""
    s = pd.Series(y, dtype=float)
    x, v = np.flatnonzero(s.notna()).astype(float), s.dropna().to_numpy()
    n, h = len(x), np.diff(x)
    a, b = np.zeros((n, n)), np.zeros(n)
    for i in range(1, n - 1):
        a[i, i - 1:i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        b[i] = 6 * ((v[i + 1] - v[i]) / h[i] - (v[i] - v[i - 1]) / h[i - 1])
    a[0, :3] = h[1], -(h[0] + h[1]), h[0]
    a[-1, -3:] = h[-1], -(h[-2] + h[-1]), h[-2]
    m = np.linalg.solve(a, b)
    out = []
    for i in range(len(y)):
        j = int(np.clip(np.searchsorted(x, i, "right") - 1, 0, n - 2))
        p, q = (x[j + 1] - i) / h[j], (i - x[j]) / h[j]
        cubic = p * v[j] + q * v[j + 1] + ((p ** 3 - p) * m[j] + (q ** 3 - q) * m[j + 1]) * h[j] ** 2 / 6
        out.append(v[0] if i < x[0] else v[-1] if i > x[-1] else cubic)
    return out


@pytest.mark.parametrize("piece", [1, 2, 7, 8192])
def test_spline_in_pieces_equals_the_whole_spline(spark, piece):
    rng = np.random.default_rng(3)
    known = (250000 + np.cumsum(rng.normal(0, 300, 900))).tolist()
    gappy = [None if rng.random() < 0.4 and 5 < i < 890 else v for i, v in enumerate(known)]
    df = panel(spark, {"a": gappy})
    spec = PanelSpec(("k",), "d", "v", width=37)
    got = values(fill_spline(df, spec, piece=piece))
    assert got == pytest.approx(whole_spline(gappy), abs=1e-8)


def test_spline_of_parts_and_many_series(spark):
    """Parts of any length side by side, some too short for a spline; each as if it were alone."""
    rng = np.random.default_rng(5)
    series = {}
    for i in range(12):
        y = (2000 + np.cumsum(rng.normal(0, 3, 10 + 7 * i))).tolist()
        series[f"s{i}"] = [None if rng.random() < 0.5 else v for v in y]
    rows = W.temporal_split(panel(spark, series), PanelSpec(("k",), "d", "v", width=11), share=0.4)
    got = fill_spline(rows, PanelSpec(("k",), "d", "v", width=11), part="split", piece=5)
    for key, y in series.items():
        cut = int(len(y) * 0.4)
        want = []
        for some in (y[:cut], y[cut:]):
            count = sum(v is not None for v in some)
            want += whole_spline(some) if count > 3 else pd.Series(some, dtype=float).interpolate(limit_direction="both").tolist()
        filled = [np.nan if v is None else v for v in values(got, key=key)]
        assert filled == pytest.approx(want, abs=1e-8, nan_ok=True)


def test_spline_solver_has_one_step_per_doubling():
    """All points take part in each step: nothing loops over them."""
    steps = []

    class Counted(np.ndarray):
        def any(self, *args, **options):
            steps.append(len(self))
            return bool(np.asarray(self).any())
    n = 5000
    one = np.ones(n)
    lower = one.copy().view(Counted)
    lower[0] = 0
    solve(lower, 4 * one, np.append(one[1:], 0.0), one[:, None])
    assert len(steps) <= 14


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 40), st.one_of(st.none(), st.integers(0, 999))), min_size=1, max_size=60),
       st.integers(1, 9))
def test_blocks_do_not_change_results(spark, steps, width):
    offsets = np.cumsum([gap for gap, _ in steps]).tolist()
    numbers = [v for _, v in steps]
    df = panel(spark, {"a": numbers, "b": numbers[::-1]}, offsets)
    spec = PanelSpec(("k",), "d", "v", width=width)
    s = pd.Series(numbers, dtype=float)

    rows = W.supervised(positions(df, spec), 3, 3, spec, drop_incomplete=False).filter("k = 'a'").orderBy("d").toPandas()
    assert rows["pos"].tolist() == list(range(1, len(s) + 1)) and set(rows["n"]) == {len(s)}
    for name, shift in {"lag_3": 3, "lag_2": 2, "lag_1": 1, "lead_1": -1, "lead_2": -2}.items():
        pd.testing.assert_series_equal(rows[name].astype(float), s.shift(shift), check_names=False)

    filled = W.fill_linear(df, spec).filter("k = 'a'").orderBy("d").toPandas()["v"].astype(float)
    want = s.interpolate("linear", limit_direction="both")
    np.testing.assert_allclose(filled, want, rtol=1e-9)
    kept = s.notna()
    assert filled[kept].tolist() == s[kept].tolist()


def test_timestamp_blocks(spark):
    stamps = [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i * 1.5) for i in range(40)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame([("a", t, float(i)) for i, t in enumerate(stamps)], f"k string, d {kind}, v double")
        spec = SPEC.fitted(df, rows=4)
        assert spec.width < 3600
        rows = positions(df, spec).orderBy("d").collect()
        assert [r.pos for r in rows] == list(range(1, 41))


def test_rows_without_key_or_time_belong_to_no_series(spark):
    df = spark.createDataFrame([("a", day(1), 1.0), (None, day(1), 1.0), ("a", None, 1.0)], "k string, d date, v double")
    assert positions(df, SPEC).count() == 1


def test_rows_are_shuffled_once(spark):
    """Split, gap filling and lags share one exchange of the rows; only block summaries move besides."""
    df = panel(spark, {"a": range(30), "b": range(30)})
    rows = W.supervised(W.fill_linear(W.temporal_split(df, SPEC), SPEC, part="split"), 3, 1, SPEC)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    moves = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line and "ReusedExchange" not in line]
    assert len(moves) == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_unique_panel_keeps_the_last(spark):
    df = spark.createDataFrame([("a", day(1), 1.0, 1), ("a", day(1), 3.0, 0), ("a", day(2), 5.0, 0)],
                               "k string, d date, v double, o int")
    rows = W.unique_panel(df, SPEC, "o").orderBy("d").collect()
    assert [r.v for r in rows] == [1.0, 5.0]


def test_price_history_filters_only_by_given_values(spark):
    df = panel(spark, {"a": [1, 2], "b": [3, 4]})
    assert [r.v for r in W.price_history(df, SPEC, 3).collect()] == [2.0, 4.0, 1.0]
    assert [r.v for r in W.price_history(df, SPEC, 3, k="b").collect()] == [4.0, 3.0]
    assert W.price_history(df, SPEC, 3, k="").count() == 3


@pytest.mark.parametrize("limit", [0, 101, -1])
def test_price_history_has_its_limit(spark, limit):
    with pytest.raises(ValueError, match="1 to 100"):
        W.price_history(panel(spark, {"a": [1]}), SPEC, limit)
