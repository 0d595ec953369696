"""The stored price table: several writers, merge on read, compaction and reads that skip files."""

from __future__ import annotations

import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from panelwright.operators.numbering import numbered
from panelwright.sources import price_table
from panelwright.sources.price_table import PriceTable
from panelwright.sources.storage import Folder
from panelwright.spec import PanelSpec

SPEC = PanelSpec(("k",), "d", "v")
KIND = "k string, d date, v int, seq int"


def table(spark, path, **options):
    return PriceTable(spark, str(path), spark.createDataFrame([], KIND).schema, SPEC, **options)


def records(spark, *rows):
    return spark.createDataFrame([(k, dt.date(2025, month, day), v, i) for i, (k, month, day, v) in enumerate(rows)], KIND)


def content(prices, **options):
    return {(r.k, r.d.month, r.d.day): r.v for r in prices.read(**options).collect()}


def test_the_slower_of_two_writers_starts_again(spark, tmp_path):
    prices = table(spark, tmp_path / "t")
    prices.upsert(records(spark, ("a", 1, 1, 1), ("b", 1, 1, 1)), 0, source="A")
    mine = prices.prepare(records(spark, ("a", 1, 1, 9), ("c", 1, 1, 9)), 1, source="A")
    late = prices.begin(mine)
    prices.upsert(records(spark, ("a", 1, 1, 2), ("b", 1, 1, 2)), 0, source="B")
    assert not prices.finish(late)
    assert content(prices) == {("a", 1, 1): 2, ("b", 1, 1): 2}
    log = prices.upsert(mine.rows, 1, source="A").first()
    assert (log.inserted, log.updated) == (1, 1)
    assert content(prices) == {("a", 1, 1): 9, ("b", 1, 1): 2, ("c", 1, 1): 9}


def test_writers_of_other_periods_do_not_wait(spark, tmp_path):
    prices = table(spark, tmp_path / "t")
    late = prices.begin(prices.prepare(records(spark, ("a", 1, 1, 1)), 0, source="A"))
    prices.upsert(records(spark, ("a", 2, 1, 2)), 0, source="B")
    assert prices.finish(late) and prices.state().version == 2
    assert content(prices) == {("a", 1, 1): 1, ("a", 2, 1): 2}


def test_a_second_driver_with_the_same_run_applies_it_once(spark, tmp_path):
    prices, again = table(spark, tmp_path / "t"), table(spark, tmp_path / "t")
    rows = records(spark, ("a", 1, 1, 1), ("a", 1, 1, 2))
    late = again.begin(again.prepare(rows, 0))
    prices.upsert(rows, 0)
    assert again.finish(late) and again.begin(again.prepare(rows, 0)) is None
    assert [(r.inserted, r.updated) for r in prices.runs().collect()] == [(1, 1)]
    assert content(again) == {("a", 1, 1): 2}


def test_many_writers_at_once(spark, tmp_path):
    """Every thread corrects rows of a common month and adds its own; each run is one commit."""
    def work(name):
        prices = table(spark, tmp_path / "t")
        for run in range(2):
            prices.upsert(records(spark, (name, 1, 1, run), ("all", 1, 2 + run, ord(name)), (name, 2 + run, 1, 5)), run, source=name)

    threads = [threading.Thread(target=work, args=(name,)) for name in "xyz"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    prices = table(spark, tmp_path / "t")
    got = content(prices)
    assert {key: v for key, v in got.items() if key[0] != "all"} == {
        (name, month, 1): v for name in "xyz" for month, v in ((1, 1), (2, 5), (3, 5))}
    # The last committed writer of a common key has it.
    order = [(r.source, r.run_id) for r in prices.commits().orderBy("version").collect()]
    last = {run: max((i, s) for i, (s, r) in enumerate(order) if r == run)[1] for run in (0, 1)}
    assert len(order) == 6 and {got["all", 1, 2 + run] for run in (0, 1)} == {ord(last[run]) for run in (0, 1)}
    assert prices.runs().agg(F.sum("inserted")).first()[0] == len(got)


def test_a_commit_file_is_created_once(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "log"))
    wins = []
    threads = [threading.Thread(target=lambda i=i: wins.append(i) if folder.create("1", f"{i}" * 1000) else None) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(wins) == 1 and folder.read("1") == f"{wins[0]}" * 1000 and folder.names() == ["1"]


def test_a_write_is_as_large_as_its_changes(spark, tmp_path):
    prices = table(spark, tmp_path / "t")
    prices.upsert(records(spark, *[(f"k{i}", 1, d, 1) for i in range(50) for d in range(1, 29)]), 0)
    prices.upsert(records(spark, ("k3", 1, 5, 1), ("k4", 1, 5, 2), ("new", 1, 5, 3)), 1)
    new = {a for a, _ in prices.state().segments} - {a for a, _ in prices.state(1).segments}
    assert spark.read.parquet(f"{prices.data}/_attempt={new.pop()}").count() == 2
    assert prices.read().count() == 50 * 28 + 1 and content(prices, version=1)["k4", 1, 5] == 1


@pytest.mark.parametrize("compact_after", [None, 2])
def test_any_sequence_equals_a_replay(spark, tmp_path, monkeypatch, compact_after):
    monkeypatch.setattr(price_table, "SNAPSHOT_EVERY", 3)
    prices, rng, want = table(spark, tmp_path / "t", compact_after=compact_after), random.Random(3), {}
    for run in range(5):
        rows = [(rng.choice("abcdef"), rng.randint(1, 2), rng.randint(1, 3), rng.choice([1, 2, None])) for _ in range(25)]
        inserted = len({r[:3] for r in rows} - set(want))
        want |= {r[:3]: r[3] for r in rows}
        log = prices.upsert(records(spark, *rows), run).first()
        assert log.inserted == inserted and content(prices) == want
    if compact_after:
        assert all(len(s) == 1 for s in prices.state().by_period().values())
    assert {r.k: r.n_rows for r in prices.series().collect()} == {
        k: sum(key[0] == k for key in want) for k in {key[0] for key in want}}
    some = {("a", *key[1:]): v for key, v in want.items() if key[0] == "a"}
    assert {(r.k, r.d.month, r.d.day): r.v for r in prices.lookup(k="a").collect()} == some


def test_compaction_and_vacuum(spark, tmp_path):
    prices = table(spark, tmp_path / "t")
    for run in range(3):
        prices.upsert(records(spark, ("a", 1, 1, run), (f"b{run}", 1, 2, run), ("c", 1 + run, 9, 1)), run)
    before = content(prices)
    # What another writer still works on stays, and its commit after the compaction counts.
    late = prices.begin(prices.prepare(records(spark, ("a", 1, 1, 7)), 0, source="other"))
    assert prices.compact() == ["2025-01"]
    assert content(prices) == before and {p: len(s) for p, s in prices.state().by_period().items()} == {
        "2025-01": 1, "2025-02": 1, "2025-03": 1}
    assert prices.finish(late)
    assert content(prices) == before | {("a", 1, 1): 7}
    assert prices.vacuum(keep=5) == []
    gone = prices.vacuum()
    assert len(gone) == 3 and all(g.endswith("_period=2025-01") for g in gone) and prices.vacuum() == []
    assert content(prices) == before | {("a", 1, 1): 7}
    unfinished = prices.begin(prices.prepare(records(spark, ("a", 1, 1, 8)), 1, source="other"))
    assert prices.vacuum() == [] and prices.finish(unfinished)
    prices.begin(prices.prepare(records(spark, ("a", 1, 1, 6)), 2, source="other"))
    assert len(prices.vacuum(unfinished_s=-1)) == 1
    assert content(prices) == before | {("a", 1, 1): 8}


def periods_read(df):
    return {f.rsplit("_period=", 1)[1].split("/")[0] for f in df.inputFiles() if "_period=" in f}


def test_latest_rows_open_the_newest_periods_only(spark, tmp_path):
    prices = table(spark, tmp_path / "t")
    prices.upsert(records(spark, *[("a", m, d, m) for m in range(1, 9) for d in (1, 2, 3)], *[("b", m, 1, m) for m in (4, 5, 6)]), 0)
    prices.upsert(records(spark, ("a", 8, 3, 80), ("a", 8, 4, 81)), 1)
    assert periods_read(prices.latest(3)) == {"2025-08", "2025-06", "2025-05", "2025-04"}
    assert sorted((r.k, r.d.month, r.d.day, r.v) for r in prices.latest(3).collect()) == [
        ("a", 8, 2, 8), ("a", 8, 3, 80), ("a", 8, 4, 81), ("b", 4, 1, 4), ("b", 5, 1, 5), ("b", 6, 1, 6)]
    assert periods_read(prices.latest(1)) == {"2025-08", "2025-06"}
    assert table(spark, tmp_path / "none").latest(3).collect() == []


def test_a_lookup_opens_the_files_of_its_series_only(spark, tmp_path):
    prices = table(spark, tmp_path / "t")
    prices.upsert(records(spark, *[(k, m, 1, m) for k in "abcd" for m in (1, 2)]), 0)
    prices.upsert(records(spark, ("a", 1, 2, 5), ("a", 2, 1, 6)), 1)
    prices.upsert(records(spark, ("b", 1, 2, 5)), 2)
    found = prices.lookup(k="a")
    assert sorted((r.d.month, r.d.day, r.v) for r in found.collect()) == [(1, 1, 1), (1, 2, 5), (2, 1, 6)]
    every = {a: run for run in (1, 2, 3) for a, _ in set(prices.state(run).segments) - set(prices.state(run - 1).segments)}
    runs = {every[f.split("_attempt=")[1].split("/")[0]] for f in found.inputFiles()}
    assert runs == {1, 2}
    assert prices.lookup(k="nobody").collect() == [] and prices.lookup(k="nobody").inputFiles() == []
    with pytest.raises(ValueError, match="not a key"):
        prices.lookup(v="1")


def test_a_compacted_period_has_files_by_series(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        prices = table(spark, tmp_path / "t")
        for run in (0, 1):
            prices.upsert(records(spark, *[(f"k{i:03d}", 1, 1 + run, i) for i in range(200)]), run)
        prices.compact()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    every = len(prices.read().inputFiles())
    assert every > 1 and len(prices.lookup(k="k007").inputFiles()) == 1
    assert [r.v for r in prices.lookup(k="k007").collect()] == [7, 7]


def test_numbers_over_all_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x"), F.when(F.col("id") > 500, 1).alias("y"))
    got = numbered(df.repartition(7), [F.col("y").asc_nulls_first(), F.col("x")], "n")
    rows = sorted(got.collect(), key=lambda r: r.n)
    assert [r.n for r in rows] == list(range(1, 1001))
    assert [(r.y or 0, r.x) for r in rows] == sorted((r.y or 0, r.x) for r in rows)
    assert numbered(df.limit(0), [F.col("x")], "n").count() == 0
