"""Upsert, validation, joins, metrics, reports, sources, sinks and streams on small fixtures."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from panelwright import schema, session
from panelwright.operators import evaluate as E
from panelwright.operators import joins as J
from panelwright.operators import quality as Q
from panelwright.operators.series import latest_n
from panelwright.operators.upsert import change_counts, keyless, merge_batch
from panelwright.sources import files, html, sinks, tables
from panelwright.sources.price_table import PriceTable
from panelwright.sources.storage import Folder
from panelwright.spec import CHILI, PanelSpec
from panelwright.streaming import ingest as streams

SPEC = PanelSpec(("k",), "d", "v")
D = dt.date(2025, 12, 1)


# --- upsert -------------------------------------------------------------------------------------

TARGET = [("k1", 10), ("k2", 7), ("k3", None)]
BATCH = [("k1", 12), ("k1", 12), ("k1", 15), ("k2", 7), ("k3", 4), ("k4", 5), ("k4", 7)]
AFTER = {"k1": 15, "k2": 7, "k3": 4, "k4": 7}


def target(spark, rows=TARGET):
    return spark.createDataFrame([(k, D, v) for k, v in rows], "k string, d date, v int")


def batch(spark, rows=BATCH):
    return spark.createDataFrame([(k, D, v, i) for i, (k, v) in enumerate(rows)], "k string, d date, v int, seq int")


def replay(target_rows, batch_rows):
    """The upsert one record after the other."""
    table, inserted, updated = dict(target_rows), 0, 0
    for key, value in batch_rows:
        if key not in table:
            inserted += 1
        elif table[key] != value:
            updated += 1
        table[key] = value
    return table, inserted, updated


def test_upsert_fixture(spark):
    merged = merge_batch(target(spark), batch(spark), SPEC)
    assert {r.k: r.v for r in merged.collect()} == AFTER
    assert tuple(change_counts(target(spark), batch(spark), SPEC).first()) == (1, 4)


def test_upsert_of_final_values_again_changes_nothing(spark):
    final = batch(spark, list(AFTER.items()))
    assert tuple(change_counts(merge_batch(target(spark), batch(spark), SPEC), final, SPEC).first()) == (0, 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_equals_sequential_replay(spark, seed):
    rng = random.Random(seed)
    old = [(f"k{i}", rng.choice([1, 2, 3])) for i in range(10)]
    new = [(rng.choice(["hot", f"k{rng.randrange(20)}"]), rng.choice([1, 2, 3])) for _ in range(300)]
    table, inserted, updated = replay(old, new)
    assert {r.k: r.v for r in merge_batch(target(spark, old), batch(spark, new), SPEC).collect()} == table
    narrow = batch(spark, new).withColumn("seq", (F.col("seq") * 70000).cast("bigint"))
    for b in (batch(spark, new), narrow):  # one block of the sequence, and one block per record
        assert tuple(change_counts(target(spark, old), b, SPEC).first()) == (inserted, updated)


def small_table(spark, path):
    kind = spark.createDataFrame([], "k string, d date, v int").schema
    return PriceTable(spark, str(path), kind, SPEC)


def test_price_table_repeats_a_run_safely(spark, tmp_path):
    prices = small_table(spark, tmp_path / "t")
    assert prices.read().count() == 0
    prices.upsert(target(spark).withColumn("seq", F.lit(0)), 0)
    first = prices.upsert(batch(spark), 1).collect()
    again = prices.upsert(batch(spark), 1).collect()
    assert first == again and (first[0].inserted, first[0].updated) == (1, 4)
    prices.upsert(target(spark).withColumn("seq", F.lit(0)), 0)  # an older run is not applied again
    assert {r.k: r.v for r in prices.read().collect()} == AFTER


def test_price_table_reads_and_rewrites_touched_periods_only(spark, tmp_path):
    prices = small_table(spark, tmp_path / "t")
    rows = [("a", dt.date(2025, m, 1), m, 0) for m in (1, 2, 3)]
    prices.upsert(spark.createDataFrame(rows, "k string, d date, v int, seq int"), 0)
    written = lambda: {f"{p.parent.name}/{p.name}": sorted(f.name for f in p.iterdir())
                       for p in (tmp_path / "t/data").glob("_attempt=*/_period=*")}
    before = written()
    assert len(before) == 3
    prices.upsert(spark.createDataFrame([("a", dt.date(2025, 2, 1), 9, 0)], "k string, d date, v int, seq int"), 1)
    after = written()
    assert {p: after[p] for p in before} == before
    assert [p.split("/")[1] for p in after if p not in before] == ["_period=2025-02"]
    assert sorted(r.v for r in prices.read().collect()) == [1, 3, 9]


def records(spark, *rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "k string, d date, v int, seq int")


def test_price_table_keeps_every_sources_rows(spark, tmp_path):
    prices = small_table(spark, tmp_path / "t")
    prices.upsert(records(spark, ("a", D, 1)), 0, source="A")
    prices.upsert(records(spark, ("b", D, 2)), 0, source="B")
    prices.upsert(records(spark, ("a", D, 1)), 0, source="A")  # as a stream does after a restart
    assert {r.k: r.v for r in prices.read().collect()} == {"a": 1, "b": 2}
    assert sorted((r.source, r.inserted) for r in prices.runs().collect()) == [("A", 1), ("B", 1)]


def test_price_table_ignores_what_a_broken_off_upsert_left(spark, tmp_path, monkeypatch):
    prices = small_table(spark, tmp_path / "t")
    prices.upsert(records(spark, ("a", D, 1)), 0, source="A")

    def broken(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(PriceTable, "_publish", broken)  # after the rows, before the commit record
        with pytest.raises(RuntimeError):
            prices.upsert(records(spark, ("a", D, 9), ("c", D, 3)), 1, source="A")
    assert {r.k: r.v for r in prices.read().collect()} == {"a": 1}
    prices.upsert(records(spark, ("b", D, 2)), 0, source="B")
    assert {r.k: r.v for r in prices.read().collect()} == {"a": 1, "b": 2}
    prices.upsert(records(spark, ("a", D, 9), ("c", D, 3)), 1, source="A")
    assert {r.k: r.v for r in prices.read().collect()} == {"a": 9, "b": 2, "c": 3}


def test_records_without_a_key_are_counted_and_left_out(spark, tmp_path):
    prices = small_table(spark, tmp_path / "t")
    rows = records(spark, ("a", D, 1), (None, D, 5), ("b", None, 6))
    for run in (0, 1):
        log = prices.upsert(rows, run).first()
        assert (log.inserted, log.updated, log.rejected) == (1 - run, 0, 2)
    assert [(r.k, r.v) for r in prices.read().collect()] == [("a", 1)]
    assert [r.reason for r in keyless(rows, SPEC).collect()] == ["empty key"] * 2
    assert tuple(change_counts(prices.read(), rows, SPEC).first()) == (0, 0)


@pytest.mark.parametrize("large_first", [True, False])
def test_the_newer_file_wins_whatever_its_size(spark, tmp_path, large_first):
    prices, kind = small_table(spark, tmp_path / "t"), "k string, d date, v int"
    more = [(f"x{i}", D, i) for i in range(20_000)]
    for n, large in enumerate((large_first, not large_first)):
        rows = [("k", D, 100 * (n + 1)), *(more if large else [])]
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for f in (tmp_path / "in").glob("part-*"):
            if not (tmp_path / f.name).exists():
                (tmp_path / f.name).touch()
                os.utime(f, (1_700_000_000 + 100 * n,) * 2)
    stream = streams.snapshot_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], kind).schema)
    streams.ingest(stream, prices, str(tmp_path / "c"), "test").awaitTermination()
    assert [r.v for r in prices.read().where("k = 'k'").collect()] == [200]


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    prices = small_table(spark, tmp_path / "t")
    source = str(tmp_path / "in")
    kind = "k string, d date, v int, seq int"
    for step in ([("k1", D, 1, 0), ("k2", D, 2, 0)], [("k1", D, 5, 0), ("k3", D, 3, 0)]):
        spark.createDataFrame(step, kind).coalesce(1).write.mode("append").parquet(source)
        stream = streams.snapshot_stream(spark, source, spark.createDataFrame([], kind).schema, files_per_batch=1)
        streams.ingest(stream, prices, str(tmp_path / "c"), "test").awaitTermination()
    assert {r.k: r.v for r in prices.read().collect()} == {"k1": 5, "k2": 2, "k3": 3}
    assert [(r.inserted, r.updated) for r in prices.runs().orderBy("run_id").collect()] == [(2, 0), (1, 1)]


def test_stream_of_pages_and_fallback(spark, tmp_path):
    def table(name):
        return PriceTable(spark, str(tmp_path / name), schema.PRICE_SCHEMA)

    prices, simulated = table("prices"), table("simulated")
    names = schema.dimension(spark, schema.PROVINCES)
    provinces = names.select(F.col("name").alias("provinsi"))
    items = F.array(*[F.lit(c) for c in schema.COMMODITIES])
    fake = lambda: tables.simulated_panel(provinces, items, F.lit(D))
    for page in (PAGE, "<html>gangguan</html>"):
        pages(spark, page).write.mode("append").parquet(str(tmp_path / "in"))
        stream = streams.snapshot_stream(spark, str(tmp_path / "in"), schema.PAGE_SCHEMA)
        streams.ingest(stream, prices, str(tmp_path / "c"), "pages",
                       lambda b: streams.page_records(b, names, prices),
                       fallback=(simulated, fake)).awaitTermination()
    assert prices.read().count() == 3
    assert simulated.read().count() == 3 * 34 * 4


# --- report pages -------------------------------------------------------------------------------

def test_character_references_are_decoded_once(spark):
    df = spark.createDataFrame([("a&#38;lt;b &ndash; &amp;amp; &unknown; &#x41;&#66;&nbsp;c &",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(html.decode_entities(F.col("t"))).collect()]
    assert got == ["a&lt;b – &amp; &unknown; AB c &", None, ""]


PAGE = """<table><tr><th>No</th><th>Komoditas (Rp)</th><th>01/ 12/ 2025</th><th>02/12/2025</th><th>x</th></tr>
<tr><td></td><td>Semua Provinsi</td><td>44.000</td><td>44.100</td><td>1</td></tr>
<tr><td>1</td><td> dki&nbsp;jakarta </td><td>45.000</td><td>-</td><td>9</td></tr>
<tr><td>2</td><td>Aceh</td><td>40.000</td><td>40.500</td><td>41.000</td><td>42.000</td></tr></table>"""


def pages(spark, *texts):
    return spark.createDataFrame([("Cabai Rawit Merah", t) for t in texts], schema.PAGE_SCHEMA)


def parsed(spark, *texts):
    rows = html.report_rows(pages(spark, *texts), schema.dimension(spark, schema.PROVINCES))
    return {(r.tanggal, r.provinsi, r.harga) for r in Q.passed(rows).collect()}


PARSED = {(D, "DKI Jakarta", 45000), (D, "Aceh", 40000), (dt.date(2025, 12, 2), "Aceh", 40500)}


def test_report_page(spark):
    assert parsed(spark, PAGE) == PARSED


def test_report_page_markup(spark):
    noisy = (PAGE.replace("<tr>", "<TR class='a'>").replace("</td>", "</td >").replace("Aceh", "<b>A</b>&#99;&#x65;h")
             .replace("45.000", "<!-- 1 --> 45.000\n"))
    assert parsed(spark, "<!-- <tr><td>1</td><td>Bali</td><td>9</td></tr> --><script>'<tr>'</script>" + noisy) == PARSED


@pytest.mark.parametrize("page", [
    PAGE.replace("</tr></table>", ""), PAGE.replace("</tr></table>", "</table>"), PAGE.replace("</tr>", ""),
    PAGE.replace("</td>", "").replace("</th>", ""), PAGE.replace("</td>", "").replace("</th>", "").replace("</tr>", ""),
    "<table><tr><td>Menu<table><tr><td>x<td>y</table></td></tr></table>" + PAGE,
    PAGE.replace("Aceh", "Aceh<table><tr></tr></table>").replace("<td>1</td>", "<td>1<p></td>"),
    PAGE.replace("<table>", "<table title='a > b' data-x=\"<tr>\"><thead>").replace("<tr><td></td>", "<tbody><tr><td></td>"),
    PAGE.replace("<td>45.000</td>", "</b></div><td>45.000</td></td></tbody>"),
    PAGE + "</table></tr><!-- cut off", PAGE.replace("40.000", "40.<!-- </td> -->000").replace("<tr>", "<tr\n>")])
def test_report_page_with_missing_or_implied_tags(spark, page):
    """Row and cell ends that are missing, tables inside cells, tags in values and comments."""
    assert parsed(spark, page) == PARSED


def test_a_row_has_the_cells_of_tables_inside_it(spark):
    inner = "<tr><td>a<table><tr><td>b</td><td>c<td>d</table>e</td><td>f</td></tr>"
    rows = html.page_cells(spark.createDataFrame([(inner,), (None,), ("",)], "t string"), "t", "cells").collect()
    assert [r.cells for r in rows] == [[["abcde", "b", "c", "d", "f"], ["b", "c", "d"]], None, []]


def test_page_without_header_gives_nothing(spark):
    assert parsed(spark, PAGE.replace("Komoditas", "Barang"), "", "<p>") == set()


def test_first_header_counts(spark):
    other = "<tr><th>No</th><th>Komoditas</th><th>05/12/2025</th><th>x</th><th>x</th></tr></table>"
    assert parsed(spark, PAGE.replace("</table>", other)) == PARSED


# --- files --------------------------------------------------------------------------------------

def write(folder, **texts):
    for name, text in texts.items():
        (folder / f"{name.replace('__', ' ')}.csv").write_text(text)


def test_series_folder(spark, tmp_path):
    write(tmp_path,
          Jawa__Barat_Cabai__Rawit__Merah=" date , harga \n2025-01-01,100.5\n2025-01-02,101.5\n",
          Aceh_Cabai__A=" harga,tanggal,x\n7,2025-01-01,1\n",
          Bali_Cabai__A="tanggal,harga\n2025-01-01,5\n2025-01-02,lima\n",
          Riau_Cabai__A="hari,harga\n2025-01-01,5\n",
          tanpa="tanggal,harga\n2025-01-01,5\n")
    load = files.load_series_folder(spark, str(tmp_path))
    rows = {(r.provinsi, r.jenis_cabai, r.tanggal.day, r.harga) for r in load.rows.collect()}
    assert rows == {("Jawa Barat", "Cabai Rawit Merah", 1, 100), ("Jawa Barat", "Cabai Rawit Merah", 2, 102),
                    ("Aceh", "Cabai A", 1, 7)}
    reasons = {r.file.rsplit("/", 1)[1].split("_")[0]: (r.reason, r.n_rows) for r in load.files.collect()}
    assert reasons == {"Jawa Barat": (None, 2), "Aceh": (None, 1), "Bali": ("unreadable row", 0),
                       "Riau": ("missing column", 0), "tanpa.csv": ("bad file name", 0)}


def test_training_folder(spark, tmp_path):
    head = "no;x,Tgl Laporan,HARGA (Rp)\n"
    body = "".join(f'1,2025-01-{i:02d},"{i}.000"\n' for i in range(1, 31))
    write(tmp_path, Aceh_Cabai__Rawit__Merah=head + body + "1,besok,5\n1,2025-02-01,-\n",
          Bali_Cabai__Rawit__Merah=head + body[:200],
          Atlantis_Cabai__Rawit__Merah=head + body,
          Riau_Cabai__Rawit__Merah="a,b\n" + body,
          Aceh_Cabai__Rawit__Merah_train=head + body)
    dims = {"provinsi": schema.dimension(spark, schema.PROVINCES),
            "jenis_cabai": schema.dimension(spark, schema.COMMODITIES)}
    load = files.load_training_folder(spark, str(tmp_path), dims)
    rows = load.rows.orderBy("tanggal").collect()
    assert [r.harga for r in rows] == [i * 1000.0 for i in range(1, 31)] + [None]
    reasons = {r.file.rsplit("/", 1)[1].split("_")[0]: r.reason for r in load.files.collect()}
    assert reasons == {"Aceh": None, "Bali": "too short", "Atlantis": "unknown name", "Riau": "missing column"}


def test_dates_of_other_formats_and_undated_rows(spark, tmp_path):
    body = "".join(f"{i}/2/2025,{i}\n" for i in range(1, 29))
    write(tmp_path, Aceh_Cabai__Rawit__Merah="tanggal,harga\n" + body + "31/2/2025,5\n,6\n")
    dims = {"provinsi": schema.dimension(spark, schema.PROVINCES)}
    load = files.load_training_folder(spark, str(tmp_path), dims, date_formats=["d/M/yyyy"], min_rows=28)
    assert sorted(r.tanggal.day for r in load.rows.collect()) == list(range(1, 29))
    assert [(r.reason, r.n_rows, r.n_undated) for r in load.files.collect()] == [(None, 28, 2)]


def test_delimited_records(spark, tmp_path):
    """Quoted line breaks, commas and quotes, blank lines, a byte order mark, short and long records, line ends of both kinds."""
    texts = {
        "Aceh_A": '\ufeff"tang""gal,\n x",tanggal, "harga"\r\n"a\nb, ""c""\n",2025-01-01,5\r\n\r\n  \n,"2025-01-02", "6"\n',
        "Bali_A": "\n\nx,tanggal,harga\n1,2025-01-01,7,more\n1,2025-01-02,8\n",
        "Riau_A": "tanggal,x,harga\n2025-01-01,1\n",
        "Bali_B": "tanggal,harga\n2025-01-01,9",
        "Bali_C": "", "Bali_D": "tanggal,harga\n", "Bali_[E]": "harga,tanggal\n4,2025-01-01\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    load = files.load_series_folder(spark, str(tmp_path))
    assert sorted((r.provinsi, r.jenis_cabai, r.tanggal.day, r.harga) for r in load.rows.collect()) == [
        ("Aceh", "A", 1, 5), ("Aceh", "A", 2, 6), ("Bali", "A", 1, 7), ("Bali", "A", 2, 8), ("Bali", "B", 1, 9), ("Bali", "[E]", 1, 4)]
    reasons = {r.file.rsplit("/", 1)[1]: (r.reason, r.n_rows) for r in load.files.collect()}
    assert reasons == {"Aceh_A.csv": (None, 2), "Bali_A.csv": (None, 2), "Riau_A.csv": ("unreadable row", 0), "Bali_B.csv": (None, 1),
                       "Bali_D.csv": (None, 0), "Bali_[E].csv": (None, 1)}


def test_a_folder_is_one_scan_per_kind_of_header(spark, tmp_path):
    for i in range(12):
        head = ("tanggal,harga", "date,harga", "harga,tanggal")[i % 3]
        (tmp_path / f"P{i}_A.csv").write_text(f"{head}\n" + ("5,2025-01-01\n" if i % 3 == 2 else "2025-01-01,5\n"))
    listed = files._listing(spark, str(tmp_path), "*.csv", False)
    assert len(listed) == 12 and {x.header for x in listed} == {("tanggal", "harga"), ("date", "harga"), ("harga", "tanggal")}
    usable = {x.file: (2, 1) if x.header[0] == "harga" else (1, 2) for x in listed}
    rows = files._scan(spark, listed, usable, CHILI, False)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2 and "FileScan text" not in plan and "Join" not in plan
    assert len(rows.collect()) == 12


@pytest.mark.parametrize("n", [3, 1500])
def test_latest_rows_of_any_number(spark, n):
    rows = [("hot", D + dt.timedelta(days=i), i) for i in range(4000)] + [("b", D, 1)]
    df = spark.createDataFrame(rows, "k string, d date, v int")
    got = latest_n(df, n, SPEC)
    assert got.columns == ["k", "d", "v"]
    assert sorted(r.v for r in got.where("k = 'hot'").collect()) == list(range(4000 - n, 4000))
    assert got.where("k = 'b'").count() == 1


def test_parquet_folder(spark, tmp_path):
    df = spark.createDataFrame([(D, 5), (dt.date(2025, 12, 2), 6)], "` Tanggal` date, Harga int").coalesce(1)
    df.write.parquet(str(tmp_path / "out"))
    made = next((tmp_path / "out").glob("part-*.parquet"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "Aceh_Cabai A.parquet").write_bytes(made.read_bytes())
    rows = files.load_series_parquet(spark, str(tmp_path / "in")).collect()
    assert {(r.provinsi, r.jenis_cabai, r.harga) for r in rows} == {("Aceh", "Cabai A", 5), ("Aceh", "Cabai A", 6)}


# --- shops, gates, validation -------------------------------------------------------------------

def test_shops(spark):
    names = schema.SHOP_FILE_COLUMNS
    row = dict.fromkeys(names) | {"nama_toko": "T", "harga": "45.5", "rating": "4,8", "gambar_produk": "g"}
    raw = spark.createDataFrame([tuple(row[n] for n in names)], ", ".join(f"{n} string" for n in names))
    shop = tables.shop_listing(Q.passed(tables.clean_shops(raw))).first()
    assert (shop.nama_toko, shop.harga, shop.satuan, shop.gambar_produk) == ("T", 45500, "", "g")
    assert shop.rating == pytest.approx(4.8)
    with pytest.raises(ValueError, match="rating"):
        tables.clean_shops(raw.drop("rating"))


def test_gate(spark):
    assert tables.seed_if_empty(spark.range(0), lambda: spark.range(3)).count() == 3
    assert tables.seed_if_empty(spark.range(1), lambda: spark.range(3)).count() == 1
    assert tables.is_empty(spark.range(0)).first()[0] is True


def test_record_reasons(spark):
    rows = [(D, "Aceh", "A", "0"), (None, "Aceh", "A", "5"), (D, "", "A", "5"), (D, "Aceh", "A", "-"), (D, "Aceh", "A", "Rp 5")]
    df = spark.createDataFrame(rows, "tanggal date, provinsi string, jenis_cabai string, harga_raw string")
    checked = Q.check_records(df)
    assert {r.reason: r.n_rows for r in Q.count_reasons(checked).collect()} == {
        "price not positive": 1, "empty tanggal": 1, "empty provinsi": 1, "unreadable price": 1, "ok": 1}
    assert Q.rejected(checked).count() == 4 and Q.passed(checked).first().harga == 5


def test_requests(spark):
    dims = {"provinsi": schema.dimension(spark, schema.PROVINCES),
            "jenis_cabai": schema.dimension(spark, schema.COMMODITIES)}
    item = schema.COMMODITIES[0]
    rows = [("Aceh", item, 1), ("aceh", item, 1), ("Aceh", "Bayam", 1), ("Aceh", item, 31), ("Aceh", item, 0)]
    df = spark.createDataFrame(rows, schema.REQUEST_SCHEMA)
    bad = [r.reason for r in Q.rejected(Q.check_requests(df, dims)).collect()]
    assert sorted(bad) == ["horizon out of range", "horizon out of range", "unknown jenis_cabai", "unknown provinsi"]
    assert Q.passed(Q.check_requests(df, dims, bounded=False)).count() == 3
    with pytest.raises(ValueError):
        Q.require_history_limit(101)


def test_series_length(spark):
    df = spark.createDataFrame([("a", D, 1)] * 3 + [("b", D, 1)], "k string, d date, v int")
    assert {r.k for r in Q.long_enough(df, 2, SPEC).collect()} == {"a"}
    parted = spark.createDataFrame([("a", s) for s in ("train",) * 12 + ("test",) * 2] + [("b", "train")] * 14,
                                   "k string, split string")
    assert {r.k for r in Q.split_long_enough(parted, SPEC).collect()} == {"a"}
    assert Q.with_date(spark.createDataFrame([(D,), (None,)], "d date"), SPEC).count() == 1


# --- joins, metrics, simulation -----------------------------------------------------------------

def test_canonical_names(spark):
    raw = spark.createDataFrame([("D.K.I. Jakarta",), ("di  yogyakarta",), ("KEP. RIAU",), ("Semua Provinsi",)], "raw string")
    got = J.canonical_names(raw, schema.dimension(spark, schema.PROVINCES), "raw", "provinsi")
    assert {r.provinsi for r in got.collect()} == {"DKI Jakarta", "DI Yogyakarta"}


def test_substitute(spark):
    df = spark.createDataFrame([("A", D, None), ("B", D, 9), ("C", D, None)], "k string, d date, v int")
    pairs = schema.substitutes(spark, {"A": "B", "B": "A"})
    assert {r.k: r.filled for r in J.fill_from_substitute(df, pairs, SPEC).collect()} == {"A": 9, "B": 9, "C": None}


def test_simulated_panel(spark):
    provinces = schema.dimension(spark, schema.PROVINCES, "provinsi")
    items = F.array(*[F.lit(c) for c in schema.COMMODITIES])
    df = tables.simulated_panel(provinces, items, F.lit(D))
    rows = df.collect()
    assert len(rows) == 408 and all(r.is_synthetic for r in rows)
    assert all(schema.PRICE_RANGES[r.jenis_cabai][0] <= r.harga <= schema.PRICE_RANGES[r.jenis_cabai][1] for r in rows)
    assert {r.tanggal for r in rows} == {D, D - dt.timedelta(days=1), D - dt.timedelta(days=2)}
    assert sorted(df.repartition(7).collect()) == sorted(rows)


def test_metrics_leave_true_zero_out_of_mape_only(spark):
    df = spark.createDataFrame([(100, 110.0), (200, 180.0)], "t int, p double")
    row = E.error_metrics(df, "t", "p").first()
    assert (row.mape, row.mae, row.rmse) == pytest.approx((10.0, 15.0, 250 ** 0.5))
    zero = df.union(spark.createDataFrame([(0, 15.0)], df.schema))
    row = E.error_metrics(zero, "t", "p").first()
    assert row.mape == pytest.approx(10.0) and row.mae == pytest.approx(15.0)


def test_scaler_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(10.0,), (20.0,)], "harga double")
    sinks.save_scaler(E.fit_scaler(df), str(tmp_path / "s"))
    scaler = sinks.load_scaler(spark, str(tmp_path / "s"))
    out = E.scaled(spark.createDataFrame([(25.0,)], "harga double"), scaler)
    assert out.first().harga == 1.5
    constant = E.fit_scaler(spark.createDataFrame([(5.0,)], "harga double"))
    assert E.scaled(spark.createDataFrame([(5.0,)], "harga double"), constant).first().harga == 0.0


def test_metrics_and_params_log(spark, tmp_path):
    metrics = spark.createDataFrame([(1.0, 2.0)], "mape double, mae double")
    sinks.append_metrics(metrics, str(tmp_path / "m"), "r1")
    sinks.append_metrics(metrics, str(tmp_path / "m"), "r2")
    sinks.append_params(spark, {"lag": 7}, str(tmp_path / "p"), "r1")
    assert spark.read.parquet(str(tmp_path / "m")).filter("run_id = 'r2'").count() == 2
    assert spark.read.parquet(str(tmp_path / "p")).first().value == "7"


def test_default_names_fit_the_price_table():
    assert CHILI.columns == ["provinsi", "jenis_cabai", "tanggal", "harga"]
    assert len(schema.PROVINCES) == 34 and list(schema.PROVINCES) == sorted(schema.PROVINCES)
    assert list(schema.COMMODITIES) == sorted(schema.COMMODITIES)


def test_tables_stored_on_the_way_go(spark):
    def make():
        inner = session.store(spark.range(5), "inner")
        return inner.union(session.store_alone(lambda: session.store(inner, "deep").where("id > 3"), "middle"))

    folder = Folder(spark, session.work_dir(spark))
    before = set(folder.names())
    rows = session.store_alone(make, "outer")
    assert sorted(r.id for r in rows.collect()) == [0, 1, 2, 3, 4, 4]
    assert [name.split("-")[0] for name in set(folder.names()) - before] == ["outer"]
    with pytest.raises(ZeroDivisionError):
        session.store_alone(lambda: session.store(spark.range(1), "lost") and 1 / 0, "never")
    assert [name.split("-")[0] for name in set(folder.names()) - before] == ["outer"]
