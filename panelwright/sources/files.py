"""Folders with one delimited file per series; the series keys are in the file name.

Headers may differ from file to file. A load is planned first: the files are listed, the header of each is read, and what it says
about the places of date and price groups the files. Each group is then one scan by Spark's reader for
delimited files, with quoted line breaks, so every text is read once and no line has to look for its header. The driver holds
names and headers of files, no rows.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote_plus

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators.quality import MIN_FILE_ROWS
from panelwright.session import store
from panelwright.spec import CHILI, PanelSpec

# What the name of a date or price column contains, in any case.
TIME_WORDS = ("tanggal", "date", "tgl")
VALUE_WORDS = ("harga", "price")
# Stems of exported splits, which are not source files.
SPLIT_SUFFIXES = "_(train|test)$"

@dataclass(frozen=True)
class FolderLoad:
    """``rows`` are the loaded rows; ``files`` has one row per file with its ``reason`` and ``n_rows``."""

    rows: DataFrame
    files: DataFrame


@dataclass(frozen=True)
class Listed:
    """A file, or a folder of files with equal headers: its name, its paths and the fields of its header."""

    file: str
    paths: tuple[str, ...]
    header: tuple[str, ...]


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The fields of a file's first record, without blanks around them; none of an empty file."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        text = ""
        while True:
            line = reader.readLine()
            if line is None:
                break
            text += line.removeprefix("\ufeff") if not text else "\n" + line
            # A record goes on as long as a quote is open; empty lines before it are none.
            if text.strip() and text.count('"') % 2 == 0:
                break
            text = text if text.strip() else ""
    finally:
        stream.close()
    fields = next(csv.reader(io.StringIO(text), skipinitialspace=True), [])
    return tuple(f.strip() for f in fields)


def _listing(spark: SparkSession, folder: str, pattern: str, in_folders: bool, threads: int = 16) -> list[Listed]:
    """The files of a folder with their headers; with ``in_folders`` its folders, a ``column=`` in front of a name is ignored.

    Files without a byte are not listed."""
    found = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", in_folders).load(folder)
             .select("path", F.col("_metadata.file_path").alias("uri")).collect())
    groups: dict[str, list[str]] = {}
    for path, uri in sorted(tuple(r) for r in found):
        name = unquote_plus(uri)
        if in_folders:
            name = re.sub(r"/[^/=]*=([^/]*)$", r"/\1", re.sub(r"/[^/]*$", "", name))
        groups.setdefault(name, []).append(path)
    with ThreadPoolExecutor(threads) as pool:
        headers = list(pool.map(lambda paths: _header(spark, paths[0]), groups.values()))
    return [Listed(name, tuple(paths), header) for (name, paths), header in zip(groups.items(), headers)]


def _planned(spark: SparkSession, listed: list[Listed], spec: PanelSpec,
             places: Callable[[tuple[str, ...]], tuple[int, int]]) -> DataFrame:
    """One row per file: its keys and the 1-based places of date and price, 0 if there is none."""
    rows = [(x.file, *places(x.header)) for x in listed]
    heads = spark.createDataFrame(rows, "file string, _time_at int, _value_at int")
    return heads.withColumns(dict(zip(spec.keys, stem_key_columns(spec))))


def _scan(spark: SparkSession, listed: list[Listed], usable: dict[str, tuple[int, int]], spec: PanelSpec,
          in_folders: bool) -> DataFrame:
    """Raw date and price text of every record of the usable files: one scan per place of date, of price and number of fields."""
    path = F.url_decode(F.col("_metadata.file_path"))
    if in_folders:
        path = F.regexp_replace(F.regexp_replace(path, "/[^/]*$", ""), "/[^/=]*=([^/]*)$", "/$1")
    groups: dict[tuple[int, int, int], list[str]] = {}
    for x in listed:
        if x.file in usable:
            groups.setdefault((*usable[x.file], len(x.header)), []).extend(x.paths)
    parts = []
    for (time_at, value_at, width), paths in sorted(groups.items()):
        schema = ", ".join([*(f"_c{i} string" for i in range(width)), "_broken string"])
        escaped = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]
        rows = (spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
                .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
                .option("maxColumns", max(20_480, 2 * width)).option("columnNameOfCorruptRecord", "_broken").csv(escaped))
        # A line of blanks is no record; its only field is one too few.
        blank = F.coalesce(S.strip(F.col("_broken")) == "", F.lit(False))
        rows = rows.select(path.alias("file"), F.col(f"_c{time_at - 1}").alias("_time"),
                           F.col(f"_c{value_at - 1}").alias("_value"), blank.alias("_blank")).where(~F.col("_blank"))
        parts.append(rows.drop("_blank"))
    empty = spark.createDataFrame([], "file string, _time string, _value string")
    rows = reduce(DataFrame.unionByName, parts) if parts else empty
    return rows.withColumns({c: S.strip(F.col(c)) for c in ("_time", "_value")}).withColumns(
        dict(zip(spec.keys, stem_key_columns(spec))))


def _usable(heads: DataFrame) -> dict[str, tuple[int, int]]:
    return {r.file: (r._time_at, r._value_at) for r in heads.where("reason is null").select(
        "file", "_time_at", "_value_at").collect()}


def _first_match(names: Sequence[str], words: tuple[str, ...]) -> int:
    """1-based place of the first column whose name contains one of the words, 0 if there is none."""
    return next((i + 1 for i, name in enumerate(names) if any(w in name for w in words)), 0)


def load_series_folder(spark: SparkSession, folder: str, spec: PanelSpec = CHILI,
                       pattern: str = "*.csv", in_folders: bool = False,
                       date_formats: Sequence[str] = ()) -> FolderLoad:
    """Strict load: headers ``tanggal`` or ``date``, and the value's name; whole numbers out.

    Dates are ISO or of one of ``date_formats``, the first that fits.

    A file with an unreadable date or price is left out whole; the others are loaded.
    """
    def places(header: tuple[str, ...]) -> tuple[int, int]:
        names = [spec.time if name == "date" else name for name in header]
        return tuple(names.index(c) + 1 if c in names else 0 for c in (spec.time, spec.value))

    listed = _listing(spark, folder, pattern, in_folders)
    heads = _planned(spark, listed, spec, places)
    no_name = F.col(spec.keys[0]).isNull()
    heads = heads.withColumn("reason", F.when(no_name, "bad file name").when(
        (F.col("_time_at") == 0) | (F.col("_value_at") == 0), "missing column"))

    rows = _scan(spark, listed, _usable(heads), spec, in_folders)
    blank = F.coalesce(F.col("_time"), F.lit("")) == ""
    rows = (rows.withColumn(spec.time, S.to_date_or_null(F.col("_time"), date_formats))
            .withColumn(spec.value, S.round_int(S.number(F.col("_value"))))
            .withColumn("_bad", (~blank & F.col(spec.time).isNull()) | F.col(spec.value).isNull()))
    rows = store(rows.drop("_time", "_value"), "series_rows")
    totals = rows.groupBy("file").agg(F.count("*").alias("n_rows"), F.max("_bad").alias("_bad"))
    files = (heads.select("file", *spec.keys, "reason").join(totals, "file", "left")
             .withColumn("reason", F.coalesce("reason", F.when(F.col("_bad"), "unreadable row")))
             .withColumn("n_rows", F.when(F.col("reason").isNull(), F.coalesce("n_rows", F.lit(0))).otherwise(0))
             .drop("_bad"))
    broken = totals.filter("_bad").select("file")
    good = rows.join(broken, "file", "left_anti").select(*spec.columns)
    return FolderLoad(good, files)


def stem_key_columns(spec: PanelSpec) -> list[Column]:
    return S.stem_keys(S.file_stem(F.col("file")), spec.keys)


def load_training_folder(spark: SparkSession, folder: str, dims: dict[str, DataFrame],
                         spec: PanelSpec = CHILI, pattern: str = "*.csv", column: str = "name",
                         min_rows: int = MIN_FILE_ROWS, in_folders: bool = False,
                         date_formats: Sequence[str] = ()) -> FolderLoad:
    """Tolerant load: date and price columns found by name, keys checked against the dimensions.

    Dates are ISO or of one of ``date_formats``. Rows without a readable date are left out and counted as
    ``n_undated`` of their file, prices are cleaned to double or null, and series with fewer than
    ``min_rows`` rows are left out. Files of exported splits are not looked at.
    """
    def places(header: tuple[str, ...]) -> tuple[int, int]:
        names = [name.lower() for name in header]
        return _first_match(names, TIME_WORDS), _first_match(names, VALUE_WORDS)

    listed = _listing(spark, folder, pattern, in_folders)
    source = ~S.file_stem(F.col("file")).rlike(SPLIT_SUFFIXES)
    heads = _planned(spark, listed, spec, places).filter(source)
    known = F.lit(True)
    for key, dim in dims.items():
        flag = f"_known_{key}"
        heads = heads.join(dim.select(F.col(column).alias(key), F.lit(True).alias(flag)).distinct(), key, "left")
        known = known & F.coalesce(F.col(flag), F.lit(False))
    heads = heads.withColumn("reason", F.when(~known, "unknown name").when(
        (F.col("_time_at") == 0) | (F.col("_value_at") == 0), "missing column")
    ).drop(*[f"_known_{key}" for key in dims])

    rows = (_scan(spark, listed, _usable(heads), spec, in_folders)
            .withColumn(spec.time, S.to_date_or_null(F.col("_time"), date_formats))
            .withColumn(spec.value, S.clean_price(F.col("_value"))))
    rows = store(rows.drop("_time", "_value"), "training_rows")
    totals = rows.groupBy("file").agg(F.count(spec.time).alias("n_rows"),
                                      F.count_if(F.col(spec.time).isNull()).alias("n_undated"))
    rows = rows.filter(F.col(spec.time).isNotNull())
    files = (heads.select("file", *spec.keys, "reason").join(totals, "file", "left")
             .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_rows", "n_undated")})
             .withColumn("reason", F.coalesce("reason", F.when(F.col("n_rows") < min_rows, "too short"))))
    long = totals.filter(F.col("n_rows") >= min_rows).select("file")
    good = rows.join(long, "file", "left_semi").select(*spec.columns)
    return FolderLoad(good, files)


def load_series_parquet(spark: SparkSession, folder: str, spec: PanelSpec = CHILI) -> DataFrame:
    """Parquet files named like the series, with one schema: header rules are applied to its columns."""
    df = spark.read.parquet(folder)
    file = F.url_decode(F.col("_metadata.file_path")).alias("file")
    df = df.select("*", file)
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    time = next(c for c in df.columns if any(w in c for w in TIME_WORDS))
    value = next(c for c in df.columns if any(w in c for w in VALUE_WORDS))
    rows = df.select("file", F.col(time).cast("date").alias(spec.time), F.col(value).alias(spec.value))
    keys = dict(zip(spec.keys, stem_key_columns(spec)))
    return rows.withColumns(keys).filter(F.col(spec.keys[0]).isNotNull()).select(*spec.columns)
