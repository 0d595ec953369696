"""A price panel with a unique natural key on shared storage: many writers, small writes, reads that skip files.

* **Commits.** A writer puts its rows into a folder of its own and then creates the next numbered file of the log, which
  can't be there yet. If another writer was first, it looks at what that one has changed: other periods of the date do no harm
  and it takes the next number; a common period makes it work out its changes anew. Nothing is ever written over, so a broken-off
  writer, a second one that still runs after a restart, and a repeated run leave every committed row as it is.
* **Merge on read.** An upsert writes only the keys it adds or changes. A period is its base files and such additions, of which
  readers take the newest record of a key; a period without additions is read as it is. ``compact`` turns a
  period's files into one base, ``vacuum`` removes what no reader needs any more.
* **Zones.** Beside its rows a writer stores which series are in which file, how many new keys each file adds and
  their dates. ``lookup`` opens only files that hold the series asked for, and ``latest`` only the newest periods
  that together hold enough rows of every series.

The driver holds the names of files, by period and writer, between two compactions: their number is that of calendar periods, not of rows.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.operators.series import latest_n
from panelwright.operators.upsert import INSERTED, UPDATED, has_key, keyless, merge_counted
from panelwright.schema import PRICE_SCHEMA
from panelwright.session import cut_lineage
from panelwright.sources.storage import Folder
from panelwright.spec import CHILI, PanelSpec

PERIOD, ATTEMPT, ORDER = "_period", "_attempt", "_order"
LOG = ("version bigint, source string, run_id bigint, inserted bigint, updated bigint, rejected bigint, "
       "periods array<string>")
SNAPSHOT_EVERY = 64

Segment = tuple[str, str]


@dataclass
class State:
    """What a version of the table consists of: (attempt, period) of its files and the newest run of every source."""

    version: int = 0
    segments: dict[Segment, int] = field(default_factory=dict)
    newest: dict[str, int] = field(default_factory=dict)

    def apply(self, record: dict) -> None:
        self.version = record["version"]
        for attempt, period in record["drop"]:
            self.segments.pop((attempt, period), None)
        for attempt, period, order in record["add"]:
            self.segments[attempt, period] = order
        if record["source"] is not None:
            self.newest[record["source"]] = max(record["run_id"], self.newest.get(record["source"], record["run_id"]))

    def by_period(self) -> dict[str, list[Segment]]:
        found: dict[str, list[Segment]] = {}
        for segment in self.segments:
            found.setdefault(segment[1], []).append(segment)
        return found


@dataclass(frozen=True)
class Attempt:
    """Rows written but not committed: the record they would be committed with, and what they were worked out from."""

    batch: "Batch"
    read_version: int
    record: dict


@dataclass(frozen=True)
class Batch:
    rows: DataFrame
    periods: tuple[str, ...]
    rejected: int
    order: str
    source: str
    run_id: int


class PriceTable:
    """See the module. Columns are those of ``spec``; ``period`` is the date format of a period."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = PRICE_SCHEMA,
                 spec: PanelSpec = CHILI, period: str = "yyyy-MM", compact_after: int | None = 16):
        self.spark, self.spec, self.period, self.compact_after = spark, spec, period, compact_after
        self.data, self.zones = f"{path}/data", f"{path}/zones"
        self._log, self._snapshots = Folder(spark, f"{path}/commits"), Folder(spark, f"{path}/snapshots")
        self._written, self._indexed = Folder(spark, self.data), Folder(spark, self.zones)
        self.schema = T.StructType([schema[c] for c in spec.columns])
        text = T.StringType()
        self._stored = T.StructType([*self.schema, T.StructField(ORDER, T.LongType()),
                                     T.StructField(ATTEMPT, text), T.StructField(PERIOD, text)])
        self._zone = T.StructType([*[schema[c] for c in spec.keys], T.StructField(PERIOD, text), T.StructField("file", text),
                                   T.StructField("inserted", T.LongType()), T.StructField("updated", T.LongType()),
                                   T.StructField("first", schema[spec.time].dataType),
                                   T.StructField("last", schema[spec.time].dataType), T.StructField(ATTEMPT, text)])

    # --- log ------------------------------------------------------------------------------------

    def state(self, version: int | None = None) -> State:
        """The newest version of the table, or an older one; reads the last snapshot and the commits since."""
        found = State()
        numbers = [int(name.split(".")[0]) for name in self._snapshots.names()]
        numbers = [n for n in numbers if version is None or n <= version]
        if numbers:
            kept = json.loads(self._snapshots.read(f"{max(numbers):020d}.json"))
            found = State(kept["version"], {(a, p): o for a, p, o in kept["segments"]}, kept["newest"])
        for name in self._log.names():
            number = int(name.split(".")[0])
            if number > found.version and (version is None or number <= version):
                found.apply(json.loads(self._log.read(name)))
        return found

    def commits(self) -> DataFrame:
        return self.spark.read.schema(LOG).json(self._log.path)

    def runs(self) -> DataFrame:
        return self.commits().where("source is not null").select("source", "run_id", "inserted", "updated", "rejected")

    def _publish(self, record: dict, version: int) -> bool:
        if not self._log.create(f"{version:020d}.json", json.dumps({**record, "version": version})):
            return False
        if version % SNAPSHOT_EVERY == 0:
            state = self.state(version)
            self._snapshots.create(f"{version:020d}.json", json.dumps({
                "version": version, "newest": state.newest,
                "segments": [[a, p, o] for (a, p), o in state.segments.items()]}))
        return True

    # --- reads ----------------------------------------------------------------------------------

    def _files(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self._stored)
        return self.spark.read.schema(self._stored).option("basePath", self.data).parquet(*paths)

    def _folders(self, segments: list[Segment]) -> list[str]:
        return [f"{self.data}/{ATTEMPT}={a}/{PERIOD}={p}" for a, p in sorted(segments)]

    def _newest(self, rows: DataFrame) -> DataFrame:
        """One record per key: that of the last commit."""
        key, value = self.spec.natural_key, self.spec.value
        newest = rows.groupBy(*key).agg(F.max_by(F.struct(value), ORDER).alias("_row"), F.max(ORDER).alias(ORDER))
        return newest.select(*key, F.col("_row")[value].alias(value), ORDER)

    def _content(self, state: State, periods: set[str] | None = None) -> DataFrame:
        """Rows with the order of their commit; only the files of ``periods`` are opened."""
        parts = {p: s for p, s in state.by_period().items() if periods is None or p in periods}
        plain = [s for found in parts.values() if len(found) == 1 for s in found]
        several = [s for found in parts.values() if len(found) > 1 for s in found]
        columns = [*self.spec.columns, ORDER]
        if not several:
            return self._files(self._folders(plain)).select(*columns)
        merged = self._newest(self._files(self._folders(several)))
        return merged.unionByName(self._files(self._folders(plain)).select(*columns)) if plain else merged

    def read(self, version: int | None = None) -> DataFrame:
        return self._content(self.state(version)).select(*self.spec.columns)

    def _zones(self, state: State) -> DataFrame:
        """Series per file of this state."""
        attempts = sorted({a for a, _ in state.segments})
        if not attempts:
            return self.spark.createDataFrame([], self._zone)
        kept = self.spark.createDataFrame(list(state.segments), f"{ATTEMPT} string, {PERIOD} string")
        rows = self.spark.read.schema(self._zone).option("basePath", self.zones).parquet(
            *[f"{self.zones}/{ATTEMPT}={a}" for a in attempts])
        return rows.join(kept, [ATTEMPT, PERIOD], "left_semi")

    def series(self) -> DataFrame:
        """Keys, number of rows, first and last date of every series, from the zones alone."""
        return self._zones(self.state()).groupBy(*self.spec.keys).agg(
            F.sum("inserted").alias("n_rows"), F.min("first").alias("first"), F.max("last").alias("last"))

    def lookup(self, **keys: str) -> DataFrame:
        """The rows of the series with these values of key columns; opens the files that hold them and no others."""
        unknown = set(keys) - set(self.spec.keys)
        if unknown:
            raise ValueError(f"not a key: {sorted(unknown)}")
        wanted = [F.col(name).eqNullSafe(F.lit(value)) for name, value in keys.items()]
        zones = self._zones(self.state())
        for one in wanted:
            zones = zones.where(one)
        found = zones.select(ATTEMPT, PERIOD, "file").distinct().collect()
        rows = self._files([f"{self.data}/{ATTEMPT}={r[0]}/{PERIOD}={r[1]}/{r[2]}" for r in found])
        for one in wanted:
            rows = rows.where(one)
        periods = [r[1] for r in found]
        return (self._newest(rows) if len(self._attempts_of(found)) > len(set(periods)) else rows).select(*self.spec.columns)

    @staticmethod
    def _attempts_of(found: list) -> set:
        return {(r[0], r[1]) for r in found}

    def latest(self, n: int) -> DataFrame:
        """The latest ``n`` rows of every series.

        The zones tell how many rows a series has in each period, so only periods are opened in which some
        series still lacks rows, and of them only series that do go on.
        """
        state, keys = self.state(), list(self.spec.keys)
        each = self._zones(state).groupBy(*keys, PERIOD).agg(F.sum("inserted").alias("rows"), F.max("last").alias("last"))
        newer = Window.partitionBy(*keys).orderBy(F.col("last").desc(), F.col(PERIOD).desc()).rowsBetween(
            Window.unboundedPreceding, -1)
        needed = each.withColumn("_newer", F.coalesce(F.sum("rows").over(newer), F.lit(0))).where(F.col("_newer") < n)
        needed = cut_lineage(needed.select(*keys, PERIOD))
        periods = {r[0] for r in needed.select(PERIOD).distinct().collect()}
        rows = self._content(state, periods).withColumn(PERIOD, self._period_of())
        return latest_n(rows.join(needed, [*keys, PERIOD], "left_semi").select(*self.spec.columns), n, self.spec)

    # --- writes ---------------------------------------------------------------------------------

    def _period_of(self) -> Column:
        return F.coalesce(F.date_format(self.spec.time, self.period), F.lit("none"))

    def _write(self, rows: DataFrame, ranged: bool = False) -> tuple[str, list[str], int, int]:
        """Stores rows with their zones; (attempt, periods, inserted, updated). With ``ranged``, files have ranges of series."""
        attempt, keys = uuid.uuid4().hex, self.spec.keys
        folder = f"{self.data}/{ATTEMPT}={attempt}"
        by = [PERIOD, *keys, self.spec.time]
        rows = rows.withColumn(PERIOD, self._period_of())
        rows = rows.repartitionByRange(*by) if ranged else rows.hint("rebalance", PERIOD)
        rows.sortWithinPartitions(*by).write.partitionBy(PERIOD).parquet(folder)
        counted = T.StructType([*self._stored.fields[:-2], T.StructField(INSERTED, T.IntegerType()),
                                T.StructField(UPDATED, T.LongType()), self._stored[PERIOD]])
        stored = self.spark.read.schema(counted).parquet(folder)
        zones = stored.groupBy(*keys, PERIOD, F.col("_metadata.file_name").alias("file")).agg(
            F.sum(INSERTED).alias("inserted"), F.sum(UPDATED).alias("updated"),
            F.min(self.spec.time).alias("first"), F.max(self.spec.time).alias("last"))
        zones.sortWithinPartitions(*keys).write.parquet(f"{self.zones}/{ATTEMPT}={attempt}")
        totals = self.spark.read.schema(self._zone).parquet(f"{self.zones}/{ATTEMPT}={attempt}").groupBy(PERIOD).agg(
            F.sum("inserted"), F.sum("updated")).collect()
        return attempt, sorted(r[0] for r in totals), sum(r[1] for r in totals), sum(r[2] for r in totals)

    def prepare(self, batch: DataFrame, run_id: int, order: str = "seq", source: str = "batch") -> Batch:
        kind = {c: self.schema[c].dataType for c in self.spec.columns}
        batch = cut_lineage(batch.select(*[F.col(c).cast(kind[c]).alias(c) for c in self.spec.columns], order))
        good = batch.filter(has_key(self.spec))
        # Calendar periods: their number is bounded by the calendar.
        touched = tuple(sorted(r[0] for r in good.select(self._period_of()).distinct().collect()))
        return Batch(good, touched, keyless(batch, self.spec).count(), order, source, run_id)

    def begin(self, batch: Batch) -> Attempt | None:
        """Works out and stores what the batch changes in the newest version; None if its run is committed already."""
        state, key = self.state(), self.spec.natural_key
        if state.newest.get(batch.source, batch.run_id - 1) >= batch.run_id:
            return None
        add, inserted, updated = [], 0, 0
        if batch.periods:
            old = self._content(state, set(batch.periods)).drop(ORDER)
            old = old.join(batch.rows.select(*key).distinct(), key, "left_semi")
            changed = merge_counted(old, batch.rows, self.spec, batch.order).where(
                (F.col(INSERTED) > 0) | (F.col(UPDATED) > 0))
            order = F.lit(state.version).cast("long").alias(ORDER)
            attempt, periods, inserted, updated = self._write(
                changed.select(*self.spec.columns, order, INSERTED, UPDATED))
            add = [[attempt, p, state.version] for p in periods]
        return Attempt(batch, state.version, {
            "source": batch.source, "run_id": batch.run_id, "inserted": inserted, "updated": updated,
            "rejected": batch.rejected, "periods": list(batch.periods), "add": add, "drop": []})

    def finish(self, attempt: Attempt) -> bool:
        """Commits the attempt; False if another writer has changed one of its periods since it began."""
        version, batch = attempt.read_version + 1, attempt.batch
        while not self._publish(attempt.record, version):
            other = json.loads(self._log.read(f"{version:020d}.json"))
            if other["source"] == batch.source and other["run_id"] >= batch.run_id:
                return True
            if set(other["periods"]) & set(batch.periods):
                return False
            version += 1
        return True

    def upsert(self, batch: DataFrame, run_id: int, order: str = "seq", source: str = "batch") -> DataFrame:
        """Applies the batch and returns its one log row (source, run_id, inserted, updated, rejected).

        ``rejected`` counts records without a whole natural key. A run at or below the newest one of its
        source changes nothing. Writers of common periods wait for nobody: who comes second starts again.
        """
        ready = self.prepare(batch, run_id, order, source)
        attempt = self.begin(ready)
        while attempt is not None and not self.finish(attempt):
            attempt = self.begin(ready)
        if self.compact_after and attempt is not None:
            self.compact(self.compact_after)
        return self.runs().filter((F.col("source") == source) & (F.col("run_id") == run_id))

    def compact(self, least: int = 2) -> list[str]:
        """Writes every period of ``least`` or more parts as one; returns the periods. Upserts may go on meanwhile."""
        state = self.state()
        parts = {p: s for p, s in state.by_period().items() if len(s) >= least}
        if not parts:
            return []
        rows = self._content(state, set(parts)).withColumn(INSERTED, F.lit(1)).withColumn(UPDATED, F.lit(0).cast("long"))
        attempt, periods, _, _ = self._write(rows.select(*self.spec.columns, ORDER, INSERTED, UPDATED), ranged=True)
        # The base counts as old as the newest of its parts, and so as older than any part still to come.
        add = [[attempt, p, max(state.segments[s] for s in parts[p])] for p in periods]
        drop = [list(s) for found in parts.values() for s in found]
        record = {"source": None, "run_id": None, "inserted": 0, "updated": 0, "rejected": 0, "periods": [],
                  "add": add, "drop": drop}
        version = state.version + 1
        while not self._publish(record, version):
            other = json.loads(self._log.read(f"{version:020d}.json"))
            if {tuple(s) for s in other["drop"]} & {tuple(s) for s in drop}:
                return []
            version += 1
        return sorted(parts)

    def vacuum(self, keep: int = 0, unfinished_s: float = 86_400) -> list[str]:
        """Removes files that neither the newest version nor the ``keep`` before it use; returns their folders.

        What was never committed goes once it is older than ``unfinished_s``: its writer may still be at work.
        """
        state = self.state()
        needed, known = set(state.segments), set()
        for name in self._log.names():
            record = json.loads(self._log.read(name))
            known |= {a for a, _, _ in record["add"]}
            if record["version"] > state.version - keep:
                needed |= {tuple(s) for s in record["drop"]}
        gone = []
        for folder in self._written.names():
            attempt = folder.split("=", 1)[1]
            if attempt not in known and time.time() - self._written.modified(folder) < unfinished_s:
                continue
            inner = Folder(self.spark, f"{self.data}/{folder}")
            periods = [name for name in inner.names() if name.startswith(f"{PERIOD}=")]
            left = [p for p in periods if (attempt, p.split("=", 1)[1]) in needed]
            for period in set(periods) - set(left):
                inner.remove(period)
                gone.append(f"{folder}/{period}")
            if not left:
                self._written.remove(folder)
                self._indexed.remove(folder)
        return sorted(gone)
