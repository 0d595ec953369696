"""Names a panel's columns, so that every operator works on any panel."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class PanelSpec:
    """A panel is many series; a series is all rows that share ``keys``, ordered by ``time``.

    ``(keys, time)`` is the natural key and must be unique: ``unique_panel`` makes it so.
    ``width`` is the span of one time block, in days for a DATE, in seconds for a timestamp and
    in units for an integer. Ordered operators never hold more than one block of one series in a
    task, so a single very long series is still worked on by many tasks.
    """

    keys: tuple[str, ...] = ("provinsi", "jenis_cabai")
    time: str = "tanggal"
    value: str = "harga"
    width: float | None = None

    @property
    def natural_key(self) -> list[str]:
        return [*self.keys, self.time]

    @property
    def columns(self) -> list[str]:
        return [*self.keys, self.time, self.value]

    def with_keys(self, *keys: str) -> "PanelSpec":
        return replace(self, keys=tuple(keys))

    def with_value(self, value: str) -> "PanelSpec":
        return replace(self, value=value)

    def fitted(self, df: DataFrame, rows: int = 1_000_000) -> "PanelSpec":
        """Sets ``width`` so that the fullest block is expected to hold about ``rows`` rows.

        For timestamps, whose density only the data tells; a date block holds one row a day anyway.
        Blocks as wide as that keep the number of block summaries small. Reads the keys and the time
        once; the counts are aggregated before the shuffle and one number comes back.
        """
        start = self.width or 3600
        spec = replace(self, width=start)
        fullest = (df.groupBy(*self.keys, spec.block(df).alias("_block")).count()
                   .agg(F.max("count")).first()[0]) or rows
        return replace(self, width=start * rows / fullest)

    def block(self, df: DataFrame) -> Column:
        """The time block a row falls in."""
        kind = df.schema[self.time].dataType
        time = F.col(self.time)
        if isinstance(kind, T.DateType):
            return F.floor(F.unix_date(time) / F.lit(self.width or 1024))
        if isinstance(kind, T.TimestampType):
            return F.floor(F.unix_micros(time) / F.lit((self.width or 3600) * 1e6))
        if isinstance(kind, T.TimestampNTZType):
            # By its parts, so that the session's time zone cannot reorder blocks.
            clock = F.hour(time) * 3600 + F.minute(time) * 60 + F.extract(F.lit("SECOND"), time).cast("double")
            seconds = F.unix_date(time.cast("date")) * F.lit(86400.0) + clock
            return F.floor(seconds / F.lit(float(self.width or 3600)))
        if isinstance(kind, T.IntegralType):
            return F.floor(time / F.lit(self.width or 65536))
        raise TypeError(f"{self.time}: a panel's time must be a date, a timestamp or an integer")


CHILI = PanelSpec()
