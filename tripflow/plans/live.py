"""Layers kept up to date load by load.

``Medallion`` builds a layer whole; ``Live`` brings it up to what the ledger has. For
each layer a table says which loads it holds, and a refresh takes only the others:

* Silver: the years that new loads touched are rewritten, other partitions stay.
* Facts, the hourly demand and the profile are kept as state that adds up over
  loads (sums and counts, sketches). A refresh computes the state of new loads, and
  results are merged from the state; trips of earlier loads are not read again.
* The demand series is rewritten from the month of the first hour that changed;
  its lags come from the hours before. A changed set of zones, or an earlier first
  hour, rebuilds the series, still from the hourly state.

States and months are partitions of a load or a month and the record of what a layer
holds is written last, so a refresh that was cut off is run again without doubles.
Names of loads and years pass through the driver; rows don't.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripflow.operators import gold, platinum, profile, silver
from tripflow.session import written
from tripflow.sources.loading import committed_loads, record_counts, write_observed
from tripflow.sources.tables import TableIO

LAYERS_SCHEMA = StructType([StructField("load_id", StringType(), True), StructField("layer", StringType(), True)])


class Live:
    def __init__(self, io: TableIO):
        self.io = io
        io.create("_layer_loads", LAYERS_SCHEMA)

    # -------------------------------------------------------------- records
    def pending(self, layer: str) -> list[str]:
        """Committed loads that a layer doesn't hold yet."""
        held = self.io.read("_layer_loads").where(F.col("layer") == layer)
        return sorted(r[0] for r in committed_loads(self.io).join(held, "load_id", "left_anti").collect())

    def _held(self, layer: str, loads: list[str]) -> None:
        rows = self.io.spark.createDataFrame([(x, layer) for x in loads], LAYERS_SCHEMA)
        self.io.append(rows.coalesce(1), "_layer_loads", partition_by="layer")

    def bronze_of(self, loads: list[str]) -> DataFrame:
        """Rows of some loads: a scan of their partitions."""
        return self.io.read("bronze").where(F.col("load_id").isin(loads))

    def _state(self, name: str, loads: list[str], state_of) -> None:
        """Writes the state of ``loads`` and records it."""
        if loads:
            self.io.overwrite(state_of(loads), name, partition_by="load_id", only_partitions=True)
            self._held(name, loads)

    def state(self, name: str) -> DataFrame:
        """The state of all committed loads that it holds."""
        return self.io.read(name).join(committed_loads(self.io), "load_id", "left_semi")

    # --------------------------------------------------------------- layers
    def refresh_silver(self) -> list[int]:
        """Rewrites the years that new loads touched; returns them."""
        loads = self.pending("silver")
        if not loads:
            return []
        years = sorted(r[0] for r in self.bronze_of(loads).select("year").distinct().collect())
        if years:
            all_of = self.io.read("bronze").where(F.col("year").isin(years)).join(committed_loads(self.io), "load_id", "left_semi")
            rows = silver.silver_transform(all_of.drop("load_id"))
            n = write_observed(self.io, rows, "silver", partition_by="trip_year", only_partitions=True)
            record_counts(self.io, f"layer-silver-{years[0]}-{years[-1]}", {"silver_rows_rewritten": n})
        self._held("silver", loads)
        return years

    def _silver_of(self, loads: list[str]) -> DataFrame:
        """Silver's rows of some loads; its rules look at one row at a time."""
        return silver.silver_transform(self.bronze_of(loads))

    def refresh_facts(self) -> None:
        self._state("_fact_state", self.pending("_fact_state"), lambda loads: gold.fact_state(self._silver_of(loads)))

    def facts(self) -> dict[str, DataFrame]:
        """The six facts (A5-A10) over all loads."""
        return gold.split_facts(gold.merge_facts(self.state("_fact_state")))

    def refresh_profile(self) -> None:
        of = lambda loads: profile.sketch_state(self.bronze_of(loads).drop("bronze_ingestion_time"))
        self._state("_profile_state", self.pending("_profile_state"), of)

    def profile(self) -> DataFrame:
        """A3/A4 of Bronze over all loads."""
        return profile.merge_sketches(self.state("_profile_state"))

    def refresh_series(self, trips_of=None) -> str:
        """Brings the demand series up to date; says how: ``nothing``, ``whole`` or
        the first month rewritten. ``trips_of`` gives Silver's rows of loads."""
        loads = self.pending("_hourly_state")
        if not loads:
            return "nothing"
        state = platinum.hourly_state((trips_of or self._silver_of)(loads))
        self.io.overwrite(state, "_hourly_state", partition_by="load_id", only_partitions=True)
        hourly = written(platinum.merge_hourly(self.state("_hourly_state")), "hourly")
        first = self.io.read("_hourly_state").where(F.col("load_id").isin(loads)).agg(F.min(platinum.series_ts())).first()[0]
        how = self._rewrite_series(hourly, first)
        self._held("_hourly_state", loads)
        return how

    def _rewrite_series(self, hourly: DataFrame, first) -> str:
        month = F.date_format("trip_date", "yyyy-MM").alias("series_month")
        if first is None:
            return "nothing"
        if self.io.schema("live_series") is not None:
            kept = self.io.read("live_series")
            zones = platinum.select_top_zones(platinum.zone_totals(hourly, count_col="trip_count")).select(platinum.ZONE)
            own = kept.select(platinum.ZONE).distinct()
            moved = zones.exceptAll(own).count() + own.exceptAll(zones).count()
            same_start = kept.agg(F.min(platinum.series_ts())).first()[0] == platinum.hourly_bounds(hourly).first()["start"]
            if not moved and same_start:
                start = first.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
                rows = platinum.series_of(hourly, since=F.lit(start).cast("timestamp"))
                self.io.overwrite(rows.select("*", month), "live_series", partition_by="series_month", only_partitions=True)
                return start.strftime("%Y-%m")
        self.io.overwrite(platinum.series_of(hourly).select("*", month), "live_series", partition_by="series_month")
        return "whole"

    def series(self) -> DataFrame:
        return self.io.read("live_series").drop("series_month")

    def refresh(self) -> None:
        self.refresh_silver()
        self.refresh_facts()
        self.refresh_profile()
        self.refresh_series()
