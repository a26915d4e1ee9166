"""The composed tables over the adapters, built on demand and once per query.

Tables that feed several others are written to the shared folder, as the
warehouse layers are; the rest stays lazy.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from checks.adapters import AS_OF, Inputs
from checks.views import NORMALS, REFERENCE
from rivulet.functions import geo
from rivulet.plans import climate, facts, staging
from rivulet.sources.tables import scratch_root, settle


READING_TASK = "8MB"  # compressed; readings are narrow and repeat, so sorted they take far more


def stored(build):
    """A cached property whose table is written once and read back."""
    def get(self) -> DataFrame:
        return settle(build(self), build.__name__, task_bytes=READING_TASK, by_input=True)

    table = cached_property(get)
    table.plan = build
    return table


class OnDemand(Mapping):
    """Tables by kind, each built when it is first asked for."""

    def __init__(self, kinds: Mapping[str, object], build: Callable[[str], DataFrame]):
        self.kinds, self.build, self.built = list(kinds), build, {}

    def __getitem__(self, kind: str) -> DataFrame:
        if kind not in self.kinds:
            raise KeyError(kind)
        if kind not in self.built:
            self.built[kind] = self.build(kind)
        return self.built[kind]

    def __iter__(self) -> Iterator[str]:
        return iter(self.kinds)

    def __len__(self) -> int:
        return len(self.kinds)


class Chain(Inputs):
    as_of = AS_OF

    def scratch(self, name: str) -> str:
        """A fresh folder in the shared directory the session names."""
        return f"{scratch_root(self.spark)}/{name}-{uuid.uuid4().hex}"

    def pruned(self, name: str, *through: str) -> DataFrame:
        """A stored table if it is there, else its plan.

        For a table that one step reads: it is not written in its full width, and columns
        that the step does not use are left out by Spark. Stored tables in ``through`` are
        planned with it, each on the ones named before it.
        """
        if name in self.__dict__:
            return self.__dict__[name]
        planned = []
        try:
            for table in through:
                if table not in self.__dict__:
                    self.__dict__[table] = getattr(Chain, table).plan(self)
                    planned.append(table)
            return getattr(Chain, name).plan(self)
        finally:
            for table in planned:
                del self.__dict__[table]

    def __call__(self, name: str) -> DataFrame:
        return self.cell_calendar if name == "cell_calendar" else super().__call__(name)

    @stored
    def cell_calendar(self) -> DataFrame:
        """The days of every cell: rain, its reloaded days and temperatures are all dealt from them.

        Few spans become many days in one task, so the days are spread for those who read them.
        """
        days = super().__call__("cell_calendar")
        return days.repartition(self.spark.sparkContext.defaultParallelism, "latitude", "longitude", "day")

    # ---- silver
    @stored
    def stations(self) -> DataFrame:
        return staging.build_stg_piezo_stations(self("raw_stations"))

    @cached_property
    def levels(self) -> DataFrame:
        return staging.build_stg_piezo_chroniques(self("raw_levels"), self.stations)

    @cached_property
    def raw_sites(self) -> DataFrame:
        """The landed file always has every column; the adapter derives some of them."""
        raw = self("raw_sites")
        missing = [c for c in staging.SITE_COLUMNS if c not in raw.columns]
        return raw.withColumns({c: F.lit(None).cast("string") for c in missing})

    @stored
    def sites(self) -> DataFrame:
        return staging.build_stg_hydrometry_sites(self.raw_sites)

    @stored
    def hydro_stations(self) -> DataFrame:
        return staging.build_stg_hydrometry_stations(self("raw_hydro_stations"), self.sites)

    @cached_property
    def flows(self) -> DataFrame:
        return staging.build_stg_hydrometry_obs_elab(self("raw_flows"), self.sites)

    @cached_property
    def flow_measures(self) -> DataFrame:
        return staging.build_stg_hydrometry_obs_elab(self("raw_flows"), self.sites, measures_only=True)

    @stored
    def rain(self) -> DataFrame:
        return staging.build_stg_era5_timeseries(self("raw_rain"))

    @stored
    def temps(self) -> DataFrame:
        return staging.build_stg_era5_daily_temp_stats(self("raw_temps"))

    @cached_property
    def boxes(self) -> DataFrame:
        """Rectangles as rings of points."""
        def corner(x: str, y: str):
            return F.struct(F.col(x).alias("lon"), F.col(y).alias("lat"))

        ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"),
                       corner("x0", "y1"))
        return self("boxes").select("code_eh", "libelle_eh", ring.alias("geometry"))

    @cached_property
    def pierced_boxes(self) -> DataFrame:
        """The rectangles with a hole each, and a second part."""
        def at(x: str, y: str):
            return F.struct(F.expr(x).alias("lon"), F.expr(y).alias("lat"))

        def box(x0: str, y0: str, x1: str, y1: str):
            return F.array(at(x0, y0), at(x1, y0), at(x1, y1), at(x0, y1))

        cx, cy, rx, ry = "(x0 + x1) / 2", "(y0 + y1) / 2", "(x1 - x0) * 0.375D", "(y1 - y0) * 0.375D"
        hole = F.array(at(f"{cx} - {rx}", cy), at(cx, f"{cy} - {ry}"), at(f"{cx} + {rx}", cy), at(cx, f"{cy} + {ry}"))
        east = box("x0 + 13", "y0", f"x0 + 13 + {rx}", "y0 + (y1 - y0) * 0.25D")
        parts = F.array(F.array(box("x0", "y0", "x1", "y1"), hole), F.array(east))
        return self("boxes").select("code_eh", "libelle_eh", parts.alias("geometry"))

    @stored
    def entities(self) -> DataFrame:
        raw = self("raw_entites").unionByName(self.boxes, allowMissingColumns=True)
        return staging.build_stg_tme_entites(raw)

    # ---- intermediate
    @stored
    def daily_levels(self) -> DataFrame:
        return facts.build_int_daily_measurements(self.levels)

    @cached_property
    def daily_flows(self) -> DataFrame:
        return facts.build_int_hydro_daily_measurements(self.flow_measures, self.hydro_stations)

    @stored
    def grid_points(self) -> DataFrame:
        return facts.build_int_era5_grid_points(self.rain)

    @stored
    def mapping(self) -> DataFrame:
        return facts.build_int_station_era5_mapping(
            self.stations, self.grid_points, self.entities, distance=geo.haversine_m)

    @stored
    def hydro_mapping(self) -> DataFrame:
        return facts.build_int_hydro_station_era5_mapping(
            self.hydro_stations, self.sites, self.grid_points, distance=geo.haversine_m)

    @stored
    def weather(self) -> DataFrame:
        return facts.build_int_era5_for_all_stations(self.rain, self.temps, self.mapping,
                                                     self.hydro_mapping)

    # ---- facts
    @stored
    def fact_levels(self) -> DataFrame:
        return facts.build_piezo_daily_chroniques(self.daily_levels, self.mapping, self.weather)

    @stored
    def fact_flows(self) -> DataFrame:
        return facts.build_hydro_daily_chroniques(self.daily_flows, self.hydro_mapping,
                                                  self.weather)

    @stored
    def monthly_levels(self) -> DataFrame:
        return facts.build_fct_monthly_chroniques(self.pruned("fact_levels"))

    @stored
    def monthly_flows(self) -> DataFrame:
        return facts.build_fct_monthly_hydro(self.pruned("fact_flows"))

    @stored
    def yearly_levels(self) -> DataFrame:
        return facts.build_fct_yearly_stats(self.monthly_levels)

    @stored
    def yearly_flows(self) -> DataFrame:
        return facts.build_fct_yearly_hydro(self.monthly_flows)

    # ---- climate
    @stored
    def monthly_grid(self) -> DataFrame:
        return climate.build_fct_era5_monthly_grid(self.rain, self.temps)

    @stored
    def normals(self) -> DataFrame:
        start, end, _ = NORMALS
        return climate.build_fct_era5_climatology_grid(self.monthly_grid, start, end)

    @cached_property
    def spei_fits(self) -> DataFrame:
        start, end, years = NORMALS
        return climate.fit_spei_reference(self.monthly_grid, start, end, min_years=years)

    @cached_property
    def spei_params(self) -> DataFrame:
        start, end, years = NORMALS
        return climate.build_fct_era5_spei_climatology_grid(
            self.monthly_grid, start=start, end=end, min_years=years)

    # ---- station indices
    @cached_property
    def plain_monthly(self) -> DataFrame:
        """Monthly levels without the weather chain, for single-operator queries."""
        from rivulet.operators.summaries import monthly_summary, spread

        return monthly_summary(
            self.daily_levels.withColumnRenamed("date_mesure", "date"), ["code_bss"], "date",
            "mois", spread("niveau_nappe_eau", "niveau", "amplitude_mensuelle", "niveau_stddev")
            | {"nb_jours_mesures": F.count(F.lit(1)), "profondeur": F.avg("profondeur_nappe")})

    @cached_property
    def series(self) -> Mapping[str, DataFrame]:
        """Written in the width of a series; one kind does not build the other, nor a table of days."""
        plans = climate.station_series(self.pruned("monthly_levels", "daily_levels"), self.pruned("monthly_flows"))
        return OnDemand(plans, lambda kind: settle(plans[kind], f"series_{kind}", task_bytes=READING_TASK,
                                                  by_input=True))

    @cached_property
    def grids(self) -> Mapping[str, DataFrame]:
        lo, hi, years, per_month = REFERENCE
        return OnDemand(self.series, lambda kind: climate.reference_grids(
            {kind: self.series[kind]}, period=(lo, hi), min_years=years, min_per_month=per_month)[kind])
