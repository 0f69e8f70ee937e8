"""The warehouse as lazily built, memoised models.

A ``Warehouse`` is given the five raw tables (after the loader's id
clean-up) and the DRG seed. Each model is built once per instance and the
same DataFrame object is handed to every reader, so a plan that reads a
model twice shares its scans and exchanges. ``persist_dims`` keeps the
dimensions in executor storage (recomputed from lineage if an executor
is lost) for runs that build many models.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from ..operators import DEFAULT_BROADCAST_ROWS, have_at_most, select_keys
from ..operators.cache import keep
from ..sources import date_spine
from . import dims, facts, marts, partitioned, staging

# rows of a side with a key and two or three more values, per row of a whole dimension under the broadcast bound
NARROW = 10


class Warehouse:
    def __init__(self, raw: dict[str, DataFrame], seed_drg: DataFrame, *,
                 cost_tie_break: tuple[str, ...] = (), min_volume: float = 30,
                 date_range: tuple[str, str] = ("2022-10-01", "2024-10-01"),
                 spine: DataFrame | None = None, persist_dims: bool = False,
                 max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                 cost_nulls_win: bool = True, persist_marts: bool = False):
        self.raw = raw
        self.seed_drg = seed_drg
        self.cost_tie_break = cost_tie_break
        self.min_volume = min_volume
        self.date_range = date_range
        self._spine = spine
        self.persist_dims = persist_dims
        self.bcast = max_broadcast_rows
        self.cost_nulls_win = cost_nulls_win
        self._bounds: dict[str, bool] = {}
        self._star: tuple = (None, ())      # a gap mart that is not kept, and the sides it joins
        self.persist_marts = persist_marts
        self.buckets: int | None = None     # of a written fact: buckets on the hospital key
        self.dealt: set[str] = set()        # models whose rows meet by these buckets before they are written

    def _keep(self, df: DataFrame) -> DataFrame:
        return keep(df) if self.persist_dims else df

    def _keep_mart(self, df: DataFrame) -> DataFrame:
        """Facts and marts are materialized tables in the warehouse; a build
        that reads them many times (the data-test suite) keeps them."""
        return keep(df) if self.persist_marts else df

    def _small(self, name: str) -> bool | None:
        """Whether dimension ``name`` is proven within the broadcast bound.

        The three dimensions are checked together, once, in one job (a
        bounded count per persisted dimension, whose pass also fills its
        cache). Tables derived from a dimension at its grain or coarser
        inherit the answer. Without a bound (``max_broadcast_rows=None``)
        Spark and AQE decide.
        """
        if not self.bcast:
            return None
        if name not in self._bounds:
            dims = {d: self.model(d) for d in self.DIMENSIONS if d not in self._bounds}
            dims[name] = self.model(name)
            self._bounds.update(have_at_most(dims, self.bcast))
        return self._bounds[name]

    # staging -----------------------------------------------------------
    @cached_property
    def stg_hospital_general_info(self) -> DataFrame:
        return staging.stg_hospital_general_info(self.raw["hospital_general_info"])

    @cached_property
    def stg_cost_report(self) -> DataFrame:
        return staging.stg_cost_report(self.raw["cost_report"], self.cost_tie_break, self.cost_nulls_win)

    @cached_property
    def stg_census_acs(self) -> DataFrame:
        return staging.stg_census_acs(self.raw["census_acs"])

    @cached_property
    def stg_zip_cbsa_crosswalk(self) -> DataFrame:
        return staging.stg_zip_cbsa_crosswalk(self.raw["zip_cbsa_crosswalk"])

    @cached_property
    def stg_medicare_inpatient(self) -> DataFrame:
        return staging.stg_medicare_inpatient(self.raw["medicare_inpatient"])

    # dimensions ----------------------------------------------------------
    @cached_property
    def dim_hospital(self) -> DataFrame:
        return self._keep(dims.dim_hospital(
            self.stg_hospital_general_info, self.stg_cost_report, self.stg_zip_cbsa_crosswalk,
            self.stg_medicare_inpatient))

    @cached_property
    def dim_drg(self) -> DataFrame:
        return self._keep(dims.dim_drg(self.seed_drg))

    @cached_property
    def dim_geography(self) -> DataFrame:
        return self._keep(dims.dim_geography(self.stg_census_acs))

    @cached_property
    def dim_date(self) -> DataFrame:
        spine = self._spine
        if spine is None:
            spine = date_spine(self.seed_drg.sparkSession, *self.date_range)
        return dims.dim_date(spine)

    # facts -----------------------------------------------------------------
    @cached_property
    def fct_hospital_finance(self) -> DataFrame:
        # read once by a query, which prunes its measures
        return facts.fct_hospital_finance(self.stg_cost_report, self.dim_hospital, self._small("dim_hospital"))

    @cached_property
    def fct_medicare_drg(self) -> DataFrame:
        medicare, hospitals = self.stg_medicare_inpatient, self.dim_hospital
        if self.buckets and self._small("dim_hospital") is False \
                and medicare.schema["ccn"].dataType == hospitals.schema["ccn"].dataType \
                and facts.own_keys(hospitals, "ccn", "hospital_key") and facts.own_keys(self.dim_drg, "drg_code", "drg_key"):
            self.dealt.add("fct_medicare_drg")
            return facts.fct_medicare_drg_dealt(medicare, hospitals, self.dim_drg, self.buckets, self._small("dim_drg"))
        return self._keep_mart(facts.fct_medicare_drg(
            self.stg_medicare_inpatient, self.dim_hospital, self.dim_drg,
            self._small("dim_hospital"), self._small("dim_drg")))

    @cached_property
    def fct_medicare_drg_with_line(self) -> DataFrame:
        """The fact with its DRG's service line. The lines of a DRG dimension
        too large to broadcast are joined to its keys, not to the fact's rows
        once more."""
        hospital_small, drg_small = self._small("dim_hospital"), self._small("dim_drg")
        if drg_small is not False or "fct_medicare_drg" in self.__dict__:
            return partitioned.with_line(self.fct_medicare_drg, self.dim_drg, drg_small)
        lined = self._keep(partitioned.with_line(select_keys(self.dim_drg, "drg_code", "drg_key"), self.dim_drg, False))
        return facts.fct_medicare_drg(self.stg_medicare_inpatient, self.dim_hospital, lined, hospital_small, False,
                                      [partitioned.LINE])

    # marts -----------------------------------------------------------------
    @cached_property
    def mart_reimbursement_gap(self) -> DataFrame:
        hospital_small, drg_small, geo_small = (self._small(d) for d in self.DIMENSIONS)
        if False in (hospital_small, drg_small) and "fct_medicare_drg" not in self.__dict__:
            per_hospital = marts.usable_hospitals(self.fct_hospital_finance, self.dim_hospital, self.dim_geography,
                                                  hospital_small, geo_small)
            sides = (self._keep(marts.gap_hospitals(per_hospital, self.dim_hospital, hospital_small)),
                     self._keep(marts.gap_drgs(self.dim_drg, drg_small)))
            star = marts.mart_reimbursement_gap_star(self.stg_medicare_inpatient, *sides, hospital_small, drg_small)
            if not self.persist_marts:
                self._star = star, sides
            return self._keep_mart(star)
        if self.buckets and drg_small is False:
            self.dealt.add("mart_reimbursement_gap")
            per_hospital = marts.usable_hospitals(self.fct_hospital_finance, self.dim_hospital, self.dim_geography,
                                                  hospital_small, geo_small)
            return marts.mart_reimbursement_gap_dealt(self.fct_medicare_drg, per_hospital, self.dim_drg, self.buckets,
                                                      hospital_small)
        return self._keep_mart(marts.mart_reimbursement_gap(
            self.fct_medicare_drg, self.fct_hospital_finance, self.dim_hospital, self.dim_drg,
            self.dim_geography, hospital_small, drg_small, geo_small))

    def gap_rows_of(self, groups: DataFrame) -> DataFrame:
        """Rows of the gap mart in the few ``groups`` (service_line,
        metro_name). Of a mart that is joined anew for every reader, only
        the hospitals of these metros and the DRGs of these lines are joined."""
        gap = self.mart_reimbursement_gap
        star, sides = self._star
        if gap is star:
            sides = marts.sides_of_groups(*sides, groups)
            small = have_at_most(dict(zip("hd", sides)), self.bcast)
            gap = marts.mart_reimbursement_gap_star(self.stg_medicare_inpatient, *sides, small["h"], small["d"])
        return marts.rows_of_groups(gap, groups)

    @cached_property
    def gap_measures(self) -> DataFrame:
        """Line, metro and measures of every row of the gap mart. Of a mart
        that is joined anew for every reader, the sides are joined with the
        few columns that this needs: ``NARROW`` times as many rows of them
        may be broadcast, within the same bytes."""
        gap = self.mart_reimbursement_gap
        star, sides = self._star
        if gap is not star:
            return gap.select(marts.GAP_MEASURES)
        sides = marts.measure_sides(*sides)
        small = have_at_most(dict(zip("hd", sides)), NARROW * self.bcast)
        return marts.gap_measures_star(self.stg_medicare_inpatient, *sides, small["h"], small["d"])

    @cached_property
    def service_line_groups(self) -> DataFrame:
        """The margin roll-up before ranking."""
        return marts.service_line_groups(self.gap_measures)

    @cached_property
    def mart_service_line_margin(self) -> DataFrame:
        return self._keep_mart(marts.mart_service_line_margin(self.service_line_groups, self.min_volume))

    @cached_property
    def mart_finance_scorecard(self) -> DataFrame:
        return self._keep_mart(marts.mart_finance_scorecard(
            self.fct_hospital_finance, self.dim_hospital, self.dim_geography,
            self._small("dim_hospital"), self._small("dim_geography")))

    @cached_property
    def mart_burden_vs_community(self) -> DataFrame:
        return marts.mart_burden_vs_community(self.mart_finance_scorecard, self.dim_geography,
                                              self._small("dim_geography"))

    DIMENSIONS = ["dim_hospital", "dim_drg", "dim_geography"]

    MODELS = [
        "stg_hospital_general_info", "stg_cost_report", "stg_census_acs", "stg_zip_cbsa_crosswalk",
        "stg_medicare_inpatient", "dim_hospital", "dim_drg", "dim_geography", "dim_date",
        "fct_hospital_finance", "fct_medicare_drg", "mart_reimbursement_gap",
        "mart_service_line_margin", "mart_finance_scorecard", "mart_burden_vs_community",
    ]

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)
