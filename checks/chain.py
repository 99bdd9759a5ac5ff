"""The stages of both product lines over one folder of test tables."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.domain import Domain, check_settings
from sectorgauge.operators import company_kpis, divisions, elements, ratios, serving
from sectorgauge.plans.monthly import flagged_kpis, sector_points
from sectorgauge.operators.seasonal import seasonal_series
from sectorgauge.plans.raw import raw_measures
from sectorgauge.plans.statements import cube_cells, flagged_ratios
from sectorgauge.sources.stages import stage

PUBLISHED_AT = dt.datetime(2001, 11, 1)


class Chain(Domain):
    """Stage tables on demand; each is computed at most once per chain."""

    def __init__(self, spark: SparkSession, sf_dir: str, **changes):
        super().__init__(spark, sf_dir)
        self.settings = check_settings(**changes)

    @cached_property
    def measures(self) -> DataFrame:
        """A union of stored tables; nothing is gained by writing it once more."""
        return raw_measures(
            self.gl_account,
            self.gl_transaction,
            self.invoice_dso,
            self.division_lookup,
            self.settings,
        )

    @property
    def kpis(self) -> DataFrame:
        return company_kpis.company_kpis(self.measures, self.settings)

    @cached_property
    def flagged_kpis(self) -> DataFrame:
        flagged = flagged_kpis(self.measures, self.division_lookup, self.settings)
        return stage(flagged, "flagged-kpis")

    @property
    def sectors(self) -> DataFrame:
        return divisions.sector_profile(self.division_lookup)

    @cached_property
    def dense_points(self) -> DataFrame:
        points = sector_points(self.flagged_kpis, self.division_lookup, self.settings)
        return stage(points, "dense-points")

    @property
    def series(self) -> DataFrame:
        return seasonal_series(self.dense_points, self.settings)

    @cached_property
    def documents(self) -> DataFrame:
        points = serving.published_points(self.series, self.settings)
        return stage(serving.series_documents(points, F.lit(PUBLISHED_AT)), "documents")

    @cached_property
    def elements(self) -> DataFrame:
        table = elements.statement_elements(
            self.measures, self.financial_period, self.settings
        )
        return stage(table, "elements")

    @property
    def ratios(self) -> DataFrame:
        return ratios.statement_ratios(self.elements, self.settings)

    @cached_property
    def flagged_ratios(self) -> DataFrame:
        flagged = flagged_ratios(self.elements, self.division_lookup, self.settings)
        return stage(flagged, "flagged-ratios")

    @cached_property
    def cells(self) -> DataFrame:
        return stage(
            cube_cells(self.flagged_ratios, self.division_lookup, self.settings), "cells"
        )

    @property
    def ratio_documents(self) -> DataFrame:
        cells = serving.publishable_cells(serving.latest_period(self.cells), self.settings)
        return serving.ratio_documents(cells, F.lit(PUBLISHED_AT))


__all__ = ["Chain", "PUBLISHED_AT"]
