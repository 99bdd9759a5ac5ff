"""From measures to statement elements, ratios, outlier flags and cube cells."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sectorgauge.config import Settings
from sectorgauge.operators.divisions import cube_profile, peer_profile
from sectorgauge.operators.outliers import flag_ratio_outliers, with_peer_profile
from sectorgauge.operators.ratio_cube import ratio_cube, ratio_members, until_publishable
from sectorgauge.operators.ratios import statement_ratios
from sectorgauge.sources.stages import stage


def flagged_ratios(elements: DataFrame, lookup: DataFrame, settings: Settings) -> DataFrame:
    """Company ratios with outlier flags."""
    ratios = with_peer_profile(statement_ratios(elements, settings), peer_profile(lookup))
    return flag_ratio_outliers(stage(ratios, "ratios"), settings)


def cube_cells(
    flagged: DataFrame, lookup: DataFrame, settings: Settings, how: str | None = None
) -> DataFrame:
    """Published cells, up to the last publishable month.

    Medians unless ``how`` says otherwise, exact ones with ``Settings.exact_median``.
    """
    how = how or ("exact_median" if settings.exact_median else "median")
    members = ratio_members(flagged, cube_profile(lookup))
    return until_publishable(ratio_cube(members, how), settings)
