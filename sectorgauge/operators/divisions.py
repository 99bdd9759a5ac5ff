"""The company dimension: who takes part, and in which peer group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"
ACCOUNTANCY = "69"
ACCOUNTANCY_SECTOR = "M69"


def domestic_divisions(lookup: DataFrame) -> DataFrame:
    """Euro divisions in the Netherlands, with their peer-group columns."""
    return lookup.filter(
        (F.col("eurocurrency") == "1") & F.col("country").contains("NL")
    ).withColumn("division", F.col("division").cast("string"))


def eligible_divisions(lookup: DataFrame) -> DataFrame:
    """Domestic divisions that share data; no answer counts as consent."""
    consent = F.col("allow_data_sharing")
    return (
        domestic_divisions(lookup)
        .filter(consent.isNull() | (consent == "True"))
        .select("division")
    )


def consent_report(lookup: DataFrame) -> DataFrame:
    """How many domestic divisions refused to share data."""
    return domestic_divisions(lookup).agg(
        F.count_if(F.col("allow_data_sharing") == "False").alias("refused"),
        F.count(F.lit(1)).alias("divisions"),
    )


def peer_profile(lookup: DataFrame) -> DataFrame:
    """Columns that place a division among its peers."""
    return domestic_divisions(lookup).select(
        "division", "sectorcode", "group_id", "size_of_merged_group"
    )


def sector_profile(lookup: DataFrame) -> DataFrame:
    """Division to sector, with accountancy moved to a sector of its own."""
    return domestic_divisions(lookup).select(
        "division",
        F.when(F.col("subsectorcode") == ACCOUNTANCY, F.lit(ACCOUNTANCY_SECTOR))
        .otherwise(F.col("sectorcode"))
        .alias("sectorcode"),
    )


def cube_profile(lookup: DataFrame) -> DataFrame:
    """Division to size, sector and subsector; gaps become 'Unknown'."""
    keys = ["sizedescription", "sectorcode", "subsectorcode"]
    return (
        domestic_divisions(lookup)
        .select("division", *keys)
        .fillna(UNKNOWN, subset=keys)
    )
