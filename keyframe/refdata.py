"""Country codes, and which of them are aggregates of others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The codes data may come under, and the aggregates among them.
ALL_COUNTRIES = [
    "AFRI", "AGO", "ALB", "ARE", "ARG", "ARM", "ASIA", "AUS", "AUT", "AZE", "BEL", "BEN", "BGD",
    "BGR", "BHR", "BIH", "BLR", "BOL", "BRA", "BRN", "BWA", "BUNK", "CAN", "CHE", "CHL", "CHNM",
    "CMR", "COD", "COG", "COL", "CIV", "CRI", "CUB", "CUW", "CYP", "CZE", "DEU", "DNK", "DOM",
    "DZA", "ECU", "EGY", "ERI", "ESP", "EST", "ETH", "EURP", "FIN", "FRA", "GAB", "GBR", "GEO",
    "GHA", "GIB", "GNQ", "GRC", "GTM", "GUY", "HKG", "HND", "HRV", "HTI", "HUN", "IDN", "IND",
    "IRL", "IRN", "IRQ", "ISL", "ISR", "ITA", "JAM", "JOR", "JPN", "KAZ", "KEN", "KGZ", "KHM",
    "KOR", "KWT", "LAO", "LBN", "LBY", "LKA", "LTU", "LUX", "LVA", "MAR", "MDA", "MDG", "MEX",
    "MIDE", "MKD", "MLT", "MMR", "MNE", "MNG", "MOZ", "MUS", "MYS", "NAM", "NAMR", "NER", "NGA",
    "NIC", "NLD", "NOR", "NPL", "NZL", "OAFR", "OASI", "OAMR", "OCEN", "OMN", "PAK", "PAN", "PER",
    "PHL", "POL", "PRK", "PRT", "PRY", "QAT", "ROU", "RUS", "RWA", "SAMR", "SAU", "SDN", "SEN",
    "SGP", "SLV", "SRB", "SSD", "SUN", "SUR", "SVK", "SVN", "SWE", "SWZ", "SYR", "TGO", "THA",
    "TJK", "TKM", "TTO", "TUN", "TUR", "TWN", "TZA", "UGA", "UKR", "URY", "USA", "UZB", "VEN",
    "VNM", "WABK", "WRLD", "WMBK", "XKX", "YEM", "YUG", "ZAF", "ZMB", "ZWE",
]
DOUBLE_COUNTED_COUNTRIES = [
    "AFRI", "ASIA", "BUNK", "EURP", "MIDE", "NAMR", "OCEN", "SAMR", "WRLD",
]

# The rest, whose data should sum to the world.
CANONICAL_COUNTRIES = [c for c in ALL_COUNTRIES if c not in DOUBLE_COUNTED_COUNTRIES]


def country_dimension(spark: SparkSession) -> DataFrame:
    """(CountryID, Country, is_double_counted), ids counting from 1."""
    rows = [(n, c, c in DOUBLE_COUNTED_COUNTRIES) for n, c in enumerate(ALL_COUNTRIES, 1)]
    return spark.createDataFrame(rows, "CountryID int, Country string, is_double_counted boolean")


def canonical_members(
    members: DataFrame, column: str, double_counted: Sequence[str] = tuple(DOUBLE_COUNTED_COUNTRIES)
) -> DataFrame:
    """Rows whose member is not an aggregate of others, so that sums count once."""
    return members.filter(~F.col(f"`{column}`").isin(list(double_counted)))
