"""Country -> region maps and country display names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ISO-2 country codes of each sales region.
_AMERICAS_APAC = {
    "North America": ("US", "CA", "DO"),
    "LATAM": ("CO", "PE", "AR", "VE", "BR"),
    "APAC": ("JP", "CN", "ID", "TH", "PH", "KZ", "MN"),
}
_EMEA = ("PT", "NO", "FR", "PL", "CV", "CZ", "RU", "ES", "SE", "SI", "HR", "AM")
_EMEA_WIDE = _EMEA + ("ZW", "AF", "NG", "TN", "CM", "SS", "ZM", "MW")

REGION_MAPS = {
    "narrow": {**_AMERICAS_APAC, "EMEA": _EMEA},
    "wide": {**_AMERICAS_APAC, "EMEA": _EMEA_WIDE},
}

# Display name of each known country code.
COUNTRY_NAMES = {
    "FR": "France", "PH": "Philippines", "CA": "Canada", "SS": "South Sudan", "MN": "Mongolia",
    "ID": "Indonesia", "US": "United States", "PT": "Portugal", "NG": "Nigeria", "SI": "Slovenia",
    "ZW": "Zimbabwe", "PL": "Poland", "AM": "Armenia", "CO": "Colombia", "AR": "Argentina",
    "HR": "Croatia", "MW": "Malawi", "CZ": "Czech Republic", "RU": "Russia", "JP": "Japan",
    "CV": "Cape Verde", "CN": "China", "TN": "Tunisia", "DO": "Dominican Republic", "TH": "Thailand",
    "KZ": "Kazakhstan", "BR": "Brazil", "NO": "Norway", "CM": "Cameroon", "AF": "Afghanistan",
    "ES": "Spain", "PE": "Peru", "ZM": "Zambia", "SE": "Sweden",
}


def map_region(country: Column, region_map: str = "wide", otherwise: str = "Other") -> Column:
    """Region of a country code; NULL and unlisted codes become ``otherwise``."""
    regions = iter(REGION_MAPS[region_map].items())
    name, codes = next(regions)
    region = F.when(country.isin(*codes), name)
    for name, codes in regions:
        region = region.when(country.isin(*codes), name)
    return region.otherwise(otherwise)


def with_country_name(df: DataFrame, country: str = "country") -> DataFrame:
    """Add ``country_name``; NULL where the code is not in the fixed table (34 rows, broadcast)."""
    values = ", ".join(f"('{code}', '{name}')" for code, name in COUNTRY_NAMES.items())
    names = df.sparkSession.sql(f"SELECT * FROM VALUES {values} AS names({country}, country_name)")
    return df.join(F.broadcast(names), country, "left")
