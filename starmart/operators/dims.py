"""The dimensions: date, city demographics, state, country."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import DATE_PARTS, date_parts, double_from_text, int_from_text
from starmart.operators.aggregates import category_sums
from starmart.operators.shape import cast_columns, fill_zero, name_or_title, override_values

CITY_KEYS = ("City", "State", "State Code")

# Source columns and the names they take in the model.
CITY_COUNTS = {
    "Male Population": "MalePopulation",
    "Female Population": "FemalePopulation",
    "Total Population": "TotalPopulation",
    "Number of Veterans": "NumberVeterans",
    "Foreign-born": "ForeignBorn",
}
CITY_AVERAGES = {
    "Median Age": "MedianAge",
    "Average Household Size": "AverageHouseholdSize",
}
RACES = {
    "American Indian and Alaska Native": "AmericanIndianAndAlaskaNative",
    "Asian": "Asian",
    "Black or African-American": "BlackOrAfricanAmerican",
    "Hispanic or Latino": "HispanicOrLatino",
    "White": "White",
}
STATE_MEASURES = (*CITY_COUNTS.values(), *RACES.values())

# Spellings that differ between the temperature data and the code table.
COUNTRY_OVERRIDES = [
    ("Country", "Congo (Democratic Republic Of The)", "Congo"),
    ("Country", "Côte D'Ivoire", "Ivory Coast"),
]
LOOKUP_OVERRIDES = [
    ("I94CTRY", "BOSNIA-HERZEGOVINA", "BOSNIA AND HERZEGOVINA"),
    ("I94CTRY", "INVALID: CANADA", "CANADA"),
    ("I94CTRY", "CHINA, PRC", "CHINA"),
    ("I94CTRY", "GUINEA-BISSAU", "GUINEA BISSAU"),
    ("I94CTRY", "INVALID: PUERTO RICO", "PUERTO RICO"),
    ("I94CTRY", "INVALID: UNITED STATES", "UNITED STATES"),
]


def date_dim(df: DataFrame, columns: Sequence[str] = ("arrdate", "depdate")) -> DataFrame:
    """One row per date that occurs in any of the columns, with its calendar parts."""
    dates = (
        df.select(F.explode(F.array(*[F.col(f"`{c}`") for c in columns])).alias("date"))
        .where(F.col("date").isNotNull())
        .distinct()
    )
    parts = date_parts("date")
    return dates.select("date", *[parts[p].alias(p) for p in DATE_PARTS])


def city_demographics(
    df: DataFrame,
    counts: Mapping[str, str] = CITY_COUNTS,
    averages: Mapping[str, str] = CITY_AVERAGES,
    races: Mapping[str, str] | None = RACES,
) -> DataFrame:
    """One row per city: its attributes, and a column of head counts per race.

    With ``races=None`` every value that occurs becomes a column of its own name, at the price
    of a pass to find them. A fixed list keeps the schema fixed and leaves other values out;
    ``quality.unknown_categories`` reports those.

    The attributes repeat on each of a city's rows, so ``max`` picks the value without
    depending on row order. Both parts group by the city and therefore share one
    aggregation, with no join between them. Rows with a NULL key are left out.
    """
    typed = cast_columns(
        df,
        {**dict.fromkeys(("Count", *counts), "int"), **dict.fromkeys(averages, "double")},
    )
    attributes = {**counts, **averages}
    if races is None:
        # As many rows as the source has categories, each of which becomes a column.
        found = df.select("Race").where(F.col("Race").isNotNull()).distinct().collect()
        races = {r["Race"]: r["Race"] for r in sorted(found)}
    cities = (
        typed.dropna(subset=list(CITY_KEYS))
        .groupBy(*[F.col(f"`{k}`") for k in CITY_KEYS])
        .agg(
            *[F.max(F.col(f"`{source}`")).alias(name) for source, name in attributes.items()],
            *category_sums("Race", "Count", races),
        )
    )
    return fill_zero(cities, [*attributes.values(), *races.values()])


def state_rollup(cities: DataFrame, measures: Sequence[str] = STATE_MEASURES) -> DataFrame:
    """City figures summed by state code; of several spellings of a state, the least."""
    return cities.groupBy(F.col("`State Code`")).agg(
        F.min("State").alias("State"), *[F.sum(F.col(f"`{m}`")).alias(m) for m in measures]
    )


def state_dim(
    cities: DataFrame,
    lookup: DataFrame,
    measures: Sequence[str] = STATE_MEASURES,
    normalize_space: bool = False,
) -> DataFrame:
    """Every state of the code table with its totals; NULL totals where no city reports.

    The name comes from the city data, else from the code table in title case.
    """
    totals = state_rollup(cities, measures).withColumnRenamed("State", "__name")
    return lookup.join(totals, F.col("Code") == F.col("State Code"), "left").select(
        "Code",
        name_or_title("__name", "State", normalize_space=normalize_space).alias("State"),
        *measures,
    )


def country_temperature(
    readings: DataFrame, overrides: Sequence[tuple[str, str, str]] = COUNTRY_OVERRIDES
) -> DataFrame:
    """Mean temperature over all readings of a country, and the place of one of its cities.

    Names are overridden before grouping, so two spellings of a country merge. Readings
    are first summed per city: those buffers are fixed-width, which keeps the pass over
    the readings in a hash aggregate, and a country with an outsized share of readings
    spreads over its cities. The place is that of the first city by name.
    """
    place = ("Country", "City", "Latitude", "Longitude")
    cities = (
        override_values(readings, overrides)
        .select(*place, double_from_text("AverageTemperature").alias("reading"))
        .groupBy(*place)
        .agg(
            F.sum("reading").alias("total"),
            F.count("reading").alias("n"),
            F.count(F.lit(1)).alias("rows"),
        )
        # Always true. A caller that reads names alone would otherwise have this step merged
        # into the next, which keeps text in its buffers and so would sort all readings.
        .where(F.col("rows") > 0)
    )
    located = F.col("Latitude").isNotNull() & F.col("Longitude").isNotNull()
    return (
        cities.where(F.col("Country").isNotNull())
        .groupBy(F.lower("Country").alias("country_key"))
        .agg(
            F.min("Country").alias("Country"),
            F.try_divide(F.sum("total"), F.sum("n")).alias("Temperature"),
            F.min(F.when(located, F.struct("City", "Latitude", "Longitude"))).alias("place"),
        )
        .select(
            "country_key",
            "Country",
            "Temperature",
            F.col("place.Latitude").alias("Latitude"),
            F.col("place.Longitude").alias("Longitude"),
        )
    )


def country_dim(
    readings: DataFrame,
    lookup: DataFrame,
    country_overrides: Sequence[tuple[str, str, str]] = COUNTRY_OVERRIDES,
    lookup_overrides: Sequence[tuple[str, str, str]] = LOOKUP_OVERRIDES,
    normalize_space: bool = False,
) -> DataFrame:
    """Every country of the code table with its climate; NULL where no reading matches."""
    climates = country_temperature(readings, country_overrides)
    codes = override_values(lookup, lookup_overrides)
    return codes.join(climates, F.lower("I94CTRY") == F.col("country_key"), "left").select(
        int_from_text("Code").alias("Code"),
        name_or_title("Country", "I94CTRY", normalize_space=normalize_space).alias("Country"),
        "Temperature",
        "Latitude",
        "Longitude",
    )
