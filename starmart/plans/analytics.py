"""Questions put to the star.

Each counts the fact by code first and only then looks up names and measures, so what is
joined has a row per code. The fact is neither shuffled row by row nor joined, and a code
that holds a large share of it collapses inside each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.aggregates import count_by
from starmart.operators.ranks import carried_sum, spearman


def _named(counts: DataFrame, key: str, dim: DataFrame, name: str) -> DataFrame:
    names = dim.select(F.col("Code").alias("__code"), F.col(name))
    return counts.join(names, F.col(key) == F.col("__code"), "left").drop("__code")


def visits_by_nationality(fact: DataFrame, country: DataFrame) -> DataFrame:
    return _named(count_by(fact, ["i94cit"]), "i94cit", country, "Country")


def visits_by_origin(fact: DataFrame, country: DataFrame) -> DataFrame:
    return _named(count_by(fact, ["i94res"]), "i94res", country, "Country")


def visits_by_airline(fact: DataFrame) -> DataFrame:
    return count_by(fact, ["airline"])


def avg_stay_by_state(fact: DataFrame, state: DataFrame) -> DataFrame:
    """Average stay in days and the visits it rests on, where the stay is known."""
    stays = (
        fact.where(F.col("stay").isNotNull())
        .groupBy("i94addr")
        .agg(F.avg("stay").alias("avg_stay"), F.count(F.lit(1)).alias("visits"))
    )
    return _named(stays, "i94addr", state, "State")


def _cells(fact: DataFrame) -> DataFrame:
    """Visits per destination and source country, where both are known."""
    known = fact.where(F.col("i94addr").isNotNull() & F.col("i94res").isNotNull())
    return count_by(known, ["i94addr", "i94res"])


def _with_margins(cells: DataFrame) -> DataFrame:
    """Adds the totals of each cell's destination and source."""
    return cells.withColumns(
        {
            "by_addr": F.sum("visits").over(Window.partitionBy("i94addr")),
            "by_res": F.sum("visits").over(Window.partitionBy("i94res")),
        }
    )


def dest_source_matrix(fact: DataFrame) -> DataFrame:
    """Visits per destination and source, with lift: observed over expected if independent."""
    cells = _cells(fact)
    total = cells.agg(F.sum("visits")).scalar()
    lift = (
        F.col("visits").cast("double")
        * total
        / (F.col("by_addr").cast("double") * F.col("by_res"))
    )
    return _with_margins(cells).select("i94addr", "i94res", "visits", lift.alias("lift"))


def corr_dest_source(fact: DataFrame) -> DataFrame:
    """Cramer's V between destination and source country, as one row."""
    return cramers_v(_cells(fact))


def cramers_v(cells: DataFrame) -> DataFrame:
    """Cramer's V of (i94addr, i94res, visits)."""
    share = F.col("visits").cast("double") * F.col("visits") / (
        F.col("by_addr").cast("double") * F.col("by_res")
    )
    totals = _with_margins(cells).agg(
        F.sum("visits").alias("visits"),
        F.count_distinct("i94addr").alias("destinations"),
        F.count_distinct("i94res").alias("sources"),
        (F.sum(share) - 1).alias("phi2"),
    )
    freedom = F.least("destinations", "sources") - 1
    return totals.select(
        "visits",
        "destinations",
        "sources",
        (F.col("phi2") * F.col("visits")).alias("chi2"),
        F.sqrt(F.try_divide(F.greatest("phi2", F.lit(0.0)), freedom)).alias("cramers_v"),
    )


def _climate_cells(fact: DataFrame, country: DataFrame) -> DataFrame:
    return _named(_cells(fact), "i94res", country, "Temperature")


def corr_dest_climate(fact: DataFrame, country: DataFrame) -> DataFrame:
    """Per destination: visits, and the mean temperature of where they came from.

    The mean weighs each source by its visits and leaves out sources without climate.
    """
    weight = F.when(F.col("Temperature").isNotNull(), F.col("visits"))
    return (
        _climate_cells(fact, country)
        .groupBy("i94addr")
        .agg(
            F.sum("visits").alias("visits"),
            F.try_divide(F.sum(weight * F.col("Temperature")), F.sum(weight)).alias(
                "source_temperature"
            ),
        )
    )


def corr_dest_climate_ratio(
    fact: DataFrame, country: DataFrame, permutations: int = 199, seed: int = 1
) -> DataFrame:
    """Correlation ratio of source temperature by destination, as one row, with a p-value.

    Eta squared is the share of the temperature's variance over visits that lies between
    destinations. Its p-value is the share of ``permutations`` that reach it, itself included, in
    which the known temperatures are dealt anew to the countries that have one; visits from one
    country share its climate, so countries are what can be exchanged. The dealing goes by a hash of seed,
    permutation and code, so that it is the same every time.

    The fact is read once and counted by destination and source before anything is joined; the
    permutations are made from those counts, as sums of weights, values and squares that add up
    over any parts. NULL where all temperatures are equal or no visit has one.
    """
    known = country.where(F.col("Temperature").isNotNull()).select("Code", "Temperature")
    runs = F.explode(F.sequence(F.lit(1), F.lit(permutations)))

    def place(side: str) -> Column:
        key = F.md5(F.concat_ws(":", F.lit(seed), "run", F.lit(side), "Code").cast("binary"))
        return F.row_number().over(Window.partitionBy("run").orderBy(key, "Code")).alias("place")

    # Two orders of the countries by hash: the first order's i-th gets the second's i-th climate.
    takers = known.select("Code", runs.alias("run")).select("run", "Code", place("to"))
    givers = known.select("Code", "Temperature", runs.alias("run")).select("run", "Temperature", place("from"))
    dealt = takers.join(givers, ["run", "place"]).select("run", "Code", "Temperature")
    dealt = dealt.unionByName(known.select(F.lit(0).alias("run"), "Code", "Temperature"))

    t = F.col("Temperature")
    by_place = (
        _cells(fact)
        .join(dealt, F.col("i94res") == F.col("Code"))
        .groupBy("run", "i94addr")
        .agg(F.sum("visits").alias("n"), F.sum(F.col("visits") * t).alias("s"), F.sum(F.col("visits") * t * t).alias("q"))
    )
    n, s = F.sum("n"), F.sum("s")
    whole = F.sum("q") - s * s / n
    by_run = by_place.groupBy("run").agg(
        n.alias("visits"),
        F.count(F.lit(1)).alias("destinations"),
        F.when(whole > 1e-9 * F.abs(F.sum("q")), (F.sum(F.col("s") * F.col("s") / F.col("n")) - s * s / n) / whole).alias("eta"),
    )
    seen = F.max(F.when(F.col("run") == 0, F.struct("visits", "destinations", "eta")))
    # A dealing that changes nothing must count as equal, however its sums were ordered.
    reached = F.count_if(F.col("etas.eta") >= F.col("seen.eta") - 1e-9)
    return (
        by_run.agg(seen.alias("seen"), F.collect_list(F.struct("run", "eta")).alias("all"))
        .select("seen", F.explode_outer("all").alias("etas"))
        .groupBy("seen")
        .agg(reached.alias("reached"))
        .select(
            F.coalesce("seen.visits", F.lit(0)).alias("visits"),
            F.coalesce("seen.destinations", F.lit(0)).alias("destinations"),
            F.col("seen.eta").alias("eta_squared"),
            F.when(F.col("seen.eta").isNotNull(), F.col("reached") / (permutations + 1)).alias("p_value"),
        )
    )


def corr_source_temperature(fact: DataFrame, country: DataFrame) -> DataFrame:
    """Correlation over countries between their visits and their temperature."""
    return temperature_correlation(count_by(fact, ["i94res"]), country)


def temperature_correlation(visits: DataFrame, country: DataFrame) -> DataFrame:
    """The same of (i94res, visits), where the origin is known."""
    climates = country.where(F.col("Temperature").isNotNull())
    both = visits.join(climates, F.col("i94res") == F.col("Code"), "inner")
    return both.agg(
        F.count(F.lit(1)).alias("countries"),
        F.corr(F.col("visits").cast("double"), F.col("Temperature")).alias("corr"),
    )


def corr_state_demographics(
    fact: DataFrame, state: DataFrame, measures: Sequence[str]
) -> DataFrame:
    """(measure, states, corr): over states, visits against each population measure."""
    visits = count_by(fact.where(F.col("i94addr").isNotNull()), ["i94addr"])
    both = visits.join(state, F.col("i94addr") == F.col("Code"), "inner")
    x = F.col("visits").cast("double")
    stats: list[Column] = []
    for i, m in enumerate(measures):
        y = F.col(f"`{m}`").cast("double")
        stats += [F.count(y).alias(f"n{i}"), F.corr(x, y).alias(f"c{i}")]
    rows = [
        F.struct(
            F.lit(m).alias("measure"),
            F.col(f"n{i}").alias("states"),
            F.col(f"c{i}").alias("corr"),
        )
        for i, m in enumerate(measures)
    ]
    return both.agg(*stats).select(F.inline(F.array(*rows)))


def visitor_profile_by_state(fact: DataFrame, state: DataFrame) -> DataFrame:
    """Per destination: visits, average age, and the shares of men, women and unstated."""
    gender = F.col("gender")
    profile = fact.groupBy("i94addr").agg(
        F.count(F.lit(1)).alias("visits"),
        F.avg("i94bir").alias("avg_age"),
        (F.count_if(gender == "M") / F.count(F.lit(1))).alias("male_share"),
        (F.count_if(gender == "F") / F.count(F.lit(1))).alias("female_share"),
        (F.count_if(gender.isNull()) / F.count(F.lit(1))).alias("unstated_share"),
    )
    return _named(profile, "i94addr", state, "State")


def visitors_present(fact: DataFrame) -> DataFrame:
    """(date, arrived, left, present): visitors in the country on each day something changes.

    A visitor is present from the day of arrival to the day of departure and counts as ``left`` on
    the day after. Without a departure the stay is open and lasts; a stay that ends before it
    begins, or has no arrival, is left out. A stay is two events, summed by day before they meet;
    nothing is made for the days in between.
    """
    stays = fact.where(F.col("arrdate").isNotNull() & F.coalesce(F.col("depdate") >= F.col("arrdate"), F.lit(True)))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    came = F.struct(F.col("arrdate").alias("date"), one.alias("arrived"), none.alias("left"))
    went = F.struct(F.date_add("depdate", 1).alias("date"), none.alias("arrived"), one.alias("left"))
    by_day = (
        stays.select(F.inline(F.array(came, went)))
        .where(F.col("date").isNotNull())
        .groupBy("date")
        .agg(F.sum("arrived").alias("arrived"), F.sum("left").alias("left"))
    )
    months = by_day.withColumn("month", F.trunc("date", "MM"))
    change = F.col("arrived") - F.col("left")
    return carried_sum(months, "month", "date", change, "present").select("date", "arrived", "left", "present")


def rank_correlation(fact: DataFrame, x: str, y: str) -> DataFrame:
    """Spearman's rank correlation of two columns over visits, as one row; ties share their rank."""
    return spearman(fact, x, y)
