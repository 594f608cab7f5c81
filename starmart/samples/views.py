"""Views over the test tables, shaped like the engine's sources.

They stand in for input files. Each takes the columns its caller reads, so joins that
feed none of them are not built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.columns import SAS_EPOCH
from starmart.operators.dims import CITY_AVERAGES, CITY_COUNTS
from starmart.operators.facts import VISIT_COLUMNS

# Stand-ins for the fixed values of the real sources.
RACES = {
    "AUTOMOBILE": "AmericanIndianAndAlaskaNative",
    "BUILDING": "Asian",
    "FURNITURE": "BlackOrAfricanAmerican",
    "HOUSEHOLD": "HispanicOrLatino",
    "MACHINERY": "White",
}
COUNTRY_OVERRIDES = [("Country", "NATION_7", "NATION_6")]
LOOKUP_OVERRIDES = [
    ("I94CTRY", "INVALID: NATION_5", "NATION_5"),
    ("I94CTRY", "INVALID: NATION_10", "NATION_10"),
]


# What the fixed list of races leaves out.
OTHER_RACE = "BUILDING B"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sas_days(ts: str) -> Column:
    return F.datediff(F.col(ts).cast("date"), F.lit(SAS_EPOCH).cast("date")).cast("double")


def visits_raw(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = VISIT_COLUMNS
) -> DataFrame:
    """Orders as arrivals: the ordering customer's nation is the origin, the first
    supplier's nation the destination, the first shipment the departure."""
    wanted = set(columns)
    df = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    if wanted & {"depdate", "i94addr", "i94bir", "airline", "visatype"}:
        first = (
            table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.min("l_shipdate").alias("dep"),
                F.min("l_suppkey").alias("sk"),
                F.min("l_partkey").alias("pk"),
            )
        )
        df = df.join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    if "i94addr" in wanted:
        supplier = table(spark, sf_dir, "supplier")
        df = df.join(supplier, F.col("s_suppkey") == F.col("sk"), "left")
    if wanted & {"i94bir", "airline", "visatype"}:
        df = df.join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("pk"), "left")

    mode = F.substring("o_orderpriority", 1, 1)
    status, third = F.col("o_orderstatus"), F.col("o_custkey") % 3
    build = {
        "cicid": lambda: F.col("o_orderkey").cast("double"),
        "i94yr": lambda: F.year("o_orderdate").cast("double"),
        "i94mon": lambda: F.month("o_orderdate").cast("double"),
        "i94cit": lambda: (F.col("o_custkey") % 25).cast("double"),
        "i94res": lambda: F.col("c_nationkey").cast("double"),
        "arrdate": lambda: _sas_days("o_orderdate"),
        "depdate": lambda: _sas_days("dep"),
        "i94mode": lambda: mode.cast("double"),
        "i94addr": lambda: F.col("s_nationkey").cast("string"),
        "i94bir": lambda: F.col("p_size").cast("double"),
        "i94visa": lambda: F.when(status == "F", 1.0).when(status == "O", 2.0).otherwise(3.0),
        "airline": lambda: F.col("p_brand"),
        "fltno": lambda: third.cast("string"),
        "visatype": lambda: F.col("p_type"),
        "gender": lambda: F.when(third == 0, "M").when(third == 1, "F"),
        "i94port": lambda: mode,
    }
    return df.select(*[build[c]().alias(c) for c in columns])


def _spelt_state() -> Column:
    lower = F.col("s_suppkey") % 10 == 0
    return F.when(lower, F.lower("n_name")).otherwise(F.col("n_name"))


def city_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of the demographics alone, for callers that read no figures."""
    sold = table(spark, sf_dir, "lineitem").select("l_suppkey").distinct()
    return (
        table(spark, sf_dir, "supplier")
        .join(sold, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
        .join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        .select(
            F.col("s_name").alias("City"),
            _spelt_state().alias("State"),
            F.col("s_nationkey").cast("string").alias("State Code"),
        )
    )


def demographics_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as cities, market segments as races, quantities as head counts.

    Every fourth supplier reports one segment under a label of its own, and every tenth spells
    its state in lower case.

    Orders find their segment before they meet the line items, which are then moved once,
    and summed per supplier and segment before names are joined on.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    bought = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")
    )
    segments = (
        lineitem.join(bought, F.col("o_orderkey") == F.col("l_orderkey"))
        .withColumn(
            "race",
            F.when(
                (F.col("l_suppkey") % 4 == 0) & (F.col("c_mktsegment") == "BUILDING"), OTHER_RACE
            ).otherwise(F.col("c_mktsegment")),
        )
        .groupBy("l_suppkey", "race")
        .agg(F.sum("l_quantity").alias("quantity"))
    )
    even = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity")).otherwise(0)
    totals = lineitem.groupBy(F.col("l_suppkey").alias("t_suppkey")).agg(
        F.sum("l_quantity").cast("int").alias("total_pop"),
        F.sum(even).cast("int").alias("male_pop"),
        F.max("l_quantity").cast("double").alias("median_age"),
    )
    total, male = F.col("total_pop"), F.col("male_pop")
    return (
        segments.join(totals, F.col("l_suppkey") == F.col("t_suppkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        .groupBy("s_name", _spelt_state().alias("state"), "s_nationkey", "race")
        .agg(
            F.sum("quantity").cast("int").alias("Count"),
            F.max("median_age").alias("Median Age"),
            F.max(total).alias("Total Population"),
            F.max(male).alias("Male Population"),
            F.max(total - male).alias("Female Population"),
            F.max(F.nullif(total % 7, F.lit(0))).alias("Number of Veterans"),
            F.max(total % 11).alias("Foreign-born"),
            F.max(F.col("median_age") / 20).alias("Average Household Size"),
        )
        .select(
            F.col("s_name").alias("City"),
            F.col("state").alias("State"),
            F.col("s_nationkey").cast("string").alias("State Code"),
            F.col("race").alias("Race"),
            "Count",
            *[F.col(f"`{c}`") for c in (*CITY_COUNTS, *CITY_AVERAGES)],
        )
    )


def temperature_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings, taken where the customer of the event lives.

    The countries of one region go by names that the code table lacks.
    """
    key = F.col("c_custkey")
    nations = table(spark, sf_dir, "nation")
    renamed = F.when(
        F.col("n_regionkey") == 3, F.concat(F.lit("OLD "), F.col("n_name"))
    ).otherwise(F.col("n_name"))
    homes = table(spark, sf_dir, "customer").join(
        nations, F.col("n_nationkey") == F.col("c_nationkey")
    )
    return (
        table(spark, sf_dir, "events")
        .join(homes, F.col("user_id") == key)
        .select(
            F.col("ts").cast("date").cast("string").alias("dt"),
            F.when(F.col("event_id") % 11 != 0, F.col("value").cast("string")).alias(
                "AverageTemperature"
            ),
            F.col("c_name").alias("City"),
            renamed.alias("Country"),
            (key % 90).cast("string").alias("Latitude"),
            (key % 180).cast("string").alias("Longitude"),
        )
    )


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.upper("n_name")
    invalid = F.concat(F.lit("INVALID: "), name)
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("Code"),
        F.when(F.col("n_nationkey") % 5 == 0, invalid).otherwise(name).alias("I94CTRY"),
    )


def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("Code"), F.upper("n_name").alias("State")
    )
    rest = spark.range(1).select(
        F.lit("99").alias("Code"), F.lit("ALL OTHER CODES").alias("State")
    )
    return nations.unionByName(rest)


def port_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities as ports: the leading digit is the code, the rest the name."""
    priority = F.col("o_orderpriority")
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.substring(priority, 1, 1).alias("ID"),
            F.substring(priority, F.lit(3), F.length(priority)).alias("Port"),
        )
        .distinct()
    )


def mode_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modes by the leading digit of the order priority; one code is listed twice."""
    code = F.substring("o_orderpriority", 1, 1)
    modes = (
        table(spark, sf_dir, "orders")
        .select(code.alias("ID"), F.concat(F.lit("Mode "), code).alias("Mode"))
        .distinct()
    )
    return modes.unionByName(
        spark.range(1).select(F.lit("1").alias("ID"), F.lit("A first mode").alias("Mode"))
    )


def visa_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visa categories by the status of the order."""
    status = F.col("o_orderstatus")
    code = F.when(status == "F", "1").when(status == "O", "2").otherwise("3")
    return (
        table(spark, sf_dir, "orders")
        .select(code.alias("ID"), F.concat(F.lit("Visa "), status).alias("Visa"))
        .distinct()
    )


def city_temperature_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings with few cities, for a layout by country and city."""
    city = F.concat(F.lit("CITY_"), F.regexp_extract("City", "([0-9])$", 1))
    return temperature_raw(spark, sf_dir).withColumn("City", city)


def airports_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as airports, their nation as the country."""
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        .select(
            F.col("s_name").alias("ident"),
            F.concat(F.lit("type "), F.col("s_suppkey") % 3).alias("type"),
            F.col("n_name").alias("iso_country"),
        )
    )
