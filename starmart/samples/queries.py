"""One query per operator, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import contracts
from starmart import functions as fn
from starmart.operators import aggregates, dims, facts, joins, names, nearest, quality, shape, sketches
from starmart.plans import analytics, reports, star
from starmart.plans.star import MONTH, in_months
from starmart.samples import views
from starmart.session import scratch_dir
from starmart.sources import (
    Snapshots,
    land,
    land_checked,
    load_table,
    merge_rows,
    read_lookup,
    read_source,
    save,
    upsert_partitions,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYS = list(dims.CITY_KEYS)
CITY_NAMES = {**dims.CITY_COUNTS, **dims.CITY_AVERAGES}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# -- inputs ------------------------------------------------------------------------------


def _fact(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The fact with the columns asked for; ``stay`` comes with both dates."""
    names = columns or facts.VISIT_COLUMNS
    return facts.visits(views.visits_raw(spark, sf, names), names)


def _cities(spark: SparkSession, sf: str) -> DataFrame:
    return dims.city_demographics(views.demographics_raw(spark, sf), races=views.RACES)


def _state(spark: SparkSession, sf: str) -> DataFrame:
    return dims.state_dim(_cities(spark, sf), views.state_lookup(spark, sf))


def _state_names(spark: SparkSession, sf: str) -> DataFrame:
    """The part of the state dimension the reports print, from the names alone."""
    return dims.state_dim(views.city_names(spark, sf), views.state_lookup(spark, sf), ())


def _country(spark: SparkSession, sf: str) -> DataFrame:
    return dims.country_dim(
        views.temperature_raw(spark, sf),
        views.country_lookup(spark, sf),
        views.COUNTRY_OVERRIDES,
        views.LOOKUP_OVERRIDES,
    )


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


# -- sources and sinks -------------------------------------------------------------------


@query
def read_project_limit(spark: SparkSession, sf: str) -> DataFrame:
    path, columns = f"{sf}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderstatus"]
    runs = {
        "full": read_source(spark, path, "parquet", columns),
        "trial": read_source(spark, path, "parquet", columns, limit=1000),
    }
    counts = quality.row_counts(runs)
    return counts.select(F.col("table").alias("run"), "rows")


@query
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    save(views.temperature_raw(spark, sf), path, fmt="csv", header=True)
    return read_source(spark, path)


@query
def csv_semicolon(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    save(views.demographics_raw(spark, sf), path, fmt="csv", header=True, sep=";")
    return read_source(spark, path, sep=";")


@query
def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "parquet")
    orders = views.table(spark, sf, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("date")
    )
    columns = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"]
    save(orders, path, columns=columns)
    return read_source(spark, path, "parquet")


@query
def partitioned_write(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "visits")
    save(_fact(spark, sf), path, partition_by=MONTH)
    return read_source(spark, path, "parquet")


YEAR = [(1995, month) for month in range(1, 13)]


def _delivered(spark: SparkSession, sf: str) -> tuple[str, str]:
    """A full load, then the months of 1995 delivered once more with revised flights.

    The delivery also holds rows of January 1996 and rows without a month. Paths of the
    stored table and of what was rejected.
    """
    path, rejects = scratch_dir(spark, "visits"), scratch_dir(spark, "rejects")
    save(_fact(spark, sf), path, partition_by=MONTH)
    stored = read_source(spark, path, "parquet")
    revised = stored.where(F.col("i94yr") == 1995).withColumn("fltno", F.lit("revised"))
    stray = stored.where(in_months([(1996, 1)])).withColumn("fltno", F.lit("stray"))
    undated = revised.where(F.col("cicid") % 50 == 0).withColumn("i94mon", F.lit(None).cast("int"))
    delivery = scratch_dir(spark, "delivery")
    save(revised.unionByName(stray).unionByName(undated), delivery)
    upsert_partitions(read_source(spark, delivery, "parquet"), path, YEAR, rejects=rejects)
    return path, rejects


@query
def monthly_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return read_source(spark, _delivered(spark, sf)[0], "parquet")


@query
def monthly_upsert_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return read_source(spark, _delivered(spark, sf)[1], "parquet").drop("delivery")


@query
def rejects_by_delivery(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries, the second made twice: each keeps its own rejected rows, once."""
    path, rejects = scratch_dir(spark, "visits"), scratch_dir(spark, "rejects")
    fact = _fact(spark, sf, "cicid", *MONTH)
    save(fact, path, partition_by=MONTH)
    for name, month in (("first", 1), ("second", 2), ("second", 2)):
        strays = fact.where((F.col("i94yr") == 1995) & (F.col("i94mon") <= month))
        upsert_partitions(strays, path, [(1995, 1)], rejects=rejects, delivery=name)
        upsert_partitions(strays, path, [(1995, 2)], rejects=f"{rejects}-other", delivery=name)
    kept = [read_source(spark, p, "parquet") for p in (rejects, f"{rejects}-other")]
    return kept[0].unionByName(kept[1])


@query
def land_raw(spark: SparkSession, sf: str) -> DataFrame:
    source, target = scratch_dir(spark, "csv"), scratch_dir(spark, "landed")
    save(views.temperature_raw(spark, sf), source, fmt="csv", header=True)
    land(spark, source, target, partition_by=["Country"])
    return read_source(spark, target, "parquet")


def _as_csv(spark: SparkSession, df: DataFrame, **options) -> str:
    path = scratch_dir(spark, "csv")
    save(df, path, fmt="csv", header=True, **options)
    return path


@query
def land_city_temperature(spark: SparkSession, sf: str) -> DataFrame:
    target = scratch_dir(spark, "landed")
    star.land_temperature(spark, _as_csv(spark, views.city_temperature_raw(spark, sf)), target)
    return read_source(spark, target, "parquet")


@query
def land_airports(spark: SparkSession, sf: str) -> DataFrame:
    target = scratch_dir(spark, "landed")
    star.land_airports(spark, _as_csv(spark, views.airports_raw(spark, sf)), target)
    return read_source(spark, target, "parquet")


@query
def city_write(spark: SparkSession, sf: str) -> DataFrame:
    target = scratch_dir(spark, "cities")
    source = _as_csv(spark, views.demographics_raw(spark, sf), sep=";")
    star.build_city_demographics(spark, source, target, races=views.RACES)
    # Partition values are read back as numbers where they look like some.
    stored = read_source(spark, target, "parquet")
    return stored.withColumn("State Code", F.col("`State Code`").cast("string"))


def _lines(df: DataFrame, sep: str, key: Column) -> DataFrame:
    """CSV lines under a header, some of which lack a field, have one too many, or open a quote
    that they never close: ``key`` is 1, 2 or 3 for those."""
    line = F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns])
    short = F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns[:-1]])
    bad = F.when(key == 1, short).when(key == 2, F.concat(line, F.lit(f"{sep}more")))
    rows = df.select(bad.when(key == 3, F.concat(F.lit('"'), line)).otherwise(line).alias("line"))
    header = df.sparkSession.range(1).select(F.lit(sep.join(df.columns)).alias("line"))
    return header.unionByName(rows)


def _landed_checked(spark: SparkSession, df: DataFrame, sep: str, key: Column) -> tuple[DataFrame, str, str]:
    source, target, rejects = (scratch_dir(spark, x) for x in ("csv", "landed", "rejects"))
    _lines(df, sep, key).write.text(source)
    report = land_checked(spark, source, target, rejects, sep=sep, columns=df.columns)
    return report, target, rejects


def _checked_readings(spark: SparkSession, sf: str) -> tuple[DataFrame, str, str]:
    key = F.col("Latitude").cast("int") % 30
    return _landed_checked(spark, views.temperature_raw(spark, sf), ",", key)


@query
def csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Source lines against landed and rejected ones, for both delimiters."""
    last = F.right(F.col("City"), F.lit(1)).cast("int")
    cities = _landed_checked(spark, views.demographics_raw(spark, sf), ";", last)[0]
    readings = _checked_readings(spark, sf)[0]
    named = [df.withColumn("source", F.lit(n)) for n, df in (("readings", readings), ("cities", cities))]
    return named[0].unionByName(named[1])


@query
def csv_rejects_lines(spark: SparkSession, sf: str) -> DataFrame:
    return read_source(spark, _checked_readings(spark, sf)[2], "parquet")


@query
def csv_rejects_landed(spark: SparkSession, sf: str) -> DataFrame:
    return read_source(spark, _checked_readings(spark, sf)[1], "parquet")


def _first_version(spark: SparkSession, sf: str) -> tuple[str, Snapshots]:
    root = scratch_dir(spark, "published")
    tables = {
        "immigration": _fact(spark, sf),
        "date": date_dim(spark, sf),
        "country": _country(spark, sf),
        "state": _state(spark, sf),
    }
    star.publish_star(spark, tables, root, rebalance=True)
    return root, star.star_snapshots(spark, root)


def _published(spark: SparkSession, sf: str) -> Snapshots:
    """A first version, the months of 1995 revised, a publication stopped by its check, a roll-back."""
    root, snapshots = _first_version(spark, sf)
    old = snapshots.read()["immigration"]
    revised = old.where(F.col("i94yr") == 1995).withColumn("fltno", F.lit("revised"))
    star.publish_star(spark, {"immigration": revised}, root, YEAR)
    try:
        star.publish_star(spark, {"state": _state(spark, sf).limit(0)}, root)
    except ValueError:
        pass  # an empty table is never switched to
    snapshots.roll_back(1)
    return snapshots


@query
def publish_star(spark: SparkSession, sf: str) -> DataFrame:
    """The fact that readers see of the second version."""
    return _published(spark, sf).read(2)["immigration"]


@query
def merge_visits(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections of two years, several for some visits, some of which move to another month, and
    visits that are new; merged twice."""
    snapshots = _first_version(spark, sf)[1]
    old = snapshots.read()["immigration"].where(F.col("i94yr").isin(1994, 1995))
    key = F.col("cicid")

    def corrected(where: Column, order: int, **changes: Column) -> DataFrame:
        return old.where(where).withColumns({**changes, "delivered": F.lit(order)})

    parts = [
        corrected(key % 7 == 0, 1, fltno=F.lit("fix 1")),
        corrected(key % 14 == 0, 2, fltno=F.lit("fix 2")),
        corrected(key % 35 == 0, 3, fltno=F.lit("moved"), i94yr=F.lit(1997), i94mon=F.lit(6)),
        corrected(key % 50 == 3, 1, cicid=key + 10_000_000),
    ]
    delivery = scratch_dir(spark, "delivery")
    save(reduce(DataFrame.unionByName, parts), delivery)
    for _ in range(2):
        merge_rows(snapshots, "immigration", read_source(spark, delivery, "parquet"), "cicid", ["delivered"])
    return snapshots.read()["immigration"]


@query
def published_versions(spark: SparkSession, sf: str) -> DataFrame:
    """(version, table, rows, revised) of every version."""
    snapshots = _published(spark, sf)
    parts = []
    for version in snapshots.versions():
        for name, df in snapshots.read(version).items():
            changed = F.col("fltno") == "revised" if name == "immigration" else F.lit(False)
            counts = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(changed).alias("revised"))
            parts.append(counts.select(F.lit(version).alias("version"), F.lit(name).alias("table"), "rows", "revised"))
    return reduce(DataFrame.unionByName, parts)


@query
def optional_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """The job without paths to write to: the fact alone."""
    return star.build_visits(spark, _as_csv(spark, views.visits_raw(spark, sf)))


def _built_visits(spark: SparkSession, sf: str) -> tuple[str, str]:
    visits, dates = scratch_dir(spark, "visits"), scratch_dir(spark, "dates")
    star.build_visits(spark, _as_csv(spark, views.visits_raw(spark, sf)), visits, dates)
    return visits, dates


@query
def build_star_visits(spark: SparkSession, sf: str) -> DataFrame:
    return read_source(spark, _built_visits(spark, sf)[0], "parquet")


@query
def build_star_dates(spark: SparkSession, sf: str) -> DataFrame:
    return read_source(spark, _built_visits(spark, sf)[1], "parquet")


@query
def build_star_countries(spark: SparkSession, sf: str) -> DataFrame:
    target = scratch_dir(spark, "countries")
    star.build_countries(
        spark,
        _as_csv(spark, views.temperature_raw(spark, sf)),
        _as_csv(spark, views.country_lookup(spark, sf)),
        target,
        country_overrides=views.COUNTRY_OVERRIDES,
        lookup_overrides=views.LOOKUP_OVERRIDES,
    )
    return _rounded(read_source(spark, target, "parquet"), "Temperature")


@query
def build_star_states(spark: SparkSession, sf: str) -> DataFrame:
    target = scratch_dir(spark, "states")
    star.build_states(
        spark,
        _as_csv(spark, views.demographics_raw(spark, sf), sep=";"),
        _as_csv(spark, views.state_lookup(spark, sf)),
        target,
        races=views.RACES,
    )
    return read_source(spark, target, "parquet")


def _loaded(spark: SparkSession, df: DataFrame, contract: contracts.TableContract) -> DataFrame:
    """What a load wrote. The catalog entry goes again, the table's files stay."""
    path = scratch_dir(spark, contract.name)
    name = load_table(df, contract, path.rsplit("/", 1)[-1].replace("-", "_"), path=path)
    spark.sql(f"DROP TABLE {name}")
    return read_source(spark, path, "parquet")


@query
def load_contract_fact(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded(spark, _fact(spark, sf), contracts.IMMIGRATION)


@query
def load_contract_text(spark: SparkSession, sf: str) -> DataFrame:
    """Whole numbers that come as text with a fraction of nothing."""
    fact = _fact(spark, sf)
    whole = [name for name, dtype in fact.dtypes if dtype == "int"]
    text = fact.withColumns({c: F.concat(F.col(c).cast("string"), F.lit(".0")) for c in whole})
    return _loaded(spark, text, contracts.IMMIGRATION)


@query
def load_contract_date(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded(spark, date_dim(spark, sf), contracts.DATE)


@query
def load_contract_state(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded(spark, _state(spark, sf), contracts.STATE)


@query
def load_contract_country(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_loaded(spark, _country(spark, sf), contracts.COUNTRY), "Temperature")


# -- shaping -----------------------------------------------------------------------------


@query
def drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    raw = views.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("cicid"),
        F.col("o_orderstatus").alias("visatype"),
        F.col("o_custkey").alias("admnum"),
        F.col("o_orderpriority").alias("occup"),
    )
    return shape.drop_columns(raw, [*facts.HIGH_NULL_COLUMNS, *facts.NOT_USEFUL_COLUMNS])


@query
def bulk_cast(spark: SparkSession, sf: str) -> DataFrame:
    names = ["cicid", "i94addr", "fltno", "airline", "i94bir"]
    types = dict.fromkeys([*names, "dtadfile"], "int")
    return shape.cast_columns(views.visits_raw(spark, sf, names), types)


@query
def rename_mapping(spark: SparkSession, sf: str) -> DataFrame:
    customer = views.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return shape.rename_columns(customer, {"c_name": "City", "c_nationkey": "Code", "x": "y"})


@query
def value_override(spark: SparkSession, sf: str) -> DataFrame:
    changes = [
        ("Country", "NATION_7", "NATION_6"),
        ("Country", "NATION_6", "Nation Six"),
        ("Country", "nation_1", "not this"),
        ("Latitude", "7", "seven"),
    ]
    readings = views.temperature_raw(spark, sf).select("dt", "City", "Country", "Latitude")
    return shape.override_values(readings, changes)


@query
def null_fallback(spark: SparkSession, sf: str) -> DataFrame:
    name = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return views.table(spark, sf, "customer").select(
        "c_custkey", shape.name_or_title(name, F.upper("c_name")).alias("name")
    )


@query
def fill_zero(spark: SparkSession, sf: str) -> DataFrame:
    cities = views.demographics_raw(spark, sf).select(
        "City", "Race", F.col("Number of Veterans").alias("NumberVeterans")
    )
    return shape.fill_zero(cities, ["NumberVeterans"])


# -- functions ---------------------------------------------------------------------------


@query
def sas_date_decode(spark: SparkSession, sf: str) -> DataFrame:
    raw = views.visits_raw(spark, sf, ["cicid", "arrdate", "depdate"])
    return raw.select(
        fn.int_from_text("cicid").alias("cicid"),
        fn.sas_date("arrdate").alias("arrdate"),
        fn.sas_date("depdate").alias("depdate"),
    )


@query
def visit_stay(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf, "cicid", "arrdate", "depdate").select("cicid", "stay")


@query
def title_case(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat_ws(" d'", "o_orderpriority", F.lower("o_orderpriority"))
    return views.table(spark, sf, "orders").select(
        "o_orderkey", fn.title_case(text).alias("title")
    )


@query
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("o_orderdate").cast("date").cast("string")
    dated = views.table(spark, sf, "orders").select(
        "o_orderkey", fn.date_from_text(text).alias("date")
    )
    return dated.select("*", *[c.alias(name) for name, c in fn.date_parts("date").items()])


# -- joins -------------------------------------------------------------------------------


def _city_attributes(raw: DataFrame) -> DataFrame:
    return raw.groupBy(KEYS).agg(
        *[F.max(F.col(f"`{c}`")).alias(name) for c, name in CITY_NAMES.items()]
    )


@query
def inner_join_keys(spark: SparkSession, sf: str) -> DataFrame:
    raw = views.demographics_raw(spark, sf)
    races = aggregates.pivot_sum(raw, KEYS, "Race", "Count", views.RACES)
    return joins.inner_join_keys(_city_attributes(raw), races, KEYS)


@query
def lower_key_join(spark: SparkSession, sf: str) -> DataFrame:
    readings = aggregates.count_by(views.temperature_raw(spark, sf), ["Country"], "readings")
    named = readings.withColumn("Country", fn.title_case("Country"))
    return joins.left_join_lower(views.country_lookup(spark, sf), named, "I94CTRY", "Country")


@query
def lookup_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Three code tables read from files, one of which lists a code twice."""
    modes = read_lookup(
        spark, _as_csv(spark, views.mode_lookup(spark, sf)), int_code="ID", schema="ID string, Mode string")
    visas = read_lookup(
        spark, _as_csv(spark, views.visa_lookup(spark, sf)), int_code="ID", schema="ID string, Visa string")
    ports = read_lookup(
        spark, _as_csv(spark, views.port_lookup(spark, sf)), schema="ID string, Port string")
    fact = _fact(spark, sf, "cicid", "i94mode", "i94visa", "i94port")
    return joins.decode_all(
        fact,
        [
            (modes, "i94mode", "ID", "Mode", "mode"),
            (visas, "i94visa", "ID", "Visa", "visa"),
            (ports, "i94port", "ID", "Port", "port"),
        ],
    )


@query
def fixed_codes(spark: SparkSession, sf: str) -> DataFrame:
    fact = _fact(spark, sf, "cicid", "i94mode", "i94visa")
    fact = joins.decode_fixed(fact, joins.MODES, "i94mode", "mode")
    return joins.decode_fixed(fact, joins.VISAS, "i94visa", "visa")


@query
def name_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """For countries of the readings that the code table lacks, names of it that are nearly theirs."""
    readings = views.temperature_raw(spark, sf)
    return names.name_candidates(readings, views.country_lookup(spark, sf), "Country", "I94CTRY")


@query
def airport_city(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as airports, placed by their number; customers' places as cities."""
    key = F.col("s_suppkey")
    longitude, latitude = (key * 37) % 360 - 180, (key * 53) % 179 - 89
    place = F.when(key % 9 != 0, F.concat(longitude.cast("string"), F.lit(".25, "), latitude.cast("string"), F.lit(".5")))
    airports = views.table(spark, sf, "supplier").select(F.col("s_name").alias("ident"), place.alias("coordinates"))
    return _rounded(nearest.airport_cities(airports, views.temperature_raw(spark, sf)), "km")


# -- aggregates --------------------------------------------------------------------------


@query
def country_temperature(spark: SparkSession, sf: str) -> DataFrame:
    readings = views.temperature_raw(spark, sf)
    return _rounded(dims.country_temperature(readings, views.COUNTRY_OVERRIDES), "Temperature")


@query
def pivot_sum(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.pivot_sum(
        views.demographics_raw(spark, sf), KEYS, "Race", "Count", views.RACES
    )


@query
def pivot_discovered(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.pivot_sum(views.demographics_raw(spark, sf), KEYS, "Race", "Count")


@query
def state_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return dims.state_rollup(_cities(spark, sf))


@query
def distinct_dates(spark: SparkSession, sf: str) -> DataFrame:
    fact = _fact(spark, sf, "arrdate", "depdate")
    return aggregates.distinct_dates(fact, facts.DATE_COLUMNS)


@query
def date_union(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.date_union(_fact(spark, sf, "arrdate", "depdate"), facts.DATE_COLUMNS)


# -- star tables -------------------------------------------------------------------------


@query
def fact_visits(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf)


@query
def date_dim(spark: SparkSession, sf: str) -> DataFrame:
    return dims.date_dim(_fact(spark, sf, "arrdate", "depdate"))


@query
def city_demographics(spark: SparkSession, sf: str) -> DataFrame:
    return _cities(spark, sf)


@query
def state_dim(spark: SparkSession, sf: str) -> DataFrame:
    return _state(spark, sf)


@query
def country_dim(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_country(spark, sf), "Temperature")


# -- quality -----------------------------------------------------------------------------


@query
def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    return quality.row_counts({n: views.table(spark, sf, n) for n in names})


@query
def dq_non_empty(spark: SparkSession, sf: str) -> DataFrame:
    star = {
        "immigration": _fact(spark, sf, "cicid"),
        "country": _country(spark, sf),
        "state": _state(spark, sf),
        "date": date_dim(spark, sf),
        "undated": _fact(spark, sf, "i94yr").where(F.col("i94yr").isNull()),
    }
    return quality.non_empty(star)


@query
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(
        views.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query
def duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_rows(
        views.temperature_raw(spark, sf), ["dt", "City", "Country", "Latitude", "Longitude"]
    )


@query
def null_keys(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["cicid", *contracts.IMMIGRATION.foreign_keys]
    return quality.null_keys(_fact(spark, sf, *keys), keys)


@query
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(quality.null_profile(views.visits_raw(spark, sf)), "null_ratio")


@query
def drop_high_null(spark: SparkSession, sf: str) -> DataFrame:
    raw = views.visits_raw(spark, sf, ["cicid", "gender", "fltno", "airline"])
    return quality.drop_high_null(raw, threshold=0.25)


SKETCHED = ("cicid", "airline", "i94cit", "stay", "i94bir")
SKETCHED_NUMBERS = ("cicid", "stay", "i94bir")


@query
def column_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Exact profiles, and whether those merged from month sketches are within their errors."""
    path, stored = scratch_dir(spark, "visits"), scratch_dir(spark, "sketches")
    fact = _fact(spark, sf, *MONTH, "cicid", "airline", "i94cit", "i94bir", "arrdate", "depdate")
    save(fact, path, partition_by=MONTH)
    fact = read_source(spark, path, "parquet")
    sketches.refresh_sketches(fact, stored, SKETCHED, SKETCHED_NUMBERS)
    merged = sketches.refresh_sketches(fact, stored, SKETCHED, SKETCHED_NUMBERS, YEAR)
    # A row for each column.
    profile = {r["column"]: r for r in sketches.sketch_profile(merged).collect()}
    parts = []
    for name in SKETCHED:
        x, found = F.col(name), profile[name]
        n, distinct = F.count(x), F.count_distinct(x)
        near = F.abs(F.lit(found["distinct"]) - distinct) <= sketches.DISTINCT_ERROR * distinct + 1
        ranks = F.lit(True)
        for q, value in zip(sketches.QUANTILES, found["quantiles"] or [], strict=False):
            below, upto = F.count_if(x < value) / n, F.count_if(x <= value) / n
            ranks = ranks & (below <= q + sketches.RANK_ERROR) & (upto >= q - sketches.RANK_ERROR)
        exact = fact.agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(x.isNull()).alias("nulls"), distinct.alias("values"),
            near.alias("distinct_within"), ranks.alias("quantiles_within"),
        )
        same = (F.col("rows") == found["rows"]) & (F.col("nulls") == found["nulls"])
        parts.append(exact.withColumns({"column": F.lit(name), "counts_equal": same}))
    return reduce(DataFrame.unionByName, parts)


@query
def unknown_categories(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unknown_categories(
        views.demographics_raw(spark, sf), "Race", "Count", list(views.RACES)
    )


@query
def cast_failures(spark: SparkSession, sf: str) -> DataFrame:
    names = ["cicid", "i94addr", "airline", "gender", "fltno", "visatype"]
    return quality.cast_failures(
        views.visits_raw(spark, sf, names), dict.fromkeys(names, "int")
    )


@query
def schema_conformance(spark: SparkSession, sf: str) -> DataFrame:
    return quality.schema_conformance(views.visits_raw(spark, sf), contracts.IMMIGRATION)


@query
def orphans_country(spark: SparkSession, sf: str) -> DataFrame:
    """Some origins carry codes that the dimension lacks."""
    code = F.col("i94res")
    fact = _fact(spark, sf, "i94res").select(
        F.when(code % 7 == 3, code + 100).otherwise(code).alias("i94res")
    )
    return quality.orphans(fact, "i94res", _country(spark, sf), "Code")


@query
def orphans_state(spark: SparkSession, sf: str) -> DataFrame:
    """Some destinations carry codes that the dimension lacks."""
    code = F.col("i94addr")
    fact = _fact(spark, sf, "i94addr").select(
        F.when(code.isin("3", "11"), F.concat(F.lit("X"), code)).otherwise(code).alias("i94addr")
    )
    return quality.orphans(fact, "i94addr", _state(spark, sf), "Code")


@query
def orphans_date(spark: SparkSession, sf: str) -> DataFrame:
    """Departure dates on which nobody arrived."""
    fact = _fact(spark, sf, "arrdate", "depdate")
    arrivals = dims.date_dim(_fact(spark, sf, "arrdate"), ["arrdate"])
    return quality.orphans(fact, "depdate", arrivals, "date")


@query
def source_target_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "visits")
    save(_fact(spark, sf, "cicid", *MONTH), path, partition_by=MONTH)
    source = shape.cast_columns(
        views.visits_raw(spark, sf, MONTH), dict.fromkeys(MONTH, "int")
    )
    return quality.source_target_counts(source, read_source(spark, path, "parquet"), MONTH)


@query
def star_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Every check of the contracts, on the four tables as loaded."""
    loaded = {"immigration": _loaded(spark, _fact(spark, sf), contracts.IMMIGRATION)}
    # Dates come from the stored fact, as in the jobs, so that the arrivals are joined once.
    dates = loaded["immigration"].select(*[F.col(c).cast("date").alias(c) for c in facts.DATE_COLUMNS])
    built = {
        "date": dims.date_dim(dates),
        "country": _country(spark, sf),
        "state": _state(spark, sf),
    }
    loaded |= {n: _loaded(spark, df, contracts.STAR[n]) for n, df in built.items()}
    return quality.check_star(loaded, contracts.STAR)


@query
def star_checks_failing(spark: SparkSession, sf: str) -> DataFrame:
    """Every check meets its fault: repeated and missing keys, and references to nothing."""
    fact, state = _fact(spark, sf), _state(spark, sf)
    origin, address = F.col("i94res"), F.col("i94addr")
    broken = fact.unionByName(fact.where(F.col("cicid") % 89 == 1)).withColumns(
        {
            "cicid": F.when(F.col("cicid") % 97 != 0, F.col("cicid")),
            "i94res": F.when(origin % 5 == 0, origin + 100).otherwise(origin),
            "i94addr": F.when(address == "3", "X3").otherwise(address),
        }
    )
    tables = {
        "immigration": broken,
        "date": date_dim(spark, sf),
        "country": _country(spark, sf),
        "state": state.unionByName(state.where(F.col("Code") == "4")),
    }
    return quality.check_star(tables, contracts.STAR)


# -- questions ---------------------------------------------------------------------------


@query
def visits_by_nationality(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.visits_by_nationality(_fact(spark, sf, "i94cit"), _country(spark, sf))


@query
def visits_by_origin(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.visits_by_origin(_fact(spark, sf, "i94res"), _country(spark, sf))


@query
def visits_by_airline(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.visits_by_airline(_fact(spark, sf, "airline"))


@query
def avg_stay_by_state(spark: SparkSession, sf: str) -> DataFrame:
    fact = _fact(spark, sf, "i94addr", "arrdate", "depdate")
    return _rounded(
        analytics.avg_stay_by_state(fact, _state_names(spark, sf)), "avg_stay"
    )


@query
def dest_source_matrix(spark: SparkSession, sf: str) -> DataFrame:
    fact = _fact(spark, sf, "i94addr", "i94res")
    return _rounded(analytics.dest_source_matrix(fact), "lift")


@query
def corr_dest_source(spark: SparkSession, sf: str) -> DataFrame:
    fact = _fact(spark, sf, "i94addr", "i94res")
    return _rounded(analytics.corr_dest_source(fact), "chi2", "cramers_v")


@query
def corr_dest_climate(spark: SparkSession, sf: str) -> DataFrame:
    fact = _fact(spark, sf, "i94addr", "i94res")
    return _rounded(
        analytics.corr_dest_climate(fact, _country(spark, sf)), "source_temperature"
    )


@query
def corr_dest_climate_ratio(spark: SparkSession, sf: str) -> DataFrame:
    fact = _fact(spark, sf, "i94addr", "i94res")
    return _rounded(
        analytics.corr_dest_climate_ratio(fact, _country(spark, sf)), "eta_squared", "p_value"
    )


@query
def visitors_present(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.visitors_present(_fact(spark, sf, "arrdate", "depdate"))


RANKED = (("i94bir", "stay"), ("cicid", "arrdate"))


@query
def rank_correlation(spark: SparkSession, sf: str) -> DataFrame:
    fact = _fact(spark, sf, "cicid", "i94bir", "arrdate", "depdate")
    parts = [
        analytics.rank_correlation(fact, x, y).withColumns({"x": F.lit(x), "y": F.lit(y)})
        for x, y in RANKED
    ]
    return _rounded(reduce(DataFrame.unionByName, parts), "rho")


def _refreshed_states(spark: SparkSession, sf: str) -> DataFrame:
    """States of a fact of which the months of 1995, then two more, were delivered anew."""
    path, states = scratch_dir(spark, "visits"), scratch_dir(spark, "states")
    save(_fact(spark, sf), path, partition_by=MONTH)
    reports.refresh_reports(read_source(spark, path, "parquet"), states)
    for months, change in (
        (YEAR, lambda df: df.withColumns({"airline": F.lit("revised"), "stay": F.col("stay") + 2})),
        ([(1995, 3), (1996, 1)], lambda df: df.where(F.col("cicid") % 3 != 0)),
    ):
        stored = read_source(spark, path, "parquet")
        delivery = scratch_dir(spark, "delivery")
        save(change(stored.where(in_months(months))), delivery)
        upsert_partitions(read_source(spark, delivery, "parquet"), path, months)
        reports.refresh_reports(read_source(spark, path, "parquet"), states, months)
    return reports.read_states(spark, states)


@query
def refresh_reports(spark: SparkSession, sf: str) -> DataFrame:
    """(report, key, visits, value) from states of which two refreshes replaced some months."""
    states = _refreshed_states(spark, sf)
    state, country = _state_names(spark, sf), _country(spark, sf)
    none = F.lit(None).cast("double")

    def part(report: str, df: DataFrame, key: Column, visits: str, value: Column) -> DataFrame:
        return df.select(F.lit(report).alias("report"), key.cast("string").alias("key"), F.col(visits).alias("visits"), F.round(value, 4).alias("value"))

    nobody = F.lit(None)
    parts = [
        part("nationality", reports.visits_by_nationality(states, country), F.col("Country"), "visits", none),
        part("origin", reports.visits_by_origin(states, country), F.col("i94res"), "visits", none),
        part("airline", reports.visits_by_airline(states), F.col("airline"), "visits", none),
        part("stay", reports.avg_stay_by_state(states, state), F.col("i94addr"), "visits", F.col("avg_stay")),
        part("age", reports.visitor_profile_by_state(states, state), F.col("State"), "visits", F.col("avg_age")),
        part("route", reports.corr_dest_source(states), nobody, "visits", F.col("cramers_v")),
        part("temperature", reports.corr_source_temperature(states, country), nobody, "countries", F.col("corr")),
        part("stay_age", reports.corr_stay_age(states), nobody, "pairs", F.col("corr")),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def corr_source_temperature(spark: SparkSession, sf: str) -> DataFrame:
    fact = _fact(spark, sf, "i94res")
    return _rounded(analytics.corr_source_temperature(fact, _country(spark, sf)), "corr")


@query
def corr_state_demographics(spark: SparkSession, sf: str) -> DataFrame:
    fact = _fact(spark, sf, "i94addr")
    return _rounded(
        analytics.corr_state_demographics(fact, _state(spark, sf), dims.STATE_MEASURES), "corr"
    )


@query
def visitor_profile_by_state(spark: SparkSession, sf: str) -> DataFrame:
    fact = _fact(spark, sf, "i94addr", "i94bir", "gender")
    return _rounded(
        analytics.visitor_profile_by_state(fact, _state_names(spark, sf)),
        "avg_age",
        "male_share",
        "female_share",
        "unstated_share",
    )
