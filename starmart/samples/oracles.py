"""The same results in SQL, for DuckDB over the same tables.

Written against the base tables alone and independent of the engine: each statement
inlines the source-shaped views it needs.
"""

from __future__ import annotations

_CTES = {
    "visits_raw": """
      SELECT CAST(o.o_orderkey AS DOUBLE) AS cicid,
        CAST(EXTRACT(YEAR FROM o.o_orderdate) AS DOUBLE) AS i94yr,
        CAST(EXTRACT(MONTH FROM o.o_orderdate) AS DOUBLE) AS i94mon,
        CAST(o.o_custkey % 25 AS DOUBLE) AS i94cit, CAST(c.c_nationkey AS DOUBLE) AS i94res,
        CAST(date_diff('day', DATE '1960-01-01', CAST(o.o_orderdate AS DATE)) AS DOUBLE) AS arrdate,
        CAST(date_diff('day', DATE '1960-01-01', CAST(l.dep AS DATE)) AS DOUBLE) AS depdate,
        CAST(left(o.o_orderpriority, 1) AS DOUBLE) AS i94mode,
        CAST(s.s_nationkey AS VARCHAR) AS i94addr, CAST(p.p_size AS DOUBLE) AS i94bir,
        CAST(CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS DOUBLE) AS i94visa,
        p.p_brand AS airline, CAST(o.o_custkey % 3 AS VARCHAR) AS fltno, p.p_type AS visatype,
        CASE o.o_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender,
        left(o.o_orderpriority, 1) AS i94port
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
      LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS dep, min(l_suppkey) AS sk,
                   min(l_partkey) AS pk FROM lineitem GROUP BY l_orderkey) l
        ON l.l_orderkey = o.o_orderkey
      LEFT JOIN supplier s ON s.s_suppkey = l.sk
      LEFT JOIN part p ON p.p_partkey = l.pk""",
    "fact": """
      SELECT i94addr, CAST(i94mon AS INTEGER) AS i94mon, CAST(cicid AS INTEGER) AS cicid,
        CAST(i94visa AS INTEGER) AS i94visa, CAST(i94res AS INTEGER) AS i94res,
        DATE '1960-01-01' + CAST(arrdate AS INTEGER) AS arrdate,
        CAST(i94yr AS INTEGER) AS i94yr,
        DATE '1960-01-01' + CAST(depdate AS INTEGER) AS depdate,
        airline, fltno, CAST(i94mode AS INTEGER) AS i94mode, i94port, visatype, gender,
        CAST(i94cit AS INTEGER) AS i94cit, CAST(i94bir AS INTEGER) AS i94bir,
        CAST(depdate - arrdate AS INTEGER) AS stay
      FROM visits_raw""",
    "demographics_raw": """
      SELECT s.s_name AS "City",
        CASE WHEN s.s_suppkey % 10 = 0 THEN lower(n.n_name) ELSE n.n_name END AS "State",
        CAST(s.s_nationkey AS VARCHAR) AS "State Code",
        CASE WHEN s.s_suppkey % 4 = 0 AND c.c_mktsegment = 'BUILDING' THEN 'BUILDING B'
          ELSE c.c_mktsegment END AS "Race",
        CAST(sum(l.l_quantity) AS INTEGER) AS "Count", max(t.median_age) AS "Median Age",
        max(t.total_pop) AS "Total Population", max(t.male_pop) AS "Male Population",
        max(t.total_pop - t.male_pop) AS "Female Population",
        max(nullif(t.total_pop % 7, 0)) AS "Number of Veterans",
        max(t.total_pop % 11) AS "Foreign-born",
        max(t.median_age / 20) AS "Average Household Size"
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
      JOIN customer c ON c.c_custkey = o.o_custkey
      JOIN supplier s ON s.s_suppkey = l.l_suppkey
      JOIN nation n ON n.n_nationkey = s.s_nationkey
      JOIN (SELECT l_suppkey, CAST(sum(l_quantity) AS INTEGER) AS total_pop,
              CAST(sum(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity ELSE 0 END) AS INTEGER)
                AS male_pop,
              CAST(max(l_quantity) AS DOUBLE) AS median_age
            FROM lineitem GROUP BY l_suppkey) t ON t.l_suppkey = s.s_suppkey
      GROUP BY ALL""",
    "temperature_raw": """
      SELECT CAST(CAST(e.ts AS DATE) AS VARCHAR) AS dt,
        CASE WHEN e.event_id % 11 <> 0 THEN CAST(e.value AS VARCHAR) END AS "AverageTemperature",
        c.c_name AS "City",
        CASE WHEN n.n_regionkey = 3 THEN concat('OLD ', n.n_name) ELSE n.n_name END AS "Country",
        CAST(c.c_custkey % 90 AS VARCHAR) AS "Latitude",
        CAST(c.c_custkey % 180 AS VARCHAR) AS "Longitude"
      FROM events e JOIN customer c ON c.c_custkey = e.user_id
      JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "country_lookup": """
      SELECT CAST(n_nationkey AS VARCHAR) AS "Code",
        CASE WHEN n_nationkey % 5 = 0 THEN concat('INVALID: ', upper(n_name))
          ELSE upper(n_name) END AS "I94CTRY"
      FROM nation""",
    "state_lookup": """
      SELECT CAST(n_nationkey AS VARCHAR) AS "Code", upper(n_name) AS "State" FROM nation
      UNION ALL SELECT '99', 'ALL OTHER CODES'""",
    "city_races": """
      SELECT "City", "State", "State Code",
        CAST(sum("Count") FILTER (WHERE "Race" = 'AUTOMOBILE') AS BIGINT)
          AS "AmericanIndianAndAlaskaNative",
        CAST(sum("Count") FILTER (WHERE "Race" = 'BUILDING') AS BIGINT) AS "Asian",
        CAST(sum("Count") FILTER (WHERE "Race" = 'FURNITURE') AS BIGINT)
          AS "BlackOrAfricanAmerican",
        CAST(sum("Count") FILTER (WHERE "Race" = 'HOUSEHOLD') AS BIGINT) AS "HispanicOrLatino",
        CAST(sum("Count") FILTER (WHERE "Race" = 'MACHINERY') AS BIGINT) AS "White"
      FROM demographics_raw GROUP BY "City", "State", "State Code" """,
    "city_first": """
      SELECT "City", "State", "State Code", max("Male Population") AS "MalePopulation",
        max("Female Population") AS "FemalePopulation",
        max("Total Population") AS "TotalPopulation",
        max("Number of Veterans") AS "NumberVeterans", max("Foreign-born") AS "ForeignBorn",
        max("Median Age") AS "MedianAge",
        max("Average Household Size") AS "AverageHouseholdSize"
      FROM demographics_raw GROUP BY "City", "State", "State Code" """,
    "cities": """
      SELECT f."City", f."State", f."State Code",
        coalesce(f."MalePopulation", 0) AS "MalePopulation",
        coalesce(f."FemalePopulation", 0) AS "FemalePopulation",
        coalesce(f."TotalPopulation", 0) AS "TotalPopulation",
        coalesce(f."NumberVeterans", 0) AS "NumberVeterans",
        coalesce(f."ForeignBorn", 0) AS "ForeignBorn",
        coalesce(f."MedianAge", 0) AS "MedianAge",
        coalesce(f."AverageHouseholdSize", 0) AS "AverageHouseholdSize",
        coalesce(r."AmericanIndianAndAlaskaNative", 0) AS "AmericanIndianAndAlaskaNative",
        coalesce(r."Asian", 0) AS "Asian",
        coalesce(r."BlackOrAfricanAmerican", 0) AS "BlackOrAfricanAmerican",
        coalesce(r."HispanicOrLatino", 0) AS "HispanicOrLatino",
        coalesce(r."White", 0) AS "White"
      FROM city_first f JOIN city_races r
        ON r."City" = f."City" AND r."State" = f."State" AND r."State Code" = f."State Code" """,
    "states": """
      SELECT "State Code", min("State") AS "State", CAST(sum("MalePopulation") AS BIGINT) AS "MalePopulation",
        CAST(sum("FemalePopulation") AS BIGINT) AS "FemalePopulation",
        CAST(sum("TotalPopulation") AS BIGINT) AS "TotalPopulation",
        CAST(sum("NumberVeterans") AS BIGINT) AS "NumberVeterans",
        CAST(sum("ForeignBorn") AS BIGINT) AS "ForeignBorn",
        CAST(sum("AmericanIndianAndAlaskaNative") AS BIGINT) AS "AmericanIndianAndAlaskaNative",
        CAST(sum("Asian") AS BIGINT) AS "Asian",
        CAST(sum("BlackOrAfricanAmerican") AS BIGINT) AS "BlackOrAfricanAmerican",
        CAST(sum("HispanicOrLatino") AS BIGINT) AS "HispanicOrLatino",
        CAST(sum("White") AS BIGINT) AS "White"
      FROM cities GROUP BY "State Code" """,
    "state": r"""
      SELECT k."Code", coalesce(s."State", array_to_string(list_transform(
          regexp_extract_all(lower(k."State"), '\p{L}+|\P{L}+'),
          lambda x: upper(x[1]) || x[2:]), '')) AS "State",
        s."MalePopulation", s."FemalePopulation", s."TotalPopulation", s."NumberVeterans",
        s."ForeignBorn", s."AmericanIndianAndAlaskaNative", s."Asian",
        s."BlackOrAfricanAmerican", s."HispanicOrLatino", s."White"
      FROM state_lookup k LEFT JOIN states s ON s."State Code" = k."Code" """,
    "readings": """
      SELECT CASE WHEN "Country" = 'NATION_7' THEN 'NATION_6' ELSE "Country" END AS "Country",
        CAST("AverageTemperature" AS DOUBLE) AS reading, "City", "Latitude", "Longitude"
      FROM temperature_raw""",
    "climates": """
      SELECT lower("Country") AS country_key, min("Country") AS "Country",
        avg(reading) AS "Temperature",
        arg_min("Latitude", "City") AS "Latitude", arg_min("Longitude", "City") AS "Longitude"
      FROM readings GROUP BY lower("Country")""",
    "country": r"""
      SELECT CAST(k."Code" AS INTEGER) AS "Code",
        coalesce(t."Country", array_to_string(list_transform(
          regexp_extract_all(lower(k.name), '\p{L}+|\P{L}+'),
          lambda x: upper(x[1]) || x[2:]), '')) AS "Country",
        t."Temperature", t."Latitude", t."Longitude"
      FROM (SELECT "Code", CASE "I94CTRY" WHEN 'INVALID: NATION_5' THEN 'NATION_5'
                WHEN 'INVALID: NATION_10' THEN 'NATION_10' ELSE "I94CTRY" END AS name
            FROM country_lookup) k
      LEFT JOIN climates t ON t.country_key = lower(k.name)""",
    "dates": """
      SELECT d AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
        CAST(day(d) AS INTEGER) AS day, CAST(weekofyear(d) AS INTEGER) AS weekofyear,
        CAST(dayofweek(d) + 1 AS INTEGER) AS dayofweek
      FROM (SELECT arrdate AS d FROM fact UNION SELECT depdate FROM fact) WHERE d IS NOT NULL""",
    "cells": """
      SELECT i94addr, i94res, count(*) AS visits FROM fact
      WHERE i94addr IS NOT NULL AND i94res IS NOT NULL GROUP BY i94addr, i94res""",
    "by_addr": """
      SELECT i94addr, count(*) AS visits FROM fact WHERE i94addr IS NOT NULL
      GROUP BY i94addr""",
    "margins": """
      SELECT c.*, a.n AS by_addr, r.n AS by_res FROM cells c
      JOIN (SELECT i94addr, sum(visits) AS n FROM cells GROUP BY i94addr) a
        ON a.i94addr = c.i94addr
      JOIN (SELECT i94res, sum(visits) AS n FROM cells GROUP BY i94res) r
        ON r.i94res = c.i94res""",
}

# Which views a view reads, in the order they must be stated.
_NEEDS = {
    "fact": ["visits_raw"],
    "city_races": ["demographics_raw"],
    "city_first": ["demographics_raw"],
    "cities": ["city_first", "city_races"],
    "states": ["cities"],
    "state": ["state_lookup", "states"],
    "readings": ["temperature_raw"],
    "climates": ["readings"],
    "country": ["country_lookup", "climates"],
    "dates": ["fact"],
    "cells": ["fact"],
    "by_addr": ["fact"],
    "margins": ["cells"],
}


def _sql(body: str, *needs: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    ctes = ",\n".join(f"{name} AS ({_CTES[name]})" for name in order)
    return f"WITH {ctes}\n{body}" if order else body


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "BUILDING B", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

_MEASURES = [
    "MalePopulation", "FemalePopulation", "TotalPopulation", "NumberVeterans", "ForeignBorn",
    "AmericanIndianAndAlaskaNative", "Asian", "BlackOrAfricanAmerican", "HispanicOrLatino",
    "White",
]

_VISIT_COLUMNS = [
    "i94addr", "i94mon", "cicid", "i94visa", "i94res", "arrdate", "i94yr", "depdate",
    "airline", "fltno", "i94mode", "i94port", "visatype", "gender", "i94cit", "i94bir",
]

# Contract column: expected type, type in the source. Dates are asked for as text of the form
# YYYY-MM-DD; the source has day numbers, none of which is such a text.
_CONTRACT = {
    **dict.fromkeys(
        ["i94mon", "cicid", "i94visa", "i94res", "i94yr", "i94mode", "i94cit", "i94bir"],
        ("int", "double"),
    ),
    "arrdate": ("date text", "double"),
    "depdate": ("date text", "double"),
    **dict.fromkeys(
        ["airline", "fltno", "i94port", "visatype", "gender", "i94addr"], ("string", "string")
    ),
}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _profile(column: str, view: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", count(*) AS rows, "
        f'count(*) FILTER (WHERE "{column}" IS NULL) AS nulls, '
        f'round(count(*) FILTER (WHERE "{column}" IS NULL) / count(*), 4) AS null_ratio '
        f"FROM {view}"
    )


def _failures(column: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", 'int' AS target_type, count(\"{column}\") AS rows, "
        f'count(*) FILTER (WHERE "{column}" IS NOT NULL AND TRY_CAST("{column}" AS INTEGER) '
        f"IS NULL) AS failed FROM visits_raw"
    )


def _conformance(column: str, expected: str, actual: str) -> str:
    misfit = {
        "int": f'TRY_CAST("{column}" AS INTEGER) IS NULL OR "{column}" <> floor("{column}")',
        "string": "false",
        "date text": "true",
    }[expected]
    failed = f'count(*) FILTER (WHERE "{column}" IS NOT NULL AND ({misfit}))'
    return (
        f"SELECT 'immigration' AS \"table\", '{column}' AS \"column\", "
        f"'{expected}' AS expected_type, '{actual}' AS actual_type, {failed} AS failed, "
        f"{failed} = 0 AS passed FROM visits_raw"
    )


def _check(table: str, check: str, count: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", n AS observed, n = 0 AS passed "
        f"FROM ({count})"
    )


def _filled(table: str, view: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", 'non_empty' AS \"check\", count(*) AS observed, "
        f"count(*) > 0 AS passed FROM {view}"
    )


def _keyed(table: str, view: str, key: str) -> list[str]:
    dups = f"SELECT count(*) AS n FROM (SELECT 1 FROM {view} GROUP BY {key} HAVING count(*) > 1)"
    nulls = f"SELECT count(*) FILTER (WHERE {key} IS NULL) AS n FROM {view}"
    return [_check(table, "unique_key", dups), _check(table, "not_null", nulls)]


# The fact and the state dimension with faults.
_BROKEN = """(SELECT * REPLACE (CASE WHEN cicid % 97 <> 0 THEN cicid END AS cicid,
    CASE WHEN i94res % 5 = 0 THEN i94res + 100 ELSE i94res END AS i94res,
    CASE WHEN i94addr = '3' THEN 'X3' ELSE i94addr END AS i94addr)
  FROM (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE cicid % 89 = 1))"""
_REPEATED = """(SELECT * FROM state UNION ALL SELECT * FROM state WHERE "Code" = '4')"""


def _referenced(column: str, table: str, view: str, key: str, fact: str = "fact") -> str:
    count = (
        f"SELECT count(*) AS n FROM {fact} WHERE {column} IS NOT NULL "
        f"AND {column} NOT IN (SELECT {key} FROM {view})"
    )
    return _check("immigration", f"references_{table}:{column}", count)


def _correlation(measure: str) -> str:
    return (
        f"SELECT '{measure}' AS measure, count(s.\"{measure}\") AS states, "
        f'round(corr(CAST(v.visits AS DOUBLE), CAST(s."{measure}" AS DOUBLE)), 4) AS corr '
        f"FROM by_addr v JOIN state s ON s.\"Code\" = v.i94addr"
    )


def _rounded_country() -> str:
    return (
        'SELECT "Code", "Country", round("Temperature", 4) AS "Temperature", "Latitude", '
        '"Longitude" FROM country'
    )


ORACLES: dict[str, str] = {
    # sources and sinks
    "read_project_limit": """
      SELECT 'full' AS run, count(*) AS rows FROM orders
      UNION ALL SELECT 'trial', count(*) FROM (SELECT o_orderkey FROM orders LIMIT 1000)""",
    "csv_roundtrip": _sql("SELECT * FROM temperature_raw", "temperature_raw"),
    "csv_semicolon": _sql(
        "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM demographics_raw", "demographics_raw"
    ),
    "parquet_roundtrip": """
      SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice,
        o_orderpriority FROM orders""",
    "partitioned_write": _sql("SELECT * FROM fact", "fact"),
    "monthly_upsert": _sql(
        "SELECT * REPLACE (CASE WHEN i94yr = 1995 THEN 'revised' ELSE fltno END AS fltno) "
        "FROM fact",
        "fact",
    ),
    "monthly_upsert_rejects": _sql(
        "SELECT * REPLACE ('stray' AS fltno) FROM fact WHERE i94yr = 1996 AND i94mon = 1 "
        "UNION ALL SELECT * REPLACE ('revised' AS fltno, CAST(NULL AS INTEGER) AS i94mon) "
        "FROM fact WHERE i94yr = 1995 AND cicid % 50 = 0",
        "fact",
    ),
    "land_city_temperature": _sql(
        "SELECT * REPLACE (concat('CITY_', right(\"City\", 1)) AS \"City\") FROM temperature_raw",
        "temperature_raw",
    ),
    "land_airports": """
      SELECT s_name AS ident, concat('type ', s_suppkey % 3) AS type, n_name AS iso_country
      FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "city_write": _sql("SELECT * FROM cities", "cities"),
    "optional_outputs": _sql("SELECT * FROM fact", "fact"),
    "build_star_visits": _sql("SELECT * FROM fact", "fact"),
    "build_star_dates": _sql("SELECT * FROM dates", "dates"),
    "build_star_countries": _sql(_rounded_country(), "country"),
    "build_star_states": _sql("SELECT * FROM state", "state"),
    "land_raw": _sql("SELECT * FROM temperature_raw", "temperature_raw"),
    "load_contract_fact": _sql(
        "SELECT * REPLACE (CAST(arrdate AS VARCHAR) AS arrdate, "
        "CAST(depdate AS VARCHAR) AS depdate) FROM fact",
        "fact",
    ),
    "load_contract_text": _sql(
        "SELECT * REPLACE (CAST(arrdate AS VARCHAR) AS arrdate, "
        "CAST(depdate AS VARCHAR) AS depdate) FROM fact",
        "fact",
    ),
    "load_contract_date": _sql(
        "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM dates", "dates"
    ),
    "load_contract_state": _sql("SELECT * FROM state", "state"),
    "load_contract_country": _sql(_rounded_country(), "country"),
    # shaping
    "drop_columns": "SELECT o_orderkey AS cicid, o_orderstatus AS visatype FROM orders",
    "bulk_cast": _sql(
        "SELECT CAST(cicid AS INTEGER) AS cicid, CAST(i94addr AS INTEGER) AS i94addr, "
        "CAST(fltno AS INTEGER) AS fltno, TRY_CAST(airline AS INTEGER) AS airline, "
        "CAST(i94bir AS INTEGER) AS i94bir FROM visits_raw",
        "visits_raw",
    ),
    "rename_mapping": """
      SELECT c_custkey, c_name AS "City", c_nationkey AS "Code" FROM customer""",
    "value_override": _sql(
        """SELECT dt, "City",
          CASE WHEN "Country" IN ('NATION_6', 'NATION_7') THEN 'Nation Six' ELSE "Country" END
            AS "Country",
          CASE WHEN "Latitude" = '7' THEN 'seven' ELSE "Latitude" END AS "Latitude"
        FROM temperature_raw""",
        "temperature_raw",
    ),
    "null_fallback": r"""
      SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'),
        array_to_string(list_transform(regexp_extract_all(lower(c_name), '\p{L}+|\P{L}+'),
          lambda x: upper(x[1]) || x[2:]), '')) AS name
      FROM customer""",
    "fill_zero": _sql(
        'SELECT "City", "Race", coalesce("Number of Veterans", 0) AS "NumberVeterans" '
        "FROM demographics_raw",
        "demographics_raw",
    ),
    # functions
    "sas_date_decode": _sql("SELECT cicid, arrdate, depdate FROM fact", "fact"),
    "visit_stay": _sql("SELECT cicid, stay FROM fact", "fact"),
    "title_case": r"""
      SELECT o_orderkey, array_to_string(list_transform(regexp_extract_all(
          lower(o_orderpriority || ' d''' || o_orderpriority), '\p{L}+|\P{L}+'),
          lambda x: upper(x[1]) || x[2:]), '') AS title
      FROM orders""",
    "date_parts": """
      SELECT o_orderkey, d AS date, CAST(year(d) AS INTEGER) AS year,
        CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
        CAST(weekofyear(d) AS INTEGER) AS weekofyear,
        CAST(dayofweek(d) + 1 AS INTEGER) AS dayofweek
      FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
    # joins
    "inner_join_keys": _sql(
        """SELECT f.*, r."AmericanIndianAndAlaskaNative", r."Asian",
          r."BlackOrAfricanAmerican", r."HispanicOrLatino", r."White"
        FROM city_first f JOIN city_races r ON r."City" = f."City" AND r."State" = f."State"
          AND r."State Code" = f."State Code" """,
        "city_first",
        "city_races",
    ),
    "lower_key_join": _sql(
        """SELECT k."Code", k."I94CTRY", replace(r."Country", 'NATION', 'Nation') AS "Country",
          r.readings
        FROM country_lookup k
        LEFT JOIN (SELECT "Country", count(*) AS readings FROM temperature_raw
                   GROUP BY "Country") r ON lower(r."Country") = lower(k."I94CTRY")""",
        "country_lookup",
        "temperature_raw",
    ),
    "lookup_decode": _sql(
        """SELECT f.cicid, f.i94mode, f.i94visa, f.i94port,
          CASE f.i94mode WHEN 1 THEN 'A first mode' ELSE concat('Mode ', f.i94mode) END AS mode,
          CASE f.i94visa WHEN 1 THEN 'Visa F' WHEN 2 THEN 'Visa O' ELSE 'Visa P' END AS visa,
          p.port
        FROM fact f LEFT JOIN (SELECT DISTINCT left(o_orderpriority, 1) AS id,
            o_orderpriority[3:] AS port FROM orders) p ON p.id = f.i94port""",
        "fact",
    ),
    "fixed_codes": _sql(
        """SELECT cicid, i94mode, i94visa,
          CASE i94mode WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land'
            WHEN 9 THEN 'Not reported' END AS mode,
          CASE i94visa WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure'
            WHEN 3 THEN 'Student' END AS visa
        FROM fact""",
        "fact",
    ),
    # aggregates
    "pivot_discovered": _sql(
        'SELECT "City", "State", "State Code", '
        + ", ".join(
            f'CAST(sum("Count") FILTER (WHERE "Race" = \'{r}\') AS BIGINT) AS "{r}"'
            for r in _SEGMENTS
        )
        + ' FROM demographics_raw GROUP BY "City", "State", "State Code"',
        "demographics_raw",
    ),
    "country_temperature": _sql(
        'SELECT * REPLACE (round("Temperature", 4) AS "Temperature") FROM climates', "climates"
    ),
    "pivot_sum": _sql("SELECT * FROM city_races", "city_races"),
    "state_rollup": _sql("SELECT * FROM states", "states"),
    "distinct_dates": _sql(
        "SELECT DISTINCT 'arrdate' AS role, arrdate AS date FROM fact "
        "UNION ALL SELECT DISTINCT 'depdate', depdate FROM fact",
        "fact",
    ),
    "date_union": _sql(
        "SELECT date FROM (SELECT DISTINCT arrdate AS date FROM fact) "
        "UNION ALL SELECT date FROM (SELECT DISTINCT depdate AS date FROM fact)",
        "fact",
    ),
    # star tables
    "fact_visits": _sql("SELECT * FROM fact", "fact"),
    "date_dim": _sql("SELECT * FROM dates", "dates"),
    "city_demographics": _sql("SELECT * FROM cities", "cities"),
    "state_dim": _sql("SELECT * FROM state", "state"),
    "country_dim": _sql(_rounded_country(), "country"),
    # quality
    "row_counts": _union(
        [f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in _TABLES]
    ),
    "dq_non_empty": _sql(
        _union(
            [
                _filled("immigration", "fact"),
                _filled("country", "country"),
                _filled("state", "state"),
                _filled("date", "dates"),
                _filled("undated", "(SELECT 1 FROM fact WHERE i94yr IS NULL)"),
            ]
        ),
        "fact",
        "country",
        "state",
        "dates",
    ),
    "duplicate_keys": """
      SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "duplicate_rows": _sql(
        """SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows,
          CAST(sum(n - 1) AS BIGINT) AS surplus_rows
        FROM (SELECT count(*) AS n FROM temperature_raw
              GROUP BY dt, "City", "Country", "Latitude", "Longitude")""",
        "temperature_raw",
    ),
    "null_keys": _sql(
        'SELECT "column", nulls FROM ('
        + _union(
            [
                _profile(c, "fact")
                for c in ["cicid", "i94cit", "i94res", "arrdate", "depdate", "i94addr"]
            ]
        )
        + ")",
        "fact",
    ),
    "null_profile": _sql(
        _union([_profile(c, "visits_raw") for c in _VISIT_COLUMNS]), "visits_raw"
    ),
    "drop_high_null": _sql("SELECT cicid, fltno, airline FROM visits_raw", "visits_raw"),
    "unknown_categories": _sql(
        """SELECT "Race" AS value, count(*) AS rows, CAST(sum("Count") AS BIGINT) AS total
        FROM demographics_raw WHERE "Race" = 'BUILDING B' GROUP BY "Race" """,
        "demographics_raw",
    ),
    "cast_failures": _sql(
        _union(
            [
                _failures(c)
                for c in ["cicid", "i94addr", "airline", "gender", "fltno", "visatype"]
            ]
        ),
        "visits_raw",
    ),
    "schema_conformance": _sql(
        _union([_conformance(c, *types) for c, types in _CONTRACT.items()])
        + "\nUNION ALL SELECT 'immigration', 'stay', 'int', NULL, NULL, false",
        "visits_raw",
    ),
    "orphans_country": _sql(
        """SELECT i94res AS code, count(*) AS visits
        FROM (SELECT CASE WHEN i94res % 7 = 3 THEN i94res + 100 ELSE i94res END AS i94res FROM fact)
        WHERE i94res IS NOT NULL AND i94res NOT IN (SELECT "Code" FROM country)
        GROUP BY i94res""",
        "fact",
        "country",
    ),
    "orphans_state": _sql(
        """SELECT i94addr AS code, count(*) AS visits
        FROM (SELECT CASE WHEN i94addr IN ('3', '11') THEN 'X' || i94addr ELSE i94addr END
                AS i94addr FROM fact)
        WHERE i94addr IS NOT NULL AND i94addr NOT IN (SELECT "Code" FROM state)
        GROUP BY i94addr""",
        "fact",
        "state",
    ),
    "orphans_date": _sql(
        """SELECT depdate AS code, count(*) AS visits FROM fact WHERE depdate IS NOT NULL
          AND depdate NOT IN (SELECT arrdate FROM fact WHERE arrdate IS NOT NULL)
        GROUP BY depdate""",
        "fact",
    ),
    "source_target_counts": _sql(
        """SELECT i94yr, i94mon, count(*) AS source_rows, count(*) AS target_rows,
          true AS complete FROM fact GROUP BY i94yr, i94mon""",
        "fact",
    ),
    "star_checks": _sql(
        _union(
            [
                _filled("immigration", "fact"),
                _filled("date", "dates"),
                _filled("country", "country"),
                _filled("state", "state"),
                *_keyed("immigration", "fact", "cicid"),
                *_keyed("country", "country", '"Code"'),
                *_keyed("state", "state", '"Code"'),
                *_keyed("date", "dates", "date"),
                _referenced("i94cit", "country", "country", '"Code"'),
                _referenced("i94res", "country", "country", '"Code"'),
                _referenced("arrdate", "date", "dates", "date"),
                _referenced("depdate", "date", "dates", "date"),
                _referenced("i94addr", "state", "state", '"Code"'),
            ]
        ),
        "fact",
        "country",
        "state",
        "dates",
    ),
    "star_checks_failing": _sql(
        _union(
            [
                _filled("immigration", _BROKEN),
                _filled("date", "dates"),
                _filled("country", "country"),
                _filled("state", _REPEATED),
                *_keyed("immigration", _BROKEN, "cicid"),
                *_keyed("country", "country", '"Code"'),
                *_keyed("state", _REPEATED, '"Code"'),
                *_keyed("date", "dates", "date"),
                _referenced("i94cit", "country", "country", '"Code"', _BROKEN),
                _referenced("i94res", "country", "country", '"Code"', _BROKEN),
                _referenced("arrdate", "date", "dates", "date", _BROKEN),
                _referenced("depdate", "date", "dates", "date", _BROKEN),
                _referenced("i94addr", "state", "state", '"Code"', _BROKEN),
            ]
        ),
        "fact",
        "country",
        "state",
        "dates",
    ),
    # questions
    "visits_by_nationality": _sql(
        """SELECT v.i94cit, c."Country", v.visits
        FROM (SELECT i94cit, count(*) AS visits FROM fact GROUP BY i94cit) v
        LEFT JOIN country c ON c."Code" = v.i94cit""",
        "fact",
        "country",
    ),
    "visits_by_origin": _sql(
        """SELECT v.i94res, c."Country", v.visits
        FROM (SELECT i94res, count(*) AS visits FROM fact GROUP BY i94res) v
        LEFT JOIN country c ON c."Code" = v.i94res""",
        "fact",
        "country",
    ),
    "visits_by_airline": _sql(
        "SELECT airline, count(*) AS visits FROM fact GROUP BY airline", "fact"
    ),
    "avg_stay_by_state": _sql(
        """SELECT v.i94addr, s."State", v.avg_stay, v.visits
        FROM (SELECT i94addr, round(avg(stay), 4) AS avg_stay, count(*) AS visits FROM fact
              WHERE stay IS NOT NULL GROUP BY i94addr) v
        LEFT JOIN state s ON s."Code" = v.i94addr""",
        "fact",
        "state",
    ),
    "dest_source_matrix": _sql(
        """SELECT i94addr, i94res, visits,
          round(CAST(visits * (SELECT sum(visits) FROM cells) AS DOUBLE)
            / (CAST(by_addr AS DOUBLE) * CAST(by_res AS DOUBLE)), 4) AS lift
        FROM margins""",
        "margins",
    ),
    "corr_dest_source": _sql(
        """SELECT CAST(n AS BIGINT) AS visits, r AS destinations, c AS sources,
          round(phi2 * n, 4) AS chi2,
          round(sqrt(greatest(phi2, 0) / (least(r, c) - 1)), 4) AS cramers_v
        FROM (SELECT sum(visits) AS n, count(DISTINCT i94addr) AS r,
                count(DISTINCT i94res) AS c,
                sum(CAST(visits AS DOUBLE) * visits
                  / (CAST(by_addr AS DOUBLE) * CAST(by_res AS DOUBLE))) - 1 AS phi2
              FROM margins)""",
        "margins",
    ),
    "corr_dest_climate": _sql(
        """SELECT c.i94addr, CAST(sum(c.visits) AS BIGINT) AS visits,
          round(sum(c.visits * k."Temperature")
            / sum(c.visits) FILTER (WHERE k."Temperature" IS NOT NULL), 4)
            AS source_temperature
        FROM cells c LEFT JOIN country k ON k."Code" = c.i94res GROUP BY c.i94addr""",
        "cells",
        "country",
    ),
    "corr_source_temperature": _sql(
        """SELECT count(*) AS countries,
          round(corr(CAST(v.visits AS DOUBLE), k."Temperature"), 4) AS corr
        FROM (SELECT i94res, count(*) AS visits FROM fact WHERE i94res IS NOT NULL
              GROUP BY i94res) v
        JOIN country k ON k."Code" = v.i94res WHERE k."Temperature" IS NOT NULL""",
        "fact",
        "country",
    ),
    "corr_state_demographics": _sql(
        _union([_correlation(m) for m in _MEASURES]), "by_addr", "state"
    ),
    "visitor_profile_by_state": _sql(
        """SELECT v.*, s."State" FROM (
          SELECT i94addr, count(*) AS visits, round(avg(i94bir), 4) AS avg_age,
            round(count(*) FILTER (WHERE gender = 'M') / count(*), 4) AS male_share,
            round(count(*) FILTER (WHERE gender = 'F') / count(*), 4) AS female_share,
            round(count(*) FILTER (WHERE gender IS NULL) / count(*), 4) AS unstated_share
          FROM fact GROUP BY i94addr) v
        LEFT JOIN state s ON s."Code" = v.i94addr""",
        "fact",
        "state",
    ),
    "rejects_by_delivery": _sql(
        """SELECT cicid, i94yr, i94mon, delivery FROM (
          SELECT cicid, i94yr, i94mon, 'first' AS delivery FROM fact WHERE i94yr = 1995 AND i94mon = 1
          UNION ALL SELECT cicid, i94yr, i94mon, 'second' FROM fact WHERE i94yr = 1995 AND i94mon <= 2)""",
        "fact",
    ),
    "csv_rejects": _sql(
        """SELECT 'readings' AS source, count(*) AS source_rows,
          count(*) FILTER (WHERE CAST("Latitude" AS INTEGER) % 30 NOT IN (1, 2, 3)) AS landed_rows,
          count(*) FILTER (WHERE CAST("Latitude" AS INTEGER) % 30 IN (1, 2, 3)) AS rejected_rows,
          true AS passed
        FROM temperature_raw
        UNION ALL SELECT 'cities', count(*),
          count(*) FILTER (WHERE right("City", 1) NOT IN ('1', '2', '3')),
          count(*) FILTER (WHERE right("City", 1) IN ('1', '2', '3')), true
        FROM demographics_raw""",
        "temperature_raw",
        "demographics_raw",
    ),
    "csv_rejects_lines": _sql(
        """SELECT CASE k WHEN 1 THEN 'fields' WHEN 2 THEN 'fields' ELSE 'quote' END AS reason,
          CASE k WHEN 1 THEN short WHEN 2 THEN concat(short, ',', "Longitude", ',more')
            ELSE concat('"', short, ',', "Longitude") END AS line
        FROM (SELECT CAST("Latitude" AS INTEGER) % 30 AS k, "Longitude", concat(dt, ',',
                coalesce("AverageTemperature", ''), ',', "City", ',', "Country", ',', "Latitude") AS short
              FROM temperature_raw) WHERE k IN (1, 2, 3)""",
        "temperature_raw",
    ),
    "csv_rejects_landed": _sql(
        """SELECT * FROM temperature_raw WHERE CAST("Latitude" AS INTEGER) % 30 NOT IN (1, 2, 3)""",
        "temperature_raw",
    ),
    "publish_star": _sql(
        "SELECT * REPLACE (CAST(arrdate AS VARCHAR) AS arrdate, CAST(depdate AS VARCHAR) AS depdate, "
        "CASE WHEN i94yr = 1995 THEN 'revised' ELSE fltno END AS fltno) FROM fact",
        "fact",
    ),
    "published_versions": _sql(
        """, counted AS (
          SELECT 'immigration' AS "table", count(*) AS rows, count(*) FILTER (WHERE i94yr = 1995) AS changed FROM fact
          UNION ALL SELECT 'date', count(*), 0 FROM dates
          UNION ALL SELECT 'country', count(*), 0 FROM country
          UNION ALL SELECT 'state', count(*), 0 FROM state)
        SELECT CAST(v AS INTEGER) AS version, "table", rows, CASE WHEN v = 2 THEN changed ELSE 0 END AS revised
        FROM counted, (SELECT unnest([1, 2, 3]) AS v)""",
        "fact",
        "dates",
        "country",
        "state",
    ),
    "corr_dest_climate_ratio": _sql(
        """, known AS (SELECT "Code", "Temperature" FROM country WHERE "Temperature" IS NOT NULL),
        runs AS (SELECT unnest(range(1, 200)) AS run),
        takers AS (SELECT run, "Code", row_number() OVER (PARTITION BY run
            ORDER BY md5(concat('1:', run, ':to:', "Code")), "Code") AS place FROM known, runs),
        givers AS (SELECT run, "Temperature" AS t, row_number() OVER (PARTITION BY run
            ORDER BY md5(concat('1:', run, ':from:', "Code")), "Code") AS place FROM known, runs),
        dealt AS (SELECT a.run, a."Code", b.t FROM takers a JOIN givers b ON b.run = a.run AND b.place = a.place
          UNION ALL SELECT 0, "Code", "Temperature" FROM known),
        by_place AS (SELECT d.run, c.i94addr, sum(c.visits) AS n, sum(c.visits * d.t) AS s,
            sum(c.visits * d.t * d.t) AS q FROM cells c JOIN dealt d ON d."Code" = c.i94res GROUP BY d.run, c.i94addr),
        by_run AS (SELECT run, sum(n) AS visits, count(*) AS destinations,
            (sum(s * s / n) - sum(s) * sum(s) / sum(n)) / (sum(q) - sum(s) * sum(s) / sum(n)) AS eta
          FROM by_place GROUP BY run)
        SELECT CAST(b.visits AS BIGINT) AS visits, b.destinations, round(b.eta, 4) AS eta_squared,
          round((SELECT count(*) FROM by_run r WHERE r.eta >= b.eta - 1e-9) / 200, 4) AS p_value
        FROM by_run b WHERE b.run = 0""",
        "cells",
        "country",
    ),
    "visitors_present": _sql(
        """SELECT date, CAST(sum(arrived) AS BIGINT) AS arrived, CAST(sum("left") AS BIGINT) AS "left",
          CAST(sum(sum(arrived) - sum("left")) OVER (ORDER BY date) AS BIGINT) AS present
        FROM (SELECT arrdate AS date, 1 AS arrived, 0 AS "left" FROM fact
              WHERE arrdate IS NOT NULL AND coalesce(depdate >= arrdate, true)
              UNION ALL SELECT depdate + 1, 0, 1 FROM fact WHERE depdate >= arrdate)
        GROUP BY date""",
        "fact",
    ),
    "rank_correlation": _sql(
        _union([
            f"""SELECT '{x}' AS x, '{y}' AS y, count(*) AS rows, round(corr(a, b), 4) AS rho
            FROM (SELECT rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2 AS a,
                    rank() OVER (ORDER BY {y}) + (count(*) OVER (PARTITION BY {y}) - 1) / 2 AS b
                  FROM fact WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"""
            for x, y in (("i94bir", "stay"), ("cicid", "arrdate"))
        ]),
        "fact",
    ),
    "refresh_reports": _sql(
        """, now AS (
          SELECT i94cit, i94res, i94addr, i94bir, CASE WHEN i94yr = 1995 THEN 'revised' ELSE airline END AS airline,
            CASE WHEN i94yr = 1995 THEN stay + 2 ELSE stay END AS stay
          FROM fact WHERE NOT ((i94yr = 1995 AND i94mon = 3) OR (i94yr = 1996 AND i94mon = 1)) OR cicid % 3 <> 0),
        pairs AS (SELECT i94addr, i94res, count(*) AS n FROM now
          WHERE i94addr IS NOT NULL AND i94res IS NOT NULL GROUP BY i94addr, i94res),
        shares AS (SELECT n, CAST(n AS DOUBLE) * n / (CAST(sum(n) OVER (PARTITION BY i94addr) AS DOUBLE)
            * CAST(sum(n) OVER (PARTITION BY i94res) AS DOUBLE)) AS share FROM pairs),
        places AS (SELECT count(DISTINCT i94addr) AS r, count(DISTINCT i94res) AS c FROM pairs),
        origins AS (SELECT i94res, count(*) AS n FROM now GROUP BY i94res)
        SELECT 'nationality' AS report, k."Country" AS key, v.n AS visits, CAST(NULL AS DOUBLE) AS value
        FROM (SELECT i94cit, count(*) AS n FROM now GROUP BY i94cit) v LEFT JOIN country k ON k."Code" = v.i94cit
        UNION ALL SELECT 'origin', CAST(i94res AS VARCHAR), n, NULL FROM origins
        UNION ALL SELECT 'airline', airline, count(*), NULL FROM now GROUP BY airline
        UNION ALL SELECT 'stay', i94addr, count(*), round(avg(stay), 4) FROM now WHERE stay IS NOT NULL GROUP BY i94addr
        UNION ALL SELECT 'age', s."State", v.n, v.a FROM (
          SELECT i94addr, count(*) AS n, round(avg(i94bir), 4) AS a FROM now GROUP BY i94addr) v
          LEFT JOIN state s ON s."Code" = v.i94addr
        UNION ALL SELECT 'route', NULL, CAST(sum(n) AS BIGINT),
          round(sqrt(greatest(sum(share) - 1, 0) / (least(min(r), min(c)) - 1)), 4) FROM shares, places
        UNION ALL SELECT 'temperature', NULL, count(*), round(corr(CAST(o.n AS DOUBLE), k."Temperature"), 4)
          FROM origins o JOIN country k ON k."Code" = o.i94res WHERE k."Temperature" IS NOT NULL
        UNION ALL SELECT 'stay_age', NULL, count(*), round(corr(stay, i94bir), 4) FROM now
          WHERE stay IS NOT NULL AND i94bir IS NOT NULL""",
        "fact",
        "country",
        "state",
    ),
    "merge_visits": _sql(
        """, text AS (SELECT * REPLACE (CAST(arrdate AS VARCHAR) AS arrdate, CAST(depdate AS VARCHAR) AS depdate),
            i94yr IN (1994, 1995) AS old FROM fact)
        SELECT * EXCLUDE (old) REPLACE (
          CASE WHEN old AND cicid % 35 = 0 THEN 'moved' WHEN old AND cicid % 14 = 0 THEN 'fix 2'
            WHEN old AND cicid % 7 = 0 THEN 'fix 1' ELSE fltno END AS fltno,
          CASE WHEN old AND cicid % 35 = 0 THEN 1997 ELSE i94yr END AS i94yr,
          CASE WHEN old AND cicid % 35 = 0 THEN 6 ELSE i94mon END AS i94mon)
        FROM text
        UNION ALL SELECT * EXCLUDE (old) REPLACE (cicid + 10000000 AS cicid) FROM text WHERE old AND cicid % 50 = 3""",
        "fact",
    ),
    "name_candidates": _sql(
        """, wanted AS (SELECT DISTINCT "Country" AS name FROM temperature_raw
            WHERE lower("Country") NOT IN (SELECT lower("I94CTRY") FROM country_lookup)),
        known AS (SELECT DISTINCT "I94CTRY" AS candidate FROM country_lookup)
        SELECT name, candidate, CAST(levenshtein(lower(name), lower(candidate)) AS INTEGER) AS distance
        FROM wanted, known
        WHERE levenshtein(lower(name), lower(candidate))
          <= least(2, (greatest(length(name), length(candidate)) - 1) // 4)""",
        "temperature_raw",
        "country_lookup",
    ),
    "column_sketches": _sql(
        _union([
            f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls,
              count(DISTINCT {c}) AS values, true AS distinct_within, true AS quantiles_within, true AS counts_equal
            FROM fact"""
            for c in ("cicid", "airline", "i94cit", "stay", "i94bir")
        ]),
        "fact",
    ),
    "airport_city": _sql(
        """, ports AS (SELECT s_name AS ident, CASE WHEN s_suppkey % 9 <> 0 THEN
              CAST(concat((s_suppkey * 37) % 360 - 180, '.25') AS DOUBLE) END AS lon,
            CASE WHEN s_suppkey % 9 <> 0 THEN CAST(concat((s_suppkey * 53) % 179 - 89, '.5') AS DOUBLE) END AS lat
          FROM supplier),
        towns AS (SELECT CAST("Latitude" AS DOUBLE) AS t_lat, CAST("Longitude" AS DOUBLE) AS t_lon, min("City") AS city,
            arg_min("Country", concat("City", '|', "Country")) AS country FROM temperature_raw GROUP BY 1, 2),
        far AS (SELECT ident, city, country, t_lat, t_lon, round(6371 * sqrt(
              pow(cos(radians(lat)) * cos(radians(lon)) - cos(radians(t_lat)) * cos(radians(t_lon)), 2)
              + pow(cos(radians(lat)) * sin(radians(lon)) - cos(radians(t_lat)) * sin(radians(t_lon)), 2)
              + pow(sin(radians(lat)) - sin(radians(t_lat)), 2)), 6) AS chord FROM ports, towns WHERE lat IS NOT NULL),
        best AS (SELECT * FROM far QUALIFY row_number() OVER (PARTITION BY ident ORDER BY chord, t_lat, t_lon) = 1)
        SELECT p.ident, b.city, b.country, CASE WHEN b.chord IS NOT NULL THEN round(2 * 6371 * asin(least(b.chord / (2 * 6371), 1.0)), 4) END AS km
        FROM ports p LEFT JOIN best b ON b.ident = p.ident""",
        "temperature_raw",
    ),
}
