"""The jobs: sources in, star tables out. A path of ``None`` skips that write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from starmart.contracts import STAR
from starmart.operators import dims, facts, quality
from starmart.sources import (
    Snapshots,
    land,
    load_table,
    path_exists,
    read_lookup,
    read_source,
    save,
    upsert_partitions,
)
from starmart.sources.tables import MONTH, in_partitions


def build_visits(
    spark: SparkSession,
    input_path: str,
    output_path: str | None = None,
    date_output_path: str | None = None,
    fmt: str = "csv",
    columns: Sequence[str] | None = facts.VISIT_COLUMNS,
    limit: int | None = None,
    partition_by: Sequence[str] | None = MONTH,
    columns_to_save: str | Sequence[str] = "*",
    refresh: Sequence[tuple[int, int]] | None = None,
    rebalance: bool = True,
    rejects: str | None = None,
    **options,
) -> DataFrame:
    """Conform arrival records into the fact, and the date dimension from it.

    ``refresh`` names the months, as (year, month), that this delivery is for: only those are
    replaced, and rows of other months or of none go to ``rejects`` or, without it, stop the
    job. ``rebalance=False`` writes without a shuffle, for input that comes in files of one
    month each. The dates come from the stored fact where there is one: two columns of Parquet
    instead of the raw source, and on a refresh of the named months alone.
    """
    picked = "*" if columns is None else columns
    raw = read_source(spark, input_path, fmt, picked, limit, **options)
    fact = facts.visits(raw, columns)
    if output_path is not None:
        if refresh is not None:
            upsert_partitions(
                fact.select(columns_to_save),
                output_path,
                refresh,
                partition_by or MONTH,
                rebalance,
                rejects,
            )
        else:
            save(
                fact,
                output_path,
                columns=columns_to_save,
                partition_by=partition_by,
                rebalance=rebalance,
            )
    if date_output_path is not None:
        stored = fact
        if output_path is not None:
            written = spark.read.parquet(output_path)
            if set(facts.DATE_COLUMNS) <= set(written.columns):
                stored = written
        if refresh is not None and path_exists(spark, date_output_path):
            by = partition_by or MONTH
            fresh = stored.where(in_partitions(refresh, by)) if stored is not fact else stored
            add_dates(fresh, date_output_path)
        else:
            save(dims.date_dim(stored), date_output_path)
    return fact


def add_dates(fact: DataFrame, path: str) -> None:
    """Adds the dates of some visits that the stored date dimension lacks.

    The stored files stay as they are, so the dimension never goes missing; a run that failed is
    run again. A date that a refreshed month no longer holds stays: the dimension lists the days,
    not their use.
    """
    stored = fact.sparkSession.read.parquet(path).select("date")
    fresh = dims.date_dim(fact).join(stored, "date", "left_anti")
    save(fresh.coalesce(1), path, mode="append")


def land_temperature(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    partition_by: Sequence[str] | None = ("Country", "City"),
    **options,
) -> DataFrame:
    return land(spark, input_path, output_path, partition_by, **options)


def land_airports(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    partition_by: Sequence[str] | None = ("iso_country",),
    **options,
) -> DataFrame:
    return land(spark, input_path, output_path, partition_by, **options)


def build_city_demographics(
    spark: SparkSession,
    input_path: str,
    output_path: str | None = None,
    partition_by: Sequence[str] | None = ("State Code",),
    limit: int | None = None,
    sep: str = ";",
    races: Mapping[str, str] | None = dims.RACES,
    **options,
) -> DataFrame:
    """``races`` as in ``dims.city_demographics``: None makes a column of every value."""
    raw = read_source(spark, input_path, limit=limit, sep=sep, **options)
    cities = dims.city_demographics(raw, races=races)
    if output_path is not None:
        save(cities, output_path, partition_by=partition_by)
    return cities


def build_states(
    spark: SparkSession,
    demographics_path: str,
    lookup_path: str,
    output_path: str | None = None,
    normalize_space: bool = False,
    **options,
) -> DataFrame:
    cities = build_city_demographics(spark, demographics_path, None, **options)
    states = dims.state_dim(
        cities, read_lookup(spark, lookup_path), normalize_space=normalize_space
    )
    if output_path is not None:
        save(states, output_path)
    return states


def build_countries(
    spark: SparkSession,
    temperature_path: str,
    lookup_path: str,
    output_path: str | None = None,
    fmt: str = "csv",
    limit: int | None = None,
    normalize_space: bool = False,
    country_overrides: Sequence[tuple[str, str, str]] = dims.COUNTRY_OVERRIDES,
    lookup_overrides: Sequence[tuple[str, str, str]] = dims.LOOKUP_OVERRIDES,
    **options,
) -> DataFrame:
    """``limit`` shortens the readings only; the code table is always read whole."""
    readings = read_source(spark, temperature_path, fmt, limit=limit, **options)
    countries = dims.country_dim(
        readings,
        read_lookup(spark, lookup_path),
        country_overrides,
        lookup_overrides,
        normalize_space,
    )
    if output_path is not None:
        save(countries, output_path)
    return countries


@dataclass(frozen=True)
class Sources:
    """Where the inputs of a full refresh lie."""

    immigration: str
    temperature: str
    demographics: str
    country_lookup: str
    state_lookup: str
    immigration_format: str = "csv"
    immigration_options: Mapping[str, str] = field(default_factory=dict)


def build_star(
    spark: SparkSession,
    sources: Sources,
    out: str,
    refresh: Sequence[tuple[int, int]] | None = None,
    rejects: str | None = None,
) -> dict[str, DataFrame]:
    """All four tables, staged under ``out``; each is returned as read back from there.

    ``refresh`` names the delivered months, as (year, month); see ``build_visits``.
    """
    paths = {name: f"{out.rstrip('/')}/{name}.parquet" for name in STAR}
    build_visits(
        spark,
        sources.immigration,
        paths["immigration"],
        paths["date"],
        sources.immigration_format,
        refresh=refresh,
        rejects=rejects,
        **sources.immigration_options,
    )
    build_countries(spark, sources.temperature, sources.country_lookup, paths["country"])
    build_states(spark, sources.demographics, sources.state_lookup, paths["state"])
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def in_months(months: Sequence[tuple[int, int]]) -> Column:
    """Whether a visit lies in one of the months, on partition columns alone."""
    return in_partitions(months, MONTH)


def stored_months(fact: DataFrame) -> list[tuple[int, int]]:
    """The months of a stored fact, read from its partitions: one row per month."""
    return [tuple(r) for r in fact.select(*MONTH).distinct().collect()]


def load_star(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    prefix: str = "",
    mode: str = "refresh",
    partition_by: Sequence[str] = MONTH,
    months: Sequence[tuple[int, int]] | None = None,
    full_checks: bool = False,
) -> dict[str, str]:
    """Check the staged tables, then load each into its contract table.

    That all are filled is always checked; ``full_checks`` holds them against keys and
    references too. Nothing is published unless the checks pass.

    The fact is partitioned by month, and staged that way, so it is loaded without another
    shuffle. With ``refresh`` its ``months``, as (year, month), replace those loaded before, and
    the dimensions, which are small, are overwritten in place; a repeated load changes nothing.
    Without ``months`` those of the staged fact count. Staged partitions of other months are
    not read. ``append`` adds every row to what is there.
    """
    staged = dict(tables)
    fact = next(name for name, contract in STAR.items() if contract.foreign_keys)
    if months is not None:
        staged[fact] = staged[fact].where(in_months(months))
    elif mode == "refresh":
        months = stored_months(staged[fact])
    check = quality.check_star(staged, STAR) if full_checks else quality.non_empty(staged)
    quality.assert_passed(check)
    names = {}
    for name, contract in STAR.items():
        is_fact = name == fact
        names[name] = load_table(
            staged[name],
            contract,
            f"{prefix}{name}",
            mode="overwrite" if mode == "refresh" and not is_fact else mode,
            partition_by=partition_by if is_fact else None,
            partitions=months if is_fact and mode == "refresh" else None,
            rebalance=False,
        )
    return names


def star_snapshots(spark: SparkSession, root: str) -> Snapshots:
    """The published versions of the four tables under ``root``."""
    fact = next(name for name, contract in STAR.items() if contract.foreign_keys)
    return Snapshots(spark, root, STAR, {fact: MONTH})


def publish_star(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    months: Sequence[tuple[int, int]] | None = None,
    full_checks: bool = False,
    rebalance: bool = False,
) -> int:
    """Publish the four tables as one version, which readers see all at once or not at all.

    The checks run on what was written, before the switch. With ``months`` only those of the fact
    are written, and the others are those of the version before. ``rebalance`` is for a fact that
    is not staged by month. Returns the version; ``star_snapshots`` reads, rolls back, cleans up.
    """
    snapshots = star_snapshots(spark, root)
    fact = next(iter(snapshots.partition_by))

    def check(seen: Mapping[str, DataFrame]) -> None:
        report = quality.check_star(seen, STAR) if full_checks else quality.non_empty(seen)
        quality.assert_passed(report)

    partitions = None if months is None else {fact: months}
    return snapshots.publish(tables, partitions, check, rebalance)
