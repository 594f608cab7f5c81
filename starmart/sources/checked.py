"""Headed CSV with every line accounted for: rows that do not parse are put aside, not bent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starmart.sources.files import Tally, read_source, save

LINE, REASON = "__line", "__reason"
_ROW, _CORRUPT = "__row", "__corrupt"


def read_checked(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    quote: str = '"',
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The columns of a headed CSV as text, with each row's line and, if it is bad, why.

    ``columns`` names what the files hold, else the header of one of them does.
    ``__reason`` is ``quote`` for a line with an odd number of quotes, else ``fields`` for one with
    more or fewer fields than the header, else NULL. Header lines, in every file, and blank lines
    are no rows. A quoted field ends on its line.
    """
    names = list(columns) if columns else read_source(spark, path, sep=sep, quote=quote).columns
    schema = StructType([*[StructField(n, StringType()) for n in names], StructField(_CORRUPT, StringType())])
    options = {"sep": sep, "quote": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in schema)
    lines = spark.read.text(path).withColumnRenamed("value", LINE).where(F.trim(LINE) != "")
    rows = lines.withColumn(_ROW, F.from_csv(LINE, ddl, options))

    def field(name: str) -> Column:
        return F.col(_ROW).getField(name)

    quotes = F.length(LINE) - F.length(F.replace(F.col(LINE), F.lit(quote), F.lit("")))
    reason = F.when(quotes % 2 == 1, "quote").when(field(_CORRUPT).isNotNull(), "fields")
    header = F.lit(True)
    for n in names:
        header = header & field(n).eqNullSafe(F.lit(n))
    checked = rows.select(*[field(n).alias(n) for n in names], LINE, reason.alias(REASON), header.alias("__header"))
    return checked.where(~F.col("__header")).drop("__header")


def land_checked(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    rejects_path: str,
    partition_by: Sequence[str] | None = None,
    sep: str = ",",
    quote: str = '"',
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Bring a headed CSV into Parquet, its bad lines to a place of their own, and account for it.

    Returns one row: the source's lines that are rows, those landed and those rejected, both
    counted where they were stored, and whether they add up. Rejects keep their whole line and the
    reason. The source is read once, and again for bad lines only if it has any.
    """
    checked = read_checked(spark, input_path, sep, quote, columns)
    bad = F.col(REASON).isNotNull()
    tally = Tally(checked, {"rows": F.count(F.lit(1)), "bad": F.count_if(bad)})
    save(tally.rows.where(~bad).drop(LINE, REASON), output_path, partition_by=partition_by)
    found = tally.result
    rejected = checked.where(bad) if found["bad"] else checked.limit(0)
    save(rejected.select(F.col(LINE).alias("line"), F.col(REASON).alias("reason")), rejects_path)
    landed = spark.read.parquet(output_path).agg(F.count(F.lit(1)).alias("landed_rows"))
    aside = spark.read.parquet(rejects_path).agg(F.count(F.lit(1)).alias("rejected_rows"))
    counts = {**landed.first().asDict(), **aside.first().asDict()}
    total = F.lit(found["rows"]).cast("long")
    return spark.range(1).select(
        total.alias("source_rows"),
        *[F.lit(n).cast("long").alias(name) for name, n in counts.items()],
        (total == sum(counts.values())).alias("passed"),
    )
