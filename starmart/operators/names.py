"""Names that are nearly those of a code table: proposals for overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST = 2  # letters changed, added or left out
LETTERS = 4  # of a name for each of them, beyond the first


def _allowed(longer: Column, most: int) -> Column:
    """The edits allowed where the longer name has so many letters: none up to 4, one up to 8."""
    return F.least(F.lit(most), F.floor((longer - 1) / LETTERS)).cast("int")


def _grams(names: DataFrame) -> DataFrame:
    """(key, n, gram, nth): a name's trigrams, its ends included, repeated ones numbered."""
    padded = F.concat(F.lit("\x01\x01"), F.col("key"), F.lit("\x01\x01"))
    each = names.withColumn("gram", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("n") + 2), lambda i: F.substring(padded, i, F.lit(3)))))
    same = Window.partitionBy("key", "gram").orderBy("n")
    return each.withColumn("nth", F.row_number().over(same))


def name_candidates(
    names: DataFrame, known: DataFrame, name: str, known_name: str, most: int = MOST
) -> DataFrame:
    """(name, candidate, distance): for names that the known ones lack, those a few edits away.

    Upper and lower case count as equal, and what is equal needs no proposal. Up to ``most``
    edits are allowed, one less for each four letters that the longer name has too few. An edit
    changes three trigrams at most, so two such names share one of their rarest trigrams: each name
    is looked up by 3 * most + 1 of them, in a join on trigrams, and what is met is measured.
    """
    def keyed(df: DataFrame, column: str) -> DataFrame:
        text = df.where(F.col(f"`{column}`").isNotNull()).select(F.col(f"`{column}`").alias("text")).distinct()
        key = F.lower("text")
        return text.select("text", key.alias("key"), F.length(key).alias("n"))

    left, right = keyed(names, name), keyed(known, known_name)
    left = left.join(right.select("key").distinct(), "key", "left_anti")
    one, other = left.select("key", "n").distinct(), right.select("key", "n").distinct()
    sides = [_grams(one).withColumn("side", F.lit(0)), _grams(other).withColumn("side", F.lit(1))]
    grams = sides[0].unionByName(sides[1])
    often = grams.groupBy("gram", "nth").agg(F.count(F.lit(1)).alias("often"))
    rarest = Window.partitionBy("side", "key").orderBy("often", "gram", "nth")
    placed = grams.join(often, ["gram", "nth"]).withColumn("place", F.row_number().over(rarest))
    picked = placed.where(F.col("place") <= 3 * _allowed(F.col("n") + most, most) + 1)
    met = (
        picked.where("side = 0").select("gram", "nth", F.col("key").alias("a"), F.col("n").alias("a_n"))
        .join(picked.where("side = 1").select("gram", "nth", F.col("key").alias("b"), F.col("n").alias("b_n")), ["gram", "nth"])
        .where(F.abs(F.col("a_n") - F.col("b_n")) <= most)
        .select("a", "b", _allowed(F.greatest("a_n", "b_n"), most).alias("allowed"))
        .distinct()
    )
    near = met.withColumn("distance", F.levenshtein("a", "b")).where(F.col("distance") <= F.col("allowed"))
    return (
        near.join(left.select(F.col("key").alias("a"), F.col("text").alias("name")), "a")
        .join(right.select(F.col("key").alias("b"), F.col("text").alias("candidate")), "b")
        .select("name", "candidate", "distance")
    )
