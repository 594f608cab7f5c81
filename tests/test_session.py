from starmart.operators import facts
from starmart.session import shuffle_partitions
from starmart.sources import save


def test_shuffles_grow_with_the_input():
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(1024**4) == 4096
    assert shuffle_partitions(100 * 1024**4) == 409_600
    assert shuffle_partitions(10 * 1024**5) == 10 * 1024 * 4096


def test_fact_is_one_generated_stage_without_a_shuffle(spark, plan, tmp_path):
    raw = spark.range(10).selectExpr(
        *[f"cast(id as double) as {c}" for c in facts.VISIT_COLUMNS if c != "airline"],
        "'AA' as airline",
        "'x' as occup",
    )
    save(raw, str(tmp_path / "raw"))
    text = plan(facts.visits(spark.read.parquet(str(tmp_path / "raw"))))
    assert "Exchange" not in text and "occup" not in text
    assert {line.split("(")[1].split(")")[0] for line in text.splitlines() if "*(" in line} == {"1"}
