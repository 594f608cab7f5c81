import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmart import functions as fn


def test_int_from_text(spark, rows):
    df = spark.createDataFrame(
        [(0, "4"), (1, "4.0"), (2, ""), (3, "x"), (4, None), (5, "1e20"), (6, "-7.9")],
        "id int, v string",
    )
    got = dict(rows(df.select("id", fn.int_from_text("v").alias("n"))))
    assert got == {0: 4, 1: 4, 2: None, 3: None, 4: None, 5: None, 6: -7}


def test_sas_date(spark):
    df = spark.createDataFrame([(20551.0,), (0.0,), (None,)], "v double")
    got = [r[0] for r in df.select(fn.sas_date("v")).collect()]
    assert got == [dt.date(2016, 4, 7), dt.date(1960, 1, 1), None]


def test_stay_is_null_if_either_date_is(spark):
    a, b = dt.date(2016, 4, 7), dt.date(2016, 4, 1)
    df = spark.createDataFrame([(b, a), (a, b), (None, a), (a, None)], "arr date, dep date")
    assert [r[0] for r in df.select(fn.stay_days("arr", "dep")).collect()] == [6, -6, None, None]


def test_date_parts_use_iso_weeks_and_start_on_sunday(spark):
    df = spark.createDataFrame([("2016-01-01",), ("2016-04-03",), ("04/03/2016",)], "v string")
    dated = df.select(fn.date_from_text("v").alias("d"))
    got = [tuple(r) for r in dated.select(*fn.date_parts("d").values()).collect()]
    assert got == [(2016, 1, 1, 53, 6), (2016, 4, 3, 13, 1), (None,) * 5]


def test_title_case_cases(spark):
    cases = {
        "BOSNIA-HERZEGOVINA": "Bosnia-Herzegovina",
        "COTE D'IVOIRE": "Cote D'Ivoire",
        "N.\u00a0CAROLINA": "N.\u00a0Carolina",
        "3RD x2y": "3Rd X2Y",
        "CÔTE D'IVOIRE": "Côte D'Ivoire",
        "": "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r[0]: r[1] for r in df.select("v", fn.title_case("v")).collect()}
    assert got == cases
    spaced = df.where(F.col("v").startswith("N.")).select(fn.title_case("v", True)).first()[0]
    assert spaced == "N. Carolina"


LETTERS = st.characters(min_codepoint=32, max_codepoint=0x17F)


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(LETTERS | st.sampled_from("中文 -'."), max_size=12), min_size=1))
def test_title_case_equals_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(fn.title_case("v")).collect()]
    assert got == [t.title() for t in texts]
