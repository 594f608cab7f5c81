"""The questions against brute force, with one destination holding a third of all visits."""

import numpy as np
import pandas as pd
import pytest

from starmart.plans import analytics


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    n = 3000
    addr = np.where(rng.random(n) < 1 / 3, "CA", rng.choice(["NY", "TX", "OR", "ZZ"], n))
    fact = pd.DataFrame(
        {
            "i94addr": addr,
            "i94res": rng.integers(1, 6, n),
            "i94cit": rng.integers(1, 6, n),
            "airline": rng.choice(["A", "B"], n),
            "gender": rng.choice(["M", "F"], n),
            "i94bir": rng.integers(0, 90, n),
            "stay": rng.integers(-3, 30, n).astype("float"),
        }
    )
    fact.loc[::10, "i94addr"] = None
    fact.loc[::11, "gender"] = None
    fact.loc[::12, "airline"] = None
    fact.loc[::13, "stay"] = None
    country = pd.DataFrame(
        {
            "Code": [1, 2, 3, 4, 9],
            "Country": ["a", "b", "c", "d", "z"],
            "Temperature": [10.0, 20.0, None, 5.5, 1.0],
        }
    )
    state = pd.DataFrame(
        {"Code": ["CA", "NY", "TX", "OR"], "State": ["C", "N", "T", "O"], "White": [9, 4, 6, 2]}
    )
    return fact, country, state


@pytest.fixture(scope="module")
def frames(spark, data):
    fact, country, state = data
    ints = {"i94res", "i94cit", "i94bir", "stay", "Code", "White"}

    def frame(df, schema):
        def value(name, v):
            if pd.isna(v):
                return None
            return int(v) if name in ints and not isinstance(v, str) else v

        tuples = [tuple(map(value, df.columns, r)) for r in df.itertuples(index=False)]
        return spark.createDataFrame(tuples, schema)

    return (
        frame(
            fact,
            "i94addr string, i94res int, i94cit int, airline string, gender string, "
            "i94bir int, stay int",
        ).repartition(4),
        frame(country, "Code int, Country string, Temperature double"),
        frame(state, "Code string, State string, White long"),
    )


def test_counts(frames, data, rows):
    fact, country, _ = data
    names = dict(zip(country.Code, country.Country))
    want = fact.i94cit.value_counts()
    got = {r.i94cit: r for r in analytics.visits_by_nationality(frames[0], frames[1]).collect()}
    assert {k: r.visits for k, r in got.items()} == want.to_dict()
    assert all(r.Country == names.get(k) for k, r in got.items())
    origin = analytics.visits_by_origin(frames[0], frames[1]).collect()
    assert {r.i94res: r.visits for r in origin} == fact.i94res.value_counts().to_dict()
    airline = {r.airline: r.visits for r in analytics.visits_by_airline(frames[0]).collect()}
    assert airline[None] == fact.airline.isna().sum() and sum(airline.values()) == len(fact)


def test_stay(frames, data):
    fact = data[0]
    got = {r.i94addr: r for r in analytics.avg_stay_by_state(frames[0], frames[2]).collect()}
    known = fact[fact.stay.notna()]
    assert got["CA"].avg_stay == pytest.approx(known[known.i94addr == "CA"].stay.mean())
    assert got[None].visits == known.i94addr.isna().sum()
    assert got["ZZ"].State is None and got["CA"].State == "C"


def test_matrix_and_cramers_v(frames, data):
    fact = data[0].dropna(subset=["i94addr"])
    table = pd.crosstab(fact.i94addr, fact.i94res)
    n = table.values.sum()
    expected = np.outer(table.sum(axis=1), table.sum(axis=0)) / n
    got = {(r.i94addr, r.i94res): r for r in analytics.dest_source_matrix(frames[0]).collect()}
    assert len(got) == (table.values > 0).sum()
    for (addr, res), r in got.items():
        i, j = table.index.get_loc(addr), table.columns.get_loc(res)
        assert r.visits == table.iloc[i, j]
        assert r.lift == pytest.approx(table.iloc[i, j] / expected[i, j])
    chi2 = ((table.values - expected) ** 2 / expected).sum()
    row = analytics.corr_dest_source(frames[0]).first()
    assert (row.visits, row.destinations, row.sources) == (n, *table.shape)
    assert row.chi2 == pytest.approx(chi2)
    assert row.cramers_v == pytest.approx(np.sqrt(chi2 / n / (min(table.shape) - 1)))


def test_climate(frames, data):
    fact, country, _ = data
    known = fact.dropna(subset=["i94addr"])
    joined = known.merge(country, left_on="i94res", right_on="Code", how="left")
    got = {r.i94addr: r for r in analytics.corr_dest_climate(frames[0], frames[1]).collect()}
    for addr, group in joined.groupby("i94addr"):
        assert got[addr].visits == len(group)
        assert got[addr].source_temperature == pytest.approx(group.Temperature.mean())
    counts = fact.i94res.value_counts().rename("n")
    both = country.dropna().set_index("Code").join(counts, how="inner")
    row = analytics.corr_source_temperature(frames[0], frames[1]).first()
    assert row.countries == len(both)
    assert row["corr"] == pytest.approx(both.n.corr(both.Temperature))


def test_state_measures_and_profile(frames, data):
    fact, _, state = data
    both = state.set_index("Code").join(fact.i94addr.value_counts().rename("n"), how="inner")
    row = analytics.corr_state_demographics(frames[0], frames[2], ["White"]).first()
    assert (row.measure, row.states) == ("White", 4)
    assert row["corr"] == pytest.approx(both.n.corr(both.White))
    got = {r.i94addr: r for r in analytics.visitor_profile_by_state(frames[0], frames[2]).collect()}
    ca = fact[fact.i94addr == "CA"]
    assert got["CA"].avg_age == pytest.approx(ca.i94bir.mean())
    assert got["CA"].male_share == pytest.approx((ca.gender == "M").mean())
    assert got["CA"].unstated_share == pytest.approx(ca.gender.isna().mean())


def test_climate_ratio_with_a_known_answer(spark):
    """Each destination gets one country: all variance lies between. One destination: none does."""
    names = "i94addr string, i94res int"
    country = spark.createDataFrame([(i, 2.0 * i) for i in range(8)] + [(8, None)], "Code int, Temperature double")
    apart = spark.createDataFrame([(f"S{i}", i) for i in range(9) for _ in range(i + 1)] + [(None, 1), ("S1", None)], names)
    row = analytics.corr_dest_climate_ratio(apart, country, permutations=19).first()
    assert (row["visits"], row["destinations"], round(row["eta_squared"], 9), row["p_value"]) == (36, 8, 1.0, 1.0)
    one = spark.createDataFrame([("S", i) for i in range(8)], names)
    row = analytics.corr_dest_climate_ratio(one, country, permutations=19).first()
    assert round(row["eta_squared"], 9) == 0.0 and row["p_value"] == 1.0
    halves = spark.createDataFrame([("warm" if i > 3 else "cold", i) for i in range(8) for _ in range(5)], names)
    row = analytics.corr_dest_climate_ratio(halves, country, permutations=199).first()
    assert round(row["eta_squared"], 9) == round(16 / 21, 9) and row["p_value"] < 0.1
    again = analytics.corr_dest_climate_ratio(halves.repartition(5), country, permutations=199).first()
    assert again["p_value"] == row["p_value"]


def test_climate_ratio_reads_the_fact_once_and_may_be_empty(spark, tmp_path, plan):
    country = spark.createDataFrame([(1, 2.0)], "Code int, Temperature double")
    spark.createDataFrame([("S", 1)], "i94addr string, i94res int").write.parquet(str(tmp_path / "f"))
    fact = spark.read.parquet(str(tmp_path / "f"))
    assert plan(analytics.corr_dest_climate_ratio(fact, country)).count("Scan parquet") == 1
    row = analytics.corr_dest_climate_ratio(fact.limit(0), country).first()
    assert tuple(row) == (0, 0, None, None)


def test_presence_by_brute_force(spark):
    import datetime as dt

    rng = np.random.default_rng(3)
    day = dt.date(2016, 1, 20)
    rows = []
    for _ in range(300):
        came = day + dt.timedelta(int(rng.integers(0, 70)))
        rows.append((came, came + dt.timedelta(int(rng.integers(-3, 40)))))
    rows += [(day, None), (None, day), (None, None)]
    got = analytics.visitors_present(spark.createDataFrame(rows, "arrdate date, depdate date")).collect()
    stays = [(a, d or dt.date.max) for a, d in rows if a and (d is None or d >= a)]
    assert sum(r["arrived"] for r in got) == len(stays) == sum(r["left"] for r in got) + 1
    for r in got:
        assert r["present"] == sum(a <= r["date"] <= d for a, d in stays)
    assert len(got) == len({a for a, _ in stays} | {d + dt.timedelta(1) for _, d in stays if d != dt.date.max})


def test_rank_correlation_with_ties_in_pieces(spark):
    rng = np.random.default_rng(9)
    x = rng.integers(0, 40, 4000)
    y = x + rng.integers(-20, 20, 4000) * 1000
    frame = pd.DataFrame({"x": x, "y": y})
    rows = [(int(a), int(b)) for a, b in zip(x, y, strict=True)] + [(None, 1), (1, None)]
    df = spark.createDataFrame(rows, "x int, y int").repartition(3)
    row = analytics.rank_correlation(df, "x", "y").first()
    assert row["rows"] == 4000 and abs(row["rho"] - frame.rank().corr().loc["x", "y"]) < 1e-12
    same = analytics.rank_correlation(df.withColumn("x", df["x"] * 0), "x", "y").first()
    assert same["rho"] is None
    assert tuple(analytics.rank_correlation(df.limit(0), "x", "y").first()) == (0, None)


def test_ranks_meet_by_range_only(spark, plan):
    """The one window over everything sees a row for each range."""
    from starmart.operators.ranks import average_ranks

    counts = spark.range(5000).selectExpr("id * 7 AS v", "1 + id % 3 AS n")
    ranks = average_ranks(counts, "v")
    text = plan(ranks)
    alone = text.split("Exchange SinglePartition")[1].splitlines()[1:4]
    assert any("Aggregate" in line for line in alone)
    last = ranks.orderBy(ranks["v"].desc()).first()
    assert last["rank"] == counts.agg({"n": "sum"}).first()[0] - (counts.where("id = 4999").first()["n"] - 1) / 2
