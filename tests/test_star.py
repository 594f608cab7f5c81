"""Files in the real sources' shape, through to loaded and checked tables."""

import pytest
from pyspark.sql import functions as F

from starmart import contracts
from starmart.__main__ import main
from starmart.operators import quality
from starmart.plans import star

IMMIGRATION = """cicid,i94yr,i94mon,i94cit,i94res,i94port,arrdate,i94mode,i94addr,depdate,i94bir,\
i94visa,count,occup,gender,airline,fltno,visatype
6.0,2016.0,4.0,582.0,582.0,LOS,20545.0,1.0,CA,20550.0,37.0,2.0,1.0,,M,AA,12,B2
7.0,2016.0,4.0,245.0,582.0,LOS,20546.0,1.0,NC,,25.0,3.0,1.0,,F,,13,F1
8.0,2016.0,5.0,245.0,245.0,NYC,20575.0,9.0,,20580.0,,1.0,1.0,,,BA,14,B1
"""
TEMPERATURE = """dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude
1900-01-01,20.0,0.1,Mexico City,Mexico,19N,99W
1900-02-01,22.0,0.1,Mexico City,Mexico,19N,99W
1900-01-01,,0.1,Beijing,China,40N,116E
1900-02-01,4.0,0.1,Beijing,China,40N,116E
"""
DEMOGRAPHICS = """City;State;Median Age;Male Population;Female Population;Total Population;\
Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count
Salem;California;35.5;40;60;100;7;3;2.5;CA;White;80
Salem;California;35.5;40;60;100;7;3;2.5;CA;Asian;20
Bend;California;38.1;10;15;25;;1;;CA;White;25
"""
AIRPORTS = "ident,type,iso_country\n00A,heliport,US\nZZZ,closed,NO\n"


@pytest.fixture
def sources(tmp_path):
    files = {
        "immigration.csv": IMMIGRATION,
        "temperature.csv": TEMPERATURE,
        "demographics.csv": DEMOGRAPHICS,
        "airports.csv": AIRPORTS,
        "countries.csv": 'Code,I94CTRY\n582,MEXICO\n245,"CHINA, PRC"\n999,INVALID: UNKNOWN\n',
        "states.csv": "Code,State\nCA,CALIFORNIA\nNC,N. CAROLINA\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    return star.Sources(
        immigration=str(tmp_path / "immigration.csv"),
        temperature=str(tmp_path / "temperature.csv"),
        demographics=str(tmp_path / "demographics.csv"),
        country_lookup=str(tmp_path / "countries.csv"),
        state_lookup=str(tmp_path / "states.csv"),
    )


def test_build_load_check(spark, sources, tmp_path, rows):
    tables = star.build_star(spark, sources, str(tmp_path / "out"))
    assert rows(tables["country"]) == [
        (245, "China", 4.0, "40N", "116E"),
        (582, "Mexico", 21.0, "19N", "99W"),
        (999, "Invalid: Unknown", None, None, None),
    ]
    assert rows(tables["state"], "Code", "State", "TotalPopulation", "NumberVeterans") == [
        ("CA", "California", 125, 7),
        ("NC", "N. Carolina", None, None),
    ]
    assert rows(tables["immigration"], "cicid", "stay", "i94bir") == [
        (6, 5, 37),
        (7, None, 25),
        (8, 5, None),
    ]
    assert tables["date"].count() == 5
    assert (tmp_path / "out" / "immigration.parquet" / "i94yr=2016" / "i94mon=5").is_dir()

    names = star.load_star(spark, tables, prefix="mart_")
    loaded = {k: spark.table(n) for k, n in names.items()}
    for name, contract in contracts.STAR.items():
        types = {f.name: f.dataType for f in contract.schema}
        assert {f.name: f.dataType for f in loaded[name].schema} == types
    quality.assert_passed(quality.check_star(loaded, contracts.STAR))
    assert rows(loaded["immigration"], "arrdate")[0] == ("2016-04-01",)


def test_loading_twice_changes_nothing(spark, sources, tmp_path, rows):
    tables = star.build_star(spark, sources, str(tmp_path / "out"))
    for _ in range(2):
        names = star.load_star(spark, tables, prefix="twice_")
    for name, loaded in names.items():
        assert spark.table(loaded).count() == tables[name].count()

    changed = tables["immigration"].withColumn("airline", F.lit("new"))
    star.load_star(spark, {**tables, "immigration": changed}, "twice_", months=[(2016, 5)])
    fact = spark.table(names["immigration"])
    assert rows(fact, "cicid", "airline") == [(6, "AA"), (7, None), (8, "new")]


def test_month_choice_prunes_staged_partitions(spark, sources, tmp_path, plan):
    fact = star.build_star(spark, sources, str(tmp_path / "out"))["immigration"]
    picked = fact.where(star.in_months([(2016, 5)]))
    assert len(picked.collect()) == 1
    assert "i94mon" in plan(picked).split("PartitionFilters: [")[1].split("]")[0]


def test_command_line(spark, sources, tmp_path, capsys):
    names = ("immigration", "temperature", "demographics", "country_lookup", "state_lookup")
    paths = [v for n in names for v in (f"--{n.replace('_', '-')}", getattr(sources, n))]
    load = ["--load", "--prefix", "cli_", "--months", "2016-04"]
    assert main([*paths, "--out", str(tmp_path / "o"), *load]) == 0
    out = capsys.readouterr().out
    assert "ok     immigration: references_state:i94addr observed 0" in out
    assert spark.table("cli_immigration").count() == 2


def test_command_line_publishes_versions(spark, sources, tmp_path, capsys):
    names = ("immigration", "temperature", "demographics", "country_lookup", "state_lookup")
    paths = [v for n in names for v in (f"--{n.replace('_', '-')}", getattr(sources, n))]
    root = str(tmp_path / "published")
    for version in (1, 2):
        assert main([*paths, "--out", str(tmp_path / "o"), "--publish", root]) == 0
        assert f"published version {version}" in capsys.readouterr().out
    assert star.star_snapshots(spark, root).read()["immigration"].count() == 3


def test_command_line_fails_on_a_failed_check(spark, sources, tmp_path, capsys):
    (tmp_path / "states.csv").write_text("Code,State\nCA,CALIFORNIA\n")
    names = ("immigration", "temperature", "demographics", "country_lookup", "state_lookup")
    paths = [v for n in names for v in (f"--{n.replace('_', '-')}", getattr(sources, n))]
    assert main([*paths, "--out", str(tmp_path / "o")]) == 1
    assert "FAILED immigration: references_state:i94addr observed 1" in capsys.readouterr().out


def test_refresh_replaces_only_delivered_months(spark, sources, tmp_path, rows):
    out = str(tmp_path / "out")
    star.build_star(spark, sources, out)
    lines = IMMIGRATION.splitlines()
    (tmp_path / "immigration.csv").write_text("\n".join([lines[0], lines[3].replace("BA", "LH")]))
    for _ in range(2):
        tables = star.build_star(spark, sources, out, refresh=[(2016, 5)])
        assert rows(tables["immigration"], "cicid", "airline") == [(6, "AA"), (7, None), (8, "LH")]
        assert tables["date"].count() == 5
    with pytest.raises(ValueError, match="1 rows lie outside"):
        star.build_star(spark, sources, out, refresh=[(2016, 4)])


def test_refresh_adds_dates_from_the_refreshed_months_alone(spark, sources, tmp_path, rows):
    out = str(tmp_path / "out")
    star.build_star(spark, sources, out)
    lines = IMMIGRATION.splitlines()
    line = lines[3].replace("20580.0", "20583.0")
    (tmp_path / "immigration.csv").write_text("\n".join([lines[0], line, lines[1]]))
    tables = star.build_star(
        spark, sources, out, refresh=[(2016, 5)], rejects=str(tmp_path / "rejects")
    )
    assert tables["date"].count() == 6
    assert rows(spark.read.parquet(str(tmp_path / "rejects")), "cicid") == [(6,)]
    assert rows(tables["immigration"], "cicid") == [(6,), (7,), (8,)]


def test_load_does_not_shuffle_the_staged_fact(spark, sources, tmp_path, monkeypatch):
    tables = star.build_star(spark, sources, str(tmp_path / "out"))
    seen = []
    real = star.load_table
    monkeypatch.setattr(star, "load_table", lambda *a, **k: seen.append(k["rebalance"]) or real(*a, **k))
    star.load_star(spark, tables, prefix="unshuffled_", full_checks=True)
    assert seen == [False] * 4


def test_nothing_is_published_if_a_check_fails(spark, sources, tmp_path):
    tables = star.build_star(spark, sources, str(tmp_path / "out"))
    twice = tables["state"].unionByName(tables["state"])
    with pytest.raises(ValueError, match="state: unique_key"):
        star.load_star(spark, {**tables, "state": twice}, prefix="held_", full_checks=True)
    assert not spark.catalog.tableExists("held_immigration")


def test_a_path_of_none_skips_the_write(spark, sources, tmp_path):
    assert star.build_visits(spark, sources.immigration).count() == 3
    assert star.build_city_demographics(spark, sources.demographics).count() == 2
    assert star.build_states(spark, sources.demographics, sources.state_lookup).count() == 2
    trial = star.build_countries(spark, sources.temperature, sources.country_lookup, limit=1)
    assert trial.count() == 3
    assert sorted(p.suffix for p in tmp_path.iterdir()) == [".csv"] * 6


def test_landing_and_city_write(spark, sources, tmp_path):
    star.land_temperature(spark, sources.temperature, str(tmp_path / "t"))
    star.land_airports(spark, str(tmp_path / "airports.csv"), str(tmp_path / "a"))
    star.build_city_demographics(spark, sources.demographics, str(tmp_path / "c"))
    assert (tmp_path / "t" / "Country=Mexico" / "City=Mexico City").is_dir()
    assert (tmp_path / "a" / "iso_country=US").is_dir()
    assert (tmp_path / "c" / "State Code=CA").is_dir()


def test_loading_an_empty_table_fails(spark, sources, tmp_path):
    tables = star.build_star(spark, sources, str(tmp_path / "out"))
    with pytest.raises(ValueError, match="date: non_empty"):
        star.load_star(spark, {**tables, "date": tables["date"].limit(0)}, prefix="empty_")
