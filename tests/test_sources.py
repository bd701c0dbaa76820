"""Types found in texts, rejected rows, and data sets by name."""

import json

import pytest

from casegrid.plans import community_rates, method_frequency, nearest_station, victims_by_age, victims_by_descent
from casegrid.sources import (
    INCIDENT_TYPES,
    Catalogue,
    Dataset,
    WrongSchema,
    infer_types,
    parse_income,
    profile_columns,
    read_inferred,
    split_typed,
)

TEXTS = {
    "whole": ["1", " -7 ", "+30", None],
    "big": ["1", "3000000000", "", "2"],
    "huge": ["1", "99999999999999999999", "2", "3"],
    "decimal": ["1", "2.5", ".5", "1e3"],
    "code": ["0100", "0200", "12", ""],
    "day": ["2020-01-31", "2020-02-29", None, " "],
    "moment": ["2020-01-31", "2020-01-31 10:00:00", "2020-01-31T23:59:59.25", ""],
    "no_day": ["2020-01-31", "2020-02-30", "", ""],
    "flag": ["true", "FALSE", "", "False"],
    "mixed": ["true", "1", "", ""],
    "marked": ["1", "1d", "2", "3"],
    "nan": ["1.5", "NaN", "", ""],
    "none": [None, "", "  ", None],
    "a.b `c": ["x", "1", None, ""],
}
KINDS = {
    "whole": "int", "big": "bigint", "huge": "double", "decimal": "double", "code": "int", "day": "date", "moment": "timestamp",
    "no_day": "string", "flag": "boolean", "mixed": "string", "marked": "string", "nan": "string", "none": "string", "a.b `c": "string",
}


@pytest.fixture(scope="module")
def texts(spark):
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in TEXTS)
    return spark.createDataFrame(list(zip(*TEXTS.values())), schema)


def test_each_column_has_its_least_kind(texts):
    assert infer_types(texts) == KINDS
    assert infer_types(texts, keep_zeros=True) == KINDS | {"code": "string"}
    assert set(infer_types(texts.limit(0)).values()) == {"string"}
    found = {r["column"]: (r["n_values"], r["n_blank"], r["n_misfits"]) for r in profile_columns(texts).collect()}
    assert found["whole"] == (3, 1, 0) and found["none"] == (0, 4, 0)


def test_kinds_do_not_depend_on_how_rows_are_dealt(texts):
    assert infer_types(texts.repartition(4)) == infer_types(texts.coalesce(1)) == KINDS


def test_profile_reads_once_and_sorts_nothing(texts):
    plan = profile_columns(texts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Sort" not in plan and "Python" not in plan


def test_misfits_within_the_tolerance_are_rejected_rows(spark):
    raw = spark.createDataFrame([(str(k), "x") for k in range(98)] + [("many", "x"), ("", "y")], "n string, misfits string")
    assert infer_types(raw) == {"n": "string", "misfits": "string"}
    types = infer_types(raw, tolerance=0.02)
    assert types == {"n": "int", "misfits": "string"}
    good, rejected = split_typed(raw, types)
    assert good.dtypes == [("n", "int"), ("misfits", "string")] and good.count() == 99
    assert [tuple(r) for r in rejected.collect()] == [("many", ["n"])]


def test_a_file_is_read_with_inferred_types(spark, tmp_path):
    lines = ["id, code ,when,x", "1,0100,2020-01-01,1.5", "2,0200,2020-01-02,", "3,0300", "4,0400,2020-01-03,2,5", '5,"0,1",,7']
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    found = read_inferred(spark, str(tmp_path / "a.csv"), keep_zeros=True)
    assert found.types == {"id": "int", "code": "string", "when": "date", "x": "double"}
    assert sorted((r["id"], r["code"], str(r["when"]), r["x"]) for r in found.rows.collect()) == [
        (1, "0100", "2020-01-01", 1.5), (2, "0200", "2020-01-02", None), (5, "0,1", "None", 7.0),
    ]
    assert sorted(r["line"] for r in found.bad_lines.collect()) == ["3,0300", "4,0400,2020-01-03,2,5"]
    assert found.rejected.count() == 0


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "old.csv").write_text("AREA,DR_NO,DATE OCC,Crm Cd Desc,Vict Age,Vict Descent,Mocodes,LAT,LON\n"
                                      "x,01,2012 Jan 03 01:00:00 AM,AGGRAVATED ASSAULT,30,H,0100 0200,34.05,-118.25\n")  # fmt: skip
    (tmp_path / "new.csv").write_text("DR_NO,DATE OCC,Crm Cd Desc,Vict Age,Vict Descent,Mocodes,LAT,LON \n"
                                      "02,2020 Feb 03 01:00:00 AM,aggravated assault,x,W,0100,34.35,-118.25\n")  # fmt: skip
    (tmp_path / "stations.csv").write_text("x,y,DIVISION\n-118.25,34.35,NORTH\n-118.25,34.05,SOUTH\n")
    (tmp_path / "descents.csv").write_text("Vict Descent,Vict Descent Full\nH,Hispanic\nW,White\n")
    (tmp_path / "income.csv").write_text("Zip Code;Community;Estimated Median Income\n90001;c;$50,000\n")
    (tmp_path / "methods.txt").write_text("0100 Suspect known\n0200 Suspect swung\n")
    ring = [[-118.3, 34.0], [-118.2, 34.0], [-118.2, 34.1], [-118.3, 34.1], [-118.3, 34.0]]
    feature = {"type": "Feature", "properties": {"COMM": "c", "ZCTA20": "90001", "POP20": 10}, "geometry": {"type": "Polygon", "coordinates": [ring]}}
    (tmp_path / "blocks.geojson").write_text(json.dumps(feature) + "\n")
    return str(tmp_path)


def datasets(folder):
    return [
        Dataset("incidents", [f"{folder}/old.csv", f"{folder}/new.csv"], types=INCIDENT_TYPES),
        Dataset("stations", f"{folder}/stations.csv", types={"DIVISION": "string", "x": "double", "y": "double"}, strict=True),
        Dataset("descents", f"{folder}/descents.csv", types={"Vict Descent": "string", "Vict Descent Full": "string"}),
        Dataset("income", f"{folder}/income.csv", types={"Zip Code": "string", "Estimated Median Income": "string"}, options={"sep": ";"}),
        Dataset("methods", f"{folder}/methods.txt", "codes"),
        Dataset("blocks", f"{folder}/blocks.geojson", "geojson"),
    ]


def test_analyses_run_by_name(spark, folder):
    named = Catalogue(spark, datasets(folder))
    assert spark.sql("SELECT count(*) AS n FROM incidents JOIN descents USING (`Vict Descent`)").first()["n"] == 2
    incidents = named.read("incidents")
    assert [tuple(r) for r in victims_by_age(incidents).collect()] == [("Adults", 1)]
    assert victims_by_descent(incidents, named.read("descents")).count() == 2
    assert {r["Code"]: r["Frequency"] for r in method_frequency(incidents, named.read("methods")).collect()} == {"0100": 2, "0200": 1}
    assert {r["division"]: r["#"] for r in nearest_station(incidents, named.read("stations")).collect()} == {"NORTH": 1, "SOUTH": 1}
    assert community_rates(incidents, named.read("blocks"), parse_income(named.read("income"))).first()["Total_Crimes"] == 1
    for name in list(named.datasets):
        named.unbind(name)
    assert not spark.catalog.tableExists("incidents")


def test_wrong_schemas_are_refused_with_their_column(spark, folder):
    with pytest.raises(WrongSchema, match="column z is missing") as caught:
        Catalogue(spark, [Dataset("s", f"{folder}/stations.csv", types={"x": "double", "z": "double"})])
    assert caught.value.column == "z" and not spark.catalog.tableExists("s")
    spark.range(3).write.parquet(f"{folder}/ids.parquet")
    with pytest.raises(WrongSchema, match="column id is bigint, not string"):
        Catalogue(spark, [Dataset("ids", f"{folder}/ids.parquet", "parquet", {"id": "string"})])
    named = Catalogue(spark, [Dataset("ids", f"{folder}/ids.parquet", "parquet", {"id": "bigint"})])
    with pytest.raises(ValueError, match="bound already"):
        named.bind(Dataset("ids", f"{folder}/ids.parquet", "parquet"))
    with pytest.raises(KeyError, match="no data set other"):
        named.read("other")
    named.unbind("ids")


def test_strict_values(spark, folder):
    types = {"DR_NO": "string", "Vict Age": "int"}
    assert [r[1] for r in Dataset("i", f"{folder}/new.csv", types=types).read(spark).collect()] == [None]
    with pytest.raises(Exception, match="column Vict Age is no int: x"):
        Dataset("i", f"{folder}/new.csv", types=types, strict=True).read(spark).collect()
