"""Small inline cases with results worked out by hand."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from casegrid.functions import EARTH_RADIUS_M, band, band_udf, haversine, matches_text, parse_money, year_of
from casegrid.operators.contains import contains_count, join_contains
from casegrid.operators.counts import banded_count, token_frequency
from casegrid.operators.nearest import nearest
from casegrid.operators.rows import dedup, union_incidents, valid_points
from casegrid.operators.shares import top_share, top_share_sql
from casegrid.operators.stats import corr_safe, corr_slices, rate_table, weighted_mean_by
from casegrid.operators.storage import drop_stored, fits_broadcast, stored
from casegrid.plans import community_rates, nearest_station
from casegrid.plans.analyses import unique_incidents
from casegrid.sources import geojson_features, parse_code_dictionary


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- text, numbers, dates


def test_matches_text_ignores_case_and_drops_null(spark):
    df = spark.createDataFrame(
        [("ASSAULT - AGGRAVATED ASSAULT",), ("aggravated assault x",), ("assault",), (None,)], "t string"
    )
    assert df.filter(matches_text(F.col("t"), "Aggravated Assault")).count() == 2


AGES = [17, 18, 24, 25, 64, 65, 0, -1, None]
BY_AGE = {"Children": 1, "Young adults": 2, "Adults": 2, "Seniors": 1}


@pytest.mark.parametrize("python_udf", [False, True])
def test_age_bands(spark, python_udf):
    df = spark.createDataFrame([("x", age) for age in AGES], "t string, age int")
    out = banded_count(df, "t", "x", "age", python_udf=python_udf)
    assert dict(rows(out)) == BY_AGE
    assert [n for _, n in rows(out)] == [2, 2, 1, 1]


def test_band_of_null_and_udf_agree(spark):
    df = spark.createDataFrame([(age,) for age in AGES], "age int")
    out = rows(df.select(band(F.col("age"), default=None), band_udf()(F.col("age"))))
    assert all(a == b for a, b in out)
    assert rows(df.filter("age IS NULL").select(band(F.col("age")))) == [("Unknown",)]


def test_dates(spark):
    df = spark.createDataFrame(
        [("2020 Mar 01 12:05:00 AM",), ("2020 Dec 31 11:59:59 PM",), ("03/01/2020",), (None,)], "d string"
    )
    assert [r[0] for r in rows(df.select(year_of(F.col("d"))))] == [2020, 2020, None, None]


def test_year_of_timestamp(spark):
    assert rows(spark.sql("SELECT timestamp'2021-05-06 07:08:09' AS d").select(year_of(F.col("d")))) == [(2021,)]


def test_money(spark):
    df = spark.createDataFrame([("$52,806",), ("7.5",), ("n/a",), ("",), (None,)], "m string")
    assert [r[0] for r in rows(df.select(parse_money(F.col("m"))))] == [52806.0, 7.5, None, None, None]


# --- rows


def test_dedup_keeps_the_least(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (1, 1, "a"), (None, 5, "n"), (None, 4, "m")], "k int, o int, v string")
    assert sorted(rows(dedup(df, ["k"], ["o"])), key=str) == [(1, 1, "a"), (None, 4, "m")]
    assert dedup(df, ["k"], ["o"]).columns == df.columns


def test_dedup_keeps_one_row_per_key_and_partition_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    plan = dedup(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange")[-1]
    assert "WindowGroupLimit" in before_shuffle


def test_union_matches_columns_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    assert sorted(rows(union_incidents(a, b))) == [(1, "x"), (2, "y")]


def test_valid_points(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (None, 1.0), (34.0, -118.0)], "LAT double, LON double"
    )
    assert rows(valid_points(df)) == [(34.0, -118.0)]


# --- codes


def dictionary(spark, *lines):
    return parse_code_dictionary(spark.createDataFrame([(line,) for line in lines], "value string"))


def test_dictionary_lines(spark):
    out = dictionary(spark, "0100 Suspect known", "0200", "12345 foo", "no code", "0300\t tabbed  text ")
    assert sorted(rows(out)) == [
        ("0100", "Suspect known"),
        ("0200", ""),
        ("0300", "tabbed  text "),
        ("1234", ""),
    ]


def test_tokens(spark):
    lists = spark.createDataFrame([("0100  0200 ",), (None,), ("0100 0900 0300",)], "codes string")
    codes = dictionary(spark, "0100 one", "0200")
    assert rows(token_frequency(lists, "codes", codes)) == [
        ("0100", "one", 2),
        ("0200", "", 1),
        ("0300", "Unknown", 1),
        ("0900", "Unknown", 1),
    ]
    assert rows(token_frequency(lists, "codes", codes, blank_as_unknown=True))[1] == ("0200", "Unknown", 1)


def test_trimmed_tokens(spark):
    lists = spark.createDataFrame([("0100\t 0100   \t",)], "codes string")
    codes = dictionary(spark, "0100 one")
    plain = token_frequency(lists, "codes", codes)
    assert dict((c, n) for c, _, n in rows(plain)) == {"0100\t": 1, "0100": 1, " ": 1, "\t": 1}
    assert rows(token_frequency(lists, "codes", codes, trim_tokens=True)) == [("0100", "one", 2)]


def test_a_repeated_dictionary_code_repeats_the_row(spark):
    lists = spark.createDataFrame([("0100 0100",)], "codes string")
    out = token_frequency(lists, "codes", dictionary(spark, "0100 a", "0100 b"))
    assert rows(out) == [("0100", "a", 2), ("0100", "b", 2)]


@pytest.mark.parametrize(
    ("hint", "operator"),
    [
        ("BROADCAST", "BroadcastHashJoin"),
        ("MERGE", "SortMergeJoin"),
        ("SHUFFLE_HASH", "ShuffledHashJoin"),
        ("SHUFFLE_REPLICATE_NL", "Join"),
    ],
)
def test_join_hints(spark, hint, operator):
    lists = spark.createDataFrame([("0100 0200",), ("0100",)], "codes string")
    codes = dictionary(spark, "0100 one")
    out = token_frequency(lists, "codes", codes, hint)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert operator in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert rows(out) == [("0100", "one", 2), ("0200", "Unknown", 1)]


def test_broadcast_hint_is_dropped_for_a_dictionary_over_the_limit(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lists = spark.createDataFrame([("0100 0200",)], "codes string")
        codes = dictionary(spark, "0100 one", "0200 two")
        kept = token_frequency(lists, "codes", codes, "BROADCAST")
        dropped = token_frequency(lists, "codes", codes, "BROADCAST", broadcast_limit_bytes=20)
        assert "BroadcastHashJoin" in kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in dropped._jdf.queryExecution().executedPlan().toString()
        assert rows(kept) == rows(dropped)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unknown_hint(spark):
    with pytest.raises(ValueError):
        token_frequency(spark.createDataFrame([("a",)], "c string"), "c", dictionary(spark, "0100"), "NOPE")


def test_fits_broadcast(spark):
    df = spark.createDataFrame([("x" * 100,), (None,)], "t string")
    assert fits_broadcast(df, 1000) and not fits_broadcast(df, 100)
    assert fits_broadcast(df.filter("false"), 0)


# --- shares


@pytest.mark.parametrize("build", [top_share, top_share_sql])
def test_top_share_keeps_ties(spark, build):
    counts = {"a": 9, "b": 7, "c": 7, "d": 7, "e": 1}
    data = [(2020, code) for code, n in counts.items() for _ in range(n)]
    data += [(None, "a"), (2020, None), (2020, "unlisted"), (2021, "e")]
    df = spark.createDataFrame(data, "y int, code string")
    names = spark.createDataFrame([(c, c.upper()) for c in counts], "code string, full string")
    out = rows(build(df, names, F.col("y"), "code", "code", "full"))
    assert [r[:3] for r in out] == [
        (2021, "E", 1),
        (2020, "A", 9),
        (2020, "B", 7),
        (2020, "C", 7),
        (2020, "D", 7),
        (None, "A", 1),
    ]
    assert out[1][3] == pytest.approx(100 * 9 / 31)


@pytest.mark.parametrize("build", [top_share, top_share_sql])
def test_codes_of_one_name_are_one_group(spark, build):
    df = spark.createDataFrame([(2020, "a"), (2020, "b"), (2020, "c")], "y int, code string")
    names = spark.createDataFrame([("a", "N"), ("b", "N"), ("c", "M")], "code string, full string")
    out = rows(build(df, names, F.col("y"), "code", "code", "full", k=1))
    assert [r[:3] for r in out] == [(2020, "N", 2)]


def test_format_number_rounds_half_even_on_the_binary_value(spark):
    df = spark.createDataFrame([(0.25,), (0.35,), (0.05,), (12345.678,)], "x double")
    assert [r[0] for r in rows(df.select(F.format_number("x", 1)))] == ["0.2", "0.3", "0.1", "12,345.7"]


# --- distances and polygons


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (5.0, 6.0, 5.0, 6.0), (0.0, 0.0, 180.0, 0.0)], "a double, b double, c double, d double")
    there = [r[0] for r in rows(df.select(haversine(*map(F.col, "abcd"))))]
    back = [r[0] for r in rows(df.select(haversine(*map(F.col, "cdab"))))]
    assert there[0] == pytest.approx(111195.066, abs=0.001)
    assert there[1] == 0.0
    assert there[2] == pytest.approx(3.141592653589793 * EARTH_RADIUS_M)
    assert there == back


def square(x, y, side=1.0):
    return [[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]


POLYGONS = "key string, coordinates array<array<array<array<double>>>>"


def found(spark, polygons, points, boundary="exclude"):
    areas = spark.createDataFrame(polygons, POLYGONS)
    spots = spark.createDataFrame(points, "id string, lon double, lat double")
    out = join_contains(spots, areas, lon="lon", lat="lat", boundary=boundary)
    return sorted((r["key"], r["id"]) for r in out.collect())


def test_boundary_points_are_outside(spark):
    points = [("centre", 0.5, 0.5), ("corner", 0.0, 0.0), ("edge", 0.5, 0.0), ("out", 2.0, 2.0), ("none", None, 0.5)]
    assert found(spark, [("a", [[square(0.0, 0.0)]])], points) == [("a", "centre")]


def test_shared_edge(spark):
    polygons = [("a", [[square(0.0, 0.0)]]), ("b", [[square(1.0, 0.0)]])]
    points = [("shared", 1.0, 0.5)]
    assert len(found(spark, polygons, points, "half_open")) == 1
    assert found(spark, polygons, points) == []


def test_hole_and_many_parts(spark):
    polygons = [("a", [[square(0.0, 0.0, 3.0), square(1.0, 1.0)], [square(10.0, 10.0)]])]
    points = [("hole", 1.5, 1.5), ("ring", 0.5, 0.5), ("part", 10.5, 10.5), ("between", 5.0, 5.0)]
    assert found(spark, polygons, points) == [("a", "part"), ("a", "ring")]


def test_no_polygons(spark):
    assert found(spark, [("a", [])], [("p", 0.5, 0.5)]) == []


def test_bad_boundary(spark):
    with pytest.raises(ValueError):
        found(spark, [("a", [[square(0.0, 0.0)]])], [("p", 0.5, 0.5)], "touch")


def test_overlapping_polygons_each_count(spark):
    areas = spark.createDataFrame(
        [("a", [[square(0.0, 0.0)]]), ("a", [[square(0.25, 0.25)]]), ("b", [[square(-8.0, -8.0, 16.0)]])], POLYGONS
    )
    spots = spark.createDataFrame([(0.5, 0.5)] * 3 + [(0.1, 0.1), (None, 0.1)], "lon double, lat double")
    out = contains_count(spots, areas, lon="lon", lat="lat", key="key")
    assert dict(rows(out)) == {"a": 7, "b": 4}


def test_geojson_lines(spark):
    def feature(pop, comm='"C"', geometry='{ "type": "Polygon", "coordinates": [[[0,0],[1,0],[1,1],[0,0]]] }'):
        return (
            '{ "type": "Feature", "properties": { "COMM": %s, "ZCTA20": "9", "POP20": %s }, "geometry": %s },'
            % (comm, pop, geometry)
        )

    multi = '{ "type": "MultiPolygon", "coordinates": [[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]] }'
    lines = [
        '{ "type": "FeatureCollection", "features": [',
        feature(5),
        feature('"5"'),
        feature("5.0"),
        feature(7, geometry=multi).rstrip(","),
        feature(8, geometry='{ "type": "Point", "coordinates": [0,0] }'),
        feature(9, geometry="null"),
        "] }",
    ]
    out = geojson_features(spark.createDataFrame([(line,) for line in lines], "value string"))
    got = rows(out.select("COMM", "ZCTA20", "POP20", F.size("coordinates")))
    without = [("C", "9", 8, None), ("C", "9", 9, None)]  # no polygon: the population still counts
    assert sorted(got, key=str) == sorted(
        [("C", "9", 5, 1), ("C", "9", 7, 2), ("C", "9", None, 1), ("C", "9", None, 1), *without], key=str
    )


# --- means, rates, correlations


def test_weighted_mean(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 3, "b"), ("z", 0, "a"), ("m", 5, "none")], "k string, w int, j string")
    values = spark.createDataFrame([("a", 10.0), ("b", 20.0)], "j string, v double")
    assert rows(weighted_mean_by(df, "k", "w", "j", values, "j", "v")) == [("k", 4, 17.5)]


def test_a_value_listed_twice_counts_twice(spark):
    df = spark.createDataFrame([("k", 2, "a")], "k string, w int, j string")
    values = spark.createDataFrame([("a", 10.0), ("a", 30.0)], "j string, v double")
    assert rows(weighted_mean_by(df, "k", "w", "j", values, "j", "v")) == [("k", 4, 20.0)]


def test_rate_table_keeps_common_keys(spark):
    means = spark.createDataFrame([("a", 100, 5.0), ("b", 10, 6.0)], "k string, total_weight long, mean double")
    counts = spark.createDataFrame([("a", 50), ("c", 1)], "k string, count long")
    assert rows(rate_table(means, counts, "k")) == [("a", 100, 5.0, 50, 0.25)]


@pytest.mark.parametrize(
    ("data", "expected"),
    [
        ([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], 1.0),
        ([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 99.0), (99.0, None)], 1.0),
        ([(1.0, 2.0), (1.0, 4.0)], None),
        ([(1.0, 2.0)], None),
        ([], None),
    ],
)
def test_corr(spark, data, expected):
    got = rows(spark.createDataFrame(data, "x double, y double").agg(corr_safe("x", "y")))[0][0]
    assert got is None if expected is None else got == pytest.approx(expected)


def test_corr_slices_break_ties_by_key(spark):
    table = [(f"g{i:02d}", 100.0 - i if i < 9 else 50.0, float(i * i % 7)) for i in range(12)]
    df = spark.createDataFrame(table, "k string, x double, y double")
    out = {r["slice"]: r for r in corr_slices(df, "x", "y", "k").collect()}
    assert {s: r["n"] for s, r in out.items()} == {"all": 12, "top10": 10, "bottom10": 10}
    top = spark.createDataFrame(table[:10], "k string, x double, y double")
    assert out["top10"]["corr"] == pytest.approx(rows(top.agg(F.corr("x", "y")))[0][0])


def test_corr_slices_of_nothing(spark):
    df = spark.createDataFrame([], "k string, x double, y double")
    assert Counter(rows(corr_slices(df, "x", "y", "k"))) == Counter(
        [("all", 0, None), ("top10", 0, None), ("bottom10", 0, None)]
    )


NAN, INFINITE = float("nan"), float("inf")


def test_a_bad_copy_never_beats_a_good_one(spark):
    schema = "DR_NO string, `Vict Age` int, Mocodes string, LAT double, LON double"
    copies = [
        ("1", 30, "0100", 0.0, 0.0), ("1", 30, "0100", 34.0, -118.0),
        ("2", None, None, None, None), ("2", 40, "0200", 34.1, -118.1),
        ("3", 50, "0300", NAN, -118.0), ("3", 50, "0300", 34.2, -118.2),
        ("4", 60, " ", 34.3, -118.3), ("4", None, "0400", 34.3, -118.3), ("4", 60, "0400", 34.3, -118.3),
    ]
    kept = unique_incidents(spark.createDataFrame(copies, schema))
    assert sorted(rows(kept)) == [copies[1], copies[3], copies[5], copies[8]]
    stations = spark.createDataFrame([("near", -118.0, 34.0)], "DIVISION string, x double, y double")
    assert [r["#"] for r in nearest_station(spark.createDataFrame(copies, schema), stations).collect()] == [4]


def test_the_caller_orders_equally_complete_copies(spark):
    copies = spark.createDataFrame([("1", 2, 20), ("1", 1, 30)], "DR_NO string, reported int, `Vict Age` int")
    assert rows(unique_incidents(copies)) == [("1", 20)]
    assert rows(unique_incidents(copies, ["reported"]).select("DR_NO", "Vict Age")) == [("1", 30)]


def test_places_off_the_earth_take_no_part(spark):
    places = [(1, 34.0, -118.0), (2, NAN, 1.0), (3, INFINITE, 1.0), (4, 91.0, 1.0), (5, 1.0, NAN), (6, None, 1.0)]
    points = spark.createDataFrame(places, "id int, lat double, lon double")
    assert [r["id"] for r in valid_points(points, "lat", "lon").collect()] == [1]
    sites = spark.createDataFrame([("s", 34.0, -118.0), ("t", NAN, 0.0), ("u", 0.0, INFINITE)], "site string, y double, x double")
    found = nearest(points, sites, point_id="id", lon="lon", lat="lat", site_id="site", site_lon="x", site_lat="y")
    assert [(r["id"], r["site"]) for r in found.collect()] == [(1, "s")]
    area = spark.createDataFrame([("a", [[square(-1000.0, -1000.0, 2000.0)]])], POLYGONS)
    assert [r["id"] for r in join_contains(points, area, lon="lon", lat="lat").collect()] == [1]


def test_stored_tables_go_and_settings_stay(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    table = stored(spark.range(3))
    assert table.count() == 3 and spark.conf.get("spark.checkpoint.dir", None) == before
    assert drop_stored() >= 1 and drop_stored() == 0


def test_a_block_without_polygon_counts_for_its_community(spark):
    blocks = spark.createDataFrame(
        [("C", "9", 5, [[square(0.0, 0.0)]]), ("C", "9", 15, None)],
        "COMM string, ZCTA20 string, POP20 bigint, coordinates array<array<array<array<double>>>>",
    )
    income = spark.createDataFrame([("9", 10.0)], "zip string, income double")
    crimes = spark.createDataFrame([("1", 0.5, 0.5)], "DR_NO string, LAT double, LON double")
    rates = community_rates(crimes, blocks, income)
    assert [(r["Total_Population"], r["Total_Crimes"]) for r in rates.collect()] == [(20, 1)]
