"""The five analyses end to end from files, against figures worked out in plain Python."""

import csv
import json
import math
import random
from collections import Counter, defaultdict

import pytest

from casegrid.functions import EARTH_RADIUS_M
from casegrid.operators import storage
from casegrid.plans import (
    community_rates,
    income_correlations,
    method_frequency,
    nearest_station,
    victims_by_age,
    victims_by_descent,
)
from casegrid.sources import (
    read_code_dictionary,
    read_geojson_features,
    read_incidents,
    read_income,
    read_lookup,
)

COLUMNS = ["DR_NO", "DATE OCC", "Crm Cd Desc", "Vict Age", "Vict Descent", "Mocodes", "LAT", "LON"]
DESCENTS = {"A": "Other Asian", "B": "Black", "H": "Hispanic", "W": "White", "X": "Unknown"}
STATIONS = {"NORTH": (-118.25, 34.35), "SOUTH": (-118.25, 34.05), "WEST": (-118.55, 34.2), "NOWHERE": (None, None)}
METHODS = {"0100": "Suspect known", "0200": "Suspect swung", "0344": "Removes property", "0416": ""}
INCOMES = {f"9000{i}": 30000 + 7000 * i for i in range(8)}
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def incident(rng, number, years):
    hour = rng.randrange(24)
    when = "%d %s %02d %02d:%02d:00 %s" % (
        rng.choice(years), rng.choice(MONTHS), rng.randrange(1, 29), hour % 12 or 12, rng.randrange(60), "AM" if hour < 12 else "PM",
    )
    located = rng.random() > 0.1
    return {
        "DR_NO": f"{number:09d}",
        "DATE OCC": when if rng.random() > 0.03 else "unknown",
        "Crm Cd Desc": rng.choice(["ASSAULT WITH DEADLY WEAPON, AGGRAVATED ASSAULT", "BURGLARY", "Aggravated assault, other"]),
        "Vict Age": rng.choice(["", "0", "-3", "abc", "17", "18", "24", "25", "64", "65", "90"]),
        "Vict Descent": rng.choice(["A", "B", "H", "H", "H", "W", "X", "", "?"]),
        "Mocodes": rng.choice(["", "0100", "0100 0200", "0344  0100 ", "9999 0416", "0200 0200"]),
        "LAT": repr(round(rng.uniform(34.0, 34.4), 4)) if located else "0.0",
        "LON": repr(round(rng.uniform(-118.7, -118.1), 4)) if located else "0.0",
    }


def write_csv(path, columns, rows, sep=","):
    with open(path, "w", newline="") as f:
        out = csv.writer(f, delimiter=sep)
        out.writerow(columns)
        out.writerows([["" if r[c.strip()] is None else r[c.strip()] for c in columns] for r in rows])


@pytest.fixture(scope="module")
def world(tmp_path_factory):
    rng = random.Random(7)
    folder = tmp_path_factory.mktemp("world")
    older = [incident(rng, i, range(2010, 2020)) for i in range(400)]
    newer = [incident(rng, 1000 + i, range(2020, 2024)) for i in range(800)]
    write_csv(folder / "older.csv", COLUMNS, older + older[:50])
    write_csv(folder / "newer.csv", ["AREA", "LON ", *reversed(COLUMNS[:-1])], [r | {"AREA": "x"} for r in newer + newer[:250]])
    write_csv(folder / "descents.csv", ["Vict Descent", "Vict Descent Full"], [{"Vict Descent": k, "Vict Descent Full": v} for k, v in DESCENTS.items()])
    write_csv(folder / "stations.csv", ["x", "y", "DIVISION"], [{"DIVISION": d, "x": x, "y": y} for d, (x, y) in STATIONS.items()])
    income = [{"Zip Code": z, "Community": "c", "Estimated Median Income": f"${v:,}"} for z, v in INCOMES.items()]
    income.append({"Zip Code": "99999", "Community": "none", "Estimated Median Income": "-"})
    write_csv(folder / "income.csv", ["Zip Code", "Community", "Estimated Median Income"], income, ";")
    (folder / "methods.txt").write_text("".join(f"{c} {d}\n" if d else f"{c}\n" for c, d in METHODS.items()) + "no code\n")

    blocks = []
    for i in range(12):
        for j in range(8):
            x, y = -118.7 + 0.05 * i, 34.0 + 0.05 * j
            ring = [[x, y], [x + 0.05, y], [x + 0.05, y + 0.05], [x, y + 0.05], [x, y]]
            properties = {
                "COMM": f"comm{(i + 3 * j) % 14}" if (i, j) != (0, 0) else None,
                "ZCTA20": rng.choice([*INCOMES, "99999", "12345"]),
                "POP20": rng.choice([0, 10, 250, 3000]),
            }
            blocks.append((properties, ring))
    with open(folder / "blocks.geojson", "w") as f:
        f.write('{ "type": "FeatureCollection", "features": [\n')
        for properties, ring in blocks:
            geometry = {"type": "Polygon", "coordinates": [ring]}
            f.write(json.dumps({"type": "Feature", "properties": properties, "geometry": geometry}) + ",\n")
        f.write("] }\n")
    return {"folder": folder, "older": older, "newer": newer, "blocks": blocks}


@pytest.fixture(scope="module")
def incidents(spark, world):
    return read_incidents(spark, [f"{world['folder']}/{name}.csv" for name in ("older", "newer")])


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_incidents_keep_leading_zeros_and_lose_bad_numbers(incidents):
    assert incidents.columns == COLUMNS
    assert incidents.count() == 1500
    assert incidents.filter("DR_NO = '000000007'").count() == 2
    assert incidents.filter("`Vict Age` IS NULL").count() > 0
    assert incidents.filter("Mocodes = '0100'").count() > 0


@pytest.mark.parametrize("python_udf", [False, True])
def test_victims_by_age(incidents, world, python_udf):
    expected = Counter()
    for r in world["older"] + world["newer"]:
        age = int(r["Vict Age"]) if r["Vict Age"].lstrip("-").isdigit() else 0
        if "aggravated assault" in r["Crm Cd Desc"].lower() and age > 0:
            expected["Children" if age < 18 else "Young adults" if age < 25 else "Adults" if age < 65 else "Seniors"] += 1
    out = victims_by_age(incidents, python_udf=python_udf)
    assert out.columns == ["Age Group", "count"]
    assert rows(out) == sorted(expected.items(), key=lambda kv: (-kv[1], kv[0]))


@pytest.mark.parametrize("sql", [False, True])
def test_victims_by_descent(spark, incidents, world, sql):
    path = f"{world['folder']}/descents.csv"
    names = read_lookup(spark, path, {"Vict Descent": "string", "Vict Descent Full": "string"})
    by_year = defaultdict(Counter)
    for r in world["older"] + world["newer"]:
        if r["Vict Descent"] in DESCENTS:
            year = None if r["DATE OCC"] == "unknown" else int(r["DATE OCC"][:4])
            by_year[year][DESCENTS[r["Vict Descent"]]] += 1
    expected = []
    for year in sorted(by_year, key=lambda y: (y is None, -(y or 0))):
        groups = sorted(by_year[year].items(), key=lambda kv: (-kv[1], kv[0]))
        total = sum(by_year[year].values())
        expected += [
            (year, name, n, f"{n / total * 100:.1f}")
            for name, n in groups
            if sum(other > n for _, other in groups) < 3
        ]
    out = victims_by_descent(incidents, names, sql=sql)
    assert out.columns == ["year", "Victim Descent", "#", "%"]
    assert rows(out) == expected


@pytest.mark.parametrize("hint", [None, "BROADCAST", "MERGE", "SHUFFLE_HASH", "SHUFFLE_REPLICATE_NL"])
def test_method_frequency(spark, incidents, world, hint):
    codes = read_code_dictionary(spark, f"{world['folder']}/methods.txt")
    counts = Counter(c for r in world["older"] + world["newer"] for c in r["Mocodes"].split(" ") if c)
    expected = sorted(((c, METHODS.get(c, "Unknown"), n) for c, n in counts.items()), key=lambda r: (-r[2], r[0]))
    assert rows(method_frequency(incidents, codes, hint)) == expected


def great_circle(lon1, lat1, lon2, lat2):
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2
    b = math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(a + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * b))


def test_nearest_station(spark, incidents, world):
    path = f"{world['folder']}/stations.csv"
    stations = read_lookup(spark, path, {"DIVISION": "string", "x": "double", "y": "double"})
    found = defaultdict(list)
    for r in world["older"] + world["newer"]:
        lat, lon = float(r["LAT"]), float(r["LON"])
        if lat and lon:
            found[min((great_circle(lon, lat, x, y), d) for d, (x, y) in STATIONS.items() if x)[1]].append(
                min(great_circle(lon, lat, x, y) for x, y in STATIONS.values() if x)
            )
    expected = sorted(((d, f"{sum(m) / len(m) / 1000:,.3f}", len(m)) for d, m in found.items()), key=lambda r: -r[2])
    out = nearest_station(incidents, stations)
    assert out.columns == ["division", "average_distance", "#"]
    assert rows(out) == expected


@pytest.mark.parametrize("years", [None, (2020, 2021)])
def test_community_rates_and_correlations(spark, world, years):
    newer = read_incidents(spark, f"{world['folder']}/newer.csv", ["DR_NO", "DATE OCC", "LAT", "LON"])
    blocks = read_geojson_features(spark, f"{world['folder']}/blocks.geojson")
    income = read_income(spark, f"{world['folder']}/income.csv")
    assert income.count() == len(INCOMES)
    kept = [(p, ring) for p, ring in world["blocks"] if p["COMM"] and p["POP20"] > 0]
    people, money, crimes = Counter(), Counter(), Counter()
    for p, _ in kept:
        if p["ZCTA20"] in INCOMES:
            people[p["COMM"]] += p["POP20"]
            money[p["COMM"]] += p["POP20"] * INCOMES[p["ZCTA20"]]
    for r in world["newer"]:
        lat, lon = float(r["LAT"]), float(r["LON"])
        if years and r["DATE OCC"][:4] not in map(str, years):
            continue
        for p, ring in kept:
            (west, south), (east, north) = ring[0], ring[2]
            crimes[p["COMM"]] += west < lon < east and south < lat < north
    expected = {
        c: (people[c], money[c] / people[c], crimes[c], crimes[c] / 2.0 / people[c]) for c in people if crimes[c]
    }
    out = community_rates(newer, blocks, income, years)
    assert out.columns == ["COMM", "Total_Population", "Avg_Income", "Total_Crimes", "Crimes_Per_Person"]
    got = {r[0]: r[1:] for r in rows(out)}
    assert got.keys() == expected.keys() and len(got) > 10
    for c in got:
        assert got[c] == pytest.approx(expected[c])

    richest_first = sorted(expected, key=lambda c: (-expected[c][1], c))
    slices = {"all": richest_first, "top10": richest_first[:10], "bottom10": sorted(expected, key=lambda c: (expected[c][1], c))[:10]}
    for r in income_correlations(out).collect():
        members = [expected[c] for c in slices[r["slice"]]]
        assert r["n"] == len(members)
        assert r["corr"] == pytest.approx(pearson([m[1] for m in members], [m[3] for m in members]))


def pearson(xs, ys):
    mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
    cov = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
    return cov / math.sqrt(sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys))


def test_settled_results_outlive_their_intermediate_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "_written", [])
    monkeypatch.setattr(storage, "shared_folder", lambda df: str(tmp_path))

    def made():
        first = storage.stored(spark.range(10))
        return storage.stored(first.filter("id > 2")).selectExpr("id * 2 AS id")

    one = storage.settled(made)
    two = storage.settled(lambda: one.filter("id > 10"))
    assert len(list(tmp_path.iterdir())) == 2
    assert sorted(r["id"] for r in one.collect()) == list(range(6, 20, 2)) and two.count() == 4
    assert storage.drop_stored() == 2 and not list(tmp_path.iterdir())


def test_arrays_count_with_all_their_elements(spark):
    rows = spark.range(100).selectExpr("id", "array_repeat(id, 1000) AS a", "array_repeat('abcdefgh', 100) AS b", "named_struct('x', 'yy') AS c")
    assert storage.fits_broadcast(rows, 2_000_000) and not storage.fits_broadcast(rows, 1_000_000)
    assert not storage.fits_broadcast(spark.range(10).selectExpr("map(id, repeat('x', 10000)) AS m"), 90_000)
