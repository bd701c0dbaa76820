"""Feature collections of any layout, cut into ranges of any size."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casegrid.sources import Dataset
from casegrid.sources.feature_files import _features, _summary, read_feature_collections, read_feature_texts

NAMES = ["plain", 'brace } { [ ] "', "back \\ slash \\\\", '\\"', "Feature", '{"type": "Feature"}', "", "ä 漢 \u2028", "\\" * 70, "line\nbreak"]


def collection(names=NAMES):
    crs = {"type": "name", "properties": {"name": "x", "more": [{"a": {}}]}}
    ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    features = [
        {"properties": {"COMM": n, "ZCTA20": str(k), "POP20": k, "deep": {"x": [{"y": 1}]}}, "geometry": {"type": "Polygon", "coordinates": [ring]}, "type": "Feature"}
        for k, n in enumerate(names)
    ]
    return {"type": "FeatureCollection", "crs": crs, "features": features, "bbox": [0, 0, 1, 1]}


def texts(data, size):
    """As Spark's steps do it, without Spark."""
    read = lambda start, length: data[start : start + length]
    found, inside, depth = [], False, 0
    for start in range(0, len(data), size):
        end = min(start + size, len(data))
        found += _features(read, start, end, inside, depth)
        odd, *gained = _summary(read, start, end)
        depth, inside = depth + gained[inside], inside ^ bool(odd)
    assert depth == 0 and not inside
    return [json.loads(text) for _, text in found]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet='ab"\\{}[], ä\n', max_size=12), max_size=4), st.integers(1, 60), st.booleans(), st.booleans())
def test_any_ranges_give_the_same_features(names, size, pretty, ascii_only):
    whole = collection(names)
    data = json.dumps(whole, indent=3 if pretty else None, ensure_ascii=ascii_only).encode()
    assert texts(data, size) == whole["features"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("collections")
    (folder / "line.json").write_text(json.dumps(collection(), ensure_ascii=False), encoding="utf-8")
    (folder / "pretty.json").write_text(json.dumps(collection(), indent=2))
    (folder / "empty.json").write_text("")
    (folder / "none.json").write_text('{"type": "FeatureCollection", "features": []}')
    (folder / "cut.json").write_text(json.dumps(collection(["a", "b"]))[:-60])
    return str(folder)


@pytest.mark.parametrize("size", [97, 1000, 1 << 24])
def test_spark_reads_one_line_and_many_lines_alike(spark, folder, size):
    for name in ("line", "pretty"):
        found = read_feature_collections(spark, f"{folder}/{name}.json", range_bytes=size).collect()
        assert sorted((r["ZCTA20"], r["COMM"], r["POP20"]) for r in found) == sorted((str(k), n, k) for k, n in enumerate(NAMES))
        assert all(r["coordinates"][0][0][2] == [1.0, 1.0] for r in found)


def test_files_without_features_and_cut_files(spark, folder):
    found = read_feature_texts(spark, [f"{folder}/{n}.json" for n in ("empty", "none", "cut")], 50).collect()
    assert [json.loads(r["text"])["properties"]["COMM"] for r in found] == ["a"]


def test_a_collection_is_a_data_set(spark, folder):
    assert Dataset("blocks", f"{folder}/pretty.json", "collection").read(spark).count() == len(NAMES)
