"""Arrays of JSON documents cut at any byte."""

import json

import pytest
from pyspark.sql import functions as F

from verdigrid.sources import features, observations
from verdigrid.sources.documents import scan_array

SQUARE = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]}
ODD = [
    {"type": "Feature", "id": "1", "geometry": SQUARE, "properties": {"name": 'quote " and {[ "features": [ \\'}},
    {"type": "Feature", "id": "2", "geometry": SQUARE, "properties": {"name": "trail \\\\", "features": [{"type": "Feature"}]}},
    {"type": "Feature", "id": "3", "geometry": SQUARE, "properties": {"name": "żółw 森林 🌲" * 5, "data": {"features": [{}]}}},
    {"type": "Feature", "id": "4", "geometry": SQUARE, "properties": {"name": '\\" ]}', "x": []}},
]
DOCUMENTS = {
    "plain": json.dumps({"type": "FeatureCollection", "features": ODD}),
    "spaced": json.dumps({"links": [{"href": "features"}], "features": ODD, "crs": {"features": [{"no": 1}]}, "more": [{"a": [1]}]}, indent=3, ensure_ascii=False),
    "late": json.dumps({"my features": [{}], "s": "\\\"features\":[{", "features": ODD[:1]}).replace('"features": [{"type"', '"features" \n:\t [ {"type"'),
    "none": json.dumps({"features": [], "other": ODD}),
    "absent": json.dumps({"other": {"features": ODD}}),
}


@pytest.mark.parametrize(
    "name, size", [("late", 1), *[(n, s) for n in ("plain", "spaced", "late") for s in (13, 64, 1 << 20)], ("none", 64), ("absent", 64)]
)
def test_same_objects_wherever_a_document_is_cut(spark, tmp_path, name, size):
    path = tmp_path / f"{name}.json"
    path.write_text(DOCUMENTS[name], encoding="utf-8")
    got = [json.loads(r["value"]) for r in scan_array(spark, str(path), "features", size).collect()]
    want = json.loads(DOCUMENTS[name]).get("features", [])
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, want))


def test_collections_in_a_folder_as_lines_and_whole(spark, tmp_path):
    many = [{"type": "Feature", "geometry": SQUARE, "properties": {"name": f"n{i}"}} for i in range(500)]
    folder = tmp_path / "layers"
    folder.mkdir()
    (folder / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": many[:300]}))
    (folder / "b.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": many[300:]}))
    (folder / "empty.geojson").write_text("")
    lines = tmp_path / "layer.jsonl"
    lines.write_text("\n".join(map(json.dumps, many)))
    cut = features.scan_features(spark, str(folder), "name string", range_bytes=1000)
    by_line = features.scan_features(spark, str(lines), "name string", line_delimited=True)
    whole = features.scan_features(spark, str(folder), "name string", range_bytes=None)
    for other, columns in ((by_line, ["feature_id", "name"]), (whole, ["name"])):
        left, right = (sorted(map(tuple, df.select(*columns, F.to_json("rings")).collect())) for df in (cut, other))
        assert left == right and len(left) == 500
    assert cut.select(F.spark_partition_id()).distinct().count() > 1


def test_a_broken_document_raises(spark, tmp_path):
    path = tmp_path / "cut.json"
    path.write_text('{"features": [{"a": 1}, {"b": ')
    with pytest.raises(Exception, match="ends inside an object"):
        scan_array(spark, str(path), "features", 5).collect()
    with pytest.raises(ValueError):
        scan_array(spark, str(path), "features", 0)


def test_response_by_ranges(spark, tmp_path):
    records = [{"sourceId": f"S{i}", "referenceTime": "2014-01-01", "observations": [{"elementId": "t", "value": i / 2}]} for i in range(50)]
    path = tmp_path / "answer.json"
    path.write_text(json.dumps({"data": records, "meta": [{"data": [{}]}]}))
    cut = observations.scan_response(spark, str(path), range_bytes=100)
    assert sorted(map(str, cut.collect())) == sorted(map(str, observations.scan_response(spark, str(path), range_bytes=None).collect()))
    assert cut.count() == 50
