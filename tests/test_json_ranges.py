"""Large JSON files by byte ranges against readers of whole texts."""

import json
import random

import pytest
from pyspark.sql import functions as F

from boundaryspark.sources import geojson as J
from boundaryspark.sources import json_ranges as R

ODD = ["a", "}", '{"features":[{', "\\", '"', "]]", "é", "x\n", "\\\"}"]


def value(rng, depth=0):
    kind = rng.random()
    if kind < 0.3 or depth > 3:
        return rng.choice([1, None, True, rng.choice(ODD) * rng.randint(0, 3), -2.5])
    if kind < 0.6:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(ODD) * rng.randint(0, 2) + str(i): value(rng, depth + 1) for i in range(rng.randint(0, 3))}


def collection(rng, n):
    def ring():
        x, y = rng.randint(-170, 170), rng.randint(-80, 80)
        return [[x, y], [x + 1, y], [x + 1, y + 1.25], [x, y]]
    features = [{"type": "Feature", "properties": {"no": str(i), "odd": rng.choice(ODD) * 2, "more": json.dumps(value(rng))},
                 "geometry": rng.choice([{"type": "Polygon", "coordinates": [ring()]}, {"type": "MultiPolygon", "coordinates": [[ring()], [ring(), ring()]]}, None])}
                for i in range(n)]
    return {"type": "FeatureCollection", "crs": {"features": [{"type": "Feature"}]}, "x}": value(rng), "features": features, "after": [{"type": "Feature"}, value(rng)]}


def test_elements_at_any_cut():
    rng = random.Random(2)
    for _ in range(400):
        document = collection(rng, rng.randint(0, 6))
        text = json.dumps(document, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2]), separators=rng.choice([None, (",", ":"), (" ,\n", " : ")])).encode()
        for separator in (b"}", b"]]"):
            pieces, blocks = text.split(separator), []
            while pieces:
                n = rng.choice([1, 1, 2, 5, 100])
                blocks.append(separator.join([*pieces[:n], b""]))
                pieces = pieces[n:]
            state, found, part = (0, [], False), [], None
            for block in blocks:
                finder = R.Elements([("features", ""), ("crs",)], state[1], state[2])
                for kind, pattern, _, raw in [*finder.feed(block), *finder.rest()]:
                    part = (pattern, raw) if pattern is not None else (part[0], part[1] + raw)
                    if kind in ("whole", "end"):
                        found.append((part[0], json.loads(part[1])))
                state = R._joined(state, R.sum_up(block, state[2]))
            assert [x for k, x in found if k == 0] == document["features"]
            assert [x for k, x in found if k == 1] == [document["crs"]]


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "100", "spark.sql.files.minPartitionNum": "1"}
    for name, v in names.items():
        spark.conf.set(name, v)
    yield
    for name in names:
        spark.conf.unset(name)


def test_collections_as_whole_texts(spark, tmp_path, small_ranges):
    rng = random.Random(5)
    for k, indent in enumerate([None, 1, None]):
        (tmp_path / f"layer {k}.geojson").write_text(json.dumps(collection(rng, [60, 40, 0][k]), indent=indent, ensure_ascii=False))
    path = str(tmp_path)
    whole = J.parse_collections(spark.read.text(path, wholetext=True).withColumn("layer", F.col("_metadata.file_path")))
    got = J.read_feature_collections(spark, path)
    assert got.columns == whole.columns
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 8
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())) and whole.count() > 40


def test_one_feature_over_many_ranges(spark, tmp_path, small_ranges):
    ring = [[k / 1000, k % 7] for k in range(3000)] + [[0.0, 0]]
    features = [{"type": "Feature", "properties": {"a": {"b": "}" * 9000}}, "geometry": {"type": "Polygon", "coordinates": [ring]}},
                {"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [ring[:4]]}}]
    (tmp_path / "x.json").write_text(json.dumps({"features": features}))
    rows = sorted(J.read_feature_collections(spark, str(tmp_path)).collect(), key=lambda r: r["feature_no"])
    assert [len(r["geom"][0][0]) for r in rows] == [3001, 4]
    assert json.loads(rows[0]["props"]["a"]) == {"b": "}" * 9000}


def test_topologies_as_whole_texts(spark, tmp_path, small_ranges):
    rng = random.Random(7)
    for k in range(2):
        arcs, rings = [], []
        for i in range(80):
            x, y, w = rng.randint(0, 900), rng.randint(0, 900), rng.randint(1, 9)
            arcs += [[[x, y], [w, 0], [0, w]], [[x, y], [0, w], [w, 0]]]
            rings.append([2 * i, -2 * i - 2])
        geometries = [{"type": "Polygon", "arcs": [r], "properties": {"no": str(i), "odd": rng.choice(ODD)}} for i, r in enumerate(rings)]
        geometries[3] = {"type": "MultiPolygon", "arcs": [[rings[3]], [rings[4]]], "properties": {"no": "3"}}
        geometries[5] = {"type": None}
        document = {"type": "Topology", "objects": {"units]]": {"type": "GeometryCollection", "geometries": geometries},
                                                     "other": {"type": "GeometryCollection", "geometries": geometries[:2]}}, "arcs": arcs}
        if k == 0:
            document["transform"] = {"scale": [0.01, 0.02], "translate": [5, -5]}
            document["objects"] = {"units": document["objects"]["units]]"], "other": document["objects"]["other"]}
        (tmp_path / f"t{k}.json").write_text(json.dumps(document, separators=(",", ":"), ensure_ascii=k == 0))
    path = str(tmp_path)
    key = lambda rows: sorted(map(str, rows.select("layer", "feature_no", "props", "geom").collect()))
    whole = J.topojson_to_features(J.read_topologies(spark, path))
    assert key(J.read_topojson_features(spark, path)) == key(whole) and whole.count() == 158
    assert J.read_topojson_features(spark, path, "other").count() == 4
