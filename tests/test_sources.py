import json
import zipfile
from pathlib import Path

from conftest import DONUT, SQUARE, frame
from pyspark.sql import functions as F

from boundaryspark.functions import geometry as G
from boundaryspark.operators import intake as N
from boundaryspark.sources import geojson as J
from boundaryspark.sources import lookups as L
from boundaryspark.sources import metadata as M
from boundaryspark.sources import packages as P
from boundaryspark.sources import sinks as K
from boundaryspark.streaming import jobs as ST

META = """Boundary Representative of Year: 2013
ISO-3166-1 (Alpha-3): ALB
Boundary Type: ADM3
Canonical Boundary Type Name: 
Source 1: Survey
Source 2: Office
Release Type: gbOpen
License: Public Domain
License Notes: none
License Source: https://example.org/copyright
Link to Source Data: https://example.org/data
Other Notes: """
LAYER = json.dumps({"type": "FeatureCollection", "features": [
    {"type": "Feature", "properties": {"Name": "A", "n": 1}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
    {"type": "Feature", "properties": {"Name": "B"}, "geometry": None},
    {"type": "Feature", "properties": {"Name": "C"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [2, 0], [2, 2], [0, 0]]]]}}]})


def pack(folder: Path, name: str, members: dict) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / name, "w") as z:
        for member, text in members.items():
            z.writestr(member, text)


def submissions(root: Path) -> Path:
    folder = root / "sourceData" / "gbOpen"
    pack(folder, "ALB_ADM3.zip", {"meta.txt": META, "x.geojson": LAYER, "__MACOSX/x.geojson": "junk", "license.png": "p"})
    pack(folder, "AND_ADM0.zip", {"a.shp": "", "a.shx": "", "a.dbf": "", "meta.txt": META})
    pack(folder, "ARM_ADM1.zip", {"a.shp": "", "b.geojson": "{}", "a.prj": "PROJCS[UTM]"})
    (folder / "BAD_ADM1.zip").write_bytes(b"not a zip")
    return root


def lookups(spark):
    countries = spark.createDataFrame([("ALB",), ("AND",)], "iso string")
    licenses = spark.createDataFrame([("Public Domain",)], "license string")
    return countries, licenses


def test_packages(spark, tmp_path):
    packages = P.read_packages(spark, str(submissions(tmp_path)))
    found = {(r["product"], r["iso"], r["adm"]) for r in packages.collect()}
    assert found == {("gbOpen", "ALB", "ADM3"), ("gbOpen", "AND", "ADM0"), ("gbOpen", "ARM", "ADM1"), ("gbOpen", "BAD", "ADM1")}
    scan = packages.select("iso")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in scan
    members = P.package_members(packages)
    name = F.regexp_extract("package_id", "([A-Z]+)_ADM", 1)
    checks = {r["c"]: list(r["reasons"]) for r in N.check_package(members).withColumn("c", name).collect()}
    assert checks["ALB"] == [] and checks["AND"] == ["no .prj"]
    assert checks["ARM"] == ["no meta.txt", "several geometry files"]
    assert checks["BAD"] == ["no meta.txt", "no geometry file"]
    projections = {r["c"]: r["projection_ok"] for r in P.check_projection(members).withColumn("c", name).collect()}
    assert projections == {"ALB": True, "ARM": False}
    features = J.features_of_members(members).collect()
    assert sorted(r["props"]["Name"] for r in features if "ALB" in r["package_id"]) == ["A", "C"]


def test_intake_stream_equals_batch(spark, tmp_path):
    root = submissions(tmp_path / "in")
    countries, licenses = lookups(spark)
    batch = ST.intake_batch(P.read_packages(spark, str(root)), countries, licenses, 2026)
    stored = P.read_packages(spark, str(root))
    stored.write.parquet(str(tmp_path / "queue"))
    stream = spark.readStream.schema(stored.schema).parquet(str(tmp_path / "queue"))
    ST.stream_intake(stream, countries, licenses, str(tmp_path / "out"), str(tmp_path / "cp"), 2026).awaitTermination()
    columns = ["package_id", "reasons", "message", "passed"]
    want = sorted(map(tuple, batch.select(columns).collect()))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(columns).collect())) == want
    assert [w[3] for w in want if "ALB" in w[0]] == [True] and sum(w[3] for w in want) == 1


def test_lookups(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Name,LocationCode,Alpha-3code,Claimant(s),Disputed,UNSDG-subregion,UNSDG-region,Continent,worldBankIncomeGroup\n"
                                    "Antartica,Unknown,ATA,FRA|ARG,Yes,U,U,U,U\n\"Korea, North\",1,PRK,None,No,E,A,Asia,Low\n")
    rows = {r["iso"]: r for r in L.read_countries(spark, str(tmp_path / "c.csv")).collect()}
    assert rows["ATA"]["claimants"] == ["FRA", "ARG"] and rows["PRK"]["claimants"] == [] and rows["PRK"]["Name"] == "Korea, North"
    (tmp_path / "l.csv").write_text("license_name, licenseText, gbOpen, gbAuthoritative, gbHumanitarian, a, b, c, d, e\n"
                                    "\"CC0, Dedication\", \"cc0.pdf\", Yes, No, Yes, Yes, No, Yes, Yes, No\n")
    row = L.read_licenses(spark, str(tmp_path / "l.csv")).first()
    assert (row["license"], row["licenseText"], row["gb_open"], row["gb_authoritative"]) == ("cc0, dedication", "cc0.pdf", True, False)
    (tmp_path / "s.csv").write_text("boundaryISO,boundaryType,apiURL\nALB,ADM1,u\n,,\nAND,ADM0,v\n")
    assert L.read_source_catalog(spark, str(tmp_path / "s.csv")).count() == 2


def test_layer_metadata(spark, tmp_path):
    for iso, n in (("ALB", 1), ("AND", 2)):
        folder = tmp_path / "gbOpen" / iso / "ADM0"
        folder.mkdir(parents=True)
        for i in range(n):
            (folder / f"{i}-metaData.json").write_text(json.dumps({"boundaryISO": iso, "boundaryType": "ADM0"}))
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "metaData.json").write_text("{}")
    single, rejected = M.read_layer_metadata(spark, str(tmp_path), ["gbOpen"])
    assert [(r["boundaryISO"], r["product"]) for r in single.collect()] == [("ALB", "gbOpen")]
    assert [r["documents"] for r in rejected.collect()] == [2]


def test_topojson_with_reversed_arc(spark, tmp_path):
    topology = {"type": "Topology", "transform": {"scale": [0.5, 0.5], "translate": [10, 20]}, "objects": {"units": {"geometries": [
        {"type": "Polygon", "arcs": [[0, 1]], "properties": {"Name": "left"}}, {"type": "MultiPolygon", "arcs": [[[-1, 2]]], "properties": {"Name": "right"}}]}},
        "arcs": [[[2, 0], [0, 2]], [[2, 2], [-2, 0], [0, -2], [2, 0]], [[2, 0], [2, 0], [0, 2], [-2, 0]]]}
    (tmp_path / "t.topojson").write_text(json.dumps(topology))
    out = J.topojson_to_features(J.read_topologies(spark, str(tmp_path / "t.topojson")))
    rings = {r["props"]["Name"]: [(v["x"], v["y"]) for v in r["geom"][0][0]] for r in out.collect()}
    assert rings["left"] == [(11, 20), (11, 21), (10, 21), (10, 20), (11, 20)]
    assert rings["right"] == [(11, 21), (11, 20), (12, 20), (12, 21), (11, 21)]


def joined(folder: Path) -> str:
    return "".join(p.read_text() for p in sorted(folder.glob("part-*")))


def test_feature_collection_is_json(spark, tmp_path):
    df = frame(spark, [("one", "b", SQUARE), ("one", "a", DONUT), ("two", "c", SQUARE)], "layer string, shapeID string")
    K.write_feature_collections(df, str(tmp_path / "fc"))
    doc = json.loads(joined(tmp_path / "fc" / "layer=one"))
    assert doc["name"] == "one" and [f["properties"]["shapeID"] for f in doc["features"]] == ["a", "b"]
    back = J.read_feature_lines(spark, str(tmp_path / "fc"))
    assert back.select(F.sum(G.planar_area("geom"))).first()[0] == 10.0
    (tmp_path / "whole.geojson").write_text(joined(tmp_path / "fc" / "layer=one"))
    assert J.read_feature_collections(spark, str(tmp_path / "whole.geojson")).count() == 2


def test_api_index_is_json(spark, tmp_path):
    records = spark.createDataFrame([("ALB", "ADM0", "1"), ("ALB", "ADM1", "2"), ("AND", "ADM0", "3")], "boundaryISO string, boundaryType string, boundaryID string")
    K.write_api_index(records, str(tmp_path / "api"))
    read = lambda iso, adm: json.loads(joined(tmp_path / "api" / f"iso_dir={iso}" / f"adm_dir={adm}"))
    assert [r["boundaryID"] for r in read("ALL", "ALL")] == ["1", "2", "3"]
    assert [r["boundaryID"] for r in read("ALL", "ADM0")] == ["1", "3"]
    assert read("AND", "ADM0")["boundaryID"] == "3" and len(read("ALB", "ALL")) == 2


def test_check_report(spark, tmp_path):
    countries, licenses = lookups(spark)
    members = P.package_members(P.read_packages(spark, str(submissions(tmp_path / "in"))))
    checks = N.metadata_checks(N.parse_meta(P.meta_texts(members)), countries, licenses, members.select("package_id", "member"), 2026)
    geometry = checks.select("package_id", F.lit(True).alias("valid_ok"), F.lit(True).alias("projection_ok"), F.lit(True).alias("passed"))
    report = K.check_report(checks, geometry, ["package_id"])
    K.write_check_report(report, str(tmp_path / "report"))
    back = spark.read.option("header", "true").csv(str(tmp_path / "report"))
    assert {(("ALB" in r["package_id"]), r["META_licenseImageInZip"], r["status"]) for r in back.collect()} == {(True, "true", "PASS"), (False, "false", "PASS")}


def test_upsert_is_idempotent(spark):
    from boundaryspark.operators.identity import upsert_catalog
    old = spark.createDataFrame([("A", "0", 1), ("B", "0", 2)], "iso string, adm string, v int")
    new = spark.createDataFrame([("B", "0", 9), ("C", "0", 3)], "iso string, adm string, v int")
    once = upsert_catalog(old, new, ["iso", "adm"])
    twice = upsert_catalog(once, new, ["iso", "adm"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("A", "0", 1), ("B", "0", 9), ("C", "0", 3)]


def test_changes_of_late_lines_and_of_equal_size(spark):
    from boundaryspark.schema import GEOMETRY_DDL
    from boundaryspark.operators import identity as I
    keys, lines = ["iso", "adm"], [f"line {i}" for i in range(1, 26)]
    square = [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]]
    moved = [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.5), (0.0, 0.0)]]]
    dated = [*lines, "Source Data Updated On: 2020-01-01", "File Built On: 2020-01-01"]

    def side(rows):
        units = spark.createDataFrame([(iso, "ADM1", n, g) for iso, gs, _ in rows for n, g in gs], f"iso string, adm string, name string, geom {GEOMETRY_DDL}")
        meta = spark.createDataFrame([(iso, "ADM1", 100, m) for iso, _, m in rows], "iso string, adm string, geometry_size long, metadata_lines array<string>")
        return meta.join(I.geometry_fingerprint(units.repartition(3), keys), keys, "left")
    two = [("a", square), ("b", moved)]
    old = side([("LINE", two, lines), ("GEOM", two, lines), ("NAME", two, lines), ("SAME", two, dated), ("NONE", two, None), ("GONE", two, lines)])
    new = side([("LINE", two, [*lines[:19], "changed", *lines[20:]]), ("GEOM", [("a", moved), ("b", moved)], lines), ("NAME", [("a", square), ("c", moved)], lines),
                ("SAME", two[::-1], [*lines, "Source Data Updated On: 2021-02-02", "File Built On: 2021-02-02"]), ("NONE", two, lines), ("NEW", two, lines)])
    found = {r["iso"]: (r["change"], r["rebuild"]) for r in I.detect_changes(new, old, keys).collect()}
    assert found == {"LINE": ("metadata", True), "GEOM": ("geometry", True), "NAME": ("geometry", True), "SAME": ("unchanged", False),
                     "NONE": ("error", True), "GONE": ("removed", False), "NEW": ("added", True)}
    legacy = {r["iso"]: r["change"] for r in I.detect_changes(new, old, keys, mode="legacy").collect()}
    assert legacy["LINE"] == legacy["GEOM"] == "unchanged"


def test_stream_upsert_over_several_batches(spark, tmp_path):
    folder = str(tmp_path / "in")
    for rows in ([("a", 1), ("b", 1)], [("b", 2)], [("a", 3), ("b", 1)]):
        spark.createDataFrame(rows, "k string, t int").coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema("k string, t int").option("maxFilesPerTrigger", 1).parquet(folder)
    ST.upsert_batches(stream, str(tmp_path / "out"), ["k"], "t", str(tmp_path / "cp")).awaitTermination()
    from boundaryspark.sources.versions import VersionedTable
    newest = VersionedTable(spark, str(tmp_path / "out"), ["k"], "t").read("k string, t int")
    assert sorted((r["k"], r["t"]) for r in newest.collect()) == [("a", 3), ("b", 2)]


def test_members_by_the_directory(spark):
    import io
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("meta.txt", META)
        z.writestr("big.geojson", "x" * 100_000)
    data = bytearray(buffer.getvalue())
    at = data.index(b"big.geojson") + len("big.geojson")
    data[at:at + 20] = b"\xff" * 20  # the large member no longer inflates
    rows = [("good", buffer.getvalue()), ("bad", bytes(data)), ("cut", buffer.getvalue()[:-30]), ("none", None)]
    packages = spark.createDataFrame([r for r in rows if r[1]], "package_id string, content binary")
    names = sorted((r["package_id"], r["member"], r["size"], r["content"] is None) for r in P.package_members(packages, None).collect())
    assert names == [("bad", "big.geojson", 100_000, True), ("bad", "meta.txt", len(META), True), ("cut", P.UNREADABLE, None, True),
                     ("good", "big.geojson", 100_000, True), ("good", "meta.txt", len(META), True)]
    one = {(r["package_id"], r["member"]): r["content"] for r in P.package_members(packages, P.META_FILE).collect()}
    assert bytes(one["bad", "meta.txt"]).decode() == META and one["bad", "big.geojson"] is None
    whole = {r["package_id"]: r["member"] for r in P.package_members(packages).collect()}
    assert whole["bad"] == P.UNREADABLE and whole["good"] == "big.geojson"


def test_versions_write_touched_buckets_only(spark, tmp_path):
    from boundaryspark.sources.versions import VersionedTable
    schema = "k long, v string, at long"
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], "at", 16)
    assert table.read(schema).count() == 0
    table.upsert(spark.createDataFrame([(k, "a", 1) for k in range(1000)], schema), 0)
    files = lambda n: list((tmp_path / "t" / "files" / f"version={n}").rglob("*.parquet"))
    assert len(files(0)) == 16
    table.upsert(spark.createDataFrame([(7, "b", 2)], schema), 1)
    assert len(files(1)) == 1
    table.upsert(spark.createDataFrame([(7, "old", 1), (2000, "c", 1)], schema), 2)
    want = {**{k: "a" for k in range(1000)}, 7: "b", 2000: "c"}
    assert {r["k"]: r["v"] for r in table.read(schema).collect()} == want
    # a retry of the last batch, and of one that failed before its manifest
    table.upsert(spark.createDataFrame([(7, "old", 1), (2000, "c", 1)], schema), 2)
    assert {r["k"]: r["v"] for r in table.read(schema).collect()} == want and len(files(2)) <= 2
    assert {r["k"]: r["v"] for r in table.read(schema, 1).collect()} == {**{k: "a" for k in range(1000)}, 7: "b"}
    table.upsert(spark.createDataFrame([], schema), 3)
    assert table.versions() == [0, 1, 2, 3] and {r["k"]: r["v"] for r in table.read(schema).collect()} == want


def test_ready_tasks_end_and_are_forgotten(spark, tmp_path):
    schema = "iso string, taskid int, time_added timestamp, status string"
    hour = lambda h: f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00:00"
    files = [[("a", 1, 0, "ready"), ("a", 2, 5, "ready"), ("b", 3, 6, "ready")],
             [("b", 4, 20, "COMPLETE"), ("b", 5, 21, "ready"), ("a", 6, 71, "ready")],
             [("a", 7, 72, "ready"), ("c", 8, 80, "ready")],
             [("d", 9, 400, "ready"), ("d", 10, 401, "ERROR")],
             # late: the watermark is at hour 400
             [("c", 11, 81, "ready"), ("e", 12, 402, "PROCESSING")]]
    folder = str(tmp_path / "in")
    for rows in files:
        df = spark.createDataFrame([(k, n, hour(h), s) for k, n, h, s in rows], "iso string, taskid int, t string, status string")
        df.select("iso", "taskid", F.col("t").cast("timestamp").alias("time_added"), "status").coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    taken = ST.stream_ready_tasks(stream, ["iso"])
    query = taken.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r["taskid"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 3, 5, 7, 8, 9]
    # keys a, b and c were never heard of again: timers dropped them
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 0


def test_release_types_are_an_argument(spark):
    rows = [("p/gbOpen/a.zip", "Release Type: gbOpen"), ("p/UN_X/b.zip", "Release Type: UN_X"), ("p/gbOpen/c.zip", "Release Type: UN_X")]
    kv = N.parse_meta(spark.createDataFrame([(p, p, t) for p, t in rows], "package_id string, path string, meta_text string"))
    got = lambda **o: {r["package_id"][-5]: r["releaseType"].split(":")[0] for r in N.check_release_type(kv, **o).collect()}
    assert got() == {"a": "gbopen", "b": "ERROR", "c": "ERROR"}
    assert got(release_types=["gbOpen", "UN_X"]) == {"a": "gbopen", "b": "un_x", "c": "ERROR"}
