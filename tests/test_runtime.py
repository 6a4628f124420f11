from pyspark.sql import functions as F

from boundaryspark import runtime as R
from boundaryspark.functions import scalars as S


def test_numbered_is_row_number(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1009).alias("k"), (F.col("id") % 3 == 0).alias("g"))
    got = R.numbered(df, "k", "n", ["g"], buckets=9).collect()
    for g in (True, False):
        rows = sorted((r["k"], r["n"]) for r in got if r["g"] == g)
        assert [n for _, n in rows] == list(range(1, len(rows) + 1))


def test_buckets_are_found_without_looking_through_all_cuts(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 3001).alias("k"))
    out = R.numbered(df, "k", "n", buckets=100)
    assert [r["n"] for r in out.orderBy("k").collect()] == list(range(1, 3001))
    assert "slice(" in out._jdf.queryExecution().analyzed().toString()


def test_spread_join_with_salts(spark, monkeypatch):
    monkeypatch.setattr(R, "BROADCAST_LIMIT_BYTES", -1)
    big = spark.range(500).select(F.lit(1).alias("k"), "id")
    small = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for how, rows in (("inner", 500), ("left", 500), ("left_semi", 500), ("left_anti", 0)):
        assert R.spread_join(big, small, ["k"], how, salts=5).count() == rows


def test_running_sums_over_chunks(spark):
    df = spark.range(100).select(F.lit("a").alias("g"), F.col("id").alias("seq"), F.lit(2).alias("v"))
    got = {r["seq"]: r["s"] for r in R.running_sums(df, ["g"], "seq", {"s": F.col("v")}, chunk=7).collect()}
    assert got == {i: 2 * (i + 1) for i in range(100)}


def test_dates(spark):
    texts = ["2024-12-18", "20241218", "2024/12/18", "Dec 18, 2024", "Wed Dec 18 10:12:38 2024", "Wed Dec  8 10:12:38 2024", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.date_format(S.parse_mixed_date("t"), "yyyy-MM-dd HH:mm")).collect()]
    assert got == ["2024-12-18 00:00"] * 4 + ["2024-12-18 10:12", "2024-12-08 10:12", None, None]


def test_local_time_follows_summer_time(spark):
    df = spark.sql("SELECT timestamp'2024-07-01 12:00:00' AS ts")
    assert df.select(S.to_local("ts")).first()[0] == "2024-07-01T08:00:00-04:00"


def test_decode_text_falls_back(spark):
    df = spark.createDataFrame([(bytearray("é".encode()),), (bytearray("é".encode("latin-1")),)], "b binary")
    assert [r[0] for r in df.select(S.decode_text("b")).collect()] == ["é", "é"]
