import datetime as dt


from obsmatch.functions import expr as X
from obsmatch.plans import silver


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_clean_time(spark):
    rows = ["900", "9:05", " 09:05 ", "", None, "12345"]
    df = spark.createDataFrame([(r,) for r in rows], "v string").select(X.clean_time("v").alias("r"))
    assert [r["r"] for r in df.collect()] == ["0900", "0905", "0905", "0000", None, "12345"]


def test_accident_timestamp(spark):
    rows = [("2024", "1", "5", "900"), ("2024", "1", "5", "12345"), ("2024", "1", "5", "2400"), ("2024", "2", "30", "0900"),
            ("2024", "1", "5", " 09:05 ")]
    df = spark.createDataFrame(rows, "an string, mois string, jour string, hrmn string")
    got = [r["t"] for r in df.select(silver.accident_timestamp().alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 5, 9, 0), None, None, None, dt.datetime(2024, 1, 5, 9, 5)]


def test_decimal_comma_and_safe_casts(spark):
    assert one(spark, X.decimal_comma("v"), "\t48,85\n") == 48.85
    for text in ("n/a", "1.0d", "NaN", "1_000", "Infinity", ""):
        assert one(spark, X.to_double("v"), text) is None
    assert one(spark, X.to_long("v"), "1.0") is None
    assert one(spark, X.to_long("v"), " -1") is None
    assert one(spark, X.to_long("v"), "-1") == -1


def test_zfill():
    assert [X.zfill(d) for d in ("1", "2A", "971", 5)] == ["01", "2A", "971", "05"]


def test_minutes_truncate_toward_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 0, 30), dt.datetime(2024, 1, 1, 9, 0))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(X.minutes_between("a", "b").alias("m"), X.minutes_between("b", "a").alias("n")).first()
    assert (r["m"], r["n"]) == (-60, 60)


def test_hour_index_negative(spark):
    df = spark.createDataFrame([(dt.datetime(1969, 12, 31, 23, 59, 59),), (dt.datetime(1970, 1, 1, 1, 0),)], "t timestamp_ntz")
    assert [r["h"] for r in df.select(X.hour_index("t").alias("h")).collect()] == [-1, 1]


def test_url_filename(spark):
    assert one(spark, X.url_filename("v"), "https://x.org/a/b/file.csv.gz?x=1") == "file.csv.gz"
    assert one(spark, X.url_filename("v"), "https://x.org/") is None


def test_ntz_literal_is_zone_free(spark):
    v = dt.datetime(2024, 3, 31, 2, 30, 15)
    r = spark.range(1).select(X.ntz_literal(v).alias("t")).first()["t"]
    assert r == v
    assert dict(spark.range(1).select(X.ntz_literal(v).alias("t")).dtypes)["t"] == "timestamp_ntz"
