"""Registered queries: catalog selection, landed files (CSV, gzip, layout, Parquet) and the
raw-file profile (SRC-*, SNK-1, FIL-6..9, LIM-1, PRF-1/2, FN-13/14).

Queries that land files write them to a fresh folder under the session's shared checkpoint
folder and read them back, so they run the real readers and writers on the driver's data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmatch.functions.expr import url_filename
from obsmatch.operators import profile
from obsmatch.plans import oracle as O
from obsmatch.plans.registry import register, sub, with_sql
from obsmatch.schemas import WEATHER_RAW_COLUMNS
from obsmatch.session import materialize, scratch_path
from obsmatch.sources import catalog as C
from obsmatch.sources import layout
from obsmatch.sources.delimited import read_delimited, write_delimited
from obsmatch.sources.sinks import write_partitioned

# Parameters of the registered runs.
ACCIDENT_YEARS = range(2000, 2025)
WEATHER_YEARS = (1995, 2000, 2005, 2010, 2015, 2020, 2025)
WEATHER_DEPARTMENTS = [f"{d:02d}" for d in range(13)]
CONTAINS, FORMAT, TOP_N = "departement", "csv", 20

RES_SQL = "res AS (SELECT id, coalesce(nullif(title, ''), nullif(name, ''), '') AS title, format, url FROM CAT)"


def catalog_df(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog substrate as resource rows (title resolved like ``resources``)."""
    (cat,) = sub(spark, sf, "CAT")
    return cat.select(
        "id", C.first_non_empty("title", "name").alias("title"), "format",
        F.lit(None).cast("bigint").alias("filesize"), F.lit(None).cast("string").alias("last_modified"), "url",
    )


@register(
    "catalog_resources",
    with_sql(("CAT",))
    + """SELECT cast(id AS varchar) AS id, coalesce(nullif(title, ''), nullif(name, ''), '') AS title, format,
       cast(NULL AS bigint) AS filesize, cast(NULL AS varchar) AS last_modified, url FROM CAT""",
)
def catalog_resources(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-7: catalog JSON (datasets of at most 100 resources) written, read back and exploded."""
    (cat,) = sub(spark, sf, "CAT")
    path = scratch_path(spark, "catalog")
    docs = cat.groupBy(F.floor(F.col("id") / 100).alias("chunk")).agg(
        F.collect_list(
            F.struct(F.col("id").cast("string").alias("id"), "title", "name", "format", "url")
        ).alias("resources")
    )
    docs.select(F.concat(F.lit("datasets "), F.col("chunk").cast("string")).alias("title"), "resources").write.json(path)
    return C.read_catalog(spark, path)


@register(
    "catalog_filter",
    with_sql(("CAT",), RES_SQL)
    + f"""SELECT id, title, format, cast(NULL AS bigint) AS filesize, cast(NULL AS varchar) AS last_modified, url FROM res
WHERE contains(lower(title), '{CONTAINS}') AND lower(format) = '{FORMAT}'""",
)
def catalog_filter(spark: SparkSession, sf: str) -> DataFrame:
    """FIL-6/7: title substring and format, both case-insensitive."""
    return C.filter_resources(catalog_df(spark, sf), CONTAINS, FORMAT).select(*C.RESOURCE_COLUMNS)


@register(
    "catalog_explore",
    with_sql(("CAT",), RES_SQL)
    + f"""SELECT id, title, format, cast(NULL AS bigint) AS filesize, cast(NULL AS varchar) AS last_modified, url FROM res
WHERE contains(lower(title), '{CONTAINS}') AND lower(format) = '{FORMAT}' ORDER BY id LIMIT {TOP_N}""",
)
def catalog_explore(spark: SparkSession, sf: str) -> DataFrame:
    """PRF-2: filter, six columns and limit in one."""
    return C.explore(catalog_df(spark, sf), CONTAINS, FORMAT, TOP_N)


@register(
    "catalog_top",
    with_sql(("CAT",), RES_SQL)
    + f"""SELECT id, title, format, cast(NULL AS bigint) AS filesize, cast(NULL AS varchar) AS last_modified, url
FROM res ORDER BY id LIMIT {TOP_N}""",
)
def catalog_top(spark: SparkSession, sf: str) -> DataFrame:
    """LIM-1: the first resources, by id."""
    return C.top(catalog_df(spark, sf), TOP_N)


_ALIAS_SQL = " OR ".join(
    "(r.resource_type = '{t}' AND ({cond}){excl})".format(
        t=t,
        cond=" OR ".join(f"contains(s.lt, '{a}')" for a in aliases),
        excl=f" AND NOT contains(s.lt, '{C.VEHICLE_EXCLUSION}')" if t == "vehicules" else "",
    )
    for t, aliases in C.BAAC_ALIASES.items()
)
_TYPES_SQL = ", ".join(f"('{t}')" for t in C.BAAC_ALIASES)


@register(
    "catalog_pick_accidents",
    with_sql(("CAT",), RES_SQL)
    + f""", req AS (SELECT cast(y AS integer) AS year, t AS resource_type
             FROM range({ACCIDENT_YEARS.start}, {ACCIDENT_YEARS.stop}) r(y) CROSS JOIN (VALUES {_TYPES_SQL}) v(t)),
lres AS (SELECT id, lower(title) AS lt FROM res),
m AS (SELECT r.year, r.resource_type, s.id FROM req r JOIN lres s
      ON contains(s.lt, cast(r.year AS varchar)) AND ({_ALIAS_SQL}))
SELECT r.year, r.resource_type, cast(count(m.id) AS bigint) AS candidates,
       CASE WHEN count(m.id) = 1 THEN min(m.id) END AS resource_id
FROM req r LEFT JOIN m ON r.year = m.year AND r.resource_type = m.resource_type
GROUP BY r.year, r.resource_type""",
)
def catalog_pick_accidents(spark: SparkSession, sf: str) -> DataFrame:
    """FIL-8: candidates per (year, resource type) request, and the pick when unique."""
    reqs = C.accident_requests(spark, ACCIDENT_YEARS)
    return C.pick_accident_resources(catalog_df(spark, sf), reqs)


_YEARS_SQL = ", ".join(f"({y})" for y in WEATHER_YEARS)


@register(
    "catalog_pick_weather",
    with_sql(("CAT",), RES_SQL)
    + f""", req AS (SELECT cast(y AS integer) AS year, lpad(cast(d AS varchar), 2, '0') AS department
             FROM (VALUES {_YEARS_SQL}) ys(y) CROSS JOIN range(0, {len(WEATHER_DEPARTMENTS)}) ds(d)),
m AS (SELECT r.year, r.department, s.id FROM req r JOIN res s
      ON regexp_matches(s.title, '(?i)hor_departement_' || r.department || '_periode_([0-9]{{4}})-([0-9]{{4}})')
     AND r.year BETWEEN TRY_CAST(regexp_extract(s.title, '(?i)hor_departement_' || r.department || '_periode_([0-9]{{4}})-([0-9]{{4}})', 1) AS integer)
                    AND TRY_CAST(regexp_extract(s.title, '(?i)hor_departement_' || r.department || '_periode_([0-9]{{4}})-([0-9]{{4}})', 2) AS integer))
SELECT r.year, r.department, cast(count(m.id) AS bigint) AS candidates,
       CASE WHEN count(m.id) = 1 THEN min(m.id) END AS resource_id
FROM req r LEFT JOIN m ON r.year = m.year AND r.department = m.department
GROUP BY r.year, r.department""",
)
def catalog_pick_weather(spark: SparkSession, sf: str) -> DataFrame:
    """FIL-9: candidates per (year, department) request, and the pick when unique."""
    reqs = C.weather_requests(spark, WEATHER_YEARS, WEATHER_DEPARTMENTS)
    return C.pick_weather_resources(catalog_df(spark, sf), reqs)


@register(
    "fn_regex_period",
    with_sql(("CAT",), RES_SQL)
    + "SELECT id, nullif(regexp_extract(title, '(?i)periode_([0-9]{4}-[0-9]{4})', 1), '') AS period FROM res",
)
def fn_regex_period(spark: SparkSession, sf: str) -> DataFrame:
    return catalog_df(spark, sf).select("id", C.weather_period(F.col("title")).alias("period"))


@register(
    "fn_url_filename",
    with_sql(("CAT",))
    + """SELECT id, url, nullif(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1),
                                      '([^/]*)$', 1), '') AS file_name FROM CAT""",
)
def fn_url_filename(spark: SparkSession, sf: str) -> DataFrame:
    (cat,) = sub(spark, sf, "CAT")
    return cat.select("id", "url", url_filename("url").alias("file_name"))


# ---------------------------------------------------------------- landed raw weather files

_W_RAW_NULLED = ", ".join(f"nullif({c}, '') AS {c}" for c in WEATHER_RAW_COLUMNS)


def _csv_roundtrip(spark: SparkSession, sf: str, name: str, compression: str | None) -> DataFrame:
    (raw,) = sub(spark, sf, "W_RAW")
    root = scratch_path(spark, name)
    first = F.col("NUM_POSTE") < F.lit("00000025")
    write_delimited(raw.where(first), f"{root}/a", compression=compression)
    write_delimited(raw.where(~first).select(*reversed(raw.columns)), f"{root}/b", compression=compression)
    return read_delimited(spark, root).select(*WEATHER_RAW_COLUMNS)


@register("csv_scan", with_sql(("W_RAW",)) + f"SELECT {_W_RAW_NULLED} FROM W_RAW")
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1/3: ';' files with two column orders, read as strings and unioned by name."""
    return _csv_roundtrip(spark, sf, "csv", None)


@register("csv_scan_gz", with_sql(("W_RAW",)) + f"SELECT {_W_RAW_NULLED} FROM W_RAW")
def csv_scan_gz(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-2: the same files gzip-compressed."""
    return _csv_roundtrip(spark, sf, "csvgz", "gzip")


_LAYOUT_SQL = (
    "substr(NUM_POSTE, 7, 2) AS department, substr(AAAAMMJJHH, 1, 3) || '0-' || substr(AAAAMMJJHH, 1, 3) || '9' AS period"
)


def _land_layout(spark: SparkSession, sf: str) -> str:
    (raw,) = sub(spark, sf, "W_RAW")
    root = scratch_path(spark, "bronze")
    y3 = F.substring("AAAAMMJJHH", 1, 3)
    landed = raw.withColumns(
        {
            "department": F.substring("NUM_POSTE", 7, 2),
            "period": F.concat(y3, F.lit("0-"), y3, F.lit("9")),
        }
    )
    write_delimited(landed, root, partition_cols=["department", "period"])
    return root


@register("bronze_layout", with_sql(("W_RAW",)) + f"SELECT {_W_RAW_NULLED}, {_LAYOUT_SQL} FROM W_RAW")
def bronze_layout(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-4: department=/period= folders; partition values come back as strings ('01')."""
    root = _land_layout(spark, sf)
    return read_delimited(spark, root, base_path=root)


@register(
    "source_file_counts",
    with_sql(("W_RAW",)) + f"SELECT DISTINCT {_LAYOUT_SQL}, cast(1 AS bigint) AS files FROM W_RAW",
)
def source_file_counts(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-5: objects per (department, period); the writer lands exactly one per partition."""
    root = _land_layout(spark, sf)
    return layout.file_counts(layout.landed_files(spark, root), ["department", "period"], strict=True)


@register(
    "source_file_counts_requested",
    with_sql(("W_RAW",))
    + f"""SELECT department, period, cast(CASE WHEN cast(department AS integer) % 2 = 0 THEN 2 ELSE 1 END AS bigint) AS files
FROM (SELECT DISTINCT {_LAYOUT_SQL} FROM W_RAW)
UNION ALL SELECT DISTINCT substr(NUM_POSTE, 7, 2), '1900-1909', cast(0 AS bigint) FROM W_RAW""",
)
def source_file_counts_requested(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-5 with none, one and two objects: even departments land a second time, and a period is asked for that none has."""
    root = _land_layout(spark, sf)
    once = read_delimited(spark, root, base_path=root)
    requests = once.select("department", "period").distinct()
    requests = requests.unionByName(once.select("department", F.lit("1900-1909").alias("period")).distinct())
    asked = materialize(requests, "requests")
    again = materialize(once.where(F.col("department").cast("int") % 2 == 0), "second_landing")
    write_delimited(again, root, partition_cols=["department", "period"], mode="append")
    return layout.file_counts(layout.landed_files(spark, root), ["department", "period"], expected=asked)


_FILE_SQL = "nullif(regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1), '')"


@register(
    "source_lineage",
    with_sql(("CAT",), RES_SQL)
    + f"""SELECT {_FILE_SQL} AS resource, lpad(cast(id % 7 AS varchar), 2, '0') AS department, id, title, url
FROM res WHERE {_FILE_SQL} IS NOT NULL""",
)
def source_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-6: landed objects joined back to the catalog resource they came from, by folder and file name."""
    cat = catalog_df(spark, sf).withColumn("department", F.lpad((F.col("id") % 7).cast("string"), 2, "0"))
    root = scratch_path(spark, "landed")
    landed = cat.select("department", url_filename("url").alias("resource"), F.col("id").cast("string").alias("body")).where(F.col("resource").isNotNull())
    write_delimited(landed.distinct(), root, partition_cols=["department", "resource"])
    files = layout.landed_files(spark, root)
    return layout.lineage(files, cat, file_key="resource", keys=["department"]).select("resource", files["department"], "id", "title", "url").distinct()


@register("parquet_roundtrip", with_sql(("W",)) + "SELECT * FROM W")
def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-1: zstd Parquet partitioned by department, clustered by station and hour, read back."""
    (w,) = sub(spark, sf, "W")
    path = scratch_path(spark, "silver_weather")
    write_partitioned(w, path, ["department"], sort_within=["station_id", "observation_timestamp"])
    return spark.read.parquet(path)


# ---------------------------------------------------------------- profile of the raw weather rows

_CANDS = [c for c in ("RR1", "FF", "DD", "T")]


@register("profile_stations", with_sql(("W_RAW",)) + "SELECT DISTINCT NUM_POSTE, NOM_USUEL, LAT, LON FROM W_RAW")
def profile_stations(spark: SparkSession, sf: str) -> DataFrame:
    (raw,) = sub(spark, sf, "W_RAW")
    return profile.stations(raw)


@register(
    "profile_date_range",
    with_sql(("W_RAW",)) + "SELECT min(AAAAMMJJHH) AS min_date, max(AAAAMMJJHH) AS max_date FROM W_RAW",
)
def profile_date_range(spark: SparkSession, sf: str) -> DataFrame:
    (raw,) = sub(spark, sf, "W_RAW")
    return profile.date_range(raw)


@register(
    "profile_non_null",
    with_sql(("W_RAW",)) + "SELECT " + ", ".join(f"count(nullif({c}, '')) AS {c}" for c in _CANDS) + " FROM W_RAW",
)
def profile_non_null(spark: SparkSession, sf: str) -> DataFrame:
    (raw,) = sub(spark, sf, "W_RAW")
    return profile.non_null_counts(raw)


@register(
    "profile_null_pct",
    with_sql(("W_RAW",))
    + "SELECT "
    + ", ".join(
        O.spark_round(f"avg(CASE WHEN nullif({c}, '') IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE * 100", 2) + f" AS {c}"
        for c in _CANDS
    )
    + " FROM W_RAW",
)
def profile_null_pct(spark: SparkSession, sf: str) -> DataFrame:
    (raw,) = sub(spark, sf, "W_RAW")
    return profile.null_percentages(raw)


@register("profile_shape", with_sql(("W_RAW",)) + f"SELECT count(*) AS rows, {len(WEATHER_RAW_COLUMNS)} AS columns FROM W_RAW")
def profile_shape(spark: SparkSession, sf: str) -> DataFrame:
    (raw,) = sub(spark, sf, "W_RAW")
    return profile.shape(raw)
