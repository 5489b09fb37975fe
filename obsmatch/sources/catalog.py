"""Resource catalogs (SRC-7, FIL-6..9, FN-12/13, LIM-1).

A catalog is JSON: one dataset object ``{title, resources: [{id, title, name, format, filesize,
last_modified, url}, ...]}`` per line, or one multi-line document. Resources are exploded into
rows; the selection rules of the reference become column predicates and equi-joins, so any
number of requests is answered in one job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsmatch.functions.expr import first_non_empty, zfill

RESOURCE_TYPE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("filesize", T.LongType()),
        T.StructField("last_modified", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)
CATALOG_SCHEMA = T.StructType(
    [T.StructField("title", T.StringType()), T.StructField("resources", T.ArrayType(RESOURCE_TYPE))]
)
RESOURCE_COLUMNS = ["id", "title", "format", "filesize", "last_modified", "url"]

# Fixed values of the reference: accident resource types, their title aliases, and the
# vehicle-registration resources excluded from the "vehicules" type.
BAAC_ALIASES: dict[str, tuple[str, ...]] = {
    "caract": ("caract", "caracteristiques"),
    "lieux": ("lieux",),
    "vehicules": ("vehicules",),
    "usagers": ("usagers",),
}
VEHICLE_EXCLUSION = "immatricul"
WEATHER_TITLE = r"(?i)hor_departement_([^_]+)_periode_([0-9]{4})-([0-9]{4})"
PERIOD = r"(?i)periode_([0-9]{4}-[0-9]{4})"


def resources(datasets: DataFrame) -> DataFrame:
    """SRC-7: one row per resource; title falls back to name, then ''."""
    r = datasets.select(F.explode("resources").alias("r")).select("r.*")
    return r.select(
        "id",
        first_non_empty("title", "name").alias("title"),
        "format",
        "filesize",
        "last_modified",
        "url",
    )


def read_catalog(spark: SparkSession, path: str, *, multiline: bool = False) -> DataFrame:
    datasets = spark.read.schema(CATALOG_SCHEMA).option("multiLine", multiline).json(path)
    return resources(datasets)


def filter_resources(df: DataFrame, contains: str | None = None, file_format: str | None = None) -> DataFrame:
    """FIL-6/7: case-insensitive literal substring on the title, case-insensitive format."""
    if contains:
        df = df.where(F.lower("title").contains(contains.lower()))
    if file_format:
        df = df.where(F.lower("format") == file_format.lower())
    return df


def top(df: DataFrame, n: int = 20) -> DataFrame:
    """LIM-1 with a stable order."""
    return df.select(*RESOURCE_COLUMNS).orderBy("id").limit(n)


def explore(df: DataFrame, contains: str | None = None, file_format: str | None = None, n: int = 20) -> DataFrame:
    """PRF-2: the first resources, by id, whose title and format fit: filter, six columns, limit."""
    return top(filter_resources(df, contains, file_format), n)


def weather_period(title: Column) -> Column:
    """FN-13: ``YYYY-YYYY`` after ``periode_``; null when absent."""
    return F.nullif(F.regexp_extract(title, PERIOD, 1), F.lit(""))


def _types_of(title: Column) -> Column:
    low = F.lower(title)
    hits = []
    for rtype, aliases in BAAC_ALIASES.items():
        cond = F.lit(False)
        for alias in aliases:
            cond = cond | low.contains(alias)
        if rtype == "vehicules":
            cond = cond & ~low.contains(VEHICLE_EXCLUSION)
        hits.append(F.when(cond, F.lit(rtype)))
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def pick_accident_resources(catalog: DataFrame, requests: DataFrame) -> DataFrame:
    """FIL-8 for many requests ``(year int, resource_type)``: candidate count and, when there is
    exactly one, its id. A year matches as a substring of the title (SURVEY Q18), found through
    the title's digit windows so the match is an equi-join, not a cross join."""
    # The title's runs (overlapping) of as many characters as some requested year has, as text: the
    # year request matches when its decimal form is one of them. Widths are a handful of numbers.
    widths = [r[0] for r in requests.select(F.length(F.col("year").cast("string")).alias("n")).where("n > 0").distinct().collect()]
    windows = [F.regexp_extract_all(F.col("title"), F.lit(f"(?=([-0-9]{{{n}}}))"), 1) for n in sorted(widths)]
    years = F.array_distinct(F.flatten(F.array(*windows))) if windows else F.array().cast("array<string>")
    cand = catalog.select(
        "id", "title", F.explode(years).alias("y"), _types_of(F.col("title")).alias("types")
    ).select("id", "title", F.col("y").alias("year_text"), F.explode("types").alias("resource_type"))
    requests = requests.withColumn("year_text", F.col("year").cast("string"))
    per = cand.groupBy("year_text", "resource_type").agg(
        F.count(F.lit(1)).alias("candidates"), F.min("id").alias("_id")
    )
    return requests.join(per, ["year_text", "resource_type"], "left").select(
        "year",
        "resource_type",
        F.coalesce("candidates", F.lit(0)).alias("candidates"),
        F.when(F.col("candidates") == 1, F.col("_id")).alias("resource_id"),
    )


def pick_weather_resources(catalog: DataFrame, requests: DataFrame) -> DataFrame:
    """FIL-9 for many requests ``(year int, department)``: resources whose title names the
    department and a period ``start-end`` with start <= year <= end."""
    named = [F.regexp_extract_all(F.col("title"), F.lit(WEATHER_TITLE), k) for k in (1, 2, 3)]
    found = catalog.select("id", F.posexplode(F.arrays_zip(*[c.alias(n) for c, n in zip(named, ("dep", "p0", "p1"), strict=True)])).alias("at", "f"))
    # A title may name several departments; of a department named twice the first period counts.
    found = found.select("id", "at", F.lower("f.dep").alias("dep"), "f.p0", "f.p1")
    cand = found.groupBy("id", "dep").agg(F.min(F.struct("at", "p0", "p1")).alias("f")).select("id", "dep", "f.p0", "f.p1")
    req = requests.select("year", "department", F.lower("department").alias("dep"))
    joined = req.join(cand, "dep").where(F.col("year").between(F.col("p0").cast("int"), F.col("p1").cast("int")))
    per = joined.groupBy("year", "department").agg(F.count(F.lit(1)).alias("candidates"), F.min("id").alias("_id"))
    return requests.join(per, ["year", "department"], "left").select(
        "year",
        "department",
        F.coalesce("candidates", F.lit(0)).alias("candidates"),
        F.when(F.col("candidates") == 1, F.col("_id")).alias("resource_id"),
    )


def require_single(picks: DataFrame) -> DataFrame:
    """The reference's guard: a request with no or several candidates raises when evaluated."""
    return picks.withColumn(
        "resource_id",
        F.when(F.col("candidates") != 1, F.raise_error(F.lit("no or several resources for a request"))).otherwise(
            F.col("resource_id")
        ),
    )


def weather_requests(spark: SparkSession, years: Iterable[int], departments: Iterable[str]) -> DataFrame:
    rows = [(int(y), zfill(d)) for y in years for d in departments]
    return spark.createDataFrame(rows, "year int, department string")


def accident_requests(spark: SparkSession, years: Iterable[int], types: Iterable[str] | None = None) -> DataFrame:
    types = list(types or BAAC_ALIASES)
    for t in types:
        if t not in BAAC_ALIASES:
            raise ValueError(f"no accident resource is called {t!r}; there are {sorted(BAAC_ALIASES)}")
    return spark.createDataFrame([(int(y), t) for y in years for t in types], "year int, resource_type string")
