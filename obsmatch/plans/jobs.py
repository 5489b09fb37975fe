"""End-to-end jobs (JOB-1..3): what the reference runs per (year, department), here for lists of
both in one run.

* ``build_silver_accidents`` / ``build_silver_weather``: raw delimited files -> contract check ->
  cleaning -> zstd Parquet partitioned by (year, department), rows clustered within files, with
  the raw and kept row counts observed during the write (no second pass). Partitions that the run asked
  for and that came out empty are emptied.
* ``load_and_build_gold``: merge Silver into the versioned accident and weather tables (first
  load copies), then bring the Gold table to those versions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obsmatch.functions import zfill
from obsmatch.operators import quality_state
from obsmatch.plans import gold, silver
from obsmatch.schemas import ACCIDENT_ATTRS, ACCIDENT_KEYS, WEATHER_ATTRS, WEATHER_KEYS
from obsmatch.session import scratch_scope
from obsmatch.sources.delimited import read_delimited
from obsmatch.sources.layout import file_counts, landed_files, require_one
from obsmatch.sources.sinks import _FS, Conflict, VersionedTable, merge_into, write_partitioned


def _write_silver(
    raw: DataFrame, clean: Callable[[DataFrame], DataFrame], out: str, years: Sequence[int], departments: Sequence[str] | None, sort_within: list[str]
) -> dict[str, int]:
    """Replaces the (year, department) partitions of ``years`` (and ``departments``, or all) under ``out``."""
    read, kept = Observation("raw"), Observation("silver")
    parts = ["year", "department"]
    metrics = [F.count(F.lit(1)).alias("rows"), F.collect_set(F.concat_ws("/", *[F.col(c).cast("string") for c in parts])).alias("parts")]
    df = clean(raw.observe(read, F.count(F.lit(1)).alias("rows")))
    write_partitioned(df, out, parts, sort_within=sort_within, dynamic=True, observe=(kept, metrics))
    written = set(kept.get["parts"])  # one value a folder
    folder = _FS(raw.sparkSession, out)
    for year in years:
        here = _FS(raw.sparkSession, f"{out}/year={year}")
        for name in here.names():
            department = name.removeprefix("department=")
            asked = departments is None or department in departments
            if name.startswith("department=") and asked and f"{year}/{department}" not in written:
                folder.fs.delete(here.child(name), True)
    return {"bronze_rows": int(read.get["rows"]), "silver_rows": int(kept.get["rows"])}


def _departments(departments: str | Iterable[str] | None) -> list[str] | None:
    """The departments as folders and files name them, each once."""
    if departments is None:
        return None
    return list(dict.fromkeys(zfill(d) for d in ([departments] if isinstance(departments, str) else departments)))


def build_silver_accidents(
    spark: SparkSession,
    raw_paths: str | list[str] | Mapping[int, str | list[str]],
    out: str,
    year: int | None = None,
    departments: str | Iterable[str] | None = None,
    *,
    strict: bool = False,
) -> dict[str, int]:
    """JOB-1: the accident characteristics for the given departments, of ``year``, or of every year that
    ``raw_paths`` maps to its files. With ``strict`` each year must have exactly one file (SRC-5), else nothing is written."""
    by_year = {year: raw_paths} if year is not None else dict(raw_paths)
    wanted = _departments(departments)
    if strict:
        files = [
            spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select(F.lit(int(y)).alias("year"), "path") for y, paths in by_year.items()
        ]
        years = spark.createDataFrame([(int(y),) for y in by_year], "year int")
        require_one(file_counts(reduce(DataFrame.unionByName, files), ["year"], expected=years))
    raw = None
    for y, paths in by_year.items():
        one = read_delimited(spark, paths).withColumn("_year", F.lit(int(y)))
        raw = one if raw is None else raw.unionByName(one, allowMissingColumns=True)

    def clean(df: DataFrame) -> DataFrame:
        parts = [silver.accidents(df.where(F.col("_year") == int(y)).drop("_year"), wanted).withColumn("year", F.lit(int(y))) for y in by_year]
        return reduce(DataFrame.unionByName, parts)

    return _write_silver(raw, clean, out, list(by_year), wanted, ["accident_timestamp"])


def build_silver_weather(
    spark: SparkSession,
    raw_root: str,
    out: str,
    years: int | Iterable[int],
    departments: str | Iterable[str] | None = None,
    *,
    strict: bool = False,
) -> dict[str, int]:
    """JOB-2: hourly observations of ``years`` for every ``department=`` folder under ``raw_root``, or for those of
    ``departments``: other folders are neither opened nor replaced. With ``strict`` each department must have exactly one
    file (SRC-5), else nothing is written; otherwise a department without a folder has no rows."""
    wanted = [years] if isinstance(years, int) else list(years)
    deps = _departments(departments)
    if strict:
        asked = None if deps is None else spark.createDataFrame([(d,) for d in deps], "department string")
        landed = landed_files(spark, raw_root)
        require_one(file_counts(landed if deps is None else landed.where(F.col("department").isin(deps)), ["department"], expected=asked))
    roots: str | list[str] = raw_root
    if deps is not None:
        here = set(_FS(spark, raw_root).names())
        roots = [f"{raw_root.rstrip('/')}/department={d}" for d in deps if f"department={d}" in here]
        if not roots:
            raise FileNotFoundError(f"no folder of the departments {', '.join(deps)} under {raw_root}")
    raw = read_delimited(spark, roots, base_path=raw_root, min_partitions=spark.sparkContext.defaultParallelism)

    def clean(df: DataFrame) -> DataFrame:
        return silver.weather(df, wanted).withColumn("year", F.year("observation_timestamp"))

    return _write_silver(raw, clean, out, wanted, deps, ["station_id", "observation_timestamp"])


def load_and_build_gold(
    spark: SparkSession,
    silver_accidents: DataFrame,
    silver_weather: DataFrame,
    accidents_table: str,
    weather_table: str,
    gold_table: str,
    *,
    incremental: bool = True,
    metrics_table: str | None = None,
) -> dict[str, dict[str, int] | int | str | None]:
    """JOB-3: incremental loads of both Silver tables, then the Gold table.

    Every Gold version names the accident and weather versions it was built from, and reads exactly those. If those are
    the current ones after the loads, Gold is left as it is. Otherwise, with ``incremental``, the rows that merges inserted
    or updated since -- by this run, by one that died before Gold, or by another writer -- are read from the versions
    in between, and only the accidents they can affect are computed anew (``gold.refresh``, equal to a full rebuild; their
    number is returned). Gold is rebuilt in full only where there is none or where one of those versions is gone. If another
    run publishes a Gold version meanwhile, this one looks again at what is current.

    With ``metrics_table`` the state of the quality checks (``quality_state``) follows Gold: only the buckets of the ids that
    were computed anew are counted again, or all where the state is not that of the Gold version before.
    """
    acc = VersionedTable(spark, accidents_table)
    wea = VersionedTable(spark, weather_table)
    g = VersionedTable(spark, gold_table)
    out = {
        "accidents": merge_into(acc, silver_accidents.select(*ACCIDENT_KEYS, *ACCIDENT_ATTRS), ACCIDENT_KEYS, ACCIDENT_ATTRS),
        "weather": merge_into(wea, silver_weather.select(*WEATHER_KEYS, *WEATHER_ATTRS), WEATHER_KEYS, WEATHER_ATTRS),
    }
    while True:
        with scratch_scope(spark):
            base = g.version()
            built = g.sources(base) if base is not None else None
            now = {"accidents": acc.version(), "weather": wea.version()}
            if built == now:
                out = out | {"gold_version": base, "gold": "unchanged", "recomputed": 0}
                return out if metrics_table is None else out | {"metrics": _follow(spark, metrics_table, g, base)}
            accidents, weather = acc.read(now["accidents"]), wea.read(now["weather"])
            since = [_since(t, built, now, n) for t, n in ((acc, "accidents"), (wea, "weather"))] if incremental and built else [None]
            if all(c is not None for c in since):
                new_gold, ids, recomputed = gold.refresh_with_ids(g.read(base), accidents, weather, *since, wea.read(built["weather"]))
                mode = "refreshed"
            else:
                new_gold, ids, recomputed = gold.accident_weather(accidents, weather), None, None
                mode = "rebuilt"
            try:
                version = g.replace(new_gold, now, base)
            except Conflict:
                continue
            out = out | {"gold_version": version, "gold": mode, "recomputed": recomputed}
            return out if metrics_table is None else out | {"metrics": _follow(spark, metrics_table, g, version, base, ids)}


def _follow(spark: SparkSession, path: str, gold_table: VersionedTable, version: int, base: int | None = None, changed_ids: DataFrame | None = None) -> str:
    """Brings the state of the quality checks to a Gold version: ``unchanged``, ``refreshed`` or ``rebuilt``.

    A run that died between Gold and its state leaves an older state, which the next run rebuilds."""
    table = VersionedTable(spark, path)
    while True:
        at = table.version()
        built = (table.sources(at) or {}) if at is not None else {}
        same = built.get("buckets") == quality_state.BUCKETS
        if same and built["gold"] >= version:  # or another run is ahead
            return "unchanged"
        if same and built["gold"] == base and changed_ids is not None:
            state, mode = quality_state.refresh(table.read(at), gold_table.read(version), changed_ids, "_aid"), "refreshed"
        else:
            state, mode = quality_state.partials(gold_table.read(version)), "rebuilt"
        try:
            table.replace(state, {"gold": version, "buckets": quality_state.BUCKETS}, at)
        except Conflict:
            continue
        return mode


def _since(table: VersionedTable, built: Mapping[str, int], now: Mapping[str, int], name: str) -> DataFrame | None:
    """The rows changed between two versions; None if that is not known."""
    if built.get(name) is None or built[name] > now[name] or built[name] not in table.versions():
        return None
    if built[name] == now[name]:
        return table.read(now[name]).limit(0)
    return table.changes(built[name], now[name])
