"""Column contracts and table schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The raw columns each Silver job requires, in the reference's order.
ACCIDENT_RAW_COLUMNS = ["Num_Acc", "jour", "mois", "an", "hrmn", "lum", "dep", "com", "atm", "col", "lat", "long"]
WEATHER_RAW_COLUMNS = ["NUM_POSTE", "NOM_USUEL", "LAT", "LON", "AAAAMMJJHH", "T", "RR1", "FF", "DD"]
# Optional raw weather measures looked at by the profile job.
CANDIDATE_WEATHER_COLUMNS = ["RR1", "FF", "DD", "T", "U", "VV", "WW"]

# The columns of the Silver and Gold tables, in the reference's order.
ACCIDENT_COLUMNS = [
    "accident_id",
    "accident_timestamp",
    "department",
    "city",
    "latitude",
    "longitude",
    "atmospheric_condition",
    "luminosity",
    "collision_type",
]
WEATHER_VALUES = ["temperature", "rainfall_1h", "wind_speed", "wind_direction"]
WEATHER_COLUMNS = [
    "station_id",
    "station_name",
    "department",
    "observation_timestamp",
    "latitude",
    "longitude",
    *WEATHER_VALUES,
]
GOLD_COLUMNS = [
    *ACCIDENT_COLUMNS,
    "station_id",
    "station_name",
    "distance_to_station_m",
    "weather_timestamp",
    *WEATHER_VALUES,
    "weather_time_difference_minutes",
]

ACCIDENT_KEYS = ["accident_id"]
ACCIDENT_ATTRS = ACCIDENT_COLUMNS[1:]
WEATHER_KEYS = ["station_id", "observation_timestamp"]
WEATHER_ATTRS = [c for c in WEATHER_COLUMNS if c not in WEATHER_KEYS]

ACCIDENTS_SCHEMA = T.StructType(
    [
        T.StructField("accident_id", T.StringType()),
        T.StructField("accident_timestamp", T.TimestampNTZType()),
        T.StructField("department", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("atmospheric_condition", T.LongType()),
        T.StructField("luminosity", T.LongType()),
        T.StructField("collision_type", T.LongType()),
    ]
)
WEATHER_SCHEMA = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("observation_timestamp", T.TimestampNTZType()),
        *[T.StructField(c, T.DoubleType()) for c in ("latitude", "longitude", *WEATHER_VALUES)],
    ]
)


class ContractBroken(ValueError):
    """A raw table lacks columns that its contract promises; ``absent`` names them."""

    def __init__(self, contract: RawContract, absent: tuple[str, ...]):
        self.contract, self.absent = contract, absent
        super().__init__(f"{contract.table} lacks {len(absent)} of its {len(contract.columns)} contract columns: {', '.join(absent)}")


@dataclass(frozen=True)
class RawContract:
    """The columns a raw table must have, by exact name (Spark's resolver would ignore case). Checked on the schema alone."""

    table: str
    columns: tuple[str, ...]

    def enforce(self, df: DataFrame) -> DataFrame:
        absent = tuple(c for c in self.columns if c not in df.columns)
        if absent:
            raise ContractBroken(self, absent)
        return df


ACCIDENT_CONTRACT = RawContract("raw accident characteristics", tuple(ACCIDENT_RAW_COLUMNS))
WEATHER_CONTRACT = RawContract("raw hourly weather observations", tuple(WEATHER_RAW_COLUMNS))
