"""Column contracts between the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions.logic import require


TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "array<float>": T.ArrayType(T.FloatType()),
}


def _schema(text: str) -> T.StructType:
    """``name type`` pairs, one per line; a trailing ``!`` means not nullable."""
    fields = []
    for line in text.strip().splitlines():
        name, kind = line.split()
        fields.append(T.StructField(name, TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


# The columns of each table.
TRIP_FILE = _schema(
    """
    ride_id string
    rideable_type string
    started_at timestamp
    ended_at timestamp
    start_station_name string
    start_station_id string
    end_station_name string
    end_station_id string
    start_lat double
    start_lng double
    end_lat double
    end_lng double
    member_casual string
    """
)
BRONZE_TRIPS = T.StructType(
    [*TRIP_FILE.fields, *_schema("_source_file string\n_ingested_at timestamp").fields]
)
BRONZE_WEATHER = _schema(
    """
    observation_time timestamp
    temperature_c double
    precipitation_mm double
    wind_speed_kmh double
    weather_code int
    is_daylight boolean
    _ingested_at timestamp
    """
)
SILVER_TRIPS = _schema(
    """
    ride_id string!
    rideable_type string!
    started_at timestamp_ntz!
    ended_at timestamp_ntz!
    start_date date!
    start_hour int!
    day_of_week string!
    ride_duration_minutes double!
    start_station_name string
    start_station_id string
    end_station_name string
    end_station_id string
    start_lat double!
    start_lng double!
    end_lat double
    end_lng double
    member_casual string!
    _source_file string!
    _ingested_at timestamp!
    """
)
SILVER_WEATHER = _schema(
    """
    observation_time timestamp_ntz!
    temperature_c double!
    precipitation_mm double!
    wind_speed_kmh double!
    weather_code int!
    is_daylight boolean!
    _ingested_at timestamp!
    """
)
STATION_HISTORY = _schema(
    """
    station_id string!
    station_name string!
    latitude double!
    longitude double!
    dbt_scd_id string!
    dbt_updated_at timestamp_ntz!
    dbt_valid_from timestamp_ntz!
    dbt_valid_to timestamp_ntz
    """
)
MEMORY = _schema(
    """
    id string!
    question string!
    query string!
    embedding array<float>!
    created_at timestamp!
    """
)


def read_contract(df: DataFrame, contract: T.StructType, *, enforce: bool = False) -> DataFrame:
    """The contract's columns, in its order and types.

    A missing column is an error at once.  With ``enforce``, a NULL in a column
    declared not nullable fails the job; without, use ``contract_checks``.
    """
    return df.select(
        *[
            (require(f.name, f.name) if enforce and not f.nullable else F.col(f.name))
            .cast(f.dataType)
            .alias(f.name)
            for f in contract.fields
        ]
    )


def required_columns(contract: T.StructType) -> list[str]:
    return [f.name for f in contract.fields if not f.nullable]
