"""Fixed schemas at every boundary of the library.

Observation times are wall-clock and zone-free (``TimestampNTZType``), ingestion
times are instants (``TimestampType``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field name in a payload -> column name in the tables.
API_FIELDS = {
    "pm2_5": "pm2_5",
    "pm10": "pm10",
    "nitrogen_dioxide": "no2",
    "sulphur_dioxide": "so2",
    "ozone": "o3",
    "carbon_monoxide": "co",
}

POLLUTANTS = tuple(API_FIELDS.values())

# Fixed value: the unit every payload field must carry (Greek mu, U+03BC).
EXPECTED_UNIT = "μg/m³"


# Names, order and types of the raw and the fact columns.
RAW = T.StructType(
    [
        T.StructField("city_id", T.StringType()),
        T.StructField("observed_at", T.TimestampNTZType()),
        T.StructField("pm2_5", T.DoubleType()),
        T.StructField("pm10", T.DoubleType()),
        T.StructField("no2", T.DoubleType()),
        T.StructField("so2", T.DoubleType()),
        T.StructField("o3", T.DoubleType()),
        T.StructField("co", T.DoubleType()),
        T.StructField("source", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
    ]
)

# What the lake files are read with: `date` is the partition folder.
LAKE = T.StructType([*RAW.fields, T.StructField("date", T.DateType())])

HOURLY_BLOCK = T.StructType(
    [
        T.StructField("time", T.ArrayType(T.TimestampNTZType())),
        *(T.StructField(name, T.ArrayType(T.DoubleType())) for name in API_FIELDS),
    ]
)

PAYLOAD = T.StructType(
    [
        T.StructField("city_id", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("hourly_units", T.MapType(T.StringType(), T.StringType())),
        T.StructField("hourly", HOURLY_BLOCK),
        T.StructField("generationtime_ms", T.DoubleType()),
    ]
)

CITY = T.StructType(
    [
        T.StructField("city_id", T.StringType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

BREAKPOINT = T.StructType(
    [
        T.StructField("pollutant", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("index_low", T.DoubleType()),
        T.StructField("index_high", T.DoubleType()),
        T.StructField("conc_low", T.DoubleType()),
        T.StructField("conc_high", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("averaging", T.StringType()),
    ]
)

FACT = T.StructType(
    [
        T.StructField("daily_aqi_id", T.StringType()),
        T.StructField("city_id", T.StringType()),
        T.StructField("observed_date", T.DateType()),
        T.StructField("hours_reported", T.LongType()),
        T.StructField("pollutants_used", T.LongType()),
        T.StructField("is_aqi_valid", T.BooleanType()),
        T.StructField("aqi", T.IntegerType()),
        T.StructField("aqi_category", T.StringType()),
        T.StructField("dominant_pollutant", T.StringType()),
        T.StructField("pm2_5_sub_index", T.IntegerType()),
        T.StructField("pm10_sub_index", T.IntegerType()),
        T.StructField("no2_sub_index", T.IntegerType()),
        T.StructField("so2_sub_index", T.IntegerType()),
        T.StructField("o3_sub_index", T.IntegerType()),
        T.StructField("co_sub_index", T.IntegerType()),
        T.StructField("pm2_5_24h_ug_m3", T.DoubleType()),
        T.StructField("pm10_24h_ug_m3", T.DoubleType()),
        T.StructField("no2_24h_ug_m3", T.DoubleType()),
        T.StructField("so2_24h_ug_m3", T.DoubleType()),
        T.StructField("o3_8h_max_ug_m3", T.DoubleType()),
        T.StructField("co_8h_max_mg_m3", T.DoubleType()),
        T.StructField("aqi_change_vs_prev_day", T.IntegerType()),
        T.StructField("aqi_7d_avg", T.DoubleType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
