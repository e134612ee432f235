"""Incident frames made row by row from ``orders``.

Three whole numbers drive every column: the order key ``k``, the customer key
``c`` and the price in cents ``p``. One order is one incident, whatever the
scale; no join, no generated rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions import text
from roadlens.plans.cleaning import engineered
from roadlens.session import settle, shared_folder
from roadlens.sources.delimited import QUOTING, read_raw
from roadlens.sources.schema import FLAGS, RENAME, TWILIGHTS, TYPES

# The categories the numbers choose from.
STATES = (
    "AL AZ AR CA CO CT DE FL GA ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY "
    "NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY DC"
).split()
WEATHER = (
    "Fair", "Mostly Cloudy", "Cloudy", "Partly Cloudy", "Clear", "Light Rain", "Overcast", "Light Snow",
    "Fog", "Rain", "Haze", "Fair / Windy", "Heavy Rain", "Light Drizzle", "Thunderstorm", "Mist",
    "Rain Showers", "Light Sleet",
)
ZONES = ("Eastern", "Central", "Mountain", "Pacific")
WINDS = ("N", "S", "E", "W", "CALM")
# A flag is true where the remainder of p by its divisor is 0; 0 means never.
FLAG_DIVISORS = {
    "amenity": 11, "bump": 101, "crossing": 7, "give_way": 53, "junction": 5, "no_exit": 47, "railway": 29,
    "roundabout": 211, "station": 23, "stop": 13, "traffic_calming": 97, "traffic_signal": 6, "turning_loop": 0,
}
# Hours (inclusive) at which each twilight column says Day.
DAYLIGHT = {
    "sunrise_sunset": (7, 17), "civil_twilight": (6, 18), "nautical_twilight": (6, 19), "astronomical_twilight": (5, 19),
}
DESCRIPTIONS = (
    "Road closed due to accident at Exit ", "Right lane blocked on route ", "Left shoulder blocked near mile ",
    "Accident with injuries on route ", "Overturned truck on route ", "Pedestrian involved near mile ",
    "Construction zone on route ", "Flooded lane area, route ", "Slow traffic on route ",
    "Multi-vehicle accident on route ", "Stalled vehicle on route ", "Debris on route ",
    "Accident on I-75 at Exit ", "Accident on ramp to route ", "Exited route ", "Incident on route ",
    "Accident on Main St at number ", "At crossing number ", "Hit and run near mile ", "3 vehicle crash on route ",
    "All lanes closed on route ", "Two left lanes open on route ", "Accident from route ", "Jackknifed trailer, route ",
)


def _pick(values, index: Column) -> Column:
    listed = F.expr("array(" + ", ".join(f"'{v}'" for v in values) + ")")
    return F.element_at(listed, (index % len(values) + 1).cast("int"))


def _div(value: Column, by: int) -> Column:
    return F.floor(value / F.lit(by))


def _seconds(value: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), value.cast("decimal(18,6)"))


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    # few narrow columns: spread them over the cores before the many are made from them
    spread = orders.repartitionByRange(spark.sparkContext.defaultParallelism, "o_orderkey").sortWithinPartitions("o_orderkey")
    return spread.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("c"),
        (F.col("o_totalprice").cast("decimal(12,2)") * 100).cast("bigint").alias("p"),
        "o_orderdate", "o_orderpriority", "o_orderstatus",
    )


def _plain_columns() -> dict[str, Column]:
    """Everything but the derived columns, in the table's names and types."""
    k, c, p = F.col("k"), F.col("c"), F.col("p")
    start = F.col("o_orderdate") + _seconds(p % 24 * 3600 + _div(p, 24) % 60 * 60 + _div(p, 1440) % 60)
    hour = p % 24
    priority = F.substring("o_orderpriority", 1, 1)
    columns = {
        "source_id": k * 3 + 1,
        "source": F.when(F.col("o_orderstatus") == "F", "Source1").when(F.col("o_orderstatus") == "O", "Source2")
        .otherwise("Source3"),
        "severity": F.when(priority == "1", 4).when(priority == "2", 3).when(priority == "3", 2).otherwise(1),
        "start_time": start,
        "end_time": start + _seconds(p % 200000 - 5000),
        "start_lat": F.lit(25.0) + (p % 2400) / F.lit(100.0),
        "start_lng": F.lit(-124.0) + (c * 7919 % 5700) / F.lit(100.0),
        "distance_mi": (p % 5000).cast("decimal(18,0)") / 1000,
        "street": F.concat(F.lit("Street "), (c % 211).cast("string")),
        "city": F.concat(F.lit("City "), (c % 97).cast("string")),
        "county": F.concat(F.lit("County "), (c % 31).cast("string")),
        "state": _pick(STATES, c),
        "zipcode": F.when(c % 50 != 0, F.lpad((c % 1000).cast("string"), 5, "0")),
        "timezone": _pick(ZONES, c),
        "airport_code": F.concat(F.lit("K"), F.lpad((c % 200).cast("string"), 3, "0")),
        "weather_timestamp": F.col("o_orderdate") + _seconds(hour * 3600),
        "temperature_f": (p % 1300 - 100).cast("decimal(18,0)") / 10,
        "humidity_pct": p % 101,
        "pressure_in": (p % 200 + 2900).cast("decimal(18,0)") / 100,
        "visibility_mi": (p % 41).cast("decimal(18,0)") / 4,
        "wind_direction": _pick(WINDS, p),
        "wind_speed_mph": (p % 500).cast("decimal(18,0)") / 10,
        "precipitation_in": (p % 30).cast("decimal(18,0)") / 100,
        "weather_condition": _pick(WEATHER, _div(p, 11)),
        **{f: (p % d == 0) if d else F.lit(False) for f, d in FLAG_DIVISORS.items()},
        **{t: F.when(hour.between(*h), "Day").otherwise("Night") for t, h in DAYLIGHT.items()},
        "description": F.concat(_pick(DESCRIPTIONS, _div(p, 7)), (c % 90).cast("string")),
    }
    return {name: column.cast(TYPES.get(name, "string")) for name, column in columns.items()}


def made_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed incident rows, ``id`` and the 51 columns, straight from ``orders``."""
    rows = _numbers(spark, sf_dir).select((F.col("k") + 1).alias("id"), *[
        c.alias(n) for n, c in _plain_columns().items()
    ])
    derived = engineered(
        F.col("start_time"), F.col("end_time"), F.col("temperature_f"), F.col("visibility_mi"),
        [F.col(t) for t in TWILIGHTS],
    )
    derived = {name: c.cast(TYPES.get(name, "string")) for name, c in derived.items()}
    fallback = text.location_fallback("junction", "crossing", "traffic_signal")
    rows = text.classify(rows.withColumns(derived), "description", "incident_context", fallback=fallback)
    return rows.select("id", *RENAME.values())


_tables: dict[tuple[str, str], str] = {}


def incident_folder(spark: SparkSession, sf_dir: str) -> str:
    """Where the incident table lies: loaded once per session, in ranges of ``id``."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _tables:
        path = f"{shared_folder(spark).rstrip('/')}/incidents-{uuid.uuid4().hex}"
        made_incidents(spark, sf_dir).write.parquet(path)
        _tables[key] = path
    return _tables[key]


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incident table that every query reads."""
    return spark.read.parquet(incident_folder(spark, sf_dir))


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same incidents as the 46 text columns of a raw file, with its blemishes.

    Keys have a prefix, some times have fractions or are unreadable, zip codes a
    suffix, zones a prefix; wind speeds and precipitation are missing here and there.
    """
    p = F.col("_p")
    plain = _plain_columns()
    rows = settle(_numbers(spark, sf_dir).select(*[c.alias(n) for n, c in plain.items()], F.col("p").alias("_p")))

    def moment(name: str) -> Column:
        body = F.date_format(name, "yyyy-MM-dd HH:mm:ss")
        return F.when(p % 4 == 0, F.concat(body, F.lit(".000000000"))).otherwise(body)

    shown = {name: F.col(name).cast("string") for name in plain}
    shown |= {flag: F.initcap(F.col(flag).cast("string")) for flag in FLAGS}
    shown |= {
        "source_id": F.concat(F.lit("A-"), F.col("source_id").cast("string")),
        "start_time": F.when(p % 997 == 0, "garbage").otherwise(moment("start_time")),
        "end_time": moment("end_time"),
        "weather_timestamp": F.date_format("weather_timestamp", "yyyy-MM-dd HH:mm:ss"),
        "zipcode": F.when(p % 3 == 0, F.concat(F.col("zipcode"), F.lit("-1234"))).otherwise(
            F.coalesce(F.col("zipcode"), F.lit("NA"))),
        "timezone": F.concat(F.lit("US/"), F.col("timezone")),
        "wind_speed_mph": F.when(p % 37 == 0, "N/A").otherwise(F.col("wind_speed_mph").cast("string")),
        "precipitation_in": F.when(p % 3 != 0, F.col("precipitation_in").cast("string")),
    }
    kept = [shown[name].alias(raw) for raw, name in RENAME.items() if name in plain]
    dropped = {"End_Lat": "start_lat", "End_Lng": "start_lng", "Country": "source", "Wind_Chill(F)": "temperature_f"}
    return rows.select(*kept, *[F.col(c).cast("string").alias(n) for n, c in dropped.items()])


_files: dict[tuple[str, str], str] = {}


def raw_file(spark: SparkSession, sf_dir: str) -> str:
    """A delimited file with the raw incidents in the shared folder, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _files:
        path = f"{shared_folder(spark).rstrip('/')}/raw-{uuid.uuid4().hex}"
        raw_incidents(spark, sf_dir).write.options(header=True, **QUOTING).csv(path)
        _files[key] = path
    return _files[key]


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw(spark, raw_file(spark, sf_dir))
