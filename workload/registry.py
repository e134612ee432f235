"""The registered queries: every operator over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.functions import geo, text
from roadlens.operators import aggregate as agg
from roadlens.operators import joins, maps, profile, quality
from roadlens.operators.ordering import number_rows, ranges_of
from roadlens.plans import build, cleaning, models, star
from roadlens.plans.contract import CONTRACT
from roadlens.plans.questions import QUESTIONS
from roadlens.session import settle, shared_folder, tune
from roadlens.sources import delimited, reports, tables, versions
from roadlens.sources.schema import UNREADABLE
from roadlens.streaming import marts
from roadlens.streaming.arrivals import clean_arrivals
from workload.expected import DOCUMENT_RULES, LEVELS, PROFILED, RADIUS, STEP, SUMMARISED
from workload.incidents import incident_folder, incidents, raw_file, raw_incidents, raw_rows

Query = Callable[[SparkSession, str], DataFrame]

# The test tables end within this year, as the real ones end within 2023.
PARTIAL_YEAR = 2001
CHOSEN = {
    "states": ["CA", "TX", "NY", "FL", "OH"], "year_range": (1996, 1999), "hour_range": (5, 20),
    "severities": [2, 3, 4], "duration_range": (0, 600),
}
SWITCHED = {"weekend_only": True, "rush_hour_only": True, "junction_only": True, "duration_range": (0, 1440)}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, to compare with engines that divide in doubles."""
    return df.selectExpr(*[f"double(`{c}`) AS `{c}`" if kind.startswith("decimal") else f"`{c}`" for c, kind in df.dtypes])


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.stage(incidents(spark, sf_dir))


def on_incidents(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(incidents(spark, sf_dir))


def on_staged(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(staged(spark, sf_dir))


def on_raw(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(raw_rows(spark, sf_dir))


# ------------------------------------------------------------ models and star


def _temporal(s: DataFrame) -> DataFrame:
    return models.int_temporal(s, PARTIAL_YEAR)


def _funnel(s: DataFrame) -> DataFrame:
    return models.int_funnel(s, PARTIAL_YEAR)


def _geo(s: DataFrame) -> DataFrame:
    return models.int_geo_hotspots(settle(models.city_sums(s)))


MARTS = {
    "mart_temporal": lambda s: models.mart_temporal(_temporal(s)),
    "mart_geo": lambda s: models.mart_geo(_geo(s)),
    "mart_weather_poi": lambda s: models.mart_weather_poi(models.int_weather_poi(s)),
    "mart_funnel": lambda s: models.mart_funnel(_funnel(s)),
}


def written_mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A mart as the build leaves it: written, then read; each call writes it anew, so its work is part of the query."""
    return tables.materialise(MARTS[name](staged(spark, sf_dir)), folder(spark, name))


def highlights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.highlights(*[written_mart(spark, sf_dir, m) for m in ("mart_funnel", "mart_geo", "mart_weather_poi")])


def _starred(s: DataFrame) -> DataFrame:
    root = folder(s.sparkSession, "star")
    made = {name: tables.materialise(df, f"{root}/{name}") for name, df in build.star_tables(s).items()}
    dims = {key: made[make.__name__] for key, make in star.DIMENSIONS.items()}
    return joins.star_join(made["fact"], dims)


def _star_rollup(s: DataFrame) -> DataFrame:
    return _starred(s).groupBy("state", "quarter_num", "incident_context").agg(agg.incidents(), agg.avg_severity())


STAR_COLUMNS = (
    "accident_id", "location_id", "severity", "duration_mins", "city", "county", "state", "zipcode", "month_num",
    "month_name", "quarter_num", "weather_condition", "temp_bucket", "incident_context", "junction",
)


# ------------------------------------------------------------------- cleaning


def clean_table(raw: DataFrame) -> DataFrame:
    return tables.typed(tables.rename_columns(cleaning.clean(raw))).select(*tables.RENAME.values())


def clean_strings(raw: DataFrame) -> DataFrame:
    return raw.groupBy(
        text.strip_id_prefix(F.col("ID")).alias("source_id"),
        text.zip_base(F.col("Zipcode")).alias("zipcode"),
        text.strip_zone_prefix(F.col("Timezone")).alias("timezone"),
    ).agg(F.count("*").alias("n"))


def parse_time(raw: DataFrame) -> DataFrame:
    return cleaning.parse(raw).select(
        F.col("ID").alias("source_id"), F.col("Start_Time").alias("start_time"), F.col("End_Time").alias("end_time")
    )


def clean_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, out = raw_file(spark, sf_dir), folder(spark, "arrived")
    columns = delimited.header_of(spark, source)
    clean_arrivals(spark, source, columns, out, folder(spark, "arrivals")).awaitTermination()
    rows = tables.typed(tables.rename_columns(spark.read.parquet(out)))
    return rows.select(*tables.RENAME.values())


def clean_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "clean")
    delimited.write_clean(cleaning.clean(raw_rows(spark, sf_dir)), path)
    rows = tables.typed(tables.rename_columns(delimited.read_clean(spark, path)))
    return rows.select(*tables.RENAME.values())


def load_and_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.stage(tables.load_table(cleaning.clean(raw_rows(spark, sf_dir)), folder(spark, "incidents")))


def raw_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions of two lines, through the raw file, cleaning and the clean file."""
    raw = raw_incidents(spark, sf_dir).withColumn("Description", F.concat("Description", F.lit("\nsecond line")))
    path, out = folder(spark, "broken"), folder(spark, "clean")
    raw.write.options(header=True, **delimited.QUOTING).csv(path)
    delimited.write_clean(cleaning.clean(delimited.read_raw(spark, path)), out)
    return delimited.read_clean(spark, out).select(F.col("ID").alias("source_id"), F.col("Description").alias("description"))


def raw_split_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file with line breaks and quotes in its descriptions, read in as many pieces as its size allows."""
    text = F.concat("Description", F.lit('\na "second", line'))
    path = folder(spark, "one-file")
    whole = raw_incidents(spark, sf_dir).withColumn("Description", text).coalesce(1)
    whole.write.options(header=True, **delimited.QUOTING).csv(path)
    clean = cleaning.clean(delimited.read_raw(spark, path))
    return clean.select(F.col("ID").alias("source_id"), F.col("Description").alias("description"))


def versioned_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a table as first written, after a refresh that failed, and refreshed; and by a reader of the first."""
    rows, path = incidents(spark, sf_dir).select("id", "severity"), folder(spark, "refreshed")
    held = versions.publish(rows.filter("severity <= 2"), path)
    failing = rows.withColumn("id", F.when(F.col("id") % 100 == 7, F.raise_error(F.lit("stopped"))).otherwise(F.col("id")))
    try:
        versions.publish(failing, path)
    except PySparkException:
        pass
    steps = {"first": held, "after_failure": versions.read_version(spark, path)}
    steps |= {"refreshed": versions.publish(rows, path), "held": held}
    named = [df.groupBy("severity").agg(agg.incidents()).withColumn("step", F.lit(step)) for step, df in steps.items()]
    return reduce(DataFrame.unionByName, named)


def kept_mart(name: str) -> Query:
    """A mart from cells to which a stream of the incident files adds batch after batch; one is sent twice."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, rows = folder(spark, "cells"), incidents(spark, sf_dir)
        files = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 3).parquet(incident_folder(spark, sf_dir))
        marts.keep_marts(tables.stage(files), path, folder(spark, "batches"), marts=[name]).awaitTermination()
        if marts.add_batch(tables.stage(rows), 0, path, marts=[name]):
            raise AssertionError("a batch was counted twice")
        return marts.read_mart(spark, path, name, PARTIAL_YEAR)

    return query


#: Buckets of a star join at least; more where the table is read in more partitions, so a bucket stays bounded.
BUCKETS = 8


def star_by(key: str, columns: tuple[str, ...]) -> Callable[[DataFrame], DataFrame]:
    """Facts with one dimension, both bucketed by its key, so that the join shuffles neither."""

    def query(s: DataFrame) -> DataFrame:
        root, tag = folder(s.sparkSession, "buckets"), uuid.uuid4().hex
        named = {"fact": star.fact(s), "dim": star.DIMENSIONS[key](s)}
        buckets = max(BUCKETS, ranges_of(s))
        made = {n: tables.save_bucketed(df, f"{n}_{tag}", key, buckets, f"{root}/{n}") for n, df in named.items()}
        return joins.star_join(made["fact"], {key: made["dim"]}).select(*columns)

    return query


BY_LOCATION = ("accident_id", "location_id", "severity", "city", "county", "state", "zipcode", "timezone")
BY_TIME = ("accident_id", "time_id", "severity", "start_time", "month_num", "month_name", "quarter_num")


def raw_header_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of which some have city and county the other way round."""
    raw, path = raw_incidents(spark, sf_dir), folder(spark, "headers")
    other = [{"City": "County", "County": "City"}.get(c, c) for c in raw.columns]
    first = F.pmod(F.xxhash64("ID"), F.lit(2)) == 0
    raw.filter(first).write.options(header=True, **delimited.QUOTING).csv(path)
    raw.filter(~first).select(*[f"`{c}`" for c in other]).write.mode("append").options(header=True, **delimited.QUOTING).csv(path)
    clean = cleaning.clean(delimited.read_raw(spark, path))
    return clean.select(F.col("ID").alias("source_id"), F.col("City").alias("city"), F.col("County").alias("county"))


def clean_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a raw file in which some temperatures and flags are no such thing."""
    raw, path = raw_incidents(spark, sf_dir), folder(spark, "unreadable")
    key = F.expr("bigint(substring(ID, 3)) div 3")
    raw = raw.withColumn("Temperature(F)", F.when(key % 41 == 0, "warm").otherwise(F.col("`Temperature(F)`")))
    raw = raw.withColumn("Junction", F.when(key % 43 == 0, "maybe").otherwise(F.col("Junction")))
    raw.write.options(header=True, **delimited.QUOTING).csv(path)
    return cleaning.reading_totals(delimited.read_raw(spark, path))


def keyword_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    fallback = [(F.col("quality") == 1, "rated_good"), (F.col("toxic") == 1, "rated_toxic")]
    return text.classify(labelled, "text", "topic", DOCUMENT_RULES, fallback).select("doc_id", "topic")


# ----------------------------------------------------- maps, profiles, checks


def point_sample(df: DataFrame) -> DataFrame:
    points = maps.point_sample(df, {"hour_range": (6, 20)}, n=1000, seed=7)
    return points.withColumn("colour", F.concat_ws(",", F.col("colour").cast("array<string>")))


def severity_names(df: DataFrame) -> DataFrame:
    colour = F.concat_ws(",", geo.severity_colour(F.col("severity")).cast("array<string>"))
    label = geo.severity_label(F.col("severity"))
    return df.groupBy("severity", label.alias("label"), colour.alias("colour")).agg(agg.incidents())


def mart_export(name: str) -> Callable[[DataFrame], DataFrame]:
    """A mart as an exported file, read back."""

    def export(s: DataFrame) -> DataFrame:
        mart, path = MARTS[name](s), folder(s.sparkSession, "export")
        delimited.export_csv(mart, path, null_value="NULL", order_by=build.mart_order(name))
        reader = s.sparkSession.read.schema(mart.schema).options(header=True, nullValue="NULL", **delimited.TIMES)
        return reader.csv(path)

    return export


def newest_record(df: DataFrame) -> DataFrame:
    return maps.record_detail(df, df.agg(F.max("id")).scalar())


def hex_bin(df: DataFrame) -> DataFrame:
    centre = {c: F.round(c, 6) for c in ("lat", "lng")}
    return maps.hex_density(df, RADIUS).withColumns(centre)


def dq_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = {"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"], "o_orderstatus": ["F", "O", "P"]}
    return quality.check_rows(table(spark, sf_dir, "orders"), "orders", accepted=accepted)


def dq_relationships(spark: SparkSession, sf_dir: str, find=quality.orphans) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("documents", "labels", "lineitem", "orders", "supplier")}
    return (
        quality.check_relationship(t["documents"], "documents", "doc_id", t["labels"], "doc_id", find)
        .unionByName(quality.check_relationship(t["lineitem"], "lineitem", "l_orderkey", t["orders"], "o_orderkey", find))
        .unionByName(quality.check_relationship(t["lineitem"], "lineitem", "l_suppkey", t["supplier"], "s_suppkey", find))
    )


def contract_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = tables.load_table(cleaning.clean(raw_rows(spark, sf_dir)), folder(spark, "incidents"))
    return build.check(build.build(loaded, folder(spark, "models")))


DAMAGED_CONTRACT = {
    "fact": {
        "unique": ["accident_id"], "not_null": ["severity", "start_time"], "accepted": {"severity": [1, 2, 3, 4]},
        "relationships": {"location_id": ("dim_location", "location_id")},
    },
}


def contract_failures(s: DataFrame) -> DataFrame:
    """Checks over a fact table with missing, unknown, repeated and orphaned values."""
    key = F.col("accident_id")
    severity = F.when(key % 5 == 0, None).when(key % 7 == 0, 9).otherwise(F.col("severity"))
    place = F.when(key % 11 == 0, "nowhere").otherwise(F.col("location_id"))
    fact = star.fact(s).withColumns({"severity": severity, "location_id": place})
    made = {"fact": settle(fact.unionByName(fact.filter(key % 13 == 0))), "dim_location": star.dim_location(s)}
    return quality.check_all(made, DAMAGED_CONTRACT)


def contract_damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The promised checks over one damaged table of each layer."""
    rows, s = incidents(spark, sf_dir), staged(spark, sf_dir)
    severity = F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 7 == 0, 9).otherwise(F.col("severity"))
    source = rows.withColumn("severity", severity)
    temporal, location, funnel = settle(_temporal(s)), star.dim_location(s), MARTS["mart_funnel"](s)
    kind, state = F.col("granularity"), F.col("state")
    made = {
        "incidents": source.unionByName(source.filter("id % 13 = 0")),
        "staged": s.withColumn("state", F.when(F.col("accident_id") % 11 != 0, state)),
        "int_temporal": temporal.withColumns({
            "granularity": F.when(kind == "hourly", "weekly").otherwise(kind),
            "accident_count": F.when(kind != "yearly", F.col("accident_count")),
        }),
        "dim_location": location.unionByName(location.filter(state == "CA")).withColumn("state", F.when(state != "TX", state)),
        "mart_funnel": funnel.withColumn(
            "dimension_value", F.when(F.col("funnel_dimension") != "by_light", F.col("dimension_value"))
        ),
    }
    return quality.check_all({name: settle(df) for name, df in made.items()}, {name: CONTRACT[name] for name in made})


def layout_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "layout")
    tables.write_layout(incidents(spark, sf_dir), path)
    rows = spark.read.parquet(path).filter(F.col("year").between(1997, 1998))
    return rows.groupBy("state", "severity", "year").agg(F.count("*").alias("accident_count"))


def layout_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.write_clustered(incidents(spark, sf_dir), folder(spark, "clustered"))
    chosen = rows.filter("hour_of_day = 8 AND severity >= 2")
    return chosen.groupBy("state", "severity", "incident_context").agg(agg.incidents())


def lookup_spread(rows: DataFrame) -> DataFrame:
    """Rows dealt by the hash of ``id``, in 8 pieces or as many as the table is read in, so a piece stays bounded."""
    return rows.repartition(max(8, ranges_of(rows)), F.xxhash64("id"))


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of the highest id, found through the Bloom filters of a table in no order."""
    rows = incidents(spark, sf_dir)
    found = tables.write_lookup(lookup_spread(rows), folder(spark, "lookup"), rows=2000)
    last = rows.agg(F.max("id")).collect()[0][0]
    city = rows.filter(F.col("id") == last).select("city").collect()[0][0]
    columns = ("id", "source_id", "city", "state", "severity", "description")
    return found.filter((F.col("id") == last) & (F.col("city") == city)).select(*columns)


def first_rows(df: DataFrame) -> DataFrame:
    """How many rows a look at the first 50 gives, and how many of them are the table's."""
    first = delimited.head(df, 50)
    known = first.join(df.select("id"), "id", "left_semi")
    return first.agg(F.count("*").alias("n_rows")).join(known.agg(F.count("*").alias("n_known")))


def report_file(report: DataFrame, source: str) -> DataFrame:
    """A report as its file holds it, but for the time it was made."""
    path = folder(report.sparkSession, "report")
    reports.write_report(plain(report), path, source)
    texts = [T.StructField(name, T.StringType()) for name in ("source_file", "generated_at")]
    rows = report.sparkSession.read.schema(T.StructType([*plain(report).schema.fields, *texts])).json(path)
    return rows.filter(F.try_to_timestamp("generated_at", F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()).drop("generated_at")


def serial_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    # the first four columns alone are not unique at every scale
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    keys += [c for c in rows.columns if c not in keys]
    return number_rows(rows, [F.col(k).asc() for k in keys], "id")


def all_queries() -> dict[str, Query]:
    queries: dict[str, Query] = {name: on_incidents(f) for name, f in QUESTIONS.items()}
    queries |= {
        "int_temporal": on_staged(_temporal),
        "int_geo": on_staged(_geo),
        "int_weather_poi": on_staged(models.int_weather_poi),
        "int_funnel": on_staged(_funnel),
        **{name: on_staged(mart) for name, mart in MARTS.items()},
        "highlights": highlights,
        "dim_location": on_staged(star.dim_location),
        "dim_time": on_staged(star.dim_time),
        "dim_weather": on_staged(star.dim_weather),
        "dim_road": on_staged(star.dim_road),
        "fact": on_staged(star.fact),
        "star_join": on_staged(lambda s: _starred(s).select(*STAR_COLUMNS)),
        "star_join_whole": on_staged(_starred),
        "star_rollup": on_staged(_star_rollup),
        "staged": staged,
        "clean_pipeline": on_raw(clean_table),
        "clean_stream": clean_stream,
        "clean_file_round_trip": clean_file_round_trip,
        "load_and_stage": load_and_stage,
        "raw_line_breaks": raw_line_breaks,
        "raw_split_read": raw_split_read,
        "versioned_refresh": versioned_refresh,
        **{f"{name}_arrivals": kept_mart(name) for name in MARTS},
        "star_by_location": on_staged(star_by("location_id", BY_LOCATION)),
        "star_by_time": on_staged(star_by("time_id", BY_TIME)),
        "raw_header_order": raw_header_order,
        "clean_unreadable": clean_unreadable,
        "clean_strings": on_raw(clean_strings),
        "parse_time": on_raw(parse_time),
        "drop_null_rows": on_raw(cleaning.clean_totals),
        "drop_null_rows_observed": on_raw(lambda r: cleaning.clean_totals(r, cleaning.OBSERVED_EXEMPT)),
        "time_features": on_incidents(
            lambda d: d.select("id", "duration_mins", "hour_of_day", "day_of_week", "is_weekend", "is_rush_hour")
        ),
        "bucket_labels": on_incidents(
            lambda d: d.select("id", "temp_bucket", "visibility_bucket", "light_condition_category")
        ),
        "incident_context": on_incidents(lambda d: d.select("id", "incident_context")),
        "keyword_context": keyword_context,
        "filter_stats": on_incidents(lambda d: maps.selection_statistics(d, CHOSEN)),
        "filter_stats_switches": on_incidents(lambda d: maps.selection_statistics(d, SWITCHED)),
        "filter_stats_all": on_incidents(lambda d: maps.selection_statistics(d, {})),
        "point_sample": on_incidents(point_sample),
        "record_detail": on_incidents(newest_record),
        "filter_options": on_incidents(maps.filter_options),
        "distinct_sorted": on_incidents(lambda d: maps.options_of(d, "weather_condition", keep_null=False)),
        "severity_names": on_incidents(severity_names),
        "mart_export": on_staged(mart_export("mart_funnel")),
        **{f"{name}_export": on_staged(mart_export(name)) for name in MARTS if name != "mart_funnel"},
        "hex_bin": on_incidents(hex_bin),
        "heat_grid": on_incidents(lambda d: maps.heat_grid(d, STEP)),
        "heat_grid_weighted": on_incidents(lambda d: maps.heat_grid(d, STEP, F.col("duration_mins"), 2)),
        "null_audit": on_raw(lambda r: profile.null_audit(r.drop(UNREADABLE))),
        "column_classes": on_incidents(profile.classification),
        "stats_report": on_incidents(profile.stats_report),
        "column_profile": on_incidents(lambda d: profile.numeric_summary(d, SUMMARISED)),
        "value_frequencies": on_incidents(lambda d: profile.value_frequencies(d, PROFILED)),
        "dq_not_null": on_raw(lambda r: quality.check_rows(r, "raw", [c for c in r.columns if c != UNREADABLE])),
        "dq_unique": lambda s, d: quality.duplicates(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
        "dq_accepted": dq_accepted,
        "dq_relationships": dq_relationships,
        "contract_checks": contract_checks,
        "contract_failures": on_staged(contract_failures),
        "contract_damage": contract_damage,
        "check_summary": on_staged(lambda s: quality.summarise(contract_failures(s))),
        "layout_read": layout_read,
        "layout_clustered": layout_clustered,
        "point_lookup": point_lookup,
        "first_rows": on_incidents(first_rows),
        "null_report_file": on_raw(lambda r: report_file(profile.null_audit(r.drop(UNREADABLE)), "raw incidents")),
        "stats_report_file": on_incidents(lambda d: report_file(profile.stats_report(d), "incidents")),
        "dq_relationships_dense": lambda s, d: dq_relationships(s, d, quality.orphans_by_bitmap),
        "heat_pyramid": on_incidents(lambda d: maps.heat_pyramid(d, STEP, LEVELS).drop("cell")),
        "serial_id": serial_id,
        "load_verify": on_incidents(tables.verify_load),
    }

    def as_plain(query: Query) -> Query:
        return lambda spark, sf_dir: plain(query(tune(spark), sf_dir))

    return {name: as_plain(q) for name, q in queries.items()}
