"""Sources and sinks over whole driver tables, each written and read again: queries and oracles."""

from __future__ import annotations

import datetime
from contextlib import suppress

from pyspark.sql import functions as F

from carelattice.functions.columns import as_of_date
from carelattice.plans import staging
from carelattice.session import scratch_dir
from carelattice.sources import tables
from suite import warehouse as w
from suite.views import load, view

oracle = w.oracle
LAST_DAY = "1998-08-02"
LOOKBACK = 90
TOPICS = ["healthcare.vitals", "healthcare.labs"]


def csv_roundtrip(spark, sf):
    """Eligibility through CSV: codes keep their zeros, empty strings become NULL."""
    path = scratch_dir(spark, "csv")
    rows = view(spark, sf, "eligibility").withColumn("zip_code", F.lpad("zip_code", 5, "0"))
    tables.export_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema)


def json_export(spark, sf):
    """Counts of claims by type and service as JSON lines."""
    path = scratch_dir(spark, "json")
    rows = view(spark, sf, "claims").groupBy("claim_type", "service_type").agg(F.count(F.lit(1)).alias("n"))
    tables.export_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


def table_roundtrip(spark, sf):
    """A table replaced by a second write, read by name with one partition wanted."""
    root = scratch_dir(spark, "warehouse")
    claims = view(spark, sf, "claims")
    for rows in (claims.filter("claim_id < 100"), claims):
        tables.write_table(rows, f"{root}/claims", partition_by=["claim_type"])
    return tables.read_table(spark, root, "claims").filter("claim_type = 'inpatient'").select(
        "claim_id", "mem_id", "claim_date", "allowed_amount", "claim_type")


def partitioned_lookback(spark, sf):
    """Orders by month: all once, then a reload of the last days with other prices replaces the months they lie in alone."""
    path = scratch_dir(spark, "by-month")
    orders = load(spark, sf, "orders")[0].select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus", F.lit(0).alias("version"))
    by = {"year": F.year("day"), "month": F.month("day")}
    tables.write_partitioned(orders, path, by, ["o_orderstatus"])
    tables.write_partitioned(
        orders.withColumn("version", F.lit(1)), path, by, ["o_orderstatus"], day="day",
        as_of=datetime.date.fromisoformat(LAST_DAY), lookback_days=LOOKBACK)
    return spark.read.parquet(path).groupBy("year", "month", "version").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


def messages(spark, sf):
    events = load(spark, sf, "events")[0]
    topic = F.when(F.col("event_id") % 3 == 0, TOPICS[0]).when(F.col("event_id") % 3 == 1, TOPICS[1]).otherwise("other.topic")
    return events.select(
        topic.alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("event_id")).alias("timestamp"), F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct("event_id", "user_id")).alias("value"))


def events_to_predictions(spark, sf):
    """Messages of two topics, read as a stream file by file, published again as keyed JSON messages."""
    source, out = scratch_dir(spark, "messages"), scratch_dir(spark, "published")
    messages(spark, sf).repartition(6, "offset").write.json(source)
    stream = tables.read_events(spark, TOPICS, path=source, max_per_trigger=2)
    tables.publish_stream(
        stream.select("key", "offset", "timestamp"), "key", topic="healthcare.predictions",
        checkpoint=scratch_dir(spark, "publish-checkpoint"), path=out).awaitTermination()
    body = F.from_json("value", "key string, offset long, timestamp timestamp")
    sent = spark.read.schema("topic string, key string, value string").json(out)
    return sent.select("topic", "key", body["offset"].alias("offset"), body["timestamp"].alias("sent_at"), (body["key"] == F.col("key")).alias("same_key"))


def published_predictions(spark, sf):
    """A batch of rows as keyed messages."""
    out = scratch_dir(spark, "published")
    tables.publish(view(spark, sf, "claims").select("claim_id", "mem_id"), "mem_id", topic="healthcare.predictions", path=out)
    return spark.read.schema("topic string, key string, value string").json(out)


def source_sizes(spark, sf):
    """Rows and columns of each source; an empty one is refused."""
    names = ["orders", "lineitem", "customer", "events"]
    sizes = {n: tables.assert_source(t) for n, t in zip(names, load(spark, sf, *names))}
    refused = False
    try:
        tables.assert_source(load(spark, sf, "region")[0].filter("r_regionkey < 0"))
    except ValueError:
        refused = True
    rows = [(n, s["rows"], s["columns"], refused) for n, s in sizes.items()]
    return spark.createDataFrame(rows, "table_name string, row_count long, column_count long, empty_refused boolean")


def audit_appends(spark, sf):
    """Audit rows appended a claim type at a time; a sink that can't be written is counted and passes by."""
    path, sink = scratch_dir(spark, "audit"), tables.AppendCounter()
    claims = view(spark, sf, "claims").select("claim_id", "claim_type")
    for kind in ("inpatient", "medical", "pharmacy"):
        sink.append(claims.filter(F.col("claim_type") == kind), path)
    with suppress(Exception):
        sink.append(claims.select("claim_id", F.lit(None).alias("nothing"), F.col("claim_id").alias("CLAIM_ID")), path)
    return spark.read.parquet(path).groupBy("claim_type").agg(F.count(F.lit(1)).alias("n")).withColumn("failed_appends", F.lit(sink.failed))


def recent_claims(spark, sf):
    return staging.recent(view(spark, sf, "claims"), "claim_date", as_of_date(LAST_DAY), LOOKBACK).select("claim_id", "claim_date")


def sorted_claims(spark, sf):
    """The whole table in order, each row with its place."""
    columns = [F.col("allowed_amount").desc(), F.col("claim_id")]
    return tables.sorted_output(view(spark, sf, "claims").select("claim_id", "allowed_amount"), columns, place="place")


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "json_export": json_export,
    "table_roundtrip": table_roundtrip,
    "partitioned_lookback": partitioned_lookback,
    "events_to_predictions": events_to_predictions,
    "published_predictions": published_predictions,
    "source_sizes": source_sizes,
    "audit_appends": audit_appends,
    "recent_claims": recent_claims,
    "sorted_claims": sorted_claims,
}

EMPTY_IS_NULL = ", ".join(f"nullif({c}, '') as {c}" for c in ("dob", "email", "phone"))
SINCE = f"date '{LAST_DAY}' - {LOOKBACK}"
ORACLES = {
    "csv_roundtrip": oracle(f"select * replace ({EMPTY_IS_NULL}, lpad(zip_code, 5, '0') as zip_code) from eligibility"),
    "json_export": oracle("select claim_type, service_type, count(*) as n from claims group by 1, 2"),
    "table_roundtrip": oracle("select claim_id, mem_id, claim_date, allowed_amount, claim_type from claims where claim_type = 'inpatient'"),
    # A month that holds a day of the lookback is replaced as a whole.
    "partitioned_lookback": oracle(f"""
        with o as (select o_orderkey, o_orderdate::date as day, year(o_orderdate::date)::int as year, month(o_orderdate::date)::int as month from orders),
        fresh as (select distinct year, month from o where day >= {SINCE}),
        kept as (select o.*, 1 as version from o semi join fresh using (year, month)
          union all select o.*, 0 from o anti join fresh using (year, month))
        select year, month, version, count(*) as n, sum(o_orderkey)::bigint as keys from kept group by 1, 2, 3"""),
    "events_to_predictions": oracle("""
        select 'healthcare.predictions' as topic, cast(user_id as varchar) as key, event_id as offset,
          timestamp '2023-11-14 22:13:20' + to_seconds(event_id) as sent_at, true as same_key from events where event_id % 3 < 2"""),
    "published_predictions": oracle("""
        select 'healthcare.predictions' as topic, mem_id as key, '{"claim_id":' || claim_id || ',"mem_id":"' || mem_id || '"}' as value from claims"""),
    "source_sizes": oracle(" union all ".join(
        f"select '{t}' as table_name, count(*) as row_count, (select count(*) from (describe {t})) as column_count, true as empty_refused from {t}"
        for t in ("orders", "lineitem", "customer", "events"))),
    "audit_appends": oracle("select claim_type, count(*) as n, 1::int as failed_appends from claims group by 1"),
    "recent_claims": oracle(f"select claim_id, claim_date from claims where claim_date >= {SINCE}"),
    "sorted_claims": oracle("""
        select claim_id, allowed_amount, row_number() over (order by allowed_amount desc, claim_id) as place from claims"""),
}
