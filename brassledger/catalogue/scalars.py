"""Scalar function families, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from brassledger import fixtures as X
from brassledger.catalogue.core import query
from brassledger.functions import columns as C
from brassledger.operators import prepare
from brassledger.operators.standardise import instant


@query(
    "fn_string",
    """SELECT c_custkey, upper(trim('  ' || c_mktsegment || ' ')) AS code,
              contains(c_name, '#00000001') AS name_has, concat_ws(',', c_mktsegment, NULL, c_name) AS joined,
              split_part(c_name, '#', 2) AS tail, c_name LIKE '%9' AS ends_in_nine, c_name[:4] AS head,
              lower(c_mktsegment) AS lowered, c_mktsegment[1] || lower(c_mktsegment[2:]) AS title,
              'CUST' || lpad(c_custkey::VARCHAR, 6, '0') AS padded, 'XX' || c_name[3:] AS overlaid
       FROM customer""",
)
def fn_string(ws):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return ws.table("customer").select(
        "c_custkey",
        C.code(F.concat(F.lit("  "), segment, F.lit(" "))).alias("code"),
        name.contains("#00000001").alias("name_has"),
        F.concat_ws(",", segment, F.lit(None).cast("string"), name).alias("joined"),
        F.split_part(name, F.lit("#"), F.lit(2)).alias("tail"),
        name.like("%9").alias("ends_in_nine"),
        F.left(name, F.lit(4)).alias("head"),
        F.lower(segment).alias("lowered"),
        F.initcap(segment).alias("title"),
        C.padded("CUST", "c_custkey", 6).alias("padded"),
        F.overlay(name, F.lit("XX"), 1, 2).alias("overlaid"),
    )


@query(
    "fn_date",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts_text, o_orderdate::DATE AS day,
              hour(o_orderdate + to_seconds(o_orderkey * 7919 % 86400))::INTEGER AS hour_of_day,
              year(o_orderdate)::INTEGER AS year_, month(o_orderdate)::INTEGER AS month_,
              date_trunc('month', o_orderdate)::DATE AS month_start, date_trunc('year', o_orderdate)::DATE AS year_start,
              (o_orderdate::DATE - INTERVAL 3 MONTH)::DATE AS three_months_before,
              date_sub('hour', o_orderdate + to_seconds(o_orderkey * 7919 % 86400), TIMESTAMP '2024-02-01') AS hours_ago,
              o_orderdate + INTERVAL 60 SECOND AS a_minute_later
       FROM orders""",
)
def fn_date(ws):
    ts = F.col("o_orderdate")
    day = ts.cast("date")
    moment = F.timestamp_add("SECOND", F.col("o_orderkey") * 7919 % 86_400, ts)
    return ws.table("orders").select(
        "o_orderkey",
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
        day.alias("day"),
        F.hour(moment).alias("hour_of_day"),
        F.year(ts).alias("year_"),
        F.month(ts).alias("month_"),
        C.month_start(day).alias("month_start"),
        C.year_start(day).alias("year_start"),
        F.add_months(day, -3).alias("three_months_before"),
        C.whole_hours(moment, instant(X.AS_OF)).alias("hours_ago"),
        F.timestamp_add("SECOND", F.lit(60), ts).alias("a_minute_later"),
    )


@query(
    "fn_math",
    """SELECT c_custkey, round(c_acctbal / 7, 2) AS rounded, round(c_acctbal::DECIMAL(18,2), -3)::DECIMAL(18,2) AS banded,
              (-(c_acctbal::DECIMAL(18,2)))::DECIMAL(18,2) AS negated,
              round(100 / nullif((c_custkey % 5)::DOUBLE, 0), 4) AS guarded,
              c_custkey * 31 % 1000 AS bucket, greatest(c_acctbal, 0) AS clipped
       FROM customer""",
)
def fn_math(ws):
    k, balance = F.col("c_custkey"), F.col("c_acctbal")
    money = balance.cast("decimal(18,2)")
    return ws.table("customer").select(
        "c_custkey",
        F.round(balance / 7, 2).alias("rounded"),
        C.banded(money).alias("banded"),
        (-money).cast("decimal(18,2)").alias("negated"),
        F.round(C.share(F.lit(1), k % 5, 100.0), 4).alias("guarded"),
        F.pmod(k * 31, F.lit(1000).cast("bigint")).alias("bucket"),
        F.greatest(balance, F.lit(0.0)).alias("clipped"),
    )


@query(
    "fn_conditional",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'HIGH' WHEN c_acctbal < 2000 THEN 'MEDIUM' ELSE 'LOW' END AS tier,
              if(c_acctbal < 0, 1, 0)::INTEGER AS overdrawn,
              coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS segment_or_none,
              nullif(c_mktsegment, 'MACHINERY') IS NULL AS is_machinery,
              c_mktsegment IN ('BUILDING', 'FURNITURE') AS chosen
       FROM customer""",
)
def fn_conditional(ws):
    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    return ws.table("customer").select(
        "c_custkey",
        F.when(balance < 0, "HIGH").when(balance < 2000, "MEDIUM").otherwise("LOW").alias("tier"),
        F.when(balance < 0, 1).otherwise(0).alias("overdrawn"),
        F.coalesce(F.nullif(segment, F.lit("BUILDING")), F.lit("none")).alias("segment_or_none"),
        F.nullif(segment, F.lit("MACHINERY")).isNull().alias("is_machinery"),
        segment.isin("BUILDING", "FURNITURE").alias("chosen"),
    )


@query(
    "fn_array",
    """SELECT reason, sum(reasons_in_row)::BIGINT AS reasons_in_rows, count(*) AS row_count
       FROM (SELECT unnest(r) AS reason, len(r) AS reasons_in_row
             FROM (SELECT list_filter([if(c_acctbal < 0, 'NEGATIVE', NULL), if(c_custkey % 3 = 0, 'THIRD', NULL),
                                       if(c_mktsegment = 'BUILDING', 'BUILDING', NULL), 'ALL'],
                                      lambda x: x IS NOT NULL) AS r FROM customer)) GROUP BY ALL""",
)
def fn_array(ws):
    flags = F.array(
        F.when(F.col("c_acctbal") < 0, "NEGATIVE"),
        F.when(F.col("c_custkey") % 3 == 0, "THIRD"),
        F.when(F.col("c_mktsegment") == "BUILDING", "BUILDING"),
    )
    listed = F.array_union(F.array_compact(flags), F.array(F.lit("ALL")))
    single = (
        ws.table("customer")
        .select(listed.alias("r"))
        .select(F.explode("r").alias("reason"), F.size("r").alias("reasons_in_row"))
    )
    return single.groupBy("reason").agg(
        F.sum("reasons_in_row").alias("reasons_in_rows"), F.count(F.lit(1)).alias("row_count")
    )


@query(
    "fn_map_lookup",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'DEPOSIT' WHEN 1 THEN 'WITHDRAWAL' WHEN 2 THEN 'PAYMENT'
              WHEN 3 THEN 'TRANSFER' WHEN 4 THEN 'DEBIT' END AS bank_type FROM orders""",
)
def fn_map_lookup(ws):
    codes = F.array(*[F.lit(c) for c in (*prepare.SOURCE_TYPES, "NO_SUCH_CODE")])
    source = F.element_at(codes, (F.col("o_orderkey") % 6).cast("int") + 1)
    return ws.table("orders").select("o_orderkey", prepare.map_types(source).alias("bank_type"))


@query(
    "fn_json",
    """SELECT event_id, (props->>'k')::BIGINT AS k,
              '{"event_type":"' || event_type || '","user_id":' || user_id || ',"nothing":null}' AS encoded,
              event_type AS decoded_type
       FROM events""",
)
def fn_json(ws):
    nothing = F.lit(None).cast("string").alias("nothing")
    encoded = F.to_json(F.struct("event_type", "user_id", nothing), {"ignoreNullFields": "false"})
    return ws.table("events").select(
        "event_id",
        F.from_json("props", "k bigint")["k"].alias("k"),
        encoded.alias("encoded"),
        F.from_json(encoded, "event_type string")["event_type"].alias("decoded_type"),
    )


@query(
    "fn_hash",
    """SELECT c_custkey, sha256(c_name) AS digest, 'H_' || sha256(c_name)[:16] AS hashed,
              ('0x' || sha256(c_name)[:15])::BIGINT % 1000 AS bucket FROM customer""",
)
def fn_hash(ws):
    return ws.table("customer").select(
        "c_custkey",
        F.sha2("c_name", 256).alias("digest"),
        C.hashed("c_name").alias("hashed"),
        C.stable_bucket("c_name", 1000).alias("bucket"),
    )


@query(
    "fn_context",
    """SELECT event_id, TIMESTAMP '2024-02-01' AS as_of, DATE '2024-02-01' AS today, '20240201T000000Z' AS run_id,
              'BANK_ANALYST' AS role, ts > TIMESTAMP '2024-01-15' AS is_recent FROM events""",
)
def fn_context(ws):
    """Clock, run and role are parameters, never read from the session."""
    settings = ws.run.settings
    return ws.table("events").select(
        "event_id",
        instant(settings.as_of).alias("as_of"),
        F.lit(settings.as_of.date()).alias("today"),
        F.lit(settings.run_id).alias("run_id"),
        F.lit("BANK_ANALYST").alias("role"),
        (F.col("ts") > instant(settings.as_of.replace(month=1, day=15))).alias("is_recent"),
    )


@query(
    "fn_cast",
    """SELECT event_id, try_cast(value::VARCHAR AS DECIMAL(18,2)) AS as_money, try_cast(props AS INTEGER) AS not_int,
              event_id::VARCHAR AS as_text, user_id::DOUBLE AS as_double, try_cast(user_id AS INTEGER) AS as_int
       FROM events""",
)
def fn_cast(ws):
    return ws.table("events").select(
        "event_id",
        F.col("value").cast("string").try_cast("decimal(18,2)").alias("as_money"),
        F.col("props").try_cast("int").alias("not_int"),
        F.col("event_id").cast("string").alias("as_text"),
        F.col("user_id").cast("double").alias("as_double"),
        F.col("user_id").try_cast("int").alias("as_int"),
    )
