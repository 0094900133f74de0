"""Sinks and table maintenance."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorledger.operators import upserts
from motorledger.operators.columns import conform_money
from motorledger.operators.keep import latest_per_key
from motorledger.queries.registry import Tables, query
from motorledger.session import shared_folder
from motorledger.sources import sinks, tables
from motorledger.streaming import stream_deletes, stream_upsert

CUT = "2024-01-16"


@query("k1_replace_table", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0")
def _(t: Tables):
    path = shared_folder(t.spark, "replace")
    sinks.write_replace(t.customer.select("c_custkey", "c_name"), path)
    sinks.write_replace(t.customer.where("c_acctbal > 0").select("c_custkey", "c_name"), path)
    sinks.write_replace(t.customer.where("c_acctbal > 1e12").select("c_custkey", "c_name"), path)
    return sinks.read_current(t.spark, path)


@query("k2_append", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t: Tables):
    path = shared_folder(t.spark, "append")
    half = t.orders.select("o_orderkey", "o_totalprice")
    sinks.write_append(half.where("o_orderkey % 2 = 0"), path)
    sinks.write_append(half.where("o_orderkey % 2 = 1"), path)
    return t.spark.read.parquet(path)


def user_state(t: Tables):
    """Target: the last event per user in the first half; batch: events of the second half."""
    events = t.events
    target = latest_per_key(events.where(F.col("ts") < CUT), ["user_id"], ["ts"]).select(
        "user_id", "event_id", "event_type", "value", F.col("props").alias("note")
    )
    batch = events.where(F.col("ts") >= CUT).select(
        "user_id", "event_id", "event_type", "ts", F.lit("x").alias("unknown"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
    )
    return target, batch


_USERS = """
    t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn
                         FROM events WHERE ts < '2024-01-16') WHERE rn = 1),
    b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn
                         FROM events WHERE ts >= '2024-01-16') WHERE rn = 1)"""
_UPSERTED = f"""WITH {_USERS}
    SELECT coalesce(b.user_id, t.user_id) AS user_id,
           CASE WHEN b.user_id IS NOT NULL THEN b.event_id ELSE t.event_id END AS event_id,
           CASE WHEN b.user_id IS NOT NULL THEN b.event_type ELSE t.event_type END AS event_type,
           CASE WHEN b.user_id IS NULL THEN t.value WHEN b.event_type <> 'error' THEN b.value END AS value,
           t.props AS note
    FROM t FULL JOIN b ON b.user_id = t.user_id"""


@query("k3_upsert", _UPSERTED)
def _(t: Tables):
    target, batch = user_state(t)
    return upserts.upsert(target, batch, "user_id", ["ts"])


@query(
    "k4_replace_rows",
    f"""WITH {_USERS}
    SELECT user_id, event_id, event_type, value, props AS note FROM t WHERE user_id NOT IN (SELECT user_id FROM b)
    UNION ALL SELECT user_id, event_id, event_type, CASE WHEN event_type <> 'error' THEN value END, NULL FROM b""",
)
def _(t: Tables):
    target, batch = user_state(t)
    return upserts.replace_rows(target, batch, "user_id", ["ts"])


@query(
    "k5_full_refresh",
    """SELECT o_orderkey AS id, try_cast(o_totalprice AS double) AS amount,
              CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS label FROM orders""",
)
def _(t: Tables):
    path = shared_folder(t.spark, "refresh")
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_totalprice").cast("string").alias("amount"),
        F.when(F.col("o_orderpriority") == "5-LOW", "null").otherwise(F.col("o_orderpriority")).alias("label"),
        F.lit("x").alias("unknown"),
    )
    schema = T.StructType.fromDDL("id bigint, amount double, label string")
    sinks.full_refresh(raw.limit(0), schema, path)
    sinks.full_refresh(raw, schema, path)
    return sinks.read_current(t.spark, path)


@query("k6_truncate_tables", "SELECT 'orders' AS name, 'ok' AS result, 0 AS rows UNION ALL SELECT 'customer', 'ok', 0 UNION ALL SELECT 'absent', 'failed', NULL")
def _(t: Tables):
    base = shared_folder(t.spark, "truncate")
    sinks.write_replace(t.orders, f"{base}/orders")
    sinks.write_replace(t.customer, f"{base}/customer")
    names = ["orders", "customer", "absent"]
    report = sinks.truncate_tables(t.spark, [f"{base}/{n}" for n in names])
    left = sinks.counts_report({n: sinks.read_current(t.spark, f"{base}/{n}") for n in names[:2]})
    report = report.select(F.regexp_extract("table_name", r"([^/]+)$", 1).alias("name"), "result")
    return report.join(left.withColumnRenamed("table_name", "name"), "name", "left").select("name", "result", "rows")


@query(
    "k7_latest_then_upsert",
    """WITH t AS (SELECT user_id, min(event_id) AS id, min(value) AS value, 'old' AS create_time FROM events
                  WHERE ts < '2024-01-16' GROUP BY user_id),
            b AS (SELECT * FROM (SELECT *, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS at,
                    row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END
                                       DESC NULLS LAST, event_id) AS rn FROM events WHERE ts >= '2024-01-16') WHERE rn = 1)
       SELECT coalesce(t.user_id, b.user_id) AS user_id, CASE WHEN t.user_id IS NULL THEN b.event_id ELSE t.id END AS id,
              CASE WHEN b.user_id IS NULL THEN t.value ELSE b.value END AS value,
              CASE WHEN t.user_id IS NULL THEN 'new' ELSE t.create_time END AS create_time
       FROM t FULL JOIN b ON b.user_id = t.user_id""",
)
def _(t: Tables):
    old, new = t.events.where(F.col("ts") < CUT), t.events.where(F.col("ts") >= CUT)
    target = old.groupBy("user_id").agg(F.min("event_id").alias("id"), F.min("value").alias("value"), F.lit("old").alias("create_time"))
    at = F.when(F.col("event_type") == "error", F.lit("unreadable")).otherwise(F.date_format("ts", "yyyy/M/d H:m:s"))
    batch = new.select("user_id", F.col("event_id").alias("id"), "value", F.lit("new").alias("create_time"), at.alias("at"))
    return upserts.latest_then_upsert(target, batch, "user_id", "at")


@query(
    "k7_stored_latest_record",
    """WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "at", CASE WHEN ts < '2024-01-16' THEN 1 ELSE 2 END AS batch FROM events WHERE event_type <> 'error'),
            n AS (SELECT *, row_number() OVER (PARTITION BY user_id, batch ORDER BY "at" DESC, event_id) AS rn,
                    min(batch) OVER (PARTITION BY user_id) AS first_batch, max(batch) OVER (PARTITION BY user_id) AS last_batch FROM e),
            w AS (SELECT * FROM n WHERE rn = 1)
       SELECT l.user_id, f.event_id AS id, 'batch ' || f.batch AS create_time, l.value, l."at"
       FROM w l JOIN w f ON f.user_id = l.user_id AND f.batch = f.first_batch WHERE l.batch = l.last_batch""",
)
def _(t: Tables):
    path = shared_folder(t.spark, "records")
    schema = T.StructType.fromDDL("user_id bigint, id bigint, create_time string, value double, at string")
    conf = sinks.TableConf(path, schema, "user_id", mode="latest_record", ts="at")
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at")
    rows = t.events.where("event_type <> 'error'").select("user_id", F.col("event_id").alias("id"), "value", at, "ts")
    for number, part in enumerate((rows.where(F.col("ts") < CUT), rows.where(F.col("ts") >= CUT)), 1):
        sinks.save(conf, part.withColumn("create_time", F.lit(f"batch {number}")).drop("ts"))
    sinks.clean_keyed(t.spark, path)
    return sinks.read_keyed(t.spark, path)


@query("k8_save_by_mode", """SELECT 'keyed' AS kind, user_id AS id, event_id AS n FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1
       UNION ALL SELECT 'full', c_custkey, c_nationkey FROM customer""")
def _(t: Tables):
    base = shared_folder(t.spark, "save")
    schema = T.StructType.fromDDL("id bigint, n bigint")
    keyed = sinks.TableConf(f"{base}/keyed", schema, "id", ["n"])
    rows = t.events.select(F.col("user_id").cast("string").alias("id"), F.col("event_id").alias("n"), "ts")
    sinks.save(keyed, rows.where(F.col("ts") < CUT))
    sinks.save(keyed, rows.where(F.col("ts") >= CUT))
    full = sinks.TableConf(f"{base}/full", schema)
    sinks.save(full, t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("n")))
    a = sinks.read_keyed(t.spark, keyed.path).select(F.lit("keyed").alias("kind"), "id", "n")
    b = sinks.read_current(t.spark, full.path).select(F.lit("full").alias("kind"), "id", "n")
    return a.unionByName(b)


@query("k9_document_export", "SELECT p_partkey, p_name, p_retailprice, CASE WHEN p_size > 25 THEN p_size END AS size FROM part")
def _(t: Tables):
    path = shared_folder(t.spark, "export")
    size = F.when(F.col("p_size") > 25, F.col("p_size")).alias("size")
    sinks.write_documents(t.part.select("p_partkey", "p_name", "p_retailprice", size), path)
    schema = "p_partkey bigint, p_name string, p_retailprice double, size int"
    return sinks.read_current(t.spark, path, "json", schema=schema)


@query("k10_csv_export", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(t: Tables):
    path = shared_folder(t.spark, "csv")
    sinks.write_csv(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), path)
    schema = "s_suppkey bigint, s_name string, s_acctbal double"
    return sinks.read_current(t.spark, path, "csv", schema=schema, header="true")


@query(
    "k11_money_types",
    """SELECT l_orderkey, cast(cast(l_extendedprice AS decimal(18,2)) AS varchar) AS price, 'decimal(18,2)' AS price_type,
              cast(cast(l_discount AS decimal(10,2)) AS varchar) AS discount, 'decimal(10,2)' AS discount_type FROM lineitem""",
)
def _(t: Tables):
    money = conform_money(t.lineitem.select("l_orderkey", F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount")))
    kind = {f.name: f.dataType.simpleString() for f in money.schema.fields}
    return money.select(
        "l_orderkey", F.col("price").cast("string").alias("price"), F.lit(kind["price"]).alias("price_type"),
        F.col("discount").cast("string").alias("discount"), F.lit(kind["discount"]).alias("discount_type"),
    )


@query(
    "k12_incremental_update",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def _(t: Tables):
    path = shared_folder(t.spark, "incremental")
    cols = ["o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"]
    old = latest_per_key(t.orders.where(F.col("o_orderdate") < "2001-06-01").select(*cols), ["o_custkey"], ["o_orderdate"])
    sinks.create_keyed(old, path, "o_custkey", 8)
    window = lambda df: tables.scan_since(df, "o_orderdate", as_of=datetime(2001, 8, 1), days=61)
    for _again in range(2):
        sinks.incremental_update(t.orders, path, "o_custkey", lambda df: df.select(*cols), window, ["o_orderdate"])
    return sinks.read_keyed(t.spark, path).select(*cols[:3])


@query(
    "k13_load_report",
    """SELECT 'nation' AS table_name, 'ok' AS result, count(*) AS rows FROM nation
       UNION ALL SELECT 'orders', 'ok', count(*) FROM orders UNION ALL SELECT 'broken', 'failed', NULL""",
)
def _(t: Tables):
    base = shared_folder(t.spark, "report")
    report = sinks.load_report(
        t.spark,
        {
            "nation": lambda: sinks.write_replace(t.nation, f"{base}/nation"),
            "orders": lambda: sinks.write_replace(t.orders.select("o_orderkey"), f"{base}/orders"),
            "broken": lambda: sinks.write_replace(t.nation.select("no_such_column"), f"{base}/broken"),
        },
    )
    return report.select("table_name", "result", "rows")


@query(
    "t1_stream_upsert",
    """SELECT user_id, event_id, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""",
)
def _(t: Tables):
    base = shared_folder(t.spark, "stream")
    rows = t.events.select("user_id", "event_id", "value", "ts")
    late, early = rows.where(F.col("ts") >= CUT), rows.where(F.col("ts") < CUT)
    for batch in (late, early):  # the older half lands last and must not win
        batch.write.mode("append").json(f"{base}/landed")
        stream = t.spark.readStream.schema("user_id bigint, event_id bigint, value double, ts timestamp_ntz").json(f"{base}/landed")
        stream_upsert(stream, f"{base}/table", "user_id", "ts", f"{base}/checkpoint").awaitTermination()
    return sinks.read_keyed(t.spark, f"{base}/table").select("user_id", "event_id", "value")


@query(
    "t2_stream_deletes",
    """WITH gone AS (SELECT cast(user_id AS varchar) AS id FROM events WHERE event_type = 'error'
                     UNION SELECT cast(user_id + 1 AS varchar) FROM events WHERE event_type = 'error')
       SELECT o_orderkey, o_custkey FROM orders WHERE cast(o_orderkey AS varchar) NOT IN (SELECT id FROM gone)""",
)
def _(t: Tables):
    from motorledger.queries.quality import delete_log

    base = shared_folder(t.spark, "deletes")
    sinks.create_keyed(t.orders.select("o_orderkey", "o_custkey"), f"{base}/orders", "o_orderkey", 8)
    delete_log(t).select("title", "contents").write.json(f"{base}/log")
    log = t.spark.readStream.schema("title string, contents string").json(f"{base}/log")
    stream_deletes(
        log, {"orders": f"{base}/orders"}, {"error": ["orders"]}, {"orders": "o_orderkey"}, f"{base}/checkpoint"
    ).awaitTermination()
    return sinks.read_keyed(t.spark, f"{base}/orders")
