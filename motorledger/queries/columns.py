"""Projection, conformance and filters."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorledger.functions.nulls import contains, non_empty, not_in
from motorledger.operators import columns, documents, rows
from motorledger.queries.registry import Tables, query

DAY = "yyyy-MM-dd"


@query("p1_select_existing", "SELECT c_name, c_custkey, 'gone' AS missing FROM customer")
def _(t: Tables):
    df, missing = columns.select_existing(t.customer, ["c_name", "gone", "c_custkey"])
    return df.withColumn("missing", F.lit(",".join(missing)))


@query("p2_rename_existing", "SELECT n_nationkey AS id, n_name AS store, n_regionkey FROM nation")
def _(t: Tables):
    return columns.rename_existing(t.nation, {"n_nationkey": "id", "n_name": "store", "absent": "x"})


@query("p3_ensure_columns", "SELECT r_regionkey, r_name, cast(NULL AS varchar) AS note, cast(NULL AS double) AS amount FROM region")
def _(t: Tables):
    return columns.ensure_columns(t.region, {"r_name": "string", "note": "string", "amount": "double"})


@query("p4_dedupe_columns", "SELECT o_orderkey AS id, o_custkey AS other FROM orders")
def _(t: Tables):
    doubled = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("other"), F.col("o_totalprice").alias("id"))
    return columns.dedupe_columns(doubled)


@query("p5_normalize_headers", "SELECT p_partkey AS partkey, p_name AS \"part name\" FROM part")
def _(t: Tables):
    return columns.normalize_headers(t.part.select(F.col("p_partkey").alias(" Part\nKey "), F.col("p_name").alias("Part Name")))


@query("p6_flatten_struct", "SELECT o_orderkey AS order_id, o_custkey AS order_buyer_id, o_orderpriority AS order_buyer_rank, o_totalprice AS amount FROM orders")
def _(t: Tables):
    buyer = F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("rank"))
    nested = t.orders.select(
        F.struct(F.col("o_orderkey").alias("id"), buyer.alias("buyer")).alias("order"), F.col("o_totalprice").alias("amount")
    )
    return columns.flatten_struct(nested)


@query(
    "p7_conform",
    """SELECT event_id AS id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS amount,
              CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id END AS buyer, strftime(ts, '%Y-%m-%d') AS day,
              '["' || event_type || '"]' AS tags FROM events""",
)
def _(t: Tables):
    raw = t.events.select(
        F.col("event_id").cast("string").alias("id"),
        F.when(F.col("event_type") == "error", F.lit("null")).otherwise(F.col("value").cast("string")).alias("amount"),
        F.when(F.col("user_id") % 3 == 0, F.concat("user_id", F.lit(".0"))).otherwise(F.col("user_id").cast("string")).alias("buyer"),
        F.date_format("ts", "yyyy/M/d").alias("day"), F.array("event_type").alias("tags"), F.lit(1).alias("unknown"),
    )
    schema = T.StructType.fromDDL("id bigint, amount double, buyer bigint, day timestamp_ntz, tags string, absent int")
    return columns.conform(raw, schema).withColumn("day", F.date_format("day", DAY))


@query("p8_constants", "SELECT r_name, '其他' AS team, 0 AS flag FROM region")
def _(t: Tables):
    return columns.with_constants(t.region.select("r_name"), {"team": "其他", "flag": 0})


@query("p9_fill_from", "SELECT vin, coalesce(trim, model) AS trim FROM {sales}")
def _(t: Tables):
    return columns.fill_from(t.sales.select("vin", "trim", "model"), "trim", "model").select("vin", "trim")


@query(
    "p10_mask_json",
    """SELECT event_id, '{"id":' || event_id || ',"user_token":"*****","tokens_user":{"password":"*****","keep":"' || event_type || '"},"apikeys":"x"}' AS masked FROM events""",
)
def _(t: Tables):
    body = F.to_json(
        F.struct(
            F.col("event_id").alias("id"), F.col("props").alias("user_token"),
            F.struct(F.col("value").cast("string").alias("password"), F.col("event_type").alias("keep")).alias("tokens_user"),
            F.lit("x").alias("apikeys"),
        )
    )
    return t.events.select("event_id", documents.mask_json_keys(body, ["token", "password", "apikey"]).alias("masked"))


@query(
    "p11_collect_json_keys",
    """SELECT event_id, CASE WHEN user_id = event_id THEN cast(user_id AS varchar)
                             ELSE '[' || user_id || ',' || event_id || ']' END AS ids,
              '"' || event_type || '"' AS kind, cast(NULL AS varchar) AS absent FROM events""",
)
def _(t: Tables):
    body = F.to_json(
        F.struct(
            F.col("user_id").alias("id"),
            F.array(F.struct(F.struct(F.col("event_id").alias("id")).alias("deep"), F.col("event_type").alias("kind")),
                    F.struct(F.lit(None).cast("struct<id: bigint>").alias("deep"), F.col("event_type").alias("kind"))).alias("items"),
        )
    )
    found = documents.collect_json_keys(body, ["id", "kind", "absent"])
    return t.events.select("event_id", found.alias("f")).select(
        "event_id", F.col("f.id").alias("ids"), F.col("f.kind").alias("kind"), F.col("f.absent").alias("absent")
    )


@query(
    "p12_set_where",
    """SELECT vin, CASE WHEN mode = '全款' THEN NULL ELSE invoice_price END AS invoice_price,
              CASE WHEN mode = '全款' THEN '无' ELSE team END AS team FROM {sales}""",
)
def _(t: Tables):
    df = t.sales.select("vin", "mode", "invoice_price", "team")
    return columns.set_where(df, F.col("mode") == "全款", {"invoice_price": None, "team": "无"}).drop("mode")


@query(
    "p13_fill_where",
    """SELECT purchase_no, vin, CASE WHEN vehicle_status = '在库' THEN strftime(coalesce(arrival_date, shipped_date), '%Y-%m-%d')
              ELSE strftime(arrival_date, '%Y-%m-%d') END AS arrived FROM {stock}""",
)
def _(t: Tables):
    df = columns.fill_where(t.stock, F.col("vehicle_status") == "在库", "arrival_date", "shipped_date")
    return df.select("purchase_no", "vin", F.date_format("arrival_date", DAY).alias("arrived"))


@query("f1_equality_chain", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def _(t: Tables):
    return rows.filter_eq(t.orders, [("o_orderstatus", "F"), ("o_orderpriority", "1-URGENT")]).select("o_orderkey")


@query(
    "f2_soft_deletes",
    """SELECT 'orders' AS source, count(*) AS rows FROM orders WHERE NOT (o_orderkey % 3 = 0) AND NOT (o_orderstatus = 'P')
       UNION ALL SELECT 'customer', count(*) FROM customer""",
)
def _(t: Tables):
    marked = t.orders.withColumns({"deleted": F.col("o_orderkey") % 3 == 0, "out_deleted": F.col("o_orderstatus") == "P"})
    out = rows.drop_soft_deleted(
        {"orders": marked, "customer": t.customer}, {"orders": ["deleted", "out_deleted"], "customer": "deleted", "absent": "x"}
    )
    counts = [df.agg(F.lit(n).alias("source"), F.count(F.lit(1)).alias("rows")) for n, df in out.items()]
    return counts[0].unionByName(counts[1])


@query("f3_non_empty", "SELECT vin, phone2 FROM {sales} WHERE phone2 IS NOT NULL AND phone2 <> ''")
def _(t: Tables):
    return t.sales.where(non_empty("phone2")).select("vin", "phone2")


@query("f4_not_in_keeps_null", "SELECT vin, team FROM {sales} WHERE team IS NULL OR team NOT IN ('调拨', '其他')")
def _(t: Tables):
    return t.sales.where(not_in("team", ["调拨", "其他"])).select("vin", "team")


@query(
    "f5_contains_with_null_value",
    """SELECT store, coalesce(contains(team, '组'), false)::int AS no_null, coalesce(contains(team, '组'), true)::int AS null_yes,
              count(*) AS n FROM {sales} GROUP BY ALL""",
)
def _(t: Tables):
    flags = {"no_null": contains("team", "组").cast("int"), "null_yes": contains("team", "组", na=True).cast("int")}
    return t.sales.withColumns(flags).groupBy("store", *flags).agg(F.count(F.lit(1)).alias("n"))


@query("f6_date_cutover_filters", "SELECT o_orderkey, CASE WHEN o_orderdate >= '1998-01-01' THEN 'since' ELSE 'before' END AS part FROM orders")
def _(t: Tables):
    a = rows.since(t.orders, "o_orderdate", "1998-01-01").select("o_orderkey", F.lit("since").alias("part"))
    return a.unionByName(rows.before(t.orders, "o_orderdate", "1998-01-01").select("o_orderkey", F.lit("before").alias("part")))


@query(
    "f7_package_rules",
    """SELECT vin, package, order_state FROM {package_sales}
       WHERE package <> '保赔无忧' AND (approval IS NULL OR approval <> '审批驳回')
         AND (order_state IS NULL OR order_state NOT IN ('已退卡', '已登记')) AND try_cast(amount AS double) <= 0""",
)
def _(t: Tables):
    from motorledger.functions.numbers import to_number

    amount = to_number("amount", default=None)
    return t.package_sales.where(
        (F.col("package") != "保赔无忧") & not_in("approval", ["审批驳回"])
        & not_in("order_state", ["已退卡", "已登记"]) & (amount <= 0)
    ).select("vin", "package", "order_state")


@query(
    "f8_prefer_rows",
    """SELECT id, out_id, item, qty FROM (SELECT *, max(out_id <> 0) OVER (PARTITION BY id) AS wanted FROM {decoration})
       WHERE id IS NOT NULL AND (out_id <> 0 OR NOT wanted)""",
)
def _(t: Tables):
    return rows.prefer_rows(t.decoration, "id", F.col("out_id") != 0).select("id", "out_id", "item", "qty")


@query(
    "f9_exclude_today",
    """SELECT 'morning' AS at, count(*) AS rows FROM orders WHERE o_orderdate < '2001-07-30'
       UNION ALL SELECT 'evening', count(*) FROM orders""",
)
def _(t: Tables):
    parts = [
        rows.exclude_today(t.orders, "o_orderdate", datetime(2001, 7, 30, hour)).agg(F.lit(name).alias("at"), F.count(F.lit(1)).alias("rows"))
        for name, hour in (("morning", 9), ("evening", 21))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "f10_excluded_keys",
    """SELECT DISTINCT l_orderkey FROM lineitem
       WHERE (l_returnflag = 'R' OR l_quantity IN (10.0, 11.0)) AND NOT (l_linestatus = 'O')""",
)
def _(t: Tables):
    rules = [F.col("l_returnflag") == "R", F.col("l_quantity").isin(10.0, 11.0)]
    return rows.excluded_keys(t.lineitem, "l_orderkey", rules, F.col("l_linestatus") == "O")
