"""Aggregation and one-row-per-key operators."""

from pyspark.sql import functions as F

from motorledger.functions.nulls import count_positive, row_mean, row_sum
from motorledger.operators import groups, keep
from motorledger.queries.registry import Tables, query


@query("a1_group_sum", "SELECT seller, round(coalesce(sum(revenue), 0), 2) AS revenue, coalesce(sum(cost), 0) AS cost FROM {decoration} WHERE seller IS NOT NULL GROUP BY seller")
def _(t: Tables):
    return groups.group_sum(t.decoration, ["seller"], ["revenue", "cost"]).withColumn("revenue", F.round("revenue", 2))


@query(
    "a2_mixed_aggregates",
    """SELECT vin, sum(cost) AS cost, min_by(item_state, (receipt_date IS NULL, receipt_date, item_state)) FILTER (item_state IS NOT NULL) AS state,
              strftime(min(receipt_date), '%Y-%m-%d') AS first_day, string_agg(DISTINCT doc_type, ',' ORDER BY doc_type) AS docs
       FROM {decoration} WHERE vin IS NOT NULL GROUP BY vin""",
)
def _(t: Tables):
    spec = {
        "cost": F.sum("cost"), "state": groups.first_known("item_state", ["receipt_date"]),
        "first_day": F.date_format(F.min("receipt_date"), "yyyy-MM-dd"), "docs": groups.join_distinct("doc_type"),
    }
    return groups.group_agg(t.decoration, ["vin"], spec)


@query("a3_join_distinct", "SELECT seller, coalesce(string_agg(DISTINCT item, ',' ORDER BY item), '') AS items FROM {decoration} WHERE seller IS NOT NULL GROUP BY seller")
def _(t: Tables):
    return groups.group_agg(t.decoration, ["seller"], {"items": groups.join_distinct("item")})


@query(
    "a4_join_dates",
    """SELECT id, coalesce(string_agg(DISTINCT strftime(receipt_date, '%Y/%m/%d'), ',' ORDER BY strftime(receipt_date, '%Y/%m/%d')), '') AS days
       FROM {decoration} GROUP BY id""",
)
def _(t: Tables):
    return groups.group_agg(t.decoration, ["id"], {"days": groups.join_dates("receipt_date")})


@query("a5_join_all", "SELECT vin, string_agg(item, ',' ORDER BY item) AS items FROM {decoration} WHERE vin IS NOT NULL GROUP BY vin")
def _(t: Tables):
    return groups.join_all(t.decoration, ["vin"], "item", "items")


def _parts_sql(copies: str, limit: int) -> str:
    """Parts of the items of a seller, by a running size over the whole seller."""
    return f"""WITH c AS (SELECT seller, item, {copies} AS n, greatest(1, {limit} // (length(item) + 1)) AS most FROM {{decoration}}
                          WHERE seller IS NOT NULL AND item IS NOT NULL GROUP BY seller, item),
            r AS (SELECT seller, item, run, least(most, n - run * most) AS k FROM (SELECT *, unnest(range(0, (n - 1) // most + 1)) AS run FROM c)),
            p AS (SELECT *, (sum(k * (length(item) + 1)) OVER (PARTITION BY seller ORDER BY item, run) - k * (length(item) + 1)) // {limit} AS slot FROM r),
            t AS (SELECT seller, slot, string_agg(repeat(item || ',', CAST(k - 1 AS INT)) || item, ',' ORDER BY item, run) AS items FROM p GROUP BY seller, slot)
       SELECT seller, row_number() OVER (PARTITION BY seller ORDER BY slot) - 1 AS part, items FROM t"""


@query("a5_joined_parts", _parts_sql("count(*)", 500))
def _(t: Tables):
    return groups.joined_parts(t.decoration, ["seller"], "item", "items", limit=500)


@query("a3_joined_parts", _parts_sql("CAST(1 AS BIGINT)", 200))
def _(t: Tables):
    return groups.joined_parts(t.decoration, ["seller"], "item", "items", distinct_items=True, limit=200)


@query(
    "a6_join_items",
    """SELECT order_no, string_agg(concat(item, '*', cast(cast(qty AS bigint) AS string)), ',' ORDER BY concat(item, '*', cast(cast(qty AS bigint) AS string))) AS items
       FROM {decoration} GROUP BY order_no""",
)
def _(t: Tables):
    return groups.group_items(t.decoration, ["order_no"], groups.item_text("item", "qty"), "items")


@query("a7_group_count", "SELECT vin, count(*) AS cnt FROM {decoration} WHERE vin IS NOT NULL GROUP BY vin")
def _(t: Tables):
    return groups.group_count(t.decoration, ["vin"])


@query("a8_earliest_date", "SELECT seller, strftime(min(receipt_date), '%Y/%m/%d') AS first_receipt FROM {decoration} WHERE seller IS NOT NULL GROUP BY seller")
def _(t: Tables):
    return groups.group_agg(t.decoration, ["seller"], {"first_receipt": F.date_format(F.min("receipt_date"), "yyyy/MM/dd")})


@query(
    "a9_conditional_sums",
    """SELECT store, sum(CASE WHEN contains(item, '膜') THEN cost ELSE 0 END) AS film, sum(CASE WHEN contains(item, '膜') THEN 0 ELSE cost END) AS other,
              sum(CASE WHEN contains(item, '龙膜') THEN cost ELSE 0 END) AS brand FROM {decoration} GROUP BY store""",
)
def _(t: Tables):
    film = F.col("item").contains("膜")
    spec = {
        "film": groups.sum_where("cost", film), "other": groups.sum_where("cost", ~film),
        "brand": groups.sum_where("cost", F.col("item").contains("龙膜")),
    }
    return groups.group_agg(t.decoration, ["store"], spec)


@query(
    "a10_summary",
    """SELECT 'sales' AS table_name, count(*) AS rows, count(DISTINCT store) AS stores, count(DISTINCT series) AS series,
              round(avg(settle_price), 2) AS mean_value, 0 AS in_stock FROM {sales}
       UNION ALL SELECT 'stock', count(*), count(DISTINCT store), count(DISTINCT series), round(avg(stock_days), 2),
              count(*) FILTER (contains(vehicle_status, '在库')) FROM {stock}""",
)
def _(t: Tables):
    sold = t.sales.withColumnRenamed("settle_price", "unit_profit")
    return groups.summary(sold, t.stock, "在库").withColumn("mean_value", F.round("mean_value", 2))


@query(
    "a11_row_sum",
    """SELECT vin, coalesce(transfer_fee, 0) + coalesce(other_deposit, 0) + coalesce(voucher, 0) AS total,
              CASE WHEN transfer_fee IS NULL AND other_deposit IS NULL THEN NULL
                   ELSE coalesce(transfer_fee, 0) + coalesce(other_deposit, 0) END AS known FROM {sales}""",
)
def _(t: Tables):
    return t.sales.select(
        "vin", row_sum(["transfer_fee", "other_deposit", "voucher"]).alias("total"),
        row_sum(["transfer_fee", "other_deposit"], min_count=1).alias("known"),
    )


@query(
    "a12_row_mean",
    """SELECT vin, CASE WHEN transfer_fee IS NULL THEN voucher ELSE (transfer_fee + voucher) / 2 END AS mean_known,
              coalesce(transfer_fee, 0) AS mean_or_zero FROM {sales}""",
)
def _(t: Tables):
    return t.sales.select(
        "vin", row_mean(["transfer_fee", "voucher", "other_deposit"]).alias("mean_known"),
        row_mean(["transfer_fee", "other_deposit"]).alias("mean_or_zero"),
    )


@query(
    "a13_count_positive",
    """SELECT vin, (CASE WHEN transfer_fee > 0 THEN 2 ELSE 0 END + CASE WHEN voucher > 0 THEN 1 ELSE 0 END
              + CASE WHEN plate_fee > 0 THEN 1 ELSE 0 END) AS items FROM {sales}""",
)
def _(t: Tables):
    return t.sales.select("vin", count_positive(["transfer_fee", "voucher", "plate_fee"], {"transfer_fee": 2}).alias("items"))


@query("a14_distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def _(t: Tables):
    return groups.distinct(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"))


@query(
    "w1_latest_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
         ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def _(t: Tables):
    return keep.latest_per_key(t.orders, ["o_custkey"], ["o_orderdate"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "w2_first_and_last_per_key",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity,
                    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS a,
                  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity,
                    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS b FROM lineitem)
       SELECT 'first' AS which, l_orderkey, l_linenumber, l_partkey, l_quantity FROM r WHERE a = 1
       UNION ALL SELECT 'last', l_orderkey, l_linenumber, l_partkey, l_quantity FROM r WHERE b = 1""",
)
def _(t: Tables):
    keys, cols = ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    a = keep.first_per_key(t.lineitem, keys, ["l_shipdate"]).select(F.lit("first").alias("which"), *cols)
    return a.unionByName(keep.last_per_key(t.lineitem, keys, ["l_shipdate"]).select(F.lit("last").alias("which"), *cols))


@query(
    "w3_group_span",
    """SELECT o_orderkey, date_diff('day', min(o_orderdate) OVER (PARTITION BY o_custkey), max(o_orderdate) OVER (PARTITION BY o_custkey)) AS span_days FROM orders""",
)
def _(t: Tables):
    return keep.group_span_days(t.orders, "o_custkey", "o_orderdate").select("o_orderkey", F.col("span_days").cast("bigint").alias("span_days"))


@query(
    "w4_tenure",
    """SELECT seller, store, tenure_days, cast(ceil(tenure_days / 30.0) AS bigint) AS tenure_months, concat(store, '-', seller) AS seller_key FROM (
         SELECT seller, max({'t': sale_date, 's': store}).s AS store, date_diff('day', min(sale_date), max(sale_date)) AS tenure_days
         FROM {sales} GROUP BY seller)""",
)
def _(t: Tables):
    out = keep.tenure(t.sales, "seller", "store", "sale_date")
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("tenure_days", "tenure_months")})


@query(
    "w5_allocate_once",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN rn = 1 THEN o_totalprice ELSE 0 END AS share FROM (
         SELECT l_orderkey, l_linenumber, l_partkey, o_totalprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS rn
         FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey)""",
)
def _(t: Tables):
    from motorledger.operators.joins import left_lookup

    lines = left_lookup(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), t.orders, ["l_orderkey"], ["o_orderkey"], {"o_totalprice": "share"})
    return keep.allocate_once(lines, ["l_orderkey"], "share", ["l_linenumber", "l_partkey"])


@query(
    "w6_dedupe_except",
    """SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'P'
       UNION ALL SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
         FROM orders WHERE o_orderstatus <> 'P') WHERE rn = 1""",
)
def _(t: Tables):
    out = keep.dedupe_except(t.orders, F.col("o_orderstatus") == "P", ["o_custkey"], ["o_orderdate"])
    return out.select("o_custkey", "o_orderkey")


@query("w7_any_in_group", "SELECT l_orderkey, l_linenumber, max(l_returnflag = 'R') OVER (PARTITION BY l_orderkey)::int AS returned FROM lineitem")
def _(t: Tables):
    out = keep.any_in_group(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"), "l_orderkey", F.col("l_returnflag") == "R", "returned")
    return out.select("l_orderkey", "l_linenumber", F.col("returned").cast("int").alias("returned"))
