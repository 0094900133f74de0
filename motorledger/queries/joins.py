"""Joins."""

from pyspark.sql import functions as F

from motorledger.operators import joins
from motorledger.queries.registry import Tables, query


@query(
    "j1_left_lookup",
    "SELECT l_orderkey, l_linenumber, l_quantity, o_totalprice, o_orderpriority FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F'",
)
def _(t: Tables):
    left = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    right = t.orders.where("o_orderstatus = 'F'").withColumnRenamed("o_orderkey", "l_orderkey")
    return joins.left_lookup(left, right, ["l_orderkey"], cols=["o_totalprice", "o_orderpriority"])


@query("j2_left_lookup_other_key_name", "SELECT o_orderkey, c_name AS buyer, c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def _(t: Tables):
    out = joins.left_lookup(t.orders, t.customer, ["o_custkey"], ["c_custkey"], {"c_name": "buyer", "c_mktsegment": "c_mktsegment"})
    return out.select("o_orderkey", "buyer", "c_mktsegment")


@query(
    "j3_left_lookup_composite",
    """SELECT s.vin, k.cost FROM {sales} s LEFT JOIN (
         SELECT store, seller, sum(cost) AS cost FROM {decoration} WHERE store IS NOT NULL AND seller IS NOT NULL GROUP BY store, seller) k
       ON k.store = s.store AND k.seller = s.seller""",
)
def _(t: Tables):
    sums = t.decoration.groupBy("store", "seller").agg(F.sum("cost").alias("cost"))
    return joins.left_lookup(t.sales, sums, ["store", "seller"]).select("vin", "cost")


@query(
    "j4_outer_merge",
    """WITH a AS (SELECT o_custkey AS buyer, sum(o_orderkey) AS early FROM orders WHERE o_orderdate < '1996-01-01' GROUP BY 1),
            b AS (SELECT o_custkey AS buyer, sum(o_orderkey) AS late FROM orders WHERE o_orderdate >= '2001-01-01' GROUP BY 1)
       SELECT buyer, early, late FROM a FULL JOIN b USING (buyer)""",
)
def _(t: Tables):
    o = t.orders.withColumnRenamed("o_custkey", "buyer")
    a = o.where(F.col("o_orderdate") < "1996-01-01").groupBy("buyer").agg(F.sum("o_orderkey").alias("early"))
    b = o.where(F.col("o_orderdate") >= "2001-01-01").groupBy("buyer").agg(F.sum("o_orderkey").alias("late"))
    return joins.outer_merge(a, b, ["buyer"])


@query(
    "j5_star_join",
    """SELECT s.vin, s.seller, c.adjustment, c.gov_subsidy, l.loan_amount, l.term, i.invoice_store FROM {sales} s
       LEFT JOIN (SELECT * FROM (SELECT vin, adjustment, gov_subsidy, row_number() OVER (PARTITION BY vin
           ORDER BY op_date DESC, adjustment, gov_subsidy) AS rn FROM {vehicle_cost}) WHERE rn = 1) c ON c.vin = s.vin
       LEFT JOIN {loan_business} l ON l.vin = s.vin
       LEFT JOIN (SELECT * FROM (SELECT vin, invoice_store, row_number() OVER (PARTITION BY vin
           ORDER BY download_time DESC, invoice_store) AS rn FROM {invoices}) WHERE rn = 1) i ON i.vin = s.vin""",
)
def _(t: Tables):
    return joins.star_join(
        t.sales.select("vin", "seller"), "vin",
        [
            joins.Lookup(t.vehicle_cost, ["adjustment", "gov_subsidy", "absent"], ["op_date"]),
            joins.Lookup(t.loan_business, ["loan_amount", "term"]),
            joins.Lookup(None, ["nothing"]),
            joins.Lookup(t.invoices, ["invoice_store"], ["download_time"]),
        ],
    )


@query(
    "j6_semi_and_flag",
    """SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 30)
              THEN '是' ELSE '否' END AS big_return
       FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def _(t: Tables):
    rich = joins.semi(t.orders, t.customer.where("c_acctbal > 0"), "o_custkey", "c_custkey")
    returned = t.lineitem.where("l_returnflag = 'R' AND l_quantity > 30")
    return joins.flag_in(rich, returned, "o_orderkey", "big_return", right_on="l_orderkey").select("o_orderkey", "big_return")


@query(
    "j7_anti",
    "SELECT vin, id, item FROM {decoration} WHERE vin IS NULL OR vin NOT IN (SELECT vin FROM {terminal_vins})",
)
def _(t: Tables):
    return joins.anti(t.decoration, t.terminal_vins, "vin").select("vin", "id", "item")


@query(
    "j8_interval_join",
    """WITH w AS (SELECT p_brand, y AS start_year, y + 1 AS end_year, cast(floor(avg(p_retailprice)) AS bigint) AS price
                  FROM part JOIN (SELECT 1995 AS y UNION ALL SELECT 1996 UNION ALL SELECT 1997 UNION ALL SELECT 1999) ON true GROUP BY 1, 2),
            l AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, p_brand, l_shipdate FROM lineitem JOIN part ON p_partkey = l_partkey),
            d AS (SELECT l.*, (SELECT max({'s': start_year, 'p': price}) FROM w WHERE w.p_brand = l.p_brand
                       AND l_shipdate >= make_date(start_year, 3, 1) AND l_shipdate <= make_date(end_year, 6, 30)) AS hit FROM l)
       SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, hit.s AS start_year, hit.p AS price FROM d""",
)
def _(t: Tables):
    years = F.explode(F.array(*[F.lit(y) for y in (1995, 1996, 1997, 1999)]))
    w = (
        t.part.select("p_brand", "p_retailprice", years.alias("start_year")).groupBy("p_brand", "start_year")
        .agg(F.floor(F.avg("p_retailprice")).alias("price"))
        .withColumns(
            {
                "s": F.make_date("start_year", F.lit(3), F.lit(1)).cast("timestamp_ntz"),
                "e": F.make_date(F.col("start_year") + 1, F.lit(6), F.lit(30)).cast("timestamp_ntz"),
            }
        )
    )
    ship = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate")
    branded = joins.left_lookup(ship, t.part, ["l_partkey"], ["p_partkey"], ["p_brand"])
    out = joins.interval_join(branded, w, ["p_brand"], "l_shipdate", "s", "e", ["start_year", "price"])
    return out.drop("p_brand", "l_shipdate")


@query(
    "j9_asof_lookup",
    """WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'), s AS (SELECT * FROM events WHERE event_type = 'signup')
       SELECT p.event_id, p.user_id, hit.e AS signup_id, hit.v AS signup_value FROM (
         SELECT p.*, (SELECT max({'t': s.ts, 'e': s.event_id, 'v': s.value}) FROM s WHERE s.user_id = p.user_id AND s.ts <= p.ts) AS hit FROM p) AS p""",
)
def _(t: Tables):
    bought = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    signed = t.events.where("event_type = 'signup'").select(
        "user_id", F.col("ts").alias("since"), F.col("event_id").alias("signup_id"), F.col("value").alias("signup_value")
    )
    return joins.asof_lookup(bought, signed, ["user_id"], "ts", "since", ["signup_id", "signup_value"]).drop("ts")


@query(
    "j10_latest_lookup",
    """SELECT s.vin, s.store, i.invoice_store FROM {sales} s LEFT JOIN (SELECT * FROM (SELECT vin, invoice_store,
         row_number() OVER (PARTITION BY vin ORDER BY download_time DESC, doc_kind, invoice_store) AS rn FROM {invoices}) WHERE rn = 1) i
       ON i.vin = s.vin""",
)
def _(t: Tables):
    return joins.latest_lookup(t.sales.select("vin", "store"), t.invoices, ["vin"], ["download_time"], ["invoice_store"])


@query(
    "j11_suffix_join",
    """SELECT s.vin, r.push, r.store FROM {sales} s LEFT JOIN (SELECT * FROM (SELECT right(vin, 6) AS k, l_ship AS push, store,
         row_number() OVER (PARTITION BY right(vin, 6) ORDER BY l_ship DESC, store) AS rn FROM
         (SELECT vin, store, CASE WHEN push_date = 'bad' THEN NULL ELSE push_date END AS l_ship FROM {film_push})) WHERE rn = 1) r
       ON r.k = right(s.vin, 6)""",
)
def _(t: Tables):
    push = t.film_push.select("vin", F.nullif("push_date", F.lit("bad")).alias("push"), "store")
    return joins.suffix_join(t.sales.select("vin"), push, "vin", ["push", "store"], ["push"])


@query(
    "j12_match_key_join",
    """WITH h AS (SELECT phone1, buyer, series, min(host) AS host FROM {unsold} GROUP BY phone1, buyer, series)
       SELECT o.vin, h.host FROM {order_business} o LEFT JOIN h ON coalesce(h.phone1, '') = coalesce(o.phone1, '')
         AND coalesce(h.buyer, '') = coalesce(o.buyer, '') AND coalesce(h.series, '') = coalesce(o.series, '')""",
)
def _(t: Tables):
    on = ["phone1", "buyer", "series"]
    return joins.key_lookup(t.order_business.select("vin", *on), t.unsold, on, on, ["host"]).drop(*on)


@query(
    "j13_qualify_store",
    """SELECT vin, CASE WHEN s.store = '直播基地' AND d.network IS NOT NULL THEN concat(d.network, '-', s.store) ELSE s.store END AS store
       FROM {sales} s LEFT JOIN {series_dim} d ON d.series = s.series""",
)
def _(t: Tables):
    return joins.qualify_store(t.sales.select("vin", "store", "series"), t.series_dim, "store", "series").drop("series")


@query(
    "j14_existence_flag",
    "SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 'yes' ELSE 'no' END AS open FROM customer",
)
def _(t: Tables):
    open_orders = t.orders.where("o_orderstatus = 'P'")
    return joins.flag_in(t.customer, open_orders, "c_custkey", "open", "yes", "no", right_on="o_custkey").select("c_custkey", "open")


@query(
    "j15_stacked_keys",
    """WITH s AS (SELECT 0 AS i, concat('O', cast(o_orderkey AS string)) AS k, o_totalprice AS v FROM orders
                  UNION ALL SELECT 1, concat('C', cast(o_custkey AS string)), o_totalprice FROM orders
                  UNION ALL SELECT 2, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat('O', cast(o_orderkey + 7 AS string)) END, o_totalprice FROM orders),
            m AS (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY i, v) AS rn FROM s WHERE k IS NOT NULL)
       SELECT k AS id, v AS plan FROM m WHERE rn = 1""",
)
def _(t: Tables):
    df = t.orders.select(
        F.concat(F.lit("O"), "o_orderkey").alias("a"), F.concat(F.lit("C"), "o_custkey").alias("b"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("O"), F.col("o_orderkey") + 7)).alias("c"),
        F.col("o_totalprice").alias("plan"),
    )
    return joins.stack_keys(df, ["a", "b", "c"], "plan", "id")


@query(
    "j16_prefer_merge",
    """WITH a AS (SELECT o_custkey AS buyer, CASE WHEN min(o_orderkey) % 2 = 0 THEN 0 ELSE max(o_totalprice) END AS score FROM orders WHERE o_orderdate < '1998-01-01' GROUP BY 1),
            b AS (SELECT o_custkey AS buyer, max(o_totalprice) AS score FROM orders WHERE o_orderdate >= '2001-03-01' GROUP BY 1)
       SELECT a.buyer, CASE WHEN a.score IS NOT NULL AND a.score <> 0 THEN a.score ELSE coalesce(b.score, a.score) END AS score
       FROM a LEFT JOIN b ON b.buyer = a.buyer""",
)
def _(t: Tables):
    o = t.orders.withColumnRenamed("o_custkey", "buyer")
    top = F.max("o_totalprice")
    a = o.where(F.col("o_orderdate") < "1998-01-01").groupBy("buyer").agg(
        F.when(F.min("o_orderkey") % 2 == 0, F.lit(0.0)).otherwise(top).alias("score")
    )
    b = o.where(F.col("o_orderdate") >= "2001-03-01").groupBy("buyer").agg(top.alias("score"))
    return joins.prefer_merge(a, b, ["buyer"], ["score"])


@query(
    "j17_in_place_subset",
    """SELECT purchase_no, vin, CASE WHEN arrival_date IS NOT NULL AND shipped_date IS NOT NULL
              THEN date_diff('day', shipped_date, arrival_date) + 1 END AS lead_days FROM {stock}""",
)
def _(t: Tables):
    from motorledger.functions.dates import days_between

    return t.stock.select("purchase_no", "vin", days_between("arrival_date", "shipped_date", inclusive=True).cast("bigint").alias("lead_days"))
