"""Sorts, unions and reshaping."""

from pyspark.sql import functions as F

from motorledger.operators import reshape, unions
from motorledger.operators.quality import header_gaps
from motorledger.queries.registry import Tables, query


@query("o1_sorted", "SELECT vin, trim, settle_price FROM {sales} ORDER BY trim NULLS LAST, settle_price DESC NULLS LAST, vin")
def _(t: Tables):
    return unions.sort_by(t.sales.select("vin", "trim", "settle_price"), ["trim", ("settle_price", "desc"), "vin"])


@query(
    "o2_sorted_by_label_part",
    """SELECT concat(cast(year(o_orderdate) AS string), '年', cast(month(o_orderdate) AS string), '月') AS label,
              concat('Q', cast(quarter(o_orderdate) AS string)) AS quarter, count(*) AS n FROM orders GROUP BY 1, 2""",
)
def _(t: Tables):
    day = F.col("o_orderdate")
    label = F.concat(F.year(day).cast("string"), F.lit("年"), F.month(day).cast("string"), F.lit("月"))
    counted = t.orders.groupBy(label.alias("label"), F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter")).agg(F.count(F.lit(1)).alias("n"))
    return unions.sort_by_expr(counted, unions.month_of_label("label"), unions.quarter_number("quarter"))


@query("o3_top_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def _(t: Tables):
    return unions.sort_by(t.orders, [("o_totalprice", "desc"), "o_orderkey"]).limit(100).select("o_orderkey", "o_totalprice")


@query(
    "u1_union_outer",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL AS nation FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""",
)
def _(t: Tables):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return unions.union_outer(a, b)


@query("u2_union_distinct", "SELECT o_custkey AS id, o_orderstatus AS state FROM orders UNION SELECT c_custkey, 'F' FROM customer")
def _(t: Tables):
    a = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("state"))
    return unions.union_distinct(a, t.customer.select(F.col("c_custkey").alias("id"), F.lit("F").alias("state")))


@query(
    "u3_union_at_cutover",
    """SELECT o_orderkey, o_totalprice AS amount, cast(NULL AS varchar) AS rank, 'new' AS side FROM orders WHERE o_orderdate >= '1998-01-01'
       UNION ALL SELECT o_orderkey, NULL, o_orderpriority, 'old' FROM orders WHERE o_orderdate < '1998-01-01' OR o_orderpriority = '5-LOW'""",
)
def _(t: Tables):
    new = t.orders.select("o_orderkey", F.col("o_totalprice").alias("amount"), F.lit("new").alias("side"), "o_orderdate")
    old = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("rank"), F.lit("old").alias("side"), "o_orderdate")
    return unions.union_at_cutover(new, old, "o_orderdate", "1998-01-01", F.col("rank") == "5-LOW").drop("o_orderdate")


@query(
    "u4_relabel_positions",
    """SELECT p_brand AS series, p_type AS model FROM part UNION SELECT c_mktsegment, c_name FROM customer""",
)
def _(t: Tables):
    names = ["series", "model"]
    a = unions.relabel_positions(t.part.select("p_brand", "p_type"), names)
    return unions.union_distinct(a, unions.relabel_positions(t.customer.select("c_mktsegment", "c_name"), names))


@query(
    "u5_header_differences",
    """SELECT o_orderkey AS file, CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'F' END AS missing,
              concat_ws(',', CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END, o_orderpriority) AS extra FROM orders""",
)
def _(t: Tables):
    listed = t.orders.select("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("headers"))
    gaps = header_gaps(listed, "o_orderkey", "headers", ["F"])
    return gaps.select("file", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"))


def yearly_wide(t: Tables):
    """Quantity per year and return flag, one column per flag."""
    return (
        t.lineitem.groupBy(F.year("l_shipdate").alias("year"), F.col("l_linestatus").alias("state"))
        .pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum(F.col("l_quantity").cast("bigint")))
    )


@query(
    "r1_melt",
    """SELECT year(l_shipdate) AS year, l_linestatus AS state, f AS flag, cast(sum(CASE WHEN l_returnflag = f THEN l_quantity::bigint END) AS varchar) AS quantity
       FROM lineitem JOIN (SELECT 'A' AS f UNION ALL SELECT 'N' UNION ALL SELECT 'R') ON true GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    return reshape.melt(yearly_wide(t), ["year", "state"], "flag", "quantity")


def monthly_wide(t: Tables):
    """Per nation a score and a factor column for some months."""
    month = F.month("o_orderdate")
    nation = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("store"))
    count = lambda m: F.count_if(month == m)
    return nation.agg(
        *[count(m).alias(f"2026年{m}月得分") for m in (1, 2, 3)], *[(count(m) * 2).alias(f"2026年{m}月折让系数") for m in (2, 3, 4)]
    )


@query(
    "r2_melt_families",
    """SELECT c_nationkey AS store, concat('2026年', cast(m AS string), '月') AS month,
              CASE WHEN m <= 3 THEN cast(count(*) FILTER (month(o_orderdate) = m) AS double) END AS score,
              CASE WHEN m >= 2 THEN cast(2 * count(*) FILTER (month(o_orderdate) = m) AS double) END AS factor
       FROM orders JOIN customer ON c_custkey = o_custkey JOIN (SELECT unnest([1, 2, 3, 4]) AS m) ON true GROUP BY 1, m""",
)
def _(t: Tables):
    return reshape.melt_families(monthly_wide(t), "store", {"score": "得分", "factor": "折让系数"})


def quarterly_wide(t: Tables):
    cols = []
    for q in range(1, 5):
        inside = F.quarter("o_orderdate") == q
        cols += [F.count_if(inside).alias(f"q{q}_score"), F.max(F.when(inside, F.col("o_orderkey"))).alias(f"q{q}_incentive")]
        if q > 2:
            cols.append(F.max(F.when(inside, F.col("o_orderpriority"))).alias(f"q{q}_result"))
    return t.orders.groupBy(F.col("o_custkey").alias("store")).agg(*cols)


@query(
    "r3_quarters_to_rows",
    """SELECT o_custkey AS store, concat('2026Q', cast(q AS string)) AS quarter, cast(count(*) FILTER (quarter(o_orderdate) = q) AS double) AS score,
              CASE WHEN q > 2 THEN max(o_orderpriority) FILTER (quarter(o_orderdate) = q) END AS result,
              cast(max(o_orderkey) FILTER (quarter(o_orderdate) = q) AS double) AS incentive
       FROM orders JOIN (SELECT unnest([1, 2, 3, 4]) AS q) ON true GROUP BY 1, q""",
)
def _(t: Tables):
    return reshape.quarters_to_rows(quarterly_wide(t), "store", "2026")


@query(
    "r4_month_to_quarter",
    """WITH m AS (SELECT o_custkey AS store, month(o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1, 2)
       SELECT store, coalesce(round_even(avg(n) FILTER (m <= 3), 2), 0) AS q1_score, cast(coalesce(sum(n) FILTER (m IN (2, 3)), 0) AS double) AS q1_incentive
       FROM m GROUP BY store""",
)
def _(t: Tables):
    n = lambda m: F.count_if(F.month("o_orderdate") == m)
    wide = t.orders.groupBy(F.col("o_custkey").alias("store")).agg(
        *[F.when(n(m) > 0, n(m).cast("double")).alias(f"m{m}") for m in (1, 2, 3)]
    )
    return reshape.month_to_quarter(wide, "store", {1: {"score": ["m1", "m2", "m3"], "incentive": ["m2", "m3"]}})


@query(
    "r5_filter_attributes",
    """SELECT l_linestatus AS state, year(l_shipdate) AS year, 'R得分' AS attribute, cast(sum(l_quantity::bigint) FILTER (l_returnflag = 'R') AS varchar) AS value
       FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2""",
)
def _(t: Tables):
    wide = yearly_wide(t).withColumnsRenamed({"R": "R得分", "A": "Unnamed: 3"}).withColumn("state", F.when(F.col("state") == "F", F.col("state")))
    long = reshape.melt(wide, ["state", "year"])
    return reshape.filter_attributes(long, "attribute", drop="Unnamed", keep="得分", key="state")


@query(
    "r6_explode_ids",
    """SELECT event_id, cast(user_id AS varchar) AS id FROM events UNION ALL SELECT event_id, cast(user_id + 1 AS varchar) FROM events""",
)
def _(t: Tables):
    listed = t.events.select("event_id", F.concat(F.lit(" "), F.col("user_id"), F.lit(", ,"), F.col("user_id") + 1, F.lit(",")).alias("ids"))
    return reshape.explode_ids(listed, "ids", "id").select("event_id", "id")
