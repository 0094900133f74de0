"""Data quality and the delete log."""

from pyspark.sql import functions as F

from motorledger.operators import deletes, quality
from motorledger.queries.registry import Tables, query
from motorledger.session import shared_folder, written
from motorledger.sources import ledgers


@query(
    "q1_header_check",
    """WITH s AS (SELECT DISTINCT o_orderstatus AS file FROM orders)
       SELECT file, 'missing' AS problem, unnest(['clerk', 'note']) AS header FROM s
       UNION ALL SELECT file, 'extra', 'o_totalprice' FROM s""",
)
def _(t: Tables):
    folder = shared_folder(t.spark, "headers")
    t.orders.drop("o_orderdate").write.option("header", True).partitionBy("o_orderstatus").csv(folder)
    part = F.regexp_extract("file", "o_orderstatus=([^/]+)/", 1)
    found = ledgers.ledger_headers(t.spark, folder, width=16).select(part.alias("file"), F.col("cells").alias("headers")).distinct()
    gaps = quality.header_gaps(found, "file", "headers", ["o_orderkey", "o_custkey", "clerk", "o_orderpriority", "note"])
    sides = [gaps.select("file", F.lit(side).alias("problem"), F.explode(side).alias("header")) for side in ("missing", "extra")]
    return sides[0].unionByName(sides[1])


# film ledger lines with every kind of mistake
LEDGER = """SELECT l_orderkey AS row, concat('f', cast(l_suppkey % 10 AS string)) AS file,
    CASE l_linenumber % 4 WHEN 0 THEN '13' WHEN 1 THEN NULL WHEN 2 THEN 'x' ELSE cast(l_linenumber AS string) END AS month,
    CASE l_partkey % 5 WHEN 0 THEN 'bad' WHEN 1 THEN NULL ELSE cast(l_shipdate AS string) END AS push_date,
    CASE l_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN cast(l_shipdate - INTERVAL '1' DAY AS string) ELSE cast(l_shipdate + INTERVAL '1' DAY AS string) END AS arrival_date,
    CASE l_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE 'someone' END AS consultant,
    CASE l_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN ' NATION_1 ' ELSE 'elsewhere' END AS store,
    CASE l_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN '12 34 56' WHEN 3 THEN 'A1-345' WHEN 4 THEN '12345' ELSE 'AB1234' END AS vin6
    FROM {lineitem}"""
RULES = [
    quality.month_rule("month"), quality.date_rule("push_date", required=False), quality.date_rule("arrival_date"),
    quality.text_rule("consultant"), quality.store_rule("store", ["NATION_1"]), quality.vin_rule("vin6"),
]
VIOLATIONS = f"""WITH r AS ({LEDGER}),
    v AS (SELECT file, row, 'month' AS rule, CASE WHEN month IS NULL THEN 'month is missing' ELSE concat('not a month: ', month) END AS message
            FROM r WHERE coalesce(try_cast(month AS int) NOT BETWEEN 1 AND 12, true)
          UNION ALL SELECT file, row, 'optional_date', concat('not a date: ', push_date) FROM r WHERE push_date = 'bad'
          UNION ALL SELECT file, row, 'date', 'date is missing' FROM r WHERE arrival_date IS NULL
          UNION ALL SELECT file, row, 'text', 'text is missing' FROM r WHERE consultant IS NULL OR trim(consultant) = ''
          UNION ALL SELECT file, row, 'store', CASE WHEN store IS NULL THEN 'store is missing' ELSE concat('unknown store: ', trim(store)) END
            FROM r WHERE store IS NULL OR trim(store) <> 'NATION_1'
          UNION ALL SELECT file, row, 'vin', CASE WHEN vin6 IS NULL OR trim(vin6) = '' THEN 'vin is missing' WHEN vin6 = 'A1-345'
            THEN concat('illegal characters: ', vin6) ELSE concat('wrong length: ', vin6) END FROM r WHERE vin6 IS NULL OR vin6 IN (' ', 'A1-345', '12345'))"""


def violations(t: Tables, before=None):
    return quality.check_rows(t.sql(LEDGER), "file", "row", RULES, before)


@query("q2_row_rules", f"{VIOLATIONS} SELECT file, row, rule, message FROM v")
def _(t: Tables):
    return violations(t).select("file", "row", "rule", "message")


@query(
    "q3_cross_field_rule",
    f"""WITH r AS ({LEDGER}) SELECT file, row, 'date_order' AS rule, concat(push_date, ',', arrival_date) AS value FROM r
        WHERE push_date <> 'bad' AND arrival_date IS NOT NULL AND cast(CASE WHEN push_date <> 'bad' THEN push_date END AS timestamp) >= cast(arrival_date AS timestamp)""",
)
def _(t: Tables):
    found = quality.check_rows(t.sql(LEDGER), "file", "row", [], ("push_date", "arrival_date"))
    return found.select("file", "row", "rule", "value")


PATHS = """SELECT o_orderkey AS id, concat(CASE o_orderkey % 4 WHEN 0 THEN '/d/投放市场费用/' WHEN 1 THEN '/d/新车三方延保/' WHEN 2 THEN '/d/贴膜升级/' ELSE '/other/' END,
    CASE o_orderkey % 3 WHEN 0 THEN 'own.csv' ELSE 'f.csv' END) AS path FROM {orders}"""


@query(
    "q4_template_by_path",
    f"""WITH r AS ({PATHS}) SELECT id, CASE id % 4 WHEN 0 THEN 'marketing_cost' WHEN 1 THEN 'warranty'
        WHEN 2 THEN CASE WHEN id % 3 = 0 THEN 'film_own_store' ELSE 'film_third_party' END ELSE 'film_third_party' END AS template FROM r""",
)
def _(t: Tables):
    words = [("投放市场费用", "marketing_cost"), ("新车三方延保", "warranty"), ("贴膜升级", "film_third_party")]
    template = quality.classify_source(F.col("path"), words, "film_third_party", ["own.csv"], "film_own_store")
    return t.sql(PATHS).select("id", template.alias("template"))


@query(
    "q5_quality_summary",
    f"""{VIOLATIONS}, s AS (SELECT count(DISTINCT file) AS files, 1 AS header_errors, (SELECT count(*) FROM v) AS data_errors, count(*) AS total_rows,
            (SELECT count(*) FROM (SELECT DISTINCT file, row FROM v)) AS error_rows FROM r)
        SELECT *, round(error_rows * 100.0 / total_rows, 2)::double AS error_rate FROM s""",
)
def _(t: Tables):
    headers = quality.check_headers(t.spark, "bad file", ["a"], ["a", "b", "c"])
    return quality.summarise(quality.row_errors(t.sql(LEDGER), "file", RULES, keep=["row"]), "row", headers)


_LEDGER_HEADERS = ["row", "month", "push_date", "arrival_date", "consultant", "store", "vin6"]


def _check_run(t: Tables):
    """Ten ledgers, two of them with a header that the template does not allow, in CSV files."""
    folder = shared_folder(t.spark, "check-run")
    ledger = t.sql(LEDGER)
    bad = F.col("file").isin("f3", "f7")
    ledger.where(~bad).write.option("header", True).partitionBy("file").csv(f"{folder}/film/good")
    drifted = ledger.where(bad).withColumnsRenamed({"vin6": "vin, last 6", "store": "Store\nname"})
    drifted.write.option("header", True).partitionBy("file").csv(f"{folder}/film/bad")
    templates = {"film": quality.Template(_LEDGER_HEADERS, RULES), "other": quality.Template(["x"])}
    template = quality.classify_source(F.col("file"), [("/film/", "film")], "other")
    rows = written(ledgers.ledger_rows(t.spark, folder, width=16), "check-rows")
    headers = written(ledgers.headers_of(rows, width=16), "check-headers")
    return quality.check_ledgers(rows, headers, template, templates, ledgers.laid_out)


def _ledger_name():
    return F.regexp_extract("file", "file=([^/]+)/", 1).alias("file")


@query(
    "q6_check_run",
    f"""{VIOLATIONS}, n AS (SELECT file, count(*) AS rows FROM r GROUP BY file),
            e AS (SELECT file, count(*) AS errors FROM v GROUP BY file)
        SELECT n.file, 'film' AS template, n.file NOT IN ('f3', 'f7') AS accepted,
            CASE WHEN n.file IN ('f3', 'f7') THEN 'store,vin6' ELSE '' END AS missing, CASE WHEN n.file IN ('f3', 'f7') THEN 'storename,vin, last 6' ELSE '' END AS extra,
            CASE WHEN n.file IN ('f3', 'f7') THEN 0 ELSE n.rows END AS rows, CASE WHEN n.file IN ('f3', 'f7') THEN 0 ELSE coalesce(e.errors, 0) END AS errors
        FROM n LEFT JOIN e ON e.file = n.file""",
)
def _(t: Tables):
    report, _ = _check_run(t)
    listed = lambda c: F.array_join(F.array_sort(c), ",").alias(c)
    by_file = report.select(_ledger_name(), "template", "accepted", listed("missing"), listed("extra"), "rows", "data_errors")
    both = ["file", "template", "accepted", "missing", "extra"]  # a ledger is written in several files
    return by_file.groupBy(*both).agg(F.sum("rows").alias("rows"), F.sum("data_errors").alias("errors"))


@query("q6_check_run_violations", f"{VIOLATIONS} SELECT file, rule, message FROM v WHERE file NOT IN ('f3', 'f7')")
def _(t: Tables):
    return _check_run(t)[1].select(_ledger_name(), "rule", "message")


def delete_log(t: Tables):
    """Error events as log entries; every seventh entry is broken."""
    good = F.concat(
        F.lit('{"Logo_IdOrCode":"'), F.col("user_id"), F.lit(", "), F.col("user_id") + 1,
        F.lit('","Arr":[{"ID":"'), F.col("event_id"), F.lit('","BillCode":"B'), F.col("user_id"), F.lit('"},{"ID":"x"}]}'),
    )
    return t.events.where("event_type = 'error'").select(
        "event_id", F.col("event_type").alias("title"), F.date_format("ts", "yyyy-MM-dd").alias("write_time"), good.alias("contents")
    )


@query(
    "e1_parse_delete_log",
    """SELECT event_id, event_type AS title, CASE WHEN event_id % 7 = 0 THEN NULL ELSE concat(user_id, ', ', user_id + 1) END AS id_or_code,
              CASE WHEN event_id % 7 = 0 THEN NULL ELSE cast(event_id AS varchar) END AS record_id,
              CASE WHEN event_id % 7 = 0 THEN NULL ELSE concat('B', user_id) END AS bill_code, '' AS user_name FROM events WHERE event_type = 'error'""",
)
def _(t: Tables):
    log = delete_log(t)
    broken = log.withColumn("contents", F.when(F.col("event_id") % 7 == 0, F.lit('{"Logo_IdOrCode": oops')).otherwise(F.col("contents")))
    return deletes.parse_delete_log(broken).select("event_id", "title", "id_or_code", "record_id", "bill_code", "user_name")


_GONE = """gone AS (SELECT cast(user_id AS varchar) AS id FROM events WHERE event_type = 'error'
                    UNION SELECT cast(user_id + 1 AS varchar) FROM events WHERE event_type = 'error')"""


@query(
    "e2_apply_deletes",
    f"""WITH {_GONE} SELECT 'orders' AS source, o_orderkey AS id FROM orders WHERE cast(o_orderkey AS varchar) NOT IN (SELECT id FROM gone)
        UNION ALL SELECT 'customer', c_custkey FROM customer WHERE cast(c_custkey AS varchar) NOT IN (SELECT id FROM gone)
        UNION ALL SELECT 'supplier', s_suppkey FROM supplier""",
)
def _(t: Tables):
    tables = {"orders": t.orders, "customer": t.customer, "supplier": t.supplier}
    out = deletes.apply_deletes(
        tables, delete_log(t), {"error": ["orders", "customer"], "other": ["supplier"]},
        {"orders": "o_orderkey", "customer": "c_custkey", "supplier": "s_suppkey"},
    )
    ids = {"orders": "o_orderkey", "customer": "c_custkey", "supplier": "s_suppkey"}
    parts = [df.select(F.lit(n).alias("source"), F.col(ids[n]).alias("id")) for n, df in out.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "e3_delete_report",
    f"""WITH {_GONE} SELECT 'delete_log' AS table_name, count(*) AS rows, 0 AS deleted FROM events WHERE event_type = 'error'
        UNION ALL SELECT 'orders', count(*), count(*) FILTER (cast(o_orderkey AS varchar) IN (SELECT id FROM gone)) FROM orders
        UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (cast(l_orderkey AS varchar) IN (SELECT id FROM gone)) FROM lineitem""",
)
def _(t: Tables):
    return deletes.delete_report(
        {"orders": t.orders, "lineitem": t.lineitem}, delete_log(t), {"error": ["orders", "lineitem"]},
        {"orders": "o_orderkey", "lineitem": "l_orderkey"},
    )
