"""Declarative header and row rules over ledgers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorledger.functions.dates import parse_ts
from motorledger.functions.nulls import as_col
from motorledger.session import written


@dataclass(frozen=True)
class Rule:
    """A named check of one field; ``problem`` gives the message or null."""

    field: str
    name: str
    problem: Callable[[Column], Column]


def _say(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def month_rule(field: str) -> Rule:
    def problem(c: Column) -> Column:
        return F.when(c.isNull(), F.lit("month is missing")).when(
            ~F.trim(c).rlike(r"^\+?0*([1-9]|1[0-2])$"), _say("not a month: ", c)
        )

    return Rule(field, "month", problem)


def date_rule(field: str, required: bool = True) -> Rule:
    def problem(c: Column) -> Column:
        bad = F.when(c.isNotNull() & parse_ts(c).isNull(), _say("not a date: ", c))
        return F.when(c.isNull(), F.lit("date is missing")).otherwise(bad) if required else bad

    return Rule(field, "date" if required else "optional_date", problem)


def text_rule(field: str) -> Rule:
    return Rule(
        field, "text",
        lambda c: F.when(c.isNull() | (F.trim(c) == ""), F.lit("text is missing")),
    )


def store_rule(field: str, stores: Sequence[str]) -> Rule:
    return Rule(
        field, "store",
        lambda c: F.when(c.isNull(), F.lit("store is missing")).when(
            ~F.trim(c).isin(*stores), _say("unknown store: ", F.trim(c))
        ),
    )


def vin_rule(field: str, exact: int | None = 6, least: int = 6) -> Rule:
    """Letters and digits only, after blanks are removed; exact or minimal length."""

    def problem(c: Column) -> Column:
        plain = F.regexp_replace(F.trim(c), r"\s+", "")
        size = F.length(plain)
        wrong = (size != exact) if exact is not None else (size < least)
        return (
            F.when(c.isNull() | (F.trim(c) == ""), F.lit("vin is missing"))
            .when(~plain.rlike("^[A-Za-z0-9]+$"), _say("illegal characters: ", c))
            .when(wrong, _say("wrong length: ", c))
        )

    return Rule(field, "vin" if exact is not None else "full_vin", problem)


def check_headers(spark, source: str, columns: Sequence[str], template: Sequence[str]) -> DataFrame:
    """Missing and extra headers of one source against its template. Schema only."""
    missing = [(source, "missing", h) for h in template if h not in columns]
    extra = [(source, "extra", h) for h in columns if h not in template]
    return spark.createDataFrame(missing + extra, "file string, problem string, header string")


def header_gaps(df: DataFrame, source: str, header_list: str, template: Sequence[str]) -> DataFrame:
    """The same comparison for a table of headers, one row per source."""
    want = F.array(*[F.lit(h) for h in template])
    found = F.col(header_list)
    return df.select(
        F.col(source).alias("file"),
        F.array_except(want, found).alias("missing"),
        F.array_except(found, want).alias("extra"),
    )


def _checks(df: DataFrame, rules: Sequence[Rule], before: tuple[str, str] | None) -> list[tuple]:
    """Field, value, rule and message of every check that the columns of ``df`` allow."""
    checks = []
    for rule in rules:
        if rule.field in df.columns:
            c = as_col(rule.field).cast("string")
            checks.append((rule.field, c, rule.name, rule.problem(c)))
    if before and set(before) <= set(df.columns):
        a, b = (F.col(c).cast("string") for c in before)
        late = F.when(parse_ts(a) >= parse_ts(b), _say(before[0], " must be before ", before[1]))
        checks.append((",".join(before), F.concat_ws(",", a, b), "date_order", late))
    return checks


def check_rows(
    df: DataFrame, file: str, row: str, rules: Sequence[Rule], before: tuple[str, str] | None = None
) -> DataFrame:
    """One output row per violation, all rules in a single pass over the data.

    ``before`` names two date columns of which the first must be the earlier; the pair is
    skipped when either is missing or unreadable.
    """
    checks = _checks(df, rules, before)
    if not checks:
        nothing = [F.lit(None).cast("string").alias(c) for c in ("field", "value", "rule", "message")]
        return df.select(F.col(file).alias("file"), F.col(row).alias("row"), *nothing).where(F.lit(False))
    # messages are computed once, in generated code; a filter before the explode would be
    # pushed below this projection and compute all of them a second time
    messages = df.select(
        F.col(file).alias("file"), F.col(row).alias("row"),
        *[value.alias(f"_v{i}") for i, (_, value, _, _) in enumerate(checks)],
        *[message.alias(f"_m{i}") for i, (_, _, _, message) in enumerate(checks)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(field).alias("field"), F.col(f"_v{i}").alias("value"),
                F.lit(name).alias("rule"), F.col(f"_m{i}").alias("message"),
            )
            for i, (field, _, name, _) in enumerate(checks)
        ]
    )
    return (
        messages.select("file", "row", F.explode(entries).alias("v"))
        .select("file", "row", "v.*").where(F.col("message").isNotNull())
    )


def classify_source(path: Column, templates: Sequence[tuple[str, str]], default: str, own_files: Sequence[str] = (), own: str | None = None) -> Column:
    """Template name by words in the folder part of a path; some files by their name."""
    # anchored at the start: a search for the last part tries every place of a long path
    folder = F.regexp_extract(path, r"(?s)^.*[/\\]", 0)
    name = F.regexp_extract(path, r"(?s)^(?:.*[/\\])?(.*)$", 1)
    out = None
    for word, template in templates:
        label = F.lit(template)
        if own is not None and template == default:
            label = F.when(name.isin(*own_files), F.lit(own)).otherwise(label)
        out = (F if out is None else out).when(folder.contains(word), label)
    return out.otherwise(F.lit(default))


def row_errors(
    df: DataFrame, file: str, rules: Sequence[Rule], before: tuple[str, str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """``file``, the columns ``keep`` and ``errors``, the number of violations, of every row."""
    checks = _checks(df, rules, before)
    flags = [F.when(message.isNotNull(), 1).otherwise(0) for _, _, _, message in checks]
    return df.select(F.col(file).alias("file"), *keep, reduce(add, flags, F.lit(0)).alias("errors"))


_COUNTS = ["files", "header_errors", "data_errors", "total_rows", "error_rows"]


def _with_rate(counts: DataFrame) -> DataFrame:
    rate = F.when(F.col("total_rows") > 0, F.col("error_rows") * 100.0 / F.col("total_rows")).otherwise(F.lit(0.0))
    return counts.select(*[F.col(c).cast("bigint").alias(c) for c in _COUNTS], F.round(rate, 2).alias("error_rate"))


def summarise(errors: DataFrame, row: str, header_problems: DataFrame) -> DataFrame:
    """What :func:`quality_summary` tells, from the errors of every row, in one pass over the rows.

    Rows of a file that share ``row`` count as one erroneous row.
    """
    rows = errors.groupBy("file", row).agg(F.sum("errors").alias("e"), F.count(F.lit(1)).alias("n"))
    files = rows.groupBy("file").agg(F.sum("e").alias("e"), F.sum("n").alias("n"), F.count_if(F.col("e") > 0).alias("bad"))
    of = lambda c: F.coalesce(F.sum(c), F.lit(0))
    data = files.agg(F.count("file").alias("files"), of("e").alias("data_errors"), of("n").alias("total_rows"), of("bad").alias("error_rows"))
    heads = header_problems.select("file").distinct().agg(F.count("file").alias("header_errors"))
    return _with_rate(data.crossJoin(heads))  # one row each


@dataclass(frozen=True)
class Template:
    """What a kind of ledger must look like: its headers, its row rules and two dates in order."""

    headers: Sequence[str]
    rules: Sequence[Rule] = ()
    before: tuple[str, str] | None = None


def header_verdicts(headers: DataFrame, template: Column, templates: Mapping[str, Template]) -> DataFrame:
    """``headers`` (file, names) with the ``template`` of each file, ``missing`` and ``extra`` names and ``accepted``.

    A header is accepted if it has every name of its template and no other; unnamed columns do not count.
    """
    wanted = F.create_map(*[x for n, t in templates.items() for x in (F.lit(n), F.array(*[F.lit(h) for h in t.headers]))])
    judged = headers.withColumn("template", template).withColumn("_want", wanted[F.col("template")])
    named = F.array_remove("names", "")
    judged = judged.withColumn("missing", F.array_except("_want", named)).withColumn("extra", F.array_except(named, F.col("_want")))
    return judged.withColumn("accepted", (F.size("missing") == 0) & (F.size("extra") == 0)).drop("_want")


def check_ledgers(
    rows: DataFrame, headers: DataFrame, template: Column, templates: Mapping[str, Template],
    lay_out: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame],
) -> tuple[DataFrame, DataFrame]:
    """The report of a check run by file, and the violations of all rows of accepted files.

    Row rules only run on files whose header is accepted. The report has one row per file:
    file, template, accepted, missing, extra, rows, data_errors, error_rows (0 where rows were
    not checked). ``rows``, ``headers`` and ``lay_out`` come from the ledger reader.
    """
    # written: conditions on the template would be moved to the rows, and read all of them for each template
    verdicts = written(header_verdicts(headers, template, templates), "header-verdicts")
    found, counts = [], []
    for name, wanted in templates.items():
        good = verdicts.where(F.col("accepted") & (F.col("template") == name)).drop("template", "missing", "extra", "accepted")
        laid = lay_out(rows, good, wanted.headers)
        counts.append(row_errors(laid, "file", wanted.rules, wanted.before))
        found.append(check_rows(laid, "file", "line", wanted.rules, wanted.before))
    merged = reduce(DataFrame.unionByName, counts)
    by_file = merged.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("errors").alias("data_errors"), F.count_if(F.col("errors") > 0).alias("error_rows")
    )
    report = verdicts.select("file", "template", "accepted", "missing", "extra").join(by_file, "file", "left")
    return report.fillna(0, ["rows", "data_errors", "error_rows"]), reduce(DataFrame.unionByName, found)


def run_summary(report: DataFrame) -> DataFrame:
    """A check run in one row: files, header errors, data errors, rows, erroneous rows and their share."""
    of = lambda c, n: F.coalesce(F.sum(c), F.lit(0)).alias(n)
    return _with_rate(
        report.agg(
            F.count(F.lit(1)).alias("files"), F.count_if(~F.col("accepted")).alias("header_errors"),
            of("data_errors", "data_errors"), of("rows", "total_rows"), of("error_rows", "error_rows"),
        )
    )


def quality_summary(rows: DataFrame, violations: DataFrame, header_problems: DataFrame, file: str) -> DataFrame:
    """Files, header errors, data errors, rows, rows with errors and their share."""
    def tally(df: DataFrame, **cols: Column) -> DataFrame:
        names = ["files", "header_errors", "data_errors", "total_rows", "error_rows"]
        return df.agg(*[cols.get(n, F.lit(0)).cast("bigint").alias(n) for n in names])

    parts = tally(rows, files=F.count_distinct(F.col(file)), total_rows=F.count(F.lit(1)))
    parts = parts.unionByName(tally(header_problems, header_errors=F.count_distinct("file")))
    parts = parts.unionByName(
        tally(violations, data_errors=F.count(F.lit(1)), error_rows=F.count_distinct("file", "row"))
    )
    out = parts.agg(*[F.sum(c).alias(c) for c in parts.columns])
    rate = F.when(F.col("total_rows") > 0, F.col("error_rows") * 100.0 / F.col("total_rows")).otherwise(F.lit(0.0))
    return out.withColumn("error_rate", F.round(rate, 2))
