"""Projection, renaming and schema conformance."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorledger import values as V
from motorledger.functions.dates import NTZ, parse_ts
from motorledger.functions.numbers import NUMBER, WHOLE, to_number
from motorledger.functions.text import alias_value, header


def select_existing(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Keep the wanted columns that exist, in the wanted order; also tell which are missing."""
    present = set(df.columns)
    return df.select(*[c for c in cols if c in present]), [c for c in cols if c not in present]


def rename_existing(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def ensure_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Add the columns that are missing as typed nulls."""
    present = set(df.columns)
    return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in present})


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Drop repeated column names, keeping the first."""
    seen: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        seen.setdefault(name, i)
    positional = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return positional.select(*[F.col(f"c{i}").alias(name) for name, i in seen.items()])


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[header(c) for c in df.columns])


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested records to flat columns; lists and empty records stay values."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType) and field.dataType.fields:
                yield from leaves(field.dataType, here)
            else:
                yield here

    paths = leaves(df.schema, ())
    return df.select(
        *[F.col(".".join(f"`{part}`" for part in path)).alias(sep.join(path)) for path in paths]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fit raw records to a table: unknown fields go, values take the table's types.

    Blank text and the word ``null`` are missing values, lists become JSON text, and
    what cannot be converted is null.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[_convert(f.name, have[f.name], f.dataType) for f in schema.fields if f.name in have]
    )


def _convert(name: str, have: T.DataType, want: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(have, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(c).alias(name)
    if isinstance(have, T.StringType):
        c = F.when(~c.isin("", "null"), c)
        if isinstance(want, T.IntegralType):
            c = F.when(F.trim(c).rlike(WHOLE), c)
        elif isinstance(want, T.NumericType):
            c = F.when(F.trim(c).rlike(NUMBER), c)
    if isinstance(want, (T.TimestampType, T.TimestampNTZType)):
        return parse_ts(c).cast(want).alias(name)
    if isinstance(want, T.DateType):
        return parse_ts(c).cast("date").alias(name)
    return c.try_cast(want).alias(name)


def with_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in constants.items()})


def fill_from(df: DataFrame, col: str, *others: str) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), *[F.col(o) for o in others]))


def set_where(df: DataFrame, where: Column, changes: Mapping[str, object]) -> DataFrame:
    """Set columns to a constant, a column or null on the rows where a predicate holds."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for name, value in changes.items():
        value = value if isinstance(value, Column) else F.lit(value).cast(types[name])
        out[name] = F.when(where, value).otherwise(F.col(name))
    return df.withColumns(out)


def fill_where(df: DataFrame, where: Column, col: str, other: str) -> DataFrame:
    """Fill nulls of ``col`` from ``other``, only where the predicate holds."""
    filled = F.coalesce(F.col(col), F.col(other))
    return df.withColumn(col, F.when(where, filled).otherwise(F.col(col)))


def conform_money(df: DataFrame, money_words: Iterable[str] = V.MONEY_WORDS) -> DataFrame:
    """Types to write: wide decimal for money-like names, narrow for other floats.

    An amount that does not fit its type raises rather than become null; NaN and infinities are null.
    """
    words = tuple(money_words)
    out = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            money = any(word in field.name for word in words)
            amount = F.col(f"`{field.name}`")
            known = F.when(~F.isnan(amount) & (F.abs(amount) != float("inf")), amount)
            fits = F.abs(known) < (1e16 if money else 1e8) - 0.005
            checked = F.when(known.isNull() | fits, known).otherwise(F.raise_error(F.concat(F.lit(f"{field.name} does not fit: "), amount.cast("string"))).cast("double"))
            out[field.name] = checked.cast("decimal(18,2)" if money else "decimal(10,2)")
        elif isinstance(field.dataType, T.DateType):
            out[field.name] = F.col(field.name).cast(NTZ)
    return df.withColumns(out) if out else df


def numbers(df: DataFrame, cols: Iterable[str], mode: str = "coerce", default: float | None = 0.0) -> DataFrame:
    """Make the columns that exist numeric. Columns that already are only lose their nulls."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c in cols:
        if c not in types:
            continue
        if isinstance(types[c], T.NumericType):
            value = f"cast(`{c}` as double)"
            out[c] = F.expr(value if default is None else f"coalesce({value}, {float(default)}D)")
        else:
            out[c] = to_number(c, mode, default)
    return df.withColumns(out) if out else df


def times(df: DataFrame, *cols: str) -> DataFrame:
    """Make the columns that exist timestamps. Columns that already hold times are only cast."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.withColumns(
        {c: F.col(c).cast(NTZ) if isinstance(kinds[c], temporal) else parse_ts(c) for c in cols if c in kinds}
    )


def alias(df: DataFrame, names: Mapping[str, str], cols: Iterable[str] | None = None) -> DataFrame:
    """Exact-value renaming in the given columns, or in every text column."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    present = set(df.columns)
    return df.withColumns({c: alias_value(c, names) for c in cols if c in present})


def relabel(df: DataFrame, col: str, where: Column, value) -> DataFrame:
    return df.withColumn(col, F.when(where, F.lit(value)).otherwise(F.col(col)))
