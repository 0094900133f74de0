"""Numbers that arrive as text, and the tax formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from motorledger import values as V
from motorledger.functions.nulls import ColumnLike, as_col

_MODES = ("coerce", "strip_commas", "digits_only")


# A cast that fails costs an exception inside the task, so the shape is checked first.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
WHOLE = r"^[+-]?\d+$"  # any length: what does not fit its type becomes null in the cast


def _parse(text: Column) -> Column:
    """Text to double; words such as ``nan`` and Java literals such as ``1d`` are null."""
    text = F.trim(text)
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_number(
    c: ColumnLike, mode: str = "coerce", default: float | None = 0.0, keep_sign: bool = False
) -> Column:
    """Raw text to double.

    ``coerce`` parses the text as it stands, ``strip_commas`` drops thousands
    separators first, ``digits_only`` keeps digits and the dot (and the minus sign
    when ``keep_sign``). What does not parse becomes ``default``.
    """
    if mode not in _MODES:
        raise ValueError(f"mode must be one of {_MODES}")
    text = as_col(c).cast("string")
    if mode == "strip_commas":
        text = F.replace(text, F.lit(","), F.lit(""))
    elif mode == "digits_only":
        text = F.regexp_replace(text, r"[^\d.-]" if keep_sign else r"[^\d.]", "")
    number = _parse(text)
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def percent_to_fraction(c: ColumnLike, default: float | None = None) -> Column:
    text = F.replace(as_col(c).cast("string"), F.lit("%"), F.lit(""))
    return to_number(text, default=default) / 100


def strip_cjk(c: ColumnLike) -> Column:
    return F.regexp_replace(as_col(c), "[一-龥]", "")


def loan_term(c: ColumnLike) -> Column:
    """First entry of a comma list as whole months with the unit, ``0期`` when unknown."""
    text = as_col(c).cast("string")
    first = F.when(F.lower(F.trim(text)) != "none", F.split_part(text, F.lit(","), F.lit(1)))
    months = F.coalesce(_parse(first).try_cast("int"), F.lit(0))
    return F.concat(months.cast("string"), F.lit("期"))


def phone_text(c: ColumnLike) -> Column:
    """Phone as plain digits; blank, null and zero give the empty text."""
    text = F.trim(as_col(c).cast("string"))
    whole = F.regexp_replace(text, r"\.0+$", "")
    number = F.when(whole.rlike(WHOLE), whole.try_cast("bigint"))
    return (
        F.when(text.isNull() | (text == "") | (number == 0), F.lit(""))
        .when(number.isNotNull(), number.cast("string"))
        .otherwise(text)
    )


def sign_flag(c: ColumnLike) -> Column:
    return F.signum(to_number(c)).cast("int")


def incentive_number(c: ColumnLike) -> Column:
    """Blank is unknown, a number is itself, any other word counts 0."""
    text = F.trim(as_col(c).cast("string"))
    return F.when(text != "", F.coalesce(_parse(text), F.lit(0.0)))


def vat_tax(base: Column) -> Column:
    tax = F.bround(base / V.VAT_DIVISOR * V.VAT_RATE * V.SURCHARGE, 2)
    return F.when(base > 0, tax).otherwise(F.lit(0.0))


def finance_tax(subsidy: Column, rebate: Column) -> Column:
    return subsidy / V.VAT_DIVISOR * V.VAT_RATE * V.SURCHARGE + (
        rebate / V.SERVICE_DIVISOR * V.SERVICE_RATE * V.SURCHARGE
    )
