"""Text clean-up, keyword rules and derived match keys."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from motorledger import values as V
from motorledger.functions.nulls import ColumnLike, as_col, contains

KEY_SEPARATOR = "\u001f"


def first_keyword(c: ColumnLike, names: Iterable[tuple[str, str]]) -> Column:
    """Name of the first keyword found; text without any keyword stays, null stays."""
    c = as_col(c)
    found = None
    for word, name in names:
        found = (F if found is None else found).when(c.contains(word), F.lit(name))
    return found.otherwise(c)


def bank_name(c: ColumnLike) -> Column:
    return first_keyword(c, [(word, word) for word in V.BANK_KEYWORDS])


def after_first(c: ColumnLike, sep: str = " ") -> Column:
    """What follows the first separator; the whole text when there is none."""
    c = as_col(c)
    at = F.instr(c, sep)
    return F.when(at > 0, F.substring(c, at + len(sep), F.length(c))).otherwise(c)


def suffix(c: ColumnLike, n: int = 6) -> Column:
    return F.right(as_col(c), F.lit(n))


def normalize_text(c: ColumnLike, case_map: Mapping[str, str] = V.UNIT_CASE) -> Column:
    """Trim, lower, single blanks, then restore the casing of unit words; null is ''."""
    text = F.regexp_replace(F.lower(F.trim(F.coalesce(as_col(c), F.lit("")))), r"\s+", " ")
    return replace_all(text, case_map)


def replace_all(c: ColumnLike, replacements: Mapping[str, str]) -> Column:
    """Literal replacements, one after another in the given order."""
    return reduce(
        lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])),
        replacements.items(),
        as_col(c),
    )


def replace_regex(c: ColumnLike, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(as_col(c), pattern, replacement)


def has_keyword(c: ColumnLike, word: str, yes: str = V.YES, no: str = V.NO) -> Column:
    return F.when(contains(c, word), F.lit(yes)).otherwise(F.lit(no))


def match_key(cols: Iterable[ColumnLike]) -> Column:
    """One text key out of several columns, nulls as ''.

    The parts are separated by a control character, so ``ab|c`` and ``a|bc`` differ.
    """
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols]
    return F.concat_ws(KEY_SEPARATOR, *parts)


def alias_value(c: ColumnLike, names: Mapping[str, str]) -> Column:
    """Exact-value renaming."""
    c = as_col(c)
    if not names:
        return c
    renamed = None
    for old, new in names.items():
        renamed = (F if renamed is None else renamed).when(c == old, F.lit(new))
    return renamed.otherwise(c)


def header(name: str) -> str:
    """Spreadsheet header: no line breaks, no outer blanks, lower case."""
    return re.sub(r"[\r\n]+", "", name).strip().lower()
