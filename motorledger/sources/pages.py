"""Landed pages of records: an envelope whose leaf is a list, or holds one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed paths of the page envelope, tried in this order.
ENVELOPES = ["$.Msg.Model", "$.Data"]
LISTS = ["", ".list", ".items"]


def explode_pages(pages: DataFrame, col: str, record: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per record of every page, typed by the struct type ``record``.

    Pages that do not parse and pages without a list give no rows.
    """
    page = F.try_parse_json(F.col(col))
    leaf = F.coalesce(
        *[F.try_variant_get(page, env + inner, "array<variant>") for env in ENVELOPES for inner in LISTS]
    )
    rows = pages.select(*keep, F.explode(leaf).alias("_record"))
    return rows.select(*keep, F.try_variant_get("_record", "$", record).alias("_r")).select(*keep, "_r.*")
