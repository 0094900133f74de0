"""Business classes as ``when`` chains."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from motorledger import values as V
from motorledger.functions.nulls import ColumnLike, as_col, not_in


def stock_age_class(days: ColumnLike, status: ColumnLike) -> Column:
    """Status wins over age; an unknown age falls into the youngest class."""
    days = as_col(days)
    out = F.when(as_col(status).isin(V.NOT_SHIPPED, V.IN_TRANSIT), F.lit(V.STOCK_NOT_ARRIVED))
    for limit, label in V.STOCK_AGE:
        out = out.when(days >= limit, F.lit(label))
    return out.otherwise(F.lit(V.STOCK_AGE_YOUNG))


def band(c: ColumnLike, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-closed bands, the last one open ended; outside or unknown is null."""
    c = as_col(c)
    out = F.when(c < edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        out = out.when(c < upper, F.lit(label))
    return out.when(c.isNotNull(), F.lit(labels[-1]))


def map_status(c: ColumnLike, mapping: Mapping[str, str], other: str) -> Column:
    """Mapped status; any other known value is ``other``, null stays null."""
    c = as_col(c)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for old, new in mapping.items():
        out = out.when(c == old, F.lit(new))
    return out.otherwise(F.lit(other))


def supplier_kind(c: ColumnLike, internal: Iterable[str], manufacturer: str) -> Column:
    """Where a car came from: a sister company, an outsider, or the manufacturer (null)."""
    c, internal = as_col(c), list(internal)
    outside = not_in(c, internal) & c.isNotNull() & (c != manufacturer)
    inside = c.isin(*internal) if internal else F.lit(False)
    return F.when(inside, F.lit(V.INTERNAL_IN)).when(outside, F.lit(V.EXTERNAL_IN))


def transfer_kind(buyer: ColumnLike, team: ColumnLike, companies: Iterable[str], short: int = 5) -> Column:
    """Transfers to a company or a short-named buyer are internal."""
    buyer, companies = as_col(buyer), list(companies)
    inside = F.length(buyer) <= short
    if companies:
        inside = buyer.isin(*companies) | inside
    moved = as_col(team) == V.TEAM_TRANSFER
    return F.when(moved & inside, F.lit(V.INTERNAL_OUT)).when(
        moved & buyer.isNotNull(), F.lit(V.EXTERNAL_OUT)
    )


def valid_store(c: ColumnLike, stores: Iterable[str]) -> Column:
    return F.coalesce(F.trim(as_col(c)).isin(*stores), F.lit(False))


def cash_and_carry(deposit_date: ColumnLike, sale_date: ColumnLike, deposit_state: ColumnLike) -> Column:
    """Ordered and delivered on the spot."""
    ordered, sold = as_col(deposit_date).isNotNull(), as_col(sale_date).isNotNull()
    unpaid = F.coalesce(as_col(deposit_state) == V.AWAITING, F.lit(False))
    return F.when(sold & (~ordered | unpaid), F.lit(V.CASH_AND_CARRY))


def film_class(visit_date: ColumnLike, film_revenue: ColumnLike, other_revenue: ColumnLike) -> dict[str, Column]:
    """Flags of the film-upgrade funnel."""
    film, other = (as_col(c).try_cast("double") for c in (film_revenue, other_revenue))
    no_film = film.isNull() | (film == 0)
    flag = lambda c: F.when(c, F.lit(V.YES)).otherwise(F.lit(V.NO))
    return {
        "free_film": F.when(as_col(visit_date).isNull(), F.lit(V.NOT_VISITED)).otherwise(flag(no_film)),
        "other_upgrade": flag(other > 0),
        "other_only": flag((other > 0) & no_film),
    }
