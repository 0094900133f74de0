"""Where queries and their SQL are collected."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from motorledger.queries.views import VIEWS
from motorledger.session import tune


class Tables:
    """The given tables of one folder, and views over them, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = self.sql(VIEWS[name]) if name in VIEWS else self.spark.read.parquet(self.path(name))
        return self._read[name]

    def sql(self, text: str) -> DataFrame:
        """Run shared SQL text; ``{name}`` stands for a given table."""
        names = set(re.findall(r"\{(\w+)\}", text))
        return self.spark.sql(text, **{n: getattr(self, n) for n in names})


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(tune(spark), folder))


QUERIES: dict[str, Query] = {}


def _with_views(sql: str) -> str:
    """Put the views a statement names in front of it, plain names for the tables."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\{(\w+)\}", text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    plain = lambda text: re.sub(r"\{(\w+)\}", r"\1", text)
    if not needed:
        return plain(sql)
    views = ",\n".join(f"{n} AS ({plain(VIEWS[n])})" for n in needed)
    body = plain(sql).strip()
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


def query(name: str, sql: str | None = None):
    """Register a query. ``sql`` is the equivalent statement; ``{name}`` marks tables and views."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, build, None if sql is None else _with_views(sql))
        return build

    return register
