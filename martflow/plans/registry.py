"""How a registered query meets its oracle: one column list shapes both sides.

A column list is text such as ``"year:i revenue:2 day:d name"``: ``i`` casts to bigint, ``d`` turns a
date into text, a digit rounds a double, no suffix leaves the column as it is. Before rounding, both
sides add the same tiny nudge, so that sums taken in a different order cannot fall on different
sides of a half.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.ordering import shared_folder
from martflow.plans.oracle_views import VIEWS
from martflow.session import sized_session
from martflow.sources.retail_views import RetailViews

NUDGE = 0.00137


def _parts(columns: str) -> list[tuple[str, str]]:
    return [(name, kind) for name, _, kind in (c.partition(":") for c in columns.split())]


def _shaped(name: str, kind: str) -> Column:
    c = F.col(f"`{name}`")
    if kind == "i":
        c = c.cast("bigint")
    elif kind == "d":
        c = F.date_format(c, "yyyy-MM-dd")
    elif kind:
        digits = int(kind)
        c = F.round(c.cast("double") + NUDGE * 10.0**-digits, digits) + 0.0
    return c.alias(name)


def _shaped_sql(name: str, kind: str) -> str:
    c = f'q."{name}"'
    if kind == "i":
        c = f"CAST({c} AS BIGINT)"
    elif kind == "d":
        c = f"CAST(CAST({c} AS DATE) AS VARCHAR)"
    elif kind:
        nudge = f"{NUDGE * 10.0 ** -int(kind):.20f}"
        c = f"ROUND(CAST({c} AS DOUBLE) + CAST({nudge} AS DOUBLE), {int(kind)}) + CAST(0 AS DOUBLE)"
    return f'{c} AS "{name}"'


def _needed_views(sql: str) -> list[str]:
    """Views the text mentions, directly or through other views, in definition order."""
    wanted: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"\b[vm]_\w+", pending.pop()))
        new = [w for w in words if w in VIEWS and w not in wanted]
        wanted.update(new)
        pending.extend(VIEWS[w] for w in new)
    return [name for name in VIEWS if name in wanted]


@dataclass(frozen=True)
class Query:
    columns: str
    build: Callable[[RetailViews], DataFrame]
    sql: str | None = None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.sparkContext.master.startswith("local"):
            shared_folder(spark)  # one folder for the sessions of all queries
        result = self.build(RetailViews(sized_session(spark, RetailViews(spark, sf_dir).line_count()), sf_dir))
        return result.select(*[_shaped(n, k) for n, k in _parts(self.columns)])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        columns = ", ".join(_shaped_sql(n, k) for n, k in _parts(self.columns))
        ctes = ", ".join(f"{name} AS ({VIEWS[name]})" for name in _needed_views(self.sql))
        prefix = f"WITH {ctes} " if ctes else ""
        return f"{prefix}SELECT {columns} FROM ({self.sql}) AS q"
