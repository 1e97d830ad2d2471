"""Registry of queries: each has a Spark frame and, where SQL can say it, reference SQL."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, functions as F

from quaymaster.sources.retail_views import RetailViews

# The rolling window of the registered KPIs, as the order dates have day grain.
DAYS = 90
MINUTES = DAYS * 1440

ORDERS_AS_OF = "(SELECT max(o_orderdate) FROM orders)"
INVENTORY_AS_OF = "(SELECT max(l_shipdate) FROM lineitem)"
EVENTS_AS_OF = "(SELECT max(ts) FROM events)"
RECENT_ORDERS = f"order_ts >= {ORDERS_AS_OF} - INTERVAL {DAYS} DAY"
RECENT_SHIPMENTS = f"shipment_ts >= {ORDERS_AS_OF} - INTERVAL {DAYS} DAY"
RECENT_INVENTORY = f"inventory_ts >= {INVENTORY_AS_OF} - INTERVAL {DAYS} DAY"


@dataclass(frozen=True)
class Query:
    name: str
    operators: str
    frame: Callable[[RetailViews], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, operators: str, sql: str | None = None):
    """Register the decorated function; ``operators`` are the rows of the survey it covers."""

    def register(frame: Callable[[RetailViews], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, operators, frame, sql)
        return frame

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round doubles, so that the order of addition does not show."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def text_time(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def sql_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"
