"""Origin-destination stocks and flows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.operators.panels import sum_with_labels


def route_matrix(
    stocks: DataFrame,
    flows: DataFrame,
    route: Sequence[str],
    period: str,
    stock_columns: Sequence[str],
    flow_columns: Sequence[str],
    labels: Mapping[str, str] | None = None,
    floor_zero: bool = False,
) -> DataFrame:
    """Stock, outflow and implied inflow per route and period.

    A route-period found in either frame gives one row, missing measures count as 0. The inflow
    is what the change of stock and the outflow imply: NULL in a route's first row, and possibly
    negative unless ``floor_zero``. ``labels`` maps label columns present in both frames to
    themselves or a new name; a label from the stocks goes before one from the flows.

    Both frames are stacked and summed together, so they meet in the shuffle of the sums.
    """
    labels = dict(labels or {})
    keys = [period, *route]
    measures = [*stock_columns, *flow_columns]

    def side(df: DataFrame, columns: Sequence[str], suffix: str) -> DataFrame:
        return df.select(*keys, *[F.col(c).alias(f"{c}{suffix}") for c in labels], *columns)

    stacked = side(stocks, stock_columns, "_s").unionByName(
        side(flows, flow_columns, "_f"), allowMissingColumns=True
    )
    label_columns = [f"{c}{suffix}" for c in labels for suffix in ("_s", "_f")]
    summed = sum_with_labels(stacked, keys, {m: F.sum(m) for m in measures}, label_columns)
    along = Window.partitionBy(*route).orderBy(period)
    previous = F.lag("stock", 1).over(along)
    inflow = F.col("stock") - previous + F.col("outflows")
    if floor_zero:
        inflow = F.when(previous.isNotNull(), F.greatest(F.lit(0), inflow))
    return (
        summed.fillna(0, subset=measures)
        .withColumns({out: F.coalesce(F.col(f"{c}_s"), F.col(f"{c}_f")) for c, out in labels.items()})
        .withColumns({
            "stock": reduce(add, [F.col(c) for c in stock_columns]),
            "outflows": reduce(add, [F.col(c) for c in flow_columns]),
        })
        .withColumn("inflows", inflow)
        .select(*keys, *labels.values(), *measures, "stock", "inflows", "outflows")
    )


def flow_balance(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    stock: str,
    outflow: str,
    inflow_out: str = "real_inflow",
    untracked_out: str = "untracked_outflow",
) -> DataFrame:
    """Split the balance ``change of stock + outflow`` into arrivals and unexplained departures.

    Needs one row per key and period. Both results are NULL in the first row of a series; a
    missing outflow counts as 0. A balance that is unknown because the current stock is gives 0.
    """
    previous = F.lag(stock, 1).over(Window.partitionBy(*keys).orderBy(period))
    balance = F.col(stock) - F.col("_previous") + F.coalesce(F.col(outflow), F.lit(0))
    known = F.col("_previous").isNotNull()
    return (
        df.withColumn("_previous", previous)
        .withColumns({
            inflow_out: F.when(known, F.greatest(F.lit(0), balance)),
            untracked_out: F.when(known, F.greatest(F.lit(0), -balance)),
        })
        .drop("_previous")
    )
