"""Deal arithmetic.  Decimals stay decimals: amounts are never turned into doubles."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmweave.functions.columns import as_column

# A percentage as a factor.  Multiplying by it is exact on decimals, whereas a
# division by 100 would make Spark pick a result scale.
_PERCENT = Decimal("0.01")


def _certainty(certainty: Column | str, scale: str) -> Column:
    if scale == "fraction":
        return as_column(certainty)
    if scale == "percent":
        return as_column(certainty) * F.lit(_PERCENT)
    raise ValueError("certainty scale is 'fraction' or 'percent'")


def weighted_forecast(
    amount: Column | str, certainty: Column | str, scale: str = "fraction"
) -> Column:
    return as_column(amount) * _certainty(certainty, scale)


def net_amount(
    forecast: Column | str, cost: Column | str, cost_default: int | Decimal | None = None
) -> Column:
    """Forecast minus cost; a missing cost gives NULL unless ``cost_default`` is set."""
    cost = as_column(cost)
    if cost_default is not None:
        cost = F.coalesce(cost, F.lit(Decimal(cost_default)))
    return as_column(forecast) - cost


def net_after_discount(revenue: Column | str, discount_percent: Column | str) -> Column:
    """Revenue after a discount given in percent."""
    return as_column(revenue) * (F.lit(Decimal("1")) - as_column(discount_percent) * F.lit(_PERCENT))


def net_weighted_amount(
    net: Column | str, certainty: Column | str, scale: str = "fraction"
) -> Column:
    return weighted_forecast(net, certainty, scale)


def with_deal_amounts(
    df: DataFrame,
    certainty: str = "certainty",
    cost: str = "cost",
    scale: str = "fraction",
    cost_default: int | Decimal | None = None,
) -> DataFrame:
    """Add the three computed amounts, from ``amount`` or else from ``forecast``."""
    amount = "amount" if "amount" in df.columns else "forecast"
    net = net_amount(amount, cost, cost_default)
    return df.withColumns(
        {
            "weighted_forecast": weighted_forecast(amount, certainty, scale),
            "net_amount": net,
            "net_weighted_amount": net_weighted_amount(net, certainty, scale),
        }
    )
