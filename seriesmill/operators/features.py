"""The feature set of a price table, described by a spec and built in one window pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, WindowSpec

from seriesmill.functions.columns import numeric_columns, product
from seriesmill.operators.clean import drop_incomplete, impute
from seriesmill.operators.order import BLOCK_ROWS, over_blocks
from seriesmill.operators.windows import difference_with_head, lag_with_head, rolling_mean


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns play which part; every mapping is new column -> source column(s)."""

    target: str
    category: str
    year: str = "Year"
    month: str = "Month"
    lags: Mapping[str, str] = field(default_factory=dict)
    rolling: Mapping[str, str] = field(default_factory=dict)
    rolling_rows: int = 3
    differences: Mapping[str, str] = field(default_factory=dict)
    products: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    not_features: tuple[str, ...] = ("idx",)

    @property
    def made(self) -> list[str]:
        return [*self.lags, *self.rolling, *self.differences, *self.products]


# The ten features of the price observation table and their sources.
PRICE_FEATURES = FeatureSpec(
    target="Food_Price",
    category="Season",
    lags={"Previous_Lag": "Previous_Price"},
    rolling={
        "Rainfall_3m_avg": "Rainfall",
        "Temperature_3m_avg": "Temperature",
        "TransportCost_3m_avg": "Transport_Cost",
    },
    differences={"GDP_Growth_diff": "GDP_Growth", "Demand_Trend": "Demand_Index"},
    products={
        "Rainfall_Demand": ("Rainfall", "Demand_Index"),
        "Temp_Crop": ("Temperature", "Crop_Yield"),
        "Rainfall_Temp": ("Rainfall", "Temperature"),
        "Yield_Demand": ("Crop_Yield", "Demand_Index"),
    },
)

# The same roles on the observation view over orders.
ORDER_FEATURES = FeatureSpec(
    target="price",
    category="season",
    year="year",
    month="month",
    lags={"previous_lag": "previous_price"},
    rolling={"qty_avg3": "qty", "disc_avg3": "disc", "ext_avg3": "ext"},
    differences={"tax_diff": "tax", "n_lines_trend": "n_lines"},
    products={
        "qty_lines": ("qty", "n_lines"),
        "disc_bal": ("disc", "acctbal"),
        "qty_disc": ("qty", "disc"),
        "bal_lines": ("acctbal", "n_lines"),
    },
    not_features=("idx", "obs_id", "obs_ts", "series_key"),
)


def engineer(
    df: DataFrame,
    spec: FeatureSpec = PRICE_FEATURES,
    fit_on: Column | None = None,
    keys: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Impute numeric nulls, add the features of ``spec`` and drop rows still incomplete.

    ``df`` carries ``idx``. Means come from the rows where ``fit_on`` holds (all rows
    by default). Lag, rolling and difference columns share one shuffle and one sort.
    """
    filled = impute(df, numeric_columns(df, exclude=spec.not_features), fit_on=fit_on)

    def build(window: WindowSpec) -> dict[str, Column]:
        return {
            **{new: lag_with_head(old, window) for new, old in spec.lags.items()},
            **{
                new: rolling_mean(old, window, spec.rolling_rows)
                for new, old in spec.rolling.items()
            },
            **{new: difference_with_head(old, window) for new, old in spec.differences.items()},
        }

    back = max(spec.rolling_rows - 1, 1)
    made = over_blocks(filled, build, back=back, ahead=1, keys=keys, block_rows=block_rows)
    made = made.withColumns({new: product(*pair) for new, pair in spec.products.items()})
    return drop_incomplete(made)
