import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from seriesmill.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def series(spark):
    """Turn lists into a positioned frame: series(x=[..], y=[..])."""

    def make(**columns):
        size = len(next(iter(columns.values())))
        rows = [(i, *(c[i] for c in columns.values())) for i in range(size)]
        kinds = ["idx long"]
        for name, values in columns.items():
            known = next((v for v in values if v is not None), 0.0)
            kinds.append(f"{name} {'string' if isinstance(known, str) else 'double'}")
        converted = [
            tuple(float(v) if isinstance(v, int) and j else v for j, v in enumerate(row))
            for row in rows
        ]
        return spark.createDataFrame(converted, ", ".join(kinds))

    return make


@pytest.fixture(scope="session")
def price_table() -> pd.DataFrame:
    """A price table of the expected 17 columns with a learnable target."""
    random = np.random.default_rng(7)
    n = 700
    day = np.arange(n)
    month = (day // 28) % 12 + 1
    seasons = np.array(["Winter", "Winter", "Spring", "Spring", "Spring", "Summer", "Summer",
                        "Summer", "Autumn", "Autumn", "Autumn", "Winter"])
    uniform = random.uniform
    frame = pd.DataFrame(
        {
            "Year": 2010 + day // 336,
            "Month": month,
            "Day": day % 28 + 1,
            "Season": seasons[month - 1],
            "Inflation_Rate": uniform(1, 10.98, n),
            "Exchange_Rate": uniform(0.1, 1, n),
            "GDP_Growth": uniform(-2, 5.98, n),
            "Crop_Yield": uniform(2.03, 10, n),
            "Fertilizer_Price": uniform(20, 100, n),
            "Water_Availability": uniform(50, 100, n),
            "Temperature": uniform(-5, 39.86, n),
            "Rainfall": uniform(0.07, 299.85, n),
            "Humidity": uniform(20, 90, n),
            "Transport_Cost": uniform(50, 500, n),
            "Demand_Index": uniform(0.5, 1.5, n),
            "Previous_Price": uniform(1.01, 9.98, n),
        }
    ).round(2)
    noise = random.normal(0, 0.2, n)
    frame["Food_Price"] = (frame["Previous_Price"] + 0.3 * frame["Demand_Index"] + noise).clip(
        0.97, 10.75
    ).round(2)
    return frame
