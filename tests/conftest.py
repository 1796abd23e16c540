import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelwright.panel import Panel  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def panel():
    return Panel("t", "g")


@pytest.fixture
def series(spark):
    """Build a panel from {group: [values in time order]}; times start at 1."""

    def build(name="s", start=1, **groups):
        rows = [
            (start + i, int(g.removeprefix("g")), v)
            for g, values in groups.items()
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(rows, f"t long, g long, {name} double")

    return build


@pytest.fixture
def read(panel):
    """Values of a column as {group: [values in time order]}."""

    def collect(df, col):
        out = {}
        for r in sorted(df.select("g", "t", col).collect()):
            out.setdefault(r[0], []).append(r[2])
        return out

    return collect
