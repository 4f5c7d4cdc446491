import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wattlane.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_panel(spark):
    """Panel from {series: [values]} on a regular grid; None stays null."""
    from datetime import datetime, timedelta

    def build(series, step_seconds=86400, start=datetime(2020, 1, 1), kind="double"):
        rows = [
            (name, start + timedelta(seconds=step_seconds * i), value)
            for name, values in series.items()
            for i, value in enumerate(values)
        ]
        return spark.createDataFrame(rows, f"series_id string, ts timestamp_ntz, value {kind}")

    return build
