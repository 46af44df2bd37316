import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        4,
        **{
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "stage"),
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()


START = dt.date(2020, 1, 6)


@pytest.fixture(scope="session")
def series(spark):
    """Daily panel from {key: units}, one value per day from START."""

    def build(histories, store="S1"):
        rows = [
            (item, store, START + dt.timedelta(days=i), int(u))
            for item, units in histories.items()
            for i, u in enumerate(units)
        ]
        return spark.createDataFrame(rows, "item_id string, store_id string, date date, units_sold bigint")

    return build
