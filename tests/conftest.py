import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parvis.session import with_defaults  # noqa: E402
from parvis.sources import schemas  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        with_defaults(SparkSession.builder.master("local[8]").appName("tests"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("run")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_listings(spark):
    """Listings from dicts; absent columns are null and row_idx counts up."""

    def make(rows):
        names = schemas.LISTINGS.fieldNames()
        full = [{"row_idx": i, "listing_id": f"L{i}", **r} for i, r in enumerate(rows)]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], schemas.LISTINGS)

    return make


@pytest.fixture(scope="session")
def make_sales(spark):
    def make(rows):
        names = schemas.SALES.fieldNames()
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.SALES)

    return make
