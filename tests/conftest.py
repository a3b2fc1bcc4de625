import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tillflow.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tillflow-tests", "local[8]", {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def star(spark, sf_dir):
    """The derived star schema, saved once and read back."""
    from tillflow.schemas import TABLES, conform
    from tillflow.session import scratch_path
    from tillflow.sources.order_lines import star_tables
    from tillflow.sources.tables import SavedTables

    tables = SavedTables(spark, scratch_path(spark, "star"))
    tables.create()
    for name, df in star_tables(spark, sf_dir).as_dict().items():
        if name == "fact_sales":
            tables.write_days(df)
        else:
            tables.replace(name, conform(df, TABLES[name]))
    return tables
