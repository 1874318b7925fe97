import glob
import os

import pytest

from stratum.layout import Layout
from stratum.session import build_session

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "stratum-tests", "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "wh"))


@pytest.fixture
def landing(tmp_path):
    for folder in ("Customer", "Product", "Order"):
        (tmp_path / "landing" / folder).mkdir(parents=True)
    return tmp_path / "landing"


@pytest.fixture
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return con


def rows(df):
    """Rows as a sorted list of tuples, NULL first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def shape(schema):
    """Column names and types; whether NULL is allowed is left out."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]
