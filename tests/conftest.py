import os
import sys
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tierline import FeedSpec, Layers, get_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
X = FeedSpec("x", "x_start", "x_end")
Y = FeedSpec("y", "y_start", "y_end")
NOON = datetime(2020, 1, 1, 12)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        spark__master="local[8]",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, str(tmp_path / "root"))


def land_table(layers: Layers, feed: str, name: str, table: pa.Table) -> None:
    """Write one landing file as it is given."""
    directory = Path(layers.landing(feed))
    directory.mkdir(parents=True, exist_ok=True)
    pq.write_table(table, directory / name)


def raw_rows(
    feed: FeedSpec, amounts: list, parties: list | None = None, entities: list | None = None, **extra
) -> pa.Table:
    """Raw rows of a feed, one per amount, with defaults for what is not given."""
    n = len(amounts)
    columns = {
        "Entity_Code": pa.array(entities or list(range(n)), pa.int64()),
        "party_size": pa.array(parties or [1.0] * n, pa.float64()),
        "total_amount": pa.array(amounts, pa.float64()),
        feed.start_col: pa.array([NOON] * n, pa.timestamp("us")),
        feed.end_col: pa.array([NOON] * n, pa.timestamp("us")),
    }
    return pa.table(columns | extra)


def land(layers: Layers, feed: FeedSpec, name: str, amounts: list, **columns) -> None:
    land_table(layers, feed.name, name, raw_rows(feed, amounts, **columns))


def values(df, *columns: str) -> list[tuple]:
    """All rows of the given columns, sorted with NULLs first."""
    rows = [tuple(row) for row in df.select(*(columns or df.columns)).collect()]
    return sorted(rows, key=lambda row: [(value is not None, value) for value in row])
