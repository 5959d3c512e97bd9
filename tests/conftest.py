import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridledger.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g",
                                                "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def forced_split(monkeypatch):
    """Joins deal every key with a few rows into chunks, as they would deal the large keys of large tables."""
    from gridledger import scale
    monkeypatch.setattr(scale, "CHUNK_ROWS", 2)


def rows(df, *cols):
    """Rows as a sorted list of tuples; NULL sorts first."""
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, str(v)) for v in t))


@pytest.fixture
def table(spark):
    """Builds a table from a schema text and rows."""
    return lambda schema, data: spark.createDataFrame(data, schema)
