import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from bazaarlens.schemas import RAW_COLUMNS, raw_schema  # noqa: E402
from bazaarlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        4, "tests", **{"spark.checkpoint.dir": str(folder), "spark.driver.memory": "4g"}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    """Make a raw table from dicts; columns left out are NULL."""

    def make(table, *rows):
        names = RAW_COLUMNS[table]
        return spark.createDataFrame(
            [tuple(row.get(name) for name in names) for row in rows], raw_schema(table)
        )

    return make


@pytest.fixture(scope="session")
def rows():
    """Collect a DataFrame as plain tuples of the named columns."""

    def collect(df, *columns):
        return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]

    return collect
