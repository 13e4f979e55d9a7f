from __future__ import annotations

import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parcelmart.session import build  # noqa: E402
from parcelmart.sources.readers import Sources, schema_of  # noqa: E402
from parcelmart.sources.schemas import SCHEMAS  # noqa: E402


@pytest.fixture(scope="session")
def shared_dir(tmp_path_factory):
    return tmp_path_factory.mktemp("shared")


@pytest.fixture(scope="session")
def spark(shared_dir):
    session = build(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(shared_dir),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ist(text: str) -> int:
    """Epoch milliseconds of an IST wall time."""
    fmt = "%Y-%m-%d %H:%M:%S" if text.count(":") == 2 else "%Y-%m-%d %H:%M" if ":" in text else "%Y-%m-%d"
    at = datetime.strptime(text, fmt).replace(tzinfo=timezone.utc)
    return int(at.timestamp() * 1000) - 19_800_000


def domain(spark, **rows: list[dict]) -> Sources:
    """Source tables with the given rows; all others are empty."""
    given = {}
    for name in SCHEMAS:
        schema = schema_of(name)
        for row in rows.get(name, []):
            assert set(row) <= set(schema.names), (name, set(row) - set(schema.names))
        data = [tuple(row.get(c) for c in schema.names) for row in rows.get(name, [])]
        given[name] = spark.createDataFrame(data, schema)
    return Sources(spark, given=given)


def values(df, *columns: str) -> list:
    """Rows of the named columns as sorted tuples (single values for one column)."""
    rows = [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]
    return sorted(rows, key=repr)
