from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from retrolane.session import local_session  # noqa: E402
from retrolane.sources.catalog import from_frames  # noqa: E402
from retrolane.sources.schemas import TABLES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def make(spark):
    """Builds a catalog from rows given as dicts; columns left out are NULL, tables left out are empty."""

    def build(**tables):
        frames = {}
        for name, schema in TABLES.items():
            columns = [part.split()[0] for part in schema.split(", ")]
            rows = [tuple(row.get(column) for column in columns) for row in tables.get(name, [])]
            for row in tables.get(name, []):
                assert set(row) <= set(columns), (name, row)
            frames[name] = spark.createDataFrame(rows, schema)
        return from_frames(spark, frames)

    return build


def dicts(df) -> list[dict]:
    return [row.asDict(recursive=True) for row in df.collect()]
