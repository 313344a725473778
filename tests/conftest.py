import os
import sys
from datetime import date, datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lensmill.session import local_session  # noqa: E402
from lensmill.sources.catalog import SCHEMAS, Clinic  # noqa: E402
from pyspark.sql.types import StructType  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def branches(spark):
    return spark.sql(
        "select * from values ('B0', 'A100000', 8.00, 6.00, 'North', '1 North St', '555-1', 'Mo', 'mo@example.test'),"
        " ('B1', 'A100001', 4.00, 2.00, 'South', '2 South St', '555-2', 'Jo', 'jo@example.test')"
        " as t(code, provider_code, fte_100, fte_85, name, address, phone, manager_name, manager_email)"
    )


@pytest.fixture
def make_clinic(spark):
    """Tables from lists of dicts; columns not given are null, tables not given are empty."""

    def build(**tables) -> Clinic:
        frames = {}
        for name, ddl in SCHEMAS.items():
            schema = StructType.fromDDL(ddl)
            rows = [tuple(row.get(f.name) for f in schema.fields) for row in tables.get(name, [])]
            for row in tables.get(name, []):
                assert set(row) <= set(schema.fieldNames()), row
            frames[name] = spark.createDataFrame(rows, schema)
        return Clinic(frames)

    return build


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def day(text: str) -> date:
    return date.fromisoformat(text)


def money(text: str) -> Decimal:
    return Decimal(text)


def rows(frame, *columns):
    """Rows as a sorted list of tuples."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)
