from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from casewright.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
# Column expressions in test modules need a session while pytest collects.
SESSION = local_session(8)


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Value of a column expression for each row of given columns."""

    def run(column, **columns):
        names = list(columns)
        rows = list(zip(*columns.values(), strict=True))
        ddl = ", ".join(f"{n} string" for n in names)
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_i int, {ddl}")
        return [r[1] for r in sorted(df.select("_i", column.alias("x")).collect())]

    return run
