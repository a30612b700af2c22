import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from cashline.schema import RAW_COLUMNS  # noqa: E402
from cashline.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, name="tests")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return Extracts(tmp_path / "extracts")


class Extracts:
    """A folder of hand-made extract files."""

    def __init__(self, root):
        self.root = root
        root.mkdir()

    def __str__(self):
        return str(self.root)

    def put(self, table, day, body, header=None):
        header = ",".join(RAW_COLUMNS[table]) + "\n" if header is None else header
        target = self.root / table / f"{table}_{day}.csv"
        target.parent.mkdir(exist_ok=True)
        data = body if isinstance(body, bytes) else body.encode()
        target.write_bytes(header.encode() + data)
        return target

    def rows(self, table, day, *rows):
        """Write dicts of raw columns; columns left out are empty, MANDT is 100."""
        lines = [
            ",".join({"MANDT": "100", **row}.get(c, "") for c in RAW_COLUMNS[table]) for row in rows
        ]
        return self.put(table, day, "".join(line + "\n" for line in lines))


def raw_frame(spark, table, rows):
    """A raw table from (source file, load number, dict of columns)."""
    import datetime as dt

    from cashline.schema import raw_struct

    start = dt.datetime(2026, 1, 1)
    data = [
        tuple(
            [values.get(c, "") for c in RAW_COLUMNS[table]]
            + [start + dt.timedelta(seconds=load), source]
        )
        for source, load, values in rows
    ]
    return spark.createDataFrame(data, raw_struct(table))


def collected(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
