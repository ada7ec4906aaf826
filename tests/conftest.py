import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from slotweave.session import local_session

    return local_session("4")


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of dictionaries (or tuples with names) as an all-text DataFrame."""

    def make(rows, columns=None):
        columns = list(columns or dict.fromkeys(k for r in rows for k in r))
        data = [tuple(r.get(c) if isinstance(r, dict) else r[i] for i, c in enumerate(columns)) for r in rows]
        schema = ", ".join(f"`{c}` string" for c in columns)
        return spark.createDataFrame(data, schema)

    return make


def records(df, *order):
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[c]) for c in order)) if order else rows
