import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from motorledger.session import local_session

    session = local_session(8, "6g", shuffle=4)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Result rows as a sorted list of tuples; None sorts first."""

    def collect(df, *cols):
        got = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(got, key=lambda r: tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in r))

    return collect
