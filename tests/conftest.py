import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from check import duck, local_session  # noqa: E402

from panelmill.session import tune  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return tune(local_session())


@pytest.fixture(scope="session")
def con():
    return duck(SF)


def rows(df, *columns):
    """Rows as sorted tuples."""
    out = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in out.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
