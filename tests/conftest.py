import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadenza.session import local_session  # noqa: E402
from panel_helpers import at  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def series(spark):
    """Panel from {spot: [value per hour from hour 0]}; None is missing."""
    def make(values: dict, start: dict | None = None, name: str = "vol"):
        rows = [(spot, at((start or {}).get(spot, 0) + i), None if v is None else float(v)) for spot, vs in values.items() for i, v in enumerate(vs)]
        return spark.createDataFrame(rows, f"spot_num string, datetime timestamp_ntz, {name} double")
    return make
