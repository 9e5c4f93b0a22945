from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marquee.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="marquee-checkpoint-")
    session = build_session(
        master="local[*]", app_name="marquee-tests", shuffle_partitions=8, extra={"spark.checkpoint.dir": folder}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def catalog(spark):
    from marquee.sources.catalog import MovieCatalog
    from tests.fixtures import ROWS

    return MovieCatalog.from_rows(spark, ROWS)
