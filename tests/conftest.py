from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from overspend.session import local_session  # noqa: E402
from overspend.sources.transactions import TRANSACTION_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session("*", shuffle_partitions=8, app="overspend-tests", checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def make_tx(spark):
    def build(rows: list[dict]):
        names = [f.name for f in TRANSACTION_SCHEMA.fields]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], TRANSACTION_SCHEMA)

    return build
