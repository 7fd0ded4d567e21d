from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quaylake.schemas import SHIPMENT_SCHEMA  # noqa: E402
from quaylake.session import local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(master="local[*]", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="quaylake-test-")


# Golden seed rows of the table-operations lab.
SEED_ROWS = [
    ("SH-1001", "Delhi", "Mumbai", "V-101", 500.0, "High", 7500.0, "In Transit", "2026-07-15 09:00:00"),
    ("SH-1002", "Mumbai", "Pune", "V-102", 250.0, "Medium", 2500.0, "Vehicle Assigned", "2026-07-15 09:10:00"),
    ("SH-1003", "Bengaluru", "Chennai", "V-103", 1200.0, "High", 18000.0, "Delivered", "2026-07-15 09:15:00"),
]
INCOMING_ROWS = [
    ("SH-1002", "Mumbai", "Pune", "V-102", 250.0, "Medium", 2500.0, "In Transit", "2026-07-15 10:00:00"),
    ("SH-1004", "Hyderabad", "Delhi", "V-104", 800.0, "Low", 8000.0, "Shipment Created", "2026-07-15 10:05:00"),
]


@pytest.fixture()
def seed(spark):
    return spark.createDataFrame(SEED_ROWS, SHIPMENT_SCHEMA)


@pytest.fixture()
def incoming(spark):
    return spark.createDataFrame(INCOMING_ROWS, SHIPMENT_SCHEMA)
