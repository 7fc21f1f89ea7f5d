from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tessera-test-")


@pytest.fixture(scope="session")
def employees_df(spark):
    rows = [
        (108, "Yuki", "Hartmann"), (101, "Mara", "Quist"), (112, "Odo", "Varga"), (105, "Pavel", "Duarte"),
        (102, "Theo", "Lindqvist"), (111, "Rin", "Castellano"), (104, "Ines", "Okafor"), (109, "Sol", "Achterberg"),
    ]
    return spark.createDataFrame(rows, "id long, firstName string, lastName string")


@pytest.fixture(scope="session")
def roles_df(spark):
    rows = [(109, "Archivist"), (106, "Pilot"), (102, "Welder"), (113, "Cook"), (105, "Welder"), (110, "Pilot"), (104, "Botanist")]
    return spark.createDataFrame(rows, "id long, jobRole string")


@pytest.fixture(scope="session")
def products_df(spark):
    rows = [
        ("kettle", "kitchen", 40), ("rake", "garden", 25), ("ladle", "kitchen", 12), ("hose", "garden", 60),
        ("stool", "home", 75), ("spade", "garden", 25), ("whisk", "kitchen", 12), ("pan", "kitchen", 55),
        ("trowel", "garden", 18), ("shelf", "home", 120), ("rug", "home", 75), ("sieve", "kitchen", 12),
    ]
    return spark.createDataFrame(rows, "product string, category string, revenue long")


@pytest.fixture(scope="session")
def people_df(spark):
    rows = [
        ("Ula ", "Brandt", 51, 88.0, "Beekeeper"),
        ("Nadia", "Roth", 38, None, "Surveyor"),
        ("ula", "Brandt", 19, None, "Glass Blower"),
        (" Timo", "Esser", 27, None, None),
        ("ULA", "Moss", 33, 64.5, None),
        ("Timo", "Esser", 45, 101.2, "beekeeper"),
    ]
    return spark.createDataFrame(rows, "firstName string, lastName string, age long, weightInLbs double, jobType string")
