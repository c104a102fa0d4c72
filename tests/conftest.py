import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from olapkit.workspace import local_session

    session = local_session("8")
    # Tests look for paths in plans; Spark cuts off longer ones.
    session.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return session


@pytest.fixture(scope="session")
def tables(spark):
    from olapkit.plans.tables import Tables

    return Tables(spark, FOLDER)
