from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("LEDGERLINE_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ledgerline.session import configure

    session = (SparkSession.builder.master("local[*]")
               .config("spark.sql.shuffle.partitions", "8")
               # catalog tables of the tests go to a scratch folder, not the working directory
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ledgerline-warehouse-"))
               .config("spark.checkpoint.dir", "file:" + tempfile.mkdtemp(prefix="ledgerline-shared-"))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    from tools.check_oracle import duck_connect

    return duck_connect(sf_dir)


@pytest.fixture(scope="session")
def catalog():
    from ledgerline.plans.catalog import queries

    return queries()


@pytest.fixture(scope="session")
def roles(spark, sf_dir):
    from ledgerline.sources.fixtures import RoleTables

    return RoleTables(spark, sf_dir)
