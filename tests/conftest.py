from __future__ import annotations

import pytest

from tidemark.session import local_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        8, "tests", spark__sql__shuffle__partitions="4", spark__sql__maxMetadataStringLength="2000",
        spark__sql__codegen__wholeStage="false", spark__sql__codegen__factoryMode="NO_CODEGEN",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark):
    from tidemark.session import scratch_path
    from tidemark.sinks.tables import TableStore

    tables = TableStore(spark, scratch_path(spark, "test-store"))
    tables.bootstrap()
    return tables
