import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.tables import Tables  # noqa: E402
from marketflow.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {"spark.checkpoint.dir": "checkpoint", "spark.sql.warehouse.dir": "warehouse"}
    session = local_session(8, **{k: str(tmp_path_factory.mktemp(v)) for k, v in folders.items()})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SMALL)


def rows(df, *columns):
    """Collected rows as tuples of the given columns, sorted by their text."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
