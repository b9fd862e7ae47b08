import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tradewind.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    extra = {"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    session = local_session("tests", 8, 8, **extra)
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    found = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return found if order else sorted(found, key=repr)


def final_plan(df) -> str:
    """The plan after it has run."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
