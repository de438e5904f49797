import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from depositlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        4,
        "tests",
        **{
            "spark.checkpoint.dir": str(folder / "checkpoint"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    import uuid

    from depositlens.sources import namespace

    name = f"test_{uuid.uuid4().hex}"
    namespace.create_schema(spark, name, "tables of one test")
    yield name
    namespace.reset_schema(spark, name)


@pytest.fixture
def settings(spark):
    """Change session settings for one test: ``settings({"key": "value"})``."""
    old = {}

    def change(new):
        for key, value in new.items():
            old.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def small_skew(settings):
    """Sort-merge joins only, and partitions count as skewed at sizes a test can make."""
    settings(
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        }
    )
