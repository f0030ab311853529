import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgersieve.plans.validation import References  # noqa: E402
from ledgersieve.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]", 8,
        **{
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def references(spark):
    return References.seeded(spark)


@pytest.fixture
def conf(spark):
    """Sets session settings for one test."""
    before = {}

    def set_conf(**settings):
        for key, value in settings.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_conf
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
