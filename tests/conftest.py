from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from footfall import build_session  # noqa: E402
from helpers import ACTION_FIELDS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", 4, spark__ui__enabled="false",
                            spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
                            spark__driver__memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def actions_of(spark):
    """Visit actions from tuples made by ``action``."""
    from footfall.sources.tables import typed_actions

    def make(rows):
        return typed_actions(spark.createDataFrame(rows, ACTION_FIELDS))

    return make


@pytest.fixture(scope="session")
def users(spark):
    from footfall.schemas import USER_INFO

    return spark.createDataFrame(
        [(1, "u1", "n1", 20, "teacher", "north", "male"),
         (2, "u2", "n2", 50, "driver", "south", "female"),
         (3, "u3", "n3", 51, "teacher", "south", "male"),
         (4, "u4", "n4", None, None, None, None)],
        USER_INFO,
    )
