import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rentlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, shuffle_partitions=4, app="rentlens-tests")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_pair_join():
    """Fails when the plan pairs rows without an equality key."""

    def check(df):
        text = plan_of(df)
        assert "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text

    return check
