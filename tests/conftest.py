import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)


@pytest.fixture(scope="session")
def spark():
    from rillflow.session import drop_scratch, local_session

    session = local_session("tests", cpus=4, **{"spark.driver.memory": "6g"})
    yield session
    drop_scratch(session)
    session.stop()


def rows(df, *columns):
    """The rows as a sorted list of tuples."""
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())
