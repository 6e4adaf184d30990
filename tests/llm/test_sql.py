"""The queries of this part that SQL can express."""

import pytest

from compare import connect, differences
from rillflow.llm.queries import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(spark, connect(SF), name, SF) is None
