"""The registered queries of the subpackage as whole plans on the smallest tables."""

import pytest

from doclake.llm import queries

SF_SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_no_pairwise_joins_or_row_udfs(spark, name):
    plan = queries.QUERIES[name][0](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert op not in plan
