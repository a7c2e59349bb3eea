"""The operators marked native plan no Python work."""

import os

import pytest

SF = "/root/testdata/sf0.001"
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow", "FlatMapGroupsInArrow",
          "FlatMapCoGroupsInArrow", "PythonUDF")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data missing")
@pytest.mark.parametrize("name", ["op4_quality_rules", "op10_pii"])
def test_native_operators_have_no_python_in_their_plans(spark, name):
    from roadlake.llm import queries
    plan = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in PYTHON if n in plan]
