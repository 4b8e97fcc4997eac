"""Plan guards for every registered query: no cross / nested-loop joins and
no Python UDF nodes (everything stays in JVM expressions)."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
from plan_audit import plan  # noqa: E402
from starloom.plans.catalog import QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_or_python(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in text, f"{name}: {bad}"
