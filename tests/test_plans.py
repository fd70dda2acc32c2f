"""Plan guards for every registered batch query: no cartesian or nested-loop
joins, no Python UDF operators, and scans that read only needed columns."""

from __future__ import annotations

import re

import pytest

from quarry.plans.catalog import QUERIES
from conftest import SF_SMALL

BATCH = sorted(QUERIES)
# Columns no registered query needs: a scan that reads them missed pruning.
UNUSED = {"lang", "source", "n_chars", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
          "l_shipdate", "l_linestatus", "l_linenumber", "o_orderdate"}
NEEDED = {"bigram_count_two_round": {"lang"}}     # its first round counts per language


@pytest.mark.parametrize("name", BATCH)
def test_plan_guards(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"
    for line in plan.splitlines():
        m = re.search(r"Location: .*?testdata/.*?ReadSchema: struct<([^>]*)>", line)
        if m:                                   # scans of the given tables only
            cols = {c.split(":")[0] for c in m.group(1).split(",") if c}
            extra = cols & UNUSED - NEEDED.get(name, set())
            assert not extra, f"{name} reads {extra}"
