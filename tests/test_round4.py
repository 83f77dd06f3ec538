from __future__ import annotations

from test_cases import LAYOUT_CASES

from quire.plans import registry


def test_layout_cases_query_has_every_rule(spark):
    found = registry.queries()["layout_cases"](spark, "/root/testdata/sf0.001").select("options").distinct().collect()
    assert {x["options"] for x in found} == {"flat", "backward"} | {f"page_{name}" for name in LAYOUT_CASES}
