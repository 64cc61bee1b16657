from __future__ import annotations

import re

import __spark_entry__ as contract


def test_each_operator_has_one_query():
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()
    assert {"op1_license_scan", "op2_contamination", "op5_secret_scan", "op7_quality_rules", "op11_overlap_join", "op12_ball_codes", "op13_conversation_trie"} <= set(contract.oracle_sql())
