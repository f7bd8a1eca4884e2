"""Plan shape checks: the scale rules hold in the executed plans."""
import re

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

# queries that write files or run streams build their result eagerly; their
# final plans are plain file scans, so the batch queries are the ones to check
BATCH = [n for n in sorted(E.queries()) if not any(
    s in n for s in ("stream", "sink", "roundtrip", "pipeline", "committed", "fan_out", "resume",
                     "dedup_events", "codec", "interleaved"))]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_global_window(spark, name):
    """No Window without partitionBy: every window runs per key or chunk."""
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for line in plan.splitlines():
        # carry windows (outputs ``__c_*``) run over the bounded per-chunk table
        if re.search(r"\bWindow \[", line) and " AS __c_" not in line:
            m = re.search(r"\], \[([^\]]*)\], \[", line)
            assert m and m.group(1).strip(), f"global window in {name}: {line.strip()[:160]}"


@pytest.mark.parametrize("name", ["enrich_orders", "fraud_alerts", "order_state_changes", "scan_topic"])
def test_scans_are_pruned(spark, name):
    """Parquet scans read only the needed columns (never all of events/orders)."""
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for m in re.finditer(r"ReadSchema: struct<([^>]*)>", plan):
        assert "props" not in m.group(1) or name == "scan_topic"
        assert "o_orderpriority" not in m.group(1)


def test_profiles_are_not_hint_broadcast(spark):
    """The profile table grows with the data: the only broadcast hint in the
    enrichment plan is on the fixed 25-row nation table; AQE decides the rest."""
    df = E.queries()["enrich_orders"](spark, SF_SMALL)
    lines = df._jdf.queryExecution().analyzed().toString().splitlines()
    hinted = [i for i, line in enumerate(lines) if "strategy=broadcast" in line]
    assert hinted
    for i in hinted:
        assert "n_nationkey" in lines[i + 1]
