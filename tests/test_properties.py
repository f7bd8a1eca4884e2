"""Property tests (hypothesis): routing ranges and the scan vs. a Python fold."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventide import schemas as S
from eventide.functions import scan
from eventide.operators import partitioning as P

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.text(min_size=0, max_size=12), st.sampled_from(S.REGIONS)), min_size=1, max_size=30))
def test_partition_always_within_region_range(spark, rows):
    df = spark.createDataFrame(rows, "k string, region string")
    got = df.select("region", P.region_partition("k", "region").alias("p")).collect()
    for r in got:
        lo, hi = S.REGION_PARTITION_RANGES[r.region]
        assert lo <= r.p <= hi


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(S.ORDER_STATUSES + ["x"])), min_size=1, max_size=60),
       st.integers(2, 20))
def test_fold_matches_python(spark, reqs, chunk):
    rows = [(f"o{k}", i, s, i) for i, (k, s) in enumerate(reqs)]
    df = spark.createDataFrame(rows, "order_id string, event_id long, requested_status string, ts long")
    out = scan.fold_states(df, ["order_id"], ["ts", "event_id"], "requested_status", S.ORDER_STATUSES,
                           S.VALID_TRANSITIONS, "placed", "prev", max_chunk_rows=chunk).collect()
    state, exp = {}, {}
    for oid, eid, req, _ in rows:
        cur = state.get(oid, "placed")
        exp[eid] = cur
        if req in S.VALID_TRANSITIONS.get(cur, []):
            state[oid] = req
    assert {r.event_id: r.prev for r in out} == exp


class _State:
    """Stand-in for GroupState in pure-pandas tests of group functions."""

    def __init__(self, value=None):
        self.value = value

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, v):
        self.value = v
