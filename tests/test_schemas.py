"""Schema evolution rules (v1 -> v2) and record shapes."""

from eventide import schemas as S
from eventide.operators import transforms as TR


def test_field_counts():
    assert len(S.ORDER_PLACED_V1.fields) == 9
    assert len(S.ORDER_PLACED_V2.fields) == 12


def test_v1_fields_unchanged_in_v2():
    v2 = {f.name: f.dataType for f in S.ORDER_PLACED_V2.fields}
    for f in S.ORDER_PLACED_V1.fields:
        assert v2[f.name] == f.dataType


def test_new_fields_have_defaults(spark):
    v1 = spark.createDataFrame([("o1", "c1", 1.0)], "order_id string, customer_id string, total_amount double")
    v2 = spark.createDataFrame([("o2", "c2", 2.0, "SAVE1", "high")],
                               "order_id string, customer_id string, total_amount double, coupon_code string, priority string")
    got = {r.order_id: r for r in TR.evolve_to_v2(v1, v2).collect()}
    assert got["o1"].coupon_code is None and got["o1"].priority == "standard" and got["o1"].metadata == {}
    assert got["o2"].priority == "high"


def test_payment_fields():
    names = {f.name for f in S.PAYMENT_PROCESSED.fields}
    assert {"payment_id", "order_id", "amount", "status"} <= names


def test_checkpoint_dir_local_fallback_only_for_local_master(spark, monkeypatch):
    """Scratch space comes from spark.checkpoint.dir; a machine-local
    fallback is refused when the master is not local."""
    import pytest

    from eventide import session as S
    assert spark.conf.get("spark.checkpoint.dir")  # set by the test session
    assert S._is_local(spark)

    class _Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class _Cluster:
        conf = _Conf()
    monkeypatch.delenv("EVENTIDE_CHECKPOINT_DIR", raising=False)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(_Cluster())
