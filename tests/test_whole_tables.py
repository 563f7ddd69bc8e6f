"""Queries that once ran over less than their operator's job."""

from plumbline import registry
from plumbline.plans.sql import run

SF = "/root/testdata/sf0.001"


def test_middle_epochs_are_120(spark):
    epochs = spark.range(3 * 125).selectExpr("id % 3 AS channel", "id div 3 AS epoch", "0 AS t_idx", "0.0D AS v")
    text = registry.SQL["w10_middle_epochs"].replace("FROM epochs", "FROM {epochs}")
    got = {(x.channel, x.epoch) for x in spark.sql(text, epochs=epochs).collect()}
    assert got == {(c, e) for c in range(3) for e in range(2, 122)}


def test_latest_order_of_each_customer_wins(spark):
    latest = {}
    for x in spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey", "o_orderkey").collect():
        latest[x.o_custkey] = max(x.o_orderkey, latest.get(x.o_custkey, 0))
    got = {x.subject_id: (x.source, x.age) for x in registry.queries()["u2_priority_union"](spark, SF).collect()}
    assert {k: ("update", float(v % 50)) for k, v in latest.items()} == {k: v for k, v in got.items() if v[0] == "update"}


def test_wide_subjects_hold_every_value(spark):
    wide = registry.queries()["s7_wide_subjects"](spark, SF).collect()
    got = {(x.subject_id, x.condition, k): v for x in wide for k, v in x.asDict().items() if "power" in k and v is not None}
    want = {(x.subject_id, x.condition, f"{x.channel}_{x.band}".lower() + f"_{x.metric}"): x.value for x in run(spark, SF, "SELECT * FROM metrics").collect()}
    assert got.keys() == want.keys() and all(abs(float(got[k]) - float(want[k])) < 2e-6 for k in want)
