"""The nearest supplier within a bucket's width is found on equal buckets, ties and repeated keys too."""

from plumbline import registry


def test_nearest_meets_on_equal_keys(spark, tmp_path):
    parts, suppliers = [-31, -1, 0, 5, 10, 29, 30, 30, 44, 1000, None], [-2, -1, 0, 0, 1, 2, None]
    spark.createDataFrame([(p,) for p in parts], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(s,) for s in suppliers], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    out = registry.queries()["j13_nearest_within"](spark, str(tmp_path))
    want = {}
    for p in {p for p in parts if p is not None}:
        near = [(abs(p - 20 * s), s) for s in suppliers if s is not None and abs(p - 20 * s) <= 15]
        if near:
            want[p] = min(near)
    assert sorted((r.p_partkey, r.d, r.s_suppkey) for r in out.collect()) == sorted((p, *b) for p, b in want.items())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
