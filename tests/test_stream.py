import json

from plumbline.plans import norms
from plumbline.streaming.norms_stream import batch_log, ingest, ingest_records, newest_cells, seen, touched_rows

SCHEMA = "subject_id long, age double, sex string, condition string, channel string, band string, metric string, value double"


def record(i, **more):
    return json.dumps({"subject_id": f"s{i}", "age": 25.0, "sex": "F", "condition": "eo", "metrics": {"Fz": {"Alpha": {"relative_power": 0.1 * i, "bad": None}}}} | more)


def test_unreadable_files_are_set_aside_and_counted(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put = lambda name, text: (tmp_path / "in" / name).write_text(text)
    go = lambda: ingest_records(spark, f"{tmp_path}/in", f"{tmp_path}/store", f"{tmp_path}/check").awaitTermination()
    for i in range(3):
        put(f"s{i}.json", record(i))
    put("cut.json", record(4)[:40])
    put("empty.json", "")
    put("nobody.json", '{"age": 3}')
    put("note.txt", "no record")
    go()
    put("s7.json", record(7))
    put("s0again.json", record(0, age=99.0))
    put("binary.json", "\x00\x01\x02")
    go()
    log = {x.batch: (x.n_rows, x.n_bad_rows, x.n_bad_files) for x in batch_log(spark, f"{tmp_path}/store").collect()}
    assert log == {0: (3, 3, 2), 1: (1, 2, 1)}
    assert sorted(x.file.rsplit("/", 1)[1] for x in spark.read.parquet(f"{tmp_path}/store/unreadable").collect()) == ["binary.json", "cut.json", "nobody.json"]
    got = {(c.bin, c.sex): (c.n, round(c.mean, 6)) for c in newest_cells(spark, f"{tmp_path}/store").collect()}
    assert got == {("20-29", "pooled"): (4, 0.25), ("20-29", "F"): (4, 0.25)}


def test_a_refresh_reads_only_the_parts_it_touches(spark, tmp_path):
    row = lambda i, channel, v: (i, 25.0, "F", "eo", channel, "Alpha", "relative_power", v)
    schema = spark.createDataFrame([], SCHEMA).schema
    for part in ([row(i, c, float(i)) for i in range(5) for c in ("Fz", "Pz")], [row(9, "Pz", 7.0)]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in", mode="append")
        ingest(spark, f"{tmp_path}/in", schema, f"{tmp_path}/store", f"{tmp_path}/check").awaitTermination()
    got = {(c.channel, c.sex): c.n for c in newest_cells(spark, f"{tmp_path}/store").collect()}
    assert got == {("Fz", "pooled"): 5, ("Fz", "F"): 5, ("Pz", "pooled"): 6, ("Pz", "F"): 6}
    rows = seen(spark, f"{tmp_path}/store", schema, 2)
    touched = norms.fan_out(spark.createDataFrame([row(11, "Pz", 1.0)], SCHEMA)).select(*norms.KEYS).distinct()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # the plan is to be shown whole
    plan = touched_rows(rows, touched)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "= Pz" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    # A repeated batch changes nothing.
    from plumbline.streaming.norms_stream import absorb

    absorb(spark, spark.createDataFrame([row(9, "Pz", 7.0)], SCHEMA), f"{tmp_path}/store", 1)
    assert {(c.channel, c.sex): c.n for c in newest_cells(spark, f"{tmp_path}/store").collect()} == got
