import json

from plumbline.plans import norms
from plumbline.sources import io


def test_records_round_trip_and_corrupt_files_are_set_aside(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"s{i}.json").write_text(json.dumps({"subject_id": f"s{i}", "age": 25 + i, "sex": "F", "condition": "eo", "metrics": {"Fz": {"Alpha": {"relative_power": 0.1 + i, "bad": None}}}}))
    (tmp_path / "broken.json").write_text('{"subject_id": ')
    records, broken = io.read_records(spark, str(tmp_path))
    rows = io.explode_metrics(records)
    assert sorted((r.subject_id, r.value) for r in rows.collect()) == [("s0", 0.1), ("s1", 1.1)] and broken.count() == 1
    nested = {r.subject_id: r.metrics for r in io.nest_metrics(rows, ["subject_id"]).collect()}
    assert nested["s1"] == {"Fz": {"Alpha": {"relative_power": 1.1}}}
    assert {r.subject_id for r in io.merge_sources({"a-1": records, "b": records}).collect()} == {"a1_s0", "a1_s1", "b_s0", "b_s1"}
    cells = norms.norm_cells(rows)
    io.write_norms_json(cells, f"{tmp_path}/out/json")
    assert io.read_norms_json(spark, f"{tmp_path}/out/json").count() == cells.count()
    io.write_norms_csv(cells, f"{tmp_path}/out/csv")
    assert "p97.5" in spark.read.csv(f"{tmp_path}/out/csv", header=True).columns
    io.write_bundle(cells.drop("kurtosis"), f"{tmp_path}/out/bundle", {"b": 1, "a": 2})
    back = io.read_bundle(spark, f"{tmp_path}/out/bundle")
    assert back.count() == cells.count() and "kurtosis" in back.columns


def test_dirty_tables(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("participant_id\tAge\tgender\tBDI\ns1\t20-25\tmale\t3\ns2\tn/a\t1\t\ns3\t31.5\tFemale\t9\n")
    got = {r.participant_id: (r.age, r.sex, r.other["BDI"]) for r in io.read_participants(spark, f"{tmp_path}/p.tsv").collect()}
    assert got == {"s1": (22.5, "M", "3"), "s2": (None, "F", None), "s3": (31.5, "F", "9")}
    (tmp_path / "e.tsv").write_text("onset\tduration\ttrial_type\tvalue\n1.5\tn/a\tn/a\tS200\nbad\t1\tx\ty\n3\t2\topen\tz\n")
    assert sorted((r.onset, r.duration, r.label) for r in io.read_events(spark, f"{tmp_path}/e.tsv").collect()) == [(1.5, 0.0, "S200"), (3.0, 2.0, "open")]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "sub-A1_ses-2_task-EyesOpen_run-3_eeg.set").write_text("x")
    m = io.read_manifest(spark, f"{tmp_path}/raw").first()
    assert (m.subject, m.session, m.task, m.run, m.condition, m.length) == ("A1", "2", "EyesOpen", 3, "eo", 1)


def test_array_spectra_are_aligned_by_name_and_other_grids_left_out(spark):
    grid = [1.0, 2.0, 3.0]
    rows = [("a", ["Pz", "Fz", "X"], grid, [[1.0, 2.0, 3.0], [4.0, 5.0, float("nan")], [0.0] * 3]), ("b", ["Fz"], grid, [[7.0, 8.0, 9.0]]), ("c", ["Fz"], [1.0, 2.5, 3.0], [[1.0] * 3]), ("d", ["Fz", "Pz"], grid, [[1.0] * 3]), ("e", None, None, None)]
    long, out = io.spectra_rows(spark.createDataFrame(rows, io.SPECTRUM), ["Fz", "Cz", "Pz"])
    got = sorted((x.recording_id, x.channel, x.position, x.freq, x.psd) for x in long.where("freq <> 3").collect())
    assert got == [("a", "Fz", 0, 1.0, 4.0), ("a", "Fz", 0, 2.0, 5.0), ("a", "Pz", 2, 1.0, 1.0), ("a", "Pz", 2, 2.0, 2.0), ("b", "Fz", 0, 1.0, 7.0), ("b", "Fz", 0, 2.0, 8.0)]
    assert long.where("recording_id = 'a' and channel = 'Fz' and freq = 3").first().psd is None
    assert sorted((x.recording_id, x.reason) for x in out.collect()) == [("c", "grid"), ("d", "shape"), ("e", "grid")]
    vector = io.channel_vector(long.where("freq = 1").withColumn("bin", long["recording_id"]), ["Fz", "Cz", "Pz"], "psd", ("bin",))
    assert {x.bin: x.vector for x in vector.collect()} == {"a": [4.0, None, 1.0], "b": [7.0, None, None]}


def test_electrodes_are_matched_greedily_and_analytic_signals_are_right(spark):
    import numpy as np

    from plumbline.operators.grouped import analytic_signal, greedy_match

    r = np.random.default_rng(5)
    found = [(i, f"E{k}", *map(float, r.normal(size=3))) for i in range(4) for k in range(9)] + [(9, "E0", 0.0, 0.0, 0.0)]
    targets = [(f"T{k}", k, *map(float, r.normal(size=3))) for k in range(5)]
    got = {(x.recording_id, x.target): (x.channel, x.distance) for x in greedy_match(spark.createDataFrame(found, "recording_id long, channel string, x double, y double, z double"), spark.createDataFrame(targets, "target string, pos int, x double, y double, z double"), 2.5).collect()}
    want = {}
    for i in {f[0] for f in found}:
        free = {f[1]: f[2:] for f in found if f[0] == i}
        for name, _, *at in targets:
            near = min(((sum((a - b) ** 2 for a, b in zip(at, p, strict=True)) ** 0.5, c) for c, p in free.items()), default=None)
            if near and near[0] <= 2.5:
                want[i, name] = near[::-1]
                del free[near[1]]
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-12 for k in got)
    t = np.arange(128) / 64
    rows = [(1, k, float(v)) for k, v in enumerate(3 * np.cos(2 * np.pi * 8 * t + 0.5) + np.cos(2 * np.pi * 20 * t))]
    out = analytic_signal(spark.createDataFrame(rows, "g long, t_idx int, v double"), ["g"], 64.0, 4.0, 13.0).orderBy("t_idx").collect()
    assert all(abs(x.amplitude - 3) < 1e-9 and abs(np.exp(1j * x.phase) - np.exp(1j * (2 * np.pi * 8 * s + 0.5))) < 1e-9 for x, s in zip(out, t, strict=True))


def test_participants_in_several_dialects(spark, tmp_path):
    (tmp_path / "lemon.csv").write_text("ID,Gender_ 1=female_2=male,Age,Smoker\ns1,1,20-25,no\ns2,2,,yes\n")
    (tmp_path / "hbn.tsv").write_text("EID\tSex\tAge\nA\t0\t9.5\nB\t1\tn/a\n")
    (tmp_path / "de.csv").write_text("Proband;Alter;Geschlecht\np1;31,5;w\np2;40_44;m\np3;x;divers\n")
    read = lambda name, dialect: {x.participant_id: (x.age, x.sex, dict(x.other)) for x in io.read_participants(spark, f"{tmp_path}/{name}", dialect=dialect).collect()}
    assert read("lemon.csv", "lemon") == {"s1": (22.5, "F", {"Smoker": "no"}), "s2": (None, "M", {"Smoker": "yes"})}
    assert read("hbn.tsv", "hbn") == {"A": (9.5, "M", {}), "B": (None, "F", {})}
    assert read("de.csv", "german") == {"p1": (31.5, "F", {}), "p2": (42.0, "M", {}), "p3": (None, "divers", {})}
