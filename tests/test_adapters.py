import pytest
from pyspark.sql import functions as F

from plumbline.sources import adapters


@pytest.fixture
def folders(tmp_path):
    for dataset, files in {
        "dortmund": ["sub-01/ses-1/sub-01_ses-1_task-EyesOpen_run-2_eeg.set", "sub-01/ses-1/sub-01_ses-1_task-EyesClosed_eeg.set", "sub-02/sub-02_task-EyesOpen_eeg.set", "participants.tsv"],
        "lemon": ["sub-01/sub-01_EC.set", "sub-03/RS/raw_EO.set"],
        "hbn": ["sub-09/sub-09_task-RestingState_eeg.set"],
    }.items():
        for f in files:
            at = tmp_path / dataset / f
            at.parent.mkdir(parents=True, exist_ok=True)
            at.write_text("x" * 7)
    return {d: str(tmp_path / d) for d in ("dortmund", "lemon", "hbn")}


def test_two_datasets_with_their_own_rules_in_one_query(spark, folders):
    rows = adapters.manifest(spark, folders, (".set",))
    found = adapters.classify(rows, adapters.condition_rules(spark))
    got = sorted((x.dataset, x.subject, str(x.session), str(x.run), x.condition, x.length) for x in found.collect())
    assert got == [("dortmund", "01", "1", "2", "eo", 7), ("dortmund", "01", "1", "None", "ec", 7), ("dortmund", "02", "None", "None", "eo", 7), ("hbn", "09", "None", "None", "split", 7), ("lemon", "01", "None", "None", "ec", 7), ("lemon", "03", "None", "None", "eo", 7)]


def test_filters_reach_the_listing(spark, folders):
    rows = adapters.manifest(spark, folders).where(F.col("subject").isin("01", "09") & (F.col("suffix") == ".set"))
    assert sorted((x.dataset, x.subject) for x in rows.collect()) == [("dortmund", "01"), ("dortmund", "01"), ("hbn", "09"), ("lemon", "01")]
    reader = adapters.RecordingReader({"path": folders["dortmund"]})
    left = list(reader.pushFilters([adapters.EqualTo(("subject",), "02"), adapters.EqualTo(("suffix",), ".set")]))
    assert [f.attribute for f in left] == [("suffix",)] and [p.path.rsplit("/", 1)[1] for p in reader.partitions()] == ["dortmund", "sub-02"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "subject#" not in "".join(line for line in plan.splitlines() if "Filter" in line and "BatchScan" not in line)


def test_rules_of_every_kind(spark):
    names = [("lemon", "sub_EC"), ("mipdb", "x_rest"), ("hbn", "task-restEO"), ("hbn", "a_rest_b"), ("dortmund", "sub_EO"), ("dortmund", "sub_EOx"), ("trt", "sub_task-eyesclosed_x"), ("trt", "sub_task-eyesclosed2"), ("none", "EC"), ("lemon", None), (None, "EC")]
    got = {(x.dataset, x.stem): x.condition for x in adapters.classify(spark.createDataFrame(names, "dataset string, stem string"), adapters.condition_rules(spark)).collect()}
    assert list(map(got.get, names)) == ["ec", "eo", "eo", "split", "eo", None, "ec", None, None, None, None]


def test_phenotype_files_of_several_makes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('# made by hand\n"Identifiers","CBCL_Total_T",Age\nA1,61.5,9\n\n# a note\nA2,n/a,10\n')
    (tmp_path / "b.csv").write_text('age,EID,cbcl_total\n8,B1,"70"\n,B2,\n')
    got = adapters.read_phenotypes(spark, str(tmp_path), {"subject": ["EID", "Identifiers"], "score": ["CBCL_Total", "CBCL_Total_T"], "age": ["Age"], "none": ["Missing"]})
    assert sorted((x.subject, x.score, x.age, x.none) for x in got.collect()) == [("A1", "61.5", "9", None), ("A2", None, "10", None), ("B1", "70", "8", None), ("B2", None, None, None)]


def test_a_run_that_was_cut_off_and_repeated_gives_the_same_table(spark, tmp_path):
    units = spark.createDataFrame([(str(i),) for i in range(8)], "unit string")
    result = lambda us: us.select("unit", (F.col("unit").cast("int") * 2).alias("x"))

    def work(store, stop=None):
        for k in range(4):
            mine = store.pending(units.where(F.col("unit").cast("int") % 4 == k))
            if mine.isEmpty():
                continue
            bad = mine.where("unit = '5'").select("unit", F.lit("unreadable").alias("detail"))
            good = mine.where("unit <> '5'")
            if stop == k:  # rows are there, the note is not
                result(good).write.mode("overwrite").parquet(f"{store.path}/rows/batch={k}")
                raise RuntimeError
            store.append(str(k), result(good), mine, bad)

    whole, broken = adapters.UnitStore(spark, f"{tmp_path}/whole"), adapters.UnitStore(spark, f"{tmp_path}/broken")
    work(whole)
    with pytest.raises(RuntimeError):
        work(broken, stop=2)
    assert sorted(x.unit for x in broken.read().collect()) == ["0", "1", "4"]
    work(broken)
    rows = lambda s: sorted((x.unit, x.x) for x in s.read().collect())
    assert rows(broken) == rows(whole) == [(str(i), 2 * i) for i in range(8) if i != 5]
    assert {x.unit: x.detail for x in broken.done().where("status = 'failed'").collect()} == {"5": "unreadable"}
    assert broken.pending(units).isEmpty() and [x.unit for x in broken.pending(units, retry=True).collect()] == ["5"]
    broken.append("9", result(units.where("unit = '5'")), units.where("unit = '5'"))
    assert rows(broken) == [(str(i), 2 * i) for i in range(8)]
