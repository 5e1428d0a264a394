import pytest
from pyspark.sql import functions as F

from tidewatch.functions import normalize_decimal, parse_decimal
from tidewatch.sources.batches import discover_batches, load_batches
from tidewatch.sources import batches
from tidewatch.sources.batches import index_rows, read_lines, target_conventions
from tidewatch.spec import INSURANCE

HEADER = "age,sex,bmi,children,smoker,region"
ROWS = ["19,female,27.9,0,yes,southwest", "34,male,33.77,1,no,southeast", "47,female,23.164,3,no,northwest",
        "62,male,29.041,0,no,northeast", "28,female,25.519,2,yes,southeast"]


@pytest.mark.parametrize("raw, expected", [
    ("14700.80931", 14700.80931), ("14700,80931", 14700.80931), ("1.234,56", 1234.56), ("1,234.56", 1234.56),
    ("1,234,567", 1234567.0), ("42", 42.0), ("  18,5  ", 18.5), ('"7,25"', 7.25), ("1e3", 1000.0), ("-.5", -0.5),
    ("", None), ("   ", None), (None, None), ("nan", None), ("NULL", None), ("NA", None), ("None", None),
    ("1.5d", None), ("1.5f", None), ("abc", None), ("1.2.3", None),
])
def test_decimal_text(spark, raw, expected):
    got = spark.createDataFrame([(raw,)], "v string").select(parse_decimal(F.col("v"))).first()[0]
    assert got == expected


def test_garbage_survives_normalizing_but_not_the_cast(spark):
    row = spark.createDataFrame([("abc",)], "v string").select(normalize_decimal(F.col("v")), parse_decimal(F.col("v"))).first()
    assert tuple(row) == ("abc", None)


@pytest.fixture
def batch_dir(tmp_path):
    def put(name, lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")

    put("dataset_a_feats.csv.csv", [HEADER, *ROWS])
    put("dataset_a_target.csv.csv", ["﻿charges", "1121,87", "", "13270,42", "63770,43", "2000,5", "3000,25"])
    put("dataset_B_FEATS.CSV", [" Age ,BMI,sex,children,region", '20,"30,5",Male,1,Northeast', "abc,31.5, FEMALE ,2,nowhere"])
    put("dataset_c_feats.csv", [HEADER, *ROWS])
    put("dataset_c_target.csv", ["100.5", "200.5", "300.5"])
    put("unrelated.csv", ["x", "1"])
    parts = tmp_path / "dataset_d_feats.csv"
    parts.mkdir()
    (parts / "part-00000.csv").write_text("\n".join([HEADER, *ROWS[:2]]) + "\n")
    (parts / "part-00001.csv").write_text("\n".join([HEADER, *ROWS[2:]]) + "\n")
    (parts / "_SUCCESS").write_text("")
    return str(tmp_path)


def test_discovery_pairs_by_id(spark, batch_dir):
    found = {r.batch_id: (r.has_target, (r.target or "").split("/")[-1]) for r in discover_batches(spark, batch_dir).collect()}
    assert found == {"a": (True, "dataset_a_target.csv.csv"), "B": (False, ""), "c": (True, "dataset_c_target.csv"),
                     "d": (False, "")}


def test_discovery_fails_without_batches(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        discover_batches(spark, str(tmp_path / "absent"))
    (tmp_path / "other.csv").write_text("x\n")
    with pytest.raises(FileNotFoundError):
        discover_batches(spark, str(tmp_path))


def test_load_batches(spark, batch_dir):
    loaded = load_batches(spark, batch_dir, INSURANCE)
    rows = {}
    for r in loaded.rows.orderBy("batch_id", "row_index").collect():
        rows.setdefault(r.batch_id, []).append(r)
    assert [r.charges for r in rows["a"]] == [1121.87, 13270.42, 63770.43, 2000.5, 3000.25]
    assert [r.age for r in rows["a"]] == [19, 34, 47, 62, 28]
    assert [r.scored for r in rows["c"]] == [True, True, True, False, False]
    assert [r.age for r in rows["d"]] == [19, 34, 47, 62, 28] and [r.row_index for r in rows["d"]] == list(range(5))
    b = rows["B"]
    assert [(r.age, r.bmi, r.sex, r.region, r.unparsed) for r in b] == [
        (20.0, 30.5, "male", "northeast", []), (None, 31.5, "female", "nowhere", ["age"])]
    sizes = {r.batch_id: (r.n_features, r.n_target) for r in loaded.batches.collect()}
    assert sizes == {"a": (5, 5), "B": (2, None), "c": (5, 3), "d": (5, None)}
    present = {(r.batch_id, r.column) for r in loaded.columns.collect()}
    assert ("a", "smoker") in present and ("B", "smoker") not in present and ("B", "bmi") in present


def test_conventions(spark, batch_dir):
    rows, _ = index_rows(read_lines(spark, discover_batches(spark, batch_dir), batch_dir))
    assert {tuple(r) for r in target_conventions(rows).collect()} == {("a", "comma"), ("c", "dot")}


def test_positions_do_not_depend_on_the_splits(spark, tmp_path):
    n = 20_000
    (tmp_path / "dataset_x_feats.csv").write_text("age,sex,bmi,children,smoker,region\n" + "\n".join(
        f"{i},male,{i}.5,0,no,northeast" for i in range(n)) + "\n")
    (tmp_path / "dataset_x_target.csv").write_text("\n".join(f"{i},25" for i in range(n)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        rows = load_batches(spark, str(tmp_path), INSURANCE).rows
        bad = rows.where("age != row_index OR charges != age + 0.25 OR NOT scored").count()
        assert rows.count() == n and bad == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_nothing_is_lost_at_load(spark, tmp_path):
    """Two files with one id, an empty file, and records with line breaks inside quotes."""
    def put(name, text):
        (tmp_path / name).write_text(text, encoding="utf-8")

    rows = "".join(f"{r}\n" for r in ROWS)
    put("dataset_a_feats.csv", f"{HEADER}\n{rows}")
    put("dataset_a_feats.csv.csv", f"{HEADER}\n{ROWS[0]}\n")
    put("dataset_a_target.csv", "1.5\n2.5\n3.5\n4.5\n5.5\n")
    put("dataset_e_feats.csv", "")
    put("dataset_q_feats.csv", HEADER + '\n19,female,27.9,0,yes,"south\nwest"\n34,male,33.77,1,no,southeast\n'
        + '20,"fe\n\nmale",20.5,"2",no,"a ""b""\nc"\n47,female,23.164,3,no,northwest\n')
    put("dataset_q_target.csv", "1\n2\n3\n4\n")
    loaded = load_batches(spark, str(tmp_path), INSURANCE)
    sizes = {r.batch_id: (r.n_features, r.n_target) for r in loaded.batches.collect()}
    assert sizes == {"a@dataset_a_feats.csv": (5, 5), "a@dataset_a_feats.csv.csv": (1, 5), "e": (0, None), "q": (4, 4)}
    got = [(r.age, r.region, r.bmi, r.charges, list(r.unparsed)) for r in
           loaded.rows.where("batch_id = 'q'").orderBy("row_index").collect()]
    assert got == [(19.0, "south\nwest", 27.9, 1.0, []), (34.0, "southeast", 33.77, 2.0, []),
                   (20.0, 'a "b"\nc', 20.5, 3.0, []), (47.0, "northwest", 23.164, 4.0, [])]


def test_damaged_files_fail_their_batch_only(spark, tmp_path):
    """Gzip files cut short or with a broken byte, files in UTF-16, empty files, and whole gzip files with and without a last line end."""
    import gzip

    def packed(batch, kind, data, cut=None, broken=None):
        folder = tmp_path / f"dataset_{batch}_{kind}.csv"
        folder.mkdir()
        content = bytearray(gzip.compress(data.encode()))
        if broken is not None:
            content[broken] ^= 0xFF
        (folder / "part-0.csv.gz").write_bytes(bytes(content[:cut]))

    many = "\n".join([HEADER, *ROWS * 400])
    packed("whole", "feats", many + "\n")
    packed("open", "feats", many)
    packed("marked", "feats", "\ufeff" + many + "\r\n")
    packed("cut", "feats", many, cut=-9)
    packed("stub", "feats", many, cut=6)
    packed("broken", "feats", many, broken=60)
    packed("label", "feats", many)
    packed("label", "target", "\n".join(["1.5"] * 2000), cut=20)
    (tmp_path / "dataset_wide_feats.csv").write_bytes(many.encode("utf-16"))
    (tmp_path / "dataset_empty_feats.csv").write_text("")
    (tmp_path / "dataset_plain_feats.csv").write_text(many)
    loaded = load_batches(spark, str(tmp_path), INSURANCE)
    assert {r.batch_id: r.reason for r in loaded.failures.collect()} == {
        "cut": "damaged", "stub": "damaged", "broken": "damaged", "label": "damaged", "wide": "encoding"}
    sizes = {r.batch_id: r.n_features for r in loaded.batches.collect()}
    assert sizes == {"whole": 2000, "open": 2000, "marked": 2000, "plain": 2000, "cut": 0, "stub": 0, "broken": 0, "label": 0, "wide": 0, "empty": 0}
    assert {r.batch_id for r in loaded.rows.select("batch_id").distinct().collect()} == {"whole", "open", "marked", "plain"}


def test_retries_double_nothing(spark, tmp_path):
    """The same training file twice, also in another order and under another name, and a baseline saved twice."""
    from conftest import NOW, people

    from tidewatch.operators.baseline import build_baseline
    from tidewatch.sources.tables import ingest_training_csv, load_baseline, save_baseline

    lines = [f"{r},100.5" for r in ROWS]
    for name, body in (("a", lines), ("b", lines[::-1]), ("c", lines[:2])):
        (tmp_path / f"{name}.csv").write_text("\n".join([HEADER + ",charges", *body]) + "\n")
    table = str(tmp_path / "table")
    sizes = [ingest_training_csv(spark, str(tmp_path / f"{n}.csv"), INSURANCE, table).count() for n in ("a", "a", "b", "c", "c")]
    assert sizes == [5, 5, 5, 7, 7]
    rows = people(spark, 60, 4).withColumn("prediction", F.col("charges") + 1)
    for model in ("m1", "m2", "m1"):
        save_baseline(build_baseline(rows, rows, INSURANCE, model, NOW, 14), str(tmp_path / "baseline"))
    found = load_baseline(spark, str(tmp_path / "baseline"))
    assert {r.model_id for r in found.profile.select("model_id").distinct().collect()} == {"m1", "m2"}
    assert found.profile.groupBy("model_id", "series").count().where("count > 1").isEmpty()


def test_lines_are_neither_sorted_nor_shuffled_and_parsed_once(spark, batch_dir, monkeypatch):
    """Only lists of files, splits and headers are joined to the lines, as broadcasts whatever their estimated size."""
    plans, pin = [], batches.pinned

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return pin(df)

    monkeypatch.setattr(batches, "pinned", spy)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = discover_batches(spark, batch_dir)
        lines = read_lines(spark, found, batch_dir)
        rows, headers = index_rows(lines)
        features, _ = batches.parse_features(rows, headers, INSURANCE)
        assert "BroadcastHashJoin" in plans[0] and not any("SortAggregate" in p and "value" in p.split("SortAggregate")[1] for p in plans)
        assert "SortMergeJoin" not in rows.where("kind = 'target'")._jdf.queryExecution().executedPlan().toString().split("Union")[1].split("Window [")[0]
        plan = features._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_csv") <= 4  # rows and header, each in both branches of the union at most
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_shared_target_gives_each_batch_its_own_first_line(spark, tmp_path):
    """Two feature files with one id share the target's lines, and so their ids."""
    for place in ("a", "b"):
        (tmp_path / place).mkdir()
        (tmp_path / place / "dataset_x_feats.csv").write_text("age\n1\n2\n")
    (tmp_path / "a" / "dataset_x_target.csv").write_text("charges\n5\n6\n")
    rows, headers = index_rows(read_lines(spark, discover_batches(spark, str(tmp_path)), str(tmp_path)))
    assert rows.count() == 8 and headers.count() == 4
