import json

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from seriesml.operators import emissions, learners
from seriesml.operators.learners import REGRESSION
from seriesml.operators.scale import fit_scaler
from seriesml.sources import payloads, readers, registry, sinks


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "02.csv").write_text("a,b\n1,x\n2,y\n")
    (tmp_path / "01.csv").write_text("a,b,c\n5,z,0.5\n4,z,\n3,w,NaN\n")
    (tmp_path / "03.csv").write_text("")
    (tmp_path / "notes.txt").write_text("a\n1\n")
    return str(tmp_path)


def test_csv_folder_by_name(spark, folder):
    df = readers.read_csv_folder(spark, folder)
    rows = df.orderBy("series_id", "ord_block", "ord").collect()
    assert [(r["series_id"], r["a"], r["b"], r["c"]) for r in rows] == [
        ("01", 5, "z", 0.5), ("01", 4, "z", None), ("01", 3, "w", None), ("02", 1, "x", None), ("02", 2, "y", None)]


def test_csv_folder_with_schema_is_one_scan(spark, tmp_path):
    for n in ("a", "b"):
        (tmp_path / f"{n}.csv").write_text("t,v\n2,1.5\n1,2.5\n")
    df = readers.read_csv_folder(spark, str(tmp_path), "t int, v double", ["t"])
    assert [tuple(r) for r in df.orderBy("series_id", "t").collect()] == [("a", 1, 2.5), ("a", 2, 1.5), ("b", 1, 2.5), ("b", 2, 1.5)]


def test_malformed_row_and_missing_folder(spark, tmp_path):
    (tmp_path / "x.csv").write_text("t,v\n1,word\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        readers.read_csv_folder(spark, str(tmp_path), "t int, v double", ["t"]).collect()
    with pytest.raises(FileNotFoundError):
        readers.read_csv_folder(spark, str(tmp_path / "nowhere"))
    (tmp_path / "e").mkdir()
    with pytest.raises(FileNotFoundError):
        readers.read_csv_folder(spark, str(tmp_path / "e"))


def test_table_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, [1.0, 2.0]), ("b", 2.0, [3.0, 4.0])], "s string, v double, x array<double>")
    sinks.write_table(df, str(tmp_path / "one"))
    sinks.write_table(df, str(tmp_path / "each"), ["s"])
    assert (tmp_path / "each" / "s=a").is_dir()
    for name in ("one", "each"):
        assert spark.read.parquet(str(tmp_path / name)).select("s", "v", "x").orderBy("s").collect() == df.orderBy("s").collect()
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    sinks.write_csv(df.drop("x"), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["s", "v"]


def test_catalogue_scaler_and_model_round_trip(spark, tmp_path):
    cat = sinks.FeatureCatalogue(("y",), ("b", "a"), ("z",))
    sinks.save_catalogue(spark, cat, str(tmp_path / "cat"))
    assert sinks.load_catalogue(spark, str(tmp_path / "cat")) == cat
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (4.0, 9.5)], "a double, label double")
    fitted = fit_scaler(df, ["a"], "standard")
    sinks.save_scaler(spark, fitted, str(tmp_path / "scaler"))
    assert sinks.load_scaler(spark, str(tmp_path / "scaler")) == fitted
    data = learners.with_vector(df, ["a"])
    model = learners.fit(data, "dt", REGRESSION)
    assert isinstance(model, PipelineModel)
    sinks.save_model(model, str(tmp_path / "models"), "m1", "dt")
    again = sinks.load_model(str(tmp_path / "models"), "m1", "dt")
    assert learners.predict(data, again).collect() == learners.predict(data, model).collect()


def test_emissions_log(spark, tmp_path):
    head = "timestamp,project_name,duration,emissions,energy_consumed,cpu_energy,ram_energy,emissions_rate\n"
    (tmp_path / "log.csv").write_text(head + "2024-01-01T10:00:00,train,120,0.5,1,1,1,1\n2024-01-01T09:00:00,train,60,0.7,1,1,1,1\n"
                                      "2024-01-01T08:00:00,clean,30,0.1,1,1,1,1\n")
    log = emissions.parse_log(readers.read_emissions_log(spark, str(tmp_path / "log.csv")))
    totals = {r["project_name"]: r["duration"] for r in emissions.stage_totals(log).collect()}
    assert totals == {"train": 3.0, "clean": 0.5}
    run = emissions.full_run(log, ["emissions"]).first()
    assert abs(run["emissions"] - 0.7) < 1e-12 and abs(run["emissions_std"] - 0.1 * 2 ** 0.5) < 1e-12
    assert [r["emissions"] for r in emissions.over_time(log).collect()] == [0.1, 0.7, 0.5]


def test_payload_round_trip(spark):
    text = json.dumps({"param": {"modeluid": "7"}, "scalar": {"headers": ["date", "b", "a"], "data": [["d0", 2.5, 1], ["d1", None, 3]]}})
    got = payloads.decode_requests(spark.createDataFrame([(text,)], "p string"), "p", ["a", "b", "c"]).orderBy("row").collect()
    assert [tuple(r) for r in got] == [("7", 0, "d0", 1.0, 2.5, None), ("7", 1, "d1", 3.0, None, None)]
    df = spark.createDataFrame([("m", i, i * 0.5) for i in (2, 0, 1)], "id string, i int, y double")
    out = payloads.encode_responses(df, "id", "i", "y", "target", part_rows=2).orderBy("part").collect()
    assert [json.loads(r["response"])["scalar"]["data"] for r in out] == [[[0.0, 0.0], [1.0, 0.5]], [[2.0, 1.0]]]
    assert json.loads(out[0]["response"])["scalar"]["headers"] == ["date", "target"]


def test_registry_appends(spark, tmp_path):
    path = str(tmp_path / "models")
    params = {"profile": {"dataset": "mill"}, "clean": {"target": "y"}, "train": {"learning_method": "rf"}, "sequentialize": {"window_size": 3}}
    registry.register_model(spark, path, "m1", params, {"r2": 0.9}, [(f"f{i}", float(i)) for i in range(20)])
    registry.register_model(spark, path, "m2", params, {"r2": 0.8, "mse": 1})
    table = registry.read_registry(spark, path)
    row = registry.find_model(table, "m1").first()
    assert [i["feature"] for i in row["importances"]] == [f"f{i}" for i in range(19, 9, -1)]
    listed = {(r["model_id"], r["metric"]): (r["dataset"], r["method"], r["window_size"], r["top_feature"], r["score"])
              for r in registry.overview(table).collect()}
    assert listed == {("m1", "r2"): ("mill", "rf", 3, "f19", 0.9), ("m2", "r2"): ("mill", "rf", 3, None, 0.8),
                      ("m2", "mse"): ("mill", "rf", 3, None, 1.0)}
    assert table.filter(F.col("model_id") == "m2").count() == 1
