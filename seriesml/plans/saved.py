"""Fitted runs on disk, by model id: everything inference needs, for every method, in one folder.

`<root>/<model id>/fitted` is a JSON object of names, settings and scalers, and of what each method keeps as numbers;
`model_<method>/<step>` are MLlib models; `neighbours_<method>` the training rows of a neighbour search; `classes` and `metrics`
are tables. The samples of the fit are not kept: a loaded run transforms, it is not explained or refitted.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, replace
from typing import Any

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesml.config import Config
from seriesml.operators import discriminant, encode, neighbours, scale
from seriesml.plans.lifecycle import ArrayPredictor, Fitted, NeighbourPredictor, Predictor, VectorPredictor
from seriesml.session import materialise
from seriesml.sources.sinks import FeatureCatalogue, _load_object, _save_object, model_path


def _lists(values: Mapping[str, Any]) -> dict:
    return {k: [np.asarray(x).tolist() for x in v] if isinstance(v, tuple) else np.asarray(v).tolist() for k, v in values.items()}


def _save_predictor(predictor: Predictor, root: str, model_id: str, method: str) -> dict:
    path = model_path(root, model_id, method)
    if isinstance(predictor, VectorPredictor):
        for i, model in enumerate(predictor.models):
            model.write().overwrite().save(f"{path}/{i}")
        return {"kind": "vector", "steps": len(predictor.models)}
    if isinstance(predictor, ArrayPredictor) and isinstance(predictor.model, discriminant.LinearDiscriminant):
        return {"kind": "linear", **_lists(vars(predictor.model))}
    if isinstance(predictor, ArrayPredictor) and isinstance(predictor.model, discriminant.QuadraticDiscriminant):
        return {"kind": "quadratic", **_lists(vars(predictor.model))}
    if isinstance(predictor, NeighbourPredictor):
        m = predictor.model
        m.table.write.mode("overwrite").parquet(f"{path}/rows")
        return {"kind": "neighbours", "classification": predictor.classification, "keys": list(predictor.keys), "k": predictor.k, "weights": predictor.weights,
                "model": {"id": m.id, "k": m.k, "block": m.block, **_lists({"pivots": m.pivots, "radius": m.radius, "rows": m.rows})}}
    raise TypeError(f"{type(predictor).__name__} cannot be saved")


def _load_predictor(spark: SparkSession, said: Mapping[str, Any], root: str, model_id: str, method: str) -> Predictor:
    path, kind = model_path(root, model_id, method), said["kind"]
    if kind == "vector":
        return VectorPredictor(tuple(PipelineModel.load(f"{path}/{i}") for i in range(said["steps"])))
    if kind == "linear":
        return ArrayPredictor(discriminant.LinearDiscriminant(tuple(said["classes"]), np.array(said["coef"]), np.array(said["intercept"])))
    if kind == "quadratic":
        return ArrayPredictor(discriminant.QuadraticDiscriminant(
            tuple(said["classes"]), np.array(said["means"]), tuple(np.array(r) for r in said["roots"]), np.array(said["constants"])))
    m = said["model"]
    model = neighbours.NeighbourModel(spark.read.parquet(f"{path}/rows"), m["id"], m["k"], np.array(m["pivots"]), np.array(m["radius"]),
                                      np.array(m["rows"], dtype="int64"), m["block"])
    return NeighbourPredictor(model, said["classification"], tuple(said["keys"]), said["k"], said["weights"])


def save_fitted(fitted: Fitted, spark: SparkSession, root: str, model_id: str) -> str:
    """Write the run under `<root>/<model_id>`; the JSON object comes last, so a folder that has it is whole."""
    folder = f"{root.rstrip('/')}/{model_id}"
    encoding = fitted.encoding
    if encoding is not None:
        classes = encoding.table if encoding.table is not None else spark.createDataFrame(
            [(c, i) for i, c in enumerate(encoding.classes)], [encoding.column, "_code"])
        classes.select(encoding.column, F.col("_code").cast("int").alias("_code")).write.mode("overwrite").parquet(f"{folder}/classes")
    if fitted.metrics is not None:
        fitted.metrics.write.mode("overwrite").parquet(f"{folder}/metrics")
    sections = {k: v for k, v in asdict(fitted.config).items() if k != "unused"}
    said = {
        "config": sections, "unused": list(fitted.config.unused), "series": list(fitted.series), "order": list(fitted.order),
        "catalogue": asdict(fitted.catalogue), "raw_inputs": list(fitted.raw_inputs),
        "encoding": encoding and {"column": encoding.column, "as_table": encoding.table is not None},
        "input_scaler": asdict(fitted.input_scaler), "target_scaler": asdict(fitted.target_scaler), "has_metrics": fitted.metrics is not None,
        "predictors": {m: _save_predictor(p, root, model_id, m) for m, p in fitted.predictors.items()}}
    _save_object(spark, said, f"{folder}/fitted")
    return folder


def load_fitted(spark: SparkSession, root: str, model_id: str) -> Fitted:
    """The run as it was saved, in this session or another one."""
    folder = f"{root.rstrip('/')}/{model_id}"
    said = _load_object(spark, f"{folder}/fitted")
    encoding = None
    if said["encoding"]:
        column, table = said["encoding"]["column"], spark.read.parquet(f"{folder}/classes")
        encoding = (encode.LabelEncoding(column, table=table) if said["encoding"]["as_table"]
                    else encode.LabelEncoding(column, tuple(r[0] for r in table.orderBy("_code").collect())))
    config = replace(Config.from_mapping(said["config"]), unused=tuple(said["unused"]))
    return Fitted(
        config, tuple(said["series"]), tuple(said["order"]), FeatureCatalogue(**{k: tuple(v) for k, v in said["catalogue"].items()}), tuple(said["raw_inputs"]),
        encoding, scale.Scaler(**said["input_scaler"]), scale.Scaler(**said["target_scaler"]),
        {m: _load_predictor(spark, p, root, model_id, m) for m, p in said["predictors"].items()},
        spark.read.parquet(f"{folder}/metrics") if said["has_metrics"] else None)


def predict_saved(spark: SparkSession, root: str, requests: DataFrame, model_col: str = "model_id") -> DataFrame:
    """(model id, series, sample, method, y_pred) of rows that name their saved model; one transform for each model asked for.

    The models named are found first: as many names as models are asked for reach the driver.
    """
    asked = materialise(requests, "requests")
    names = sorted(r[0] for r in asked.select(model_col).distinct().collect() if r[0] is not None)
    out = None
    for name in names:
        rows = asked.filter(F.col(model_col) == name).drop(model_col)
        made = load_fitted(spark, root, name).transform(rows).withColumn(model_col, F.lit(name))
        out = made if out is None else out.unionByName(made)
    if out is None:
        raise ValueError("no row names a model")
    return out
