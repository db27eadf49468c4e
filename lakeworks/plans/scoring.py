"""Persist a fitted Spark ML pipeline, load it back and score a table with it (H1).

Python-object models are scored with ``mapInPandas`` (Arrow batches, one model load per task).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def save_model(model: PipelineModel, path: str, overwrite: bool = True) -> str:
    w = model.write()
    if overwrite:
        w = w.overwrite()
    w.save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def batch_score(path: str, df: DataFrame, keep: Sequence[str] = (), outputs: Sequence[str] = ("prediction",)) -> DataFrame:
    """Score ``df`` with the pipeline stored at ``path``; keep chosen input columns + outputs."""
    scored = load_model(path).transform(df)
    return scored.select(*keep, *outputs)


def score_with_python_model(
    df: DataFrame, load: Callable[[], object], features: Sequence[str], output_type: T.DataType = T.DoubleType()
) -> DataFrame:
    """Score with a Python model object (``load()`` returns something with ``predict(pandas)``)."""
    cols = list(features)
    schema = T.StructType([*df.schema.fields, T.StructField("prediction", output_type)])

    def run(batches):
        model = load()
        for pdf in batches:
            pdf = pdf.copy()
            pdf["prediction"] = model.predict(pdf[cols])
            yield pdf

    return df.mapInPandas(run, schema)
