"""Model save / load by name and version; S12: predictions sink."""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from cairn.sources.registry import _append_registry, _last, _p, registry, resolve_version
from cairn.sources.tables import write_table


def save_model(model: PipelineModel, root: str, name: str, version: str, desc: str = "") -> str:
    """Persist a ``PipelineModel`` in a folder of its own and then register it: a save that fails, or one of the same
    version, leaves the published files as they are."""
    spark = SparkSession.getActiveSession()
    path = _p(root, "models", quote(name, safe=""), f"{quote(version, safe='')}-{uuid.uuid4().hex[:12]}")
    model.write().save(path)
    _append_registry(spark, root, ("model", name, version, None, [], None, desc, None, path))
    return path


def load_model(spark: SparkSession, root: str, name: str, version: str | None = "latest") -> PipelineModel:
    """The last model registered under the version; an unknown one raises ``KeyError``."""
    reg = registry(spark, root)
    v = resolve_version(reg, name, version, "model")
    rows = reg.where((F.col("kind") == "model") & (F.col("name") == name) & (F.col("version") == v))
    path = rows.agg(_last("path").alias("path")).first()["path"]
    if path is None:
        raise KeyError(f"model '{name}' has no version '{v}'")
    return PipelineModel.load(path)


def write_predictions(pred: DataFrame, path: str, fmt: str = "parquet") -> str:
    """The predictions table (see E12) written as a table."""
    return write_table(pred, path, fmt)
