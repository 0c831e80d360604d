"""The training job of one log type: from stored vectors to a model row."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import stored
from . import anomaly, batches, registry

LEAST_ROWS = 10


@dataclass
class Trained:
    log_type: str
    fit: DataFrame
    model: anomaly.LinearAutoencoder
    threshold: float
    basis: str
    rows: int
    timesteps: int = batches.TIMESTEPS


def train_job(store: DataFrame, log_type: str, sigma: float = 3.0, timesteps: int = batches.TIMESTEPS, components: int = 16) -> Trained | None:
    """Loads a type's vectors, cuts windows, splits by time, scales on the training part, fits a linear autoencoder and sets
    the threshold on held-out windows. None if there are fewer than ten rows. run_training() does the whole job."""
    rows = store.filter(F.col("log_type") == log_type).select("id", "features")
    n = rows.count()
    if n < max(LEAST_ROWS, timesteps):
        return None
    split = stored(batches.chrono_split(batches.train_windows(rows, [], ["id"], timesteps=timesteps), [], timesteps=timesteps), "windows")
    fit = anomaly.minmax_fit(split.filter("split = 'train'"))
    scaled = split.withColumn("row", F.col("place")).select("row", "split", F.posexplode("window").alias("step", "features"))
    scaled = anomaly.minmax_apply_fit(scaled, fit)
    windows = stored(scaled.groupBy("row", "split").agg(F.transform(F.sort_array(F.collect_list(F.struct("step", "features"))), lambda s: s["features"]).alias("window")), "scaled-windows")
    model = anomaly.LinearAutoencoder.fit(windows.filter("split = 'train'"), k=components)
    rebuilt = anomaly.reconstruct(windows, model)
    mae, _ = anomaly.window_error(F.col("window"), F.col("rebuilt"))
    found = anomaly.static_threshold(rebuilt.select("split", mae.alias("mae")), sigma).first()
    return Trained(log_type, fit, model, found.threshold, found.basis, n, timesteps)


#: A model's table: scaler (a row for each feature: its low and its range), mean, axes (a row for each value of a window), limit.
MODEL = "log_type string, part string, i int, x array<double>, basis string, rows long"


def save_model(trained: Trained, path: str) -> None:
    """Writes the scaler, the mean and axes of the autoencoder and the threshold as a Parquet table; its size is bounded by the
    width of a window. What was there is replaced."""
    spark = trained.fit.sparkSession
    same = (trained.basis, trained.rows)
    scaler = trained.fit.select(F.lit(trained.log_type).alias("log_type"), F.lit("scaler").alias("part"), F.col("i").cast("int").alias("i"), F.array("low", "range").alias("x"), F.lit(trained.basis).alias("basis"), F.lit(trained.rows).cast("long").alias("rows"))
    arrays = [("mean", 0, trained.model.mean.tolist()), *[("axes", i, row) for i, row in enumerate(trained.model.axes.tolist())], ("limit", trained.timesteps, [float(trained.threshold)])]
    rest = spark.createDataFrame([(trained.log_type, part, i, x, *same) for part, i, x in arrays], MODEL)
    scaler.unionByName(rest).coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> Trained:
    """The model that save_model() wrote. ValueError if parts of it are missing."""
    table = spark.read.schema(MODEL).parquet(path)
    fit = stored(table.filter("part = 'scaler'").select("i", F.col("x")[0].alias("low"), F.col("x")[1].alias("range")), "scaler")
    parts = {}
    for r in table.filter("part <> 'scaler'").orderBy("part", "i").collect():  # as many as a window has values
        parts.setdefault(r.part, []).append(r)
    if set(parts) != {"mean", "axes", "limit"} or len(parts["axes"]) != len(parts["mean"][0].x):
        raise ValueError(f"no whole model lies at {path}")
    limit = parts["limit"][0]
    model = anomaly.LinearAutoencoder(np.array(parts["mean"][0].x), np.array([r.x for r in parts["axes"]]))
    return Trained(limit.log_type, fit, model, limit.x[0], limit.basis, limit.rows, limit.i)


def load_latest(models: DataFrame, log_type: str) -> Trained | None:
    """The model of a type's newest row, from where the row says it lies; None where the type has no row."""
    newest = batches.latest_model(models.filter(F.col("log_type") == log_type)).select("model_path").first()
    return load_model(models.sparkSession, newest.model_path) if newest else None


def score_rows(rows: DataFrame, trained: Trained, keys: list[str], order: list[str], vector: str = "features") -> DataFrame:
    """rows that end a window of the model's length within their keys, with place, mae and is_anomaly: scaled by the model's
    scaler, rebuilt, and held against its threshold."""
    scaled = anomaly.minmax_apply_fit(rows, trained.fit, vector)
    windows = batches.train_windows(scaled, keys, order, vector, trained.timesteps)
    mae, _ = anomaly.window_error(F.col("window"), F.col("rebuilt"))
    found = anomaly.reconstruct(windows, trained.model).withColumn("mae", mae)
    return found.withColumn("is_anomaly", F.col("mae") >= F.lit(float(trained.threshold))).drop("window", "rebuilt")


@dataclass
class Registry:
    """The tables that a training job reads and replaces."""

    store: DataFrame
    models: DataFrame
    totals: DataFrame


def run_training(tables: Registry, log_type: str, model_path: str, created_at: datetime, **options) -> tuple[Trained | None, Registry]:
    """The whole job of one type: trains, saves the model at model_path and then its row, adds the rows to the type's total and
    clears its store. With too few rows nothing is trained and all tables stay. The tables given back replace the old ones
    once they are written; a model without a row is one whose job didn't end."""
    found = train_job(tables.store, log_type, **options)
    if found is None:
        return None, tables
    spark = tables.store.sparkSession
    save_model(found, model_path)
    row = spark.createDataFrame([(log_type, model_path, created_at, found.threshold, len(found.model.mean) // found.timesteps, found.timesteps, found.rows)], "log_type string, model_path string, created_at timestamp, anomaly_threshold double, input_dim int, timesteps int, training_samples long")
    added = spark.createDataFrame([(log_type, found.rows)], "log_type string, count long")
    return found, Registry(registry.clear_type(tables.store, log_type), registry.save_model_row(tables.models, row), registry.add_total_rows(tables.totals, added))
