"""Attack classification as one Spark ML pipeline, from labelled columns to class probabilities, that is saved and loaded whole."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import attack


class _Columns(Params):
    columns = Param(Params._dummy(), "columns", "the columns that the stage reads", TypeConverters.toListString)


class FeatureMaker(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """attack.engineer_features as a stage."""

    def _transform(self, rows: DataFrame) -> DataFrame:
        return attack.engineer_features(rows)


class LabelCoder(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the sorted distinct values of columns, which are few."""

    @keyword_only
    def __init__(self, columns=("proto", "service", "state")):
        super().__init__()
        self._set(columns=list(columns))

    def _fit(self, rows: DataFrame) -> LabelCoderModel:
        names = self.getOrDefault("columns")
        return LabelCoderModel(columns=names, values=[[r[0] for r in attack.label_codes(rows, n).orderBy("code").collect()] for n in names])


class LabelCoderModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Columns as codes of what was learned, from 0; -1 for null and unknown values."""

    values = Param(Params._dummy(), "values", "for each column its values in order of their codes")

    @keyword_only
    def __init__(self, columns=(), values=()):
        super().__init__()
        self._set(columns=list(columns), values=[list(v) for v in values])

    def code(self, name: str) -> Column:
        values = self.getOrDefault("values")[self.getOrDefault("columns").index(name)]
        known = F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")
        return F.coalesce(F.array_position(known, F.col(name)) - 1, F.lit(-1)).cast("double")

    def _transform(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({n: self.code(n) for n in self.getOrDefault("columns")})


class Standardizer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns mean and population deviation of columns in one pass."""

    @keyword_only
    def __init__(self, columns=()):
        super().__init__()
        self._set(columns=list(columns))

    def _fit(self, rows: DataFrame) -> StandardizerModel:
        names = self.getOrDefault("columns")
        one = attack.standard_fit(rows, names).first() if names else {}
        return StandardizerModel(columns=names, means=[one[f"mean_{n}"] or 0.0 for n in names], deviations=[one[f"std_{n}"] or 1.0 for n in names])


class StandardizerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Columns less their mean, over their deviation (over 1 where that was 0)."""

    means = Param(Params._dummy(), "means", "the mean of each column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "what each column is divided by", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, columns=(), means=(), deviations=()):
        super().__init__()
        self._set(columns=list(columns), means=list(means), deviations=list(deviations))

    def _transform(self, rows: DataFrame) -> DataFrame:
        of = zip(self.getOrDefault("columns"), self.getOrDefault("means"), self.getOrDefault("deviations"), strict=True)
        return rows.withColumns({n: (F.col(n).cast("double") - m) / d for n, m, d in of})


class FeatureVector(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Columns as one vector `features`, nulls as 0."""

    @keyword_only
    def __init__(self, columns=()):
        super().__init__()
        self._set(columns=list(columns))

    def _transform(self, rows: DataFrame) -> DataFrame:
        return attack._vectors(rows, self.getOrDefault("columns"))


def attack_pipeline(features: list[str], coded: tuple[str, ...] = ("proto", "service", "state"), scaled: tuple[str, ...] = (), label: str = "y", weight: str = "weight", trees: int = 40, depth: int = 8) -> Pipeline:
    """The stages from labelled columns to a weighted forest: derived features, codes, scaling, one vector, classes."""
    forest = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol=weight, numTrees=trees, maxDepth=depth, seed=42)
    return Pipeline(stages=[FeatureMaker(), LabelCoder(columns=list(coded)), Standardizer(columns=list(scaled)), FeatureVector(columns=features), forest])


def predict_with(pipeline: PipelineModel, rows: DataFrame, out: str = "probabilities") -> DataFrame:
    """rows as the pipeline's stages leave them, with the probability of each class in order of its number."""
    return pipeline.transform(rows).withColumn(out, vector_to_array("probability")).drop("features", "rawPrediction", "probability", "prediction")
