"""From the business layer to a training set, and from captures to predictions."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields

import numpy as np
from pyspark.ml import Model, PipelineModel
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, types as T

from flowlab.functions.names import quoted
from flowlab.operators.clean import FillProfile, clean_headers
from flowlab.operators.discriminant import DiscriminantModel
from flowlab.operators.encode import IndexMapping
from flowlab.operators.models import score
from flowlab.operators.scale import MinMaxModel
from flowlab.plans.layers import (
    business_layer, layer_path, staging_rows, unlabelled, without_constants,
)
from flowlab.plans.settings import EtlSettings
from flowlab.sources.layers import read_layer, save_mapping, write_layer


def training_set(
    df: DataFrame,
    target: str = "Label_Index",
    categorical: Sequence[str] = ("Label_Index", "Source_Port", "Destination_Port"),
    components: int = 6,
    fit_on: DataFrame | None = None,
) -> tuple[DataFrame, MinMaxModel, DiscriminantModel]:
    """Scaled and reduced columns ``c0..`` with the target, and the two models behind them.

    The models are fitted on all rows, as the published figures were, or on ``fit_on`` to keep
    the held-out rows unseen.
    """
    fit_on = df if fit_on is None else fit_on
    scaler = MinMaxModel.fit(fit_on, categorical)
    reducer = DiscriminantModel.fit(scaler.transform(fit_on), target)
    return reducer.transform(scaler.transform(df), components), scaler, reducer


def run_training_set(
    spark: SparkSession, business_path: str, layers: str, settings: EtlSettings = EtlSettings()
) -> dict[str, str]:
    """Write the training set and the variance table of a business layer; returns their paths."""
    s = settings
    reduced, _, reducer = training_set(
        read_layer(spark, business_path), s.label_index, s.categorical, s.components
    )
    ratios = spark.createDataFrame(reducer.explained_variance(), "k int, ratio double")
    return {
        "training_set": write_layer(reduced, layer_path(layers, "training_set")),
        "variance_ratio": save_mapping(ratios.coalesce(1), layer_path(layers, "variance_ratio")),
    }


@dataclass(frozen=True)
class FlowPreparation:
    """Everything learnt from labelled flows that unlabelled flows need to be scored alike."""

    settings: EtlSettings
    profile: FillProfile
    mappings: Mapping[str, IndexMapping]
    scaler: MinMaxModel
    reducer: DiscriminantModel

    @classmethod
    def fit(cls, raw: DataFrame, settings: EtlSettings = EtlSettings()) -> tuple[FlowPreparation, DataFrame]:
        """Fit on a raw layer; returns the preparation and the training set."""
        s = settings
        rows = staging_rows(raw, s.filter_columns, s.staging_drop)
        profile = FillProfile.fit(rows, s.fill_max, s.drop_constants)
        staged = profile.transform(rows)
        s = without_constants(s, profile.constants)
        business, mappings = business_layer(staged, s.ip_columns, s.index_columns, s.ports, s.port_columns)
        reduced, scaler, reducer = training_set(business, s.label_index, s.categorical, s.components)
        return cls(s, profile, mappings, scaler, reducer), reduced

    @property
    def features(self) -> list[str]:
        return self.reducer.component_names(self.settings.components)

    def transform(self, captures: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Features ``c0..`` of unlabelled flows, with the ``keep`` columns (clean names) as ids.

        No row is filtered: every flow gets a prediction. Values unseen in training share the
        next free index.
        """
        s = unlabelled(self.settings)
        df = clean_headers(captures)
        dropped = [c for c in s.staging_drop if c not in keep]
        staged = self.profile.transform(df.drop(*dropped, *s.raw_drop))
        encoded, _ = business_layer(
            staged, s.ip_columns, s.index_columns, s.ports, s.port_columns, self.mappings, "keep"
        )
        reduced = self.reducer.transform(self.scaler.transform(encoded), self.settings.components)
        return reduced.select(*self.features, *[quoted(c) for c in keep])

    def save(self, spark: SparkSession, path: str) -> str:
        """Write everything learnt below ``path``: value indexes as Parquet, the rest as one line of JSON."""
        s = {f.name: getattr(self.settings, f.name) for f in fields(EtlSettings) if f.name != "schema"}
        s["schema"] = self.settings.schema and self.settings.schema.json()
        state = {
            "settings": s, "tops": self.profile.tops, "constants": self.profile.constants,
            "ranges": self.scaler.ranges, "mappings": {c: m.small for c, m in self.mappings.items()},
            "reducer": {
                "features": self.reducer.features, "target": self.reducer.target, "centre": self.reducer.centre.tolist(),
                "axes": self.reducer.axes.tolist(), "ratios": self.reducer.ratios.tolist(),
            },
        }
        for number, mapping in enumerate(self.mappings.values()):
            write_layer(mapping.table, layer_path(path, f"mapping_{number}"))
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(layer_path(path, "state"))
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FlowPreparation:
        state = json.loads(spark.read.text(layer_path(path, "state")).first()[0])
        s, r = dict(state["settings"]), state["reducer"]
        s["schema"] = s["schema"] and T.StructType.fromJson(json.loads(s["schema"]))
        s["index_columns"] = tuple(map(tuple, s["index_columns"]))
        mappings = {
            c: IndexMapping(read_layer(spark, layer_path(path, f"mapping_{number}")), small)
            for number, (c, small) in enumerate(state["mappings"].items())
        }
        reducer = DiscriminantModel(
            r["features"], r["target"], np.array(r["centre"]), np.array(r["axes"]), np.array(r["ratios"])
        )
        scaler = MinMaxModel({c: tuple(ends) for c, ends in state["ranges"].items()})
        return cls(EtlSettings(**s), FillProfile(state["tops"], state["constants"]), mappings, scaler, reducer)

    def predict(self, model: Model, captures: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return score(model, self.transform(captures, keep))

    def scorer(self, model: PipelineModel, keep: Sequence[str] = ()) -> PipelineModel:
        """Preparation and classifier as one pipeline, which is saved, loaded and applied to captures as a whole."""
        return PipelineModel([FlowFeatures(self, keep), *model.stages])


class FlowFeatures(Model, MLReadable, MLWritable):
    """Pipeline stage: unlabelled captures to the features of a ``FlowPreparation``, with the ``keep`` columns as ids."""

    def __init__(self, preparation: FlowPreparation | None = None, keep: Sequence[str] = ()):
        super().__init__()
        self.preparation, self.keep = preparation, list(keep)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.preparation.transform(dataset, self.keep)

    def write(self) -> MLWriter:
        return FlowFeaturesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return FlowFeaturesReader()


class FlowFeaturesWriter(MLWriter):
    def __init__(self, stage: FlowFeatures):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"keep": self.stage.keep})
        self.stage.preparation.save(self.sparkSession, layer_path(path, "preparation"))


class FlowFeaturesReader(MLReader):
    def load(self, path: str) -> FlowFeatures:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = FlowFeatures(FlowPreparation.load(self.sparkSession, layer_path(path, "preparation")), metadata["keep"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage
