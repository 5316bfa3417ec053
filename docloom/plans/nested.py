"""Models of models that are saved with the models they hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F


class NestedWriter(MLWriter):
    """Writes ``state`` as metadata and every inner model to a folder of its own."""

    def __init__(self, instance: NestedModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        inner = self.instance.inner()
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"state": self.instance.state(), "inner": list(inner)})
        for name, model in inner.items():
            model.write().save(f"{path}/inner/{name}")


class NestedReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        inner = {name: DefaultParamsReader.loadParamsInstance(f"{path}/inner/{name}", self.sparkSession) for name in metadata["inner"]}
        model = self.kind.restored(metadata["state"], inner)
        model._resetUid(metadata["uid"])
        return model


class NestedModel(Model, MLReadable, MLWritable):
    """A model of models. Subclasses give their inner models, the rest of their state as JSON values, and build themselves from both."""

    def inner(self) -> dict[str, Model]:
        raise NotImplementedError

    def state(self) -> dict:
        raise NotImplementedError

    @classmethod
    def restored(cls, state: dict, inner: dict[str, Model]) -> NestedModel:
        raise NotImplementedError

    def write(self) -> NestedWriter:
        return NestedWriter(self)

    @classmethod
    def read(cls) -> NestedReader:
        return NestedReader(cls)


def with_prediction(df: DataFrame, columns: Sequence[str], probability: str = "_p") -> DataFrame:
    """``columns`` with the array ``probability`` as vector and its first maximum as prediction."""
    best = F.array_position(probability, F.array_max(probability)).cast("double") - 1
    return df.select(*columns, array_to_vector(probability).alias("probability"), best.alias("prediction"))
