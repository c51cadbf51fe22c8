"""Fitted models that can be written and read, alone or as stages of a pipeline, with the models inside them."""

from __future__ import annotations

import json

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter


class StoredModel(Model, MLWritable, MLReadable):
    """A model made of plain values (``content``) and of other models (``members``).

    Subclasses take both in their constructor. The values are written as one row of JSON per entry of
    ``content`` and every member by its own writer, so members may be of any kind.
    """

    def __init__(self, content: dict, members: dict[str, Model] | None = None):
        super().__init__()
        self.content, self.members = content, dict(members or {})

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance: StoredModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark, model = self.sparkSession, self.instance
        names = sorted(model.members)
        DefaultParamsWriter.saveMetadata(model, path, spark, extraMetadata={"members": names})
        rows = [(name, json.dumps(value)) for name, value in model.content.items()]
        spark.createDataFrame(rows, "name string, value string").coalesce(1).write.parquet(f"{path}/content")
        for i, name in enumerate(names):
            model.members[name].write().save(f"{path}/members/{i}")


class _Reader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> StoredModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        content = {r["name"]: json.loads(r["value"]) for r in spark.read.parquet(f"{path}/content").collect()}
        members = {name: DefaultParamsReader.loadParamsInstance(f"{path}/members/{i}", spark) for i, name in enumerate(metadata["members"])}
        model = self.kind(content, members)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
