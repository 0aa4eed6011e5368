"""Fitted stages that persist like native Spark ML stages.

A stage keeps scalars in ``state`` (stored as JSON metadata) and keyed tables in
``lookups`` (stored as Parquet), so it can sit inside a ``pyspark.ml.PipelineModel``
next to native stages and be saved and loaded with it.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasSeed
from pyspark.ml.util import (
    DefaultParamsReader,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)

from ..functions.lookups import Lookup, settle


class FoldParams(HasLabelCol, HasSeed):
    """Parameters of estimators that deal rows into folds by their ids; grids and ``copy`` can change them."""

    numFolds = Param(Params._dummy(), "numFolds", "parts that the rows are dealt into", TypeConverters.toInt)
    idCols = Param(Params._dummy(), "idCols", "columns that name a row", TypeConverters.toListString)

    @property
    def label(self) -> str:
        return self.getLabelCol()

    @property
    def id_cols(self) -> list[str]:
        return self.getOrDefault(self.idCols)

    @property
    def folds(self) -> int:
        return self.getOrDefault(self.numFolds)


class _StageWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path):
        weights = {name: lookup.weight for name, lookup in self.stage.lookups.items()}
        DefaultParamsWriter.saveMetadata(
            self.stage, path, self.sparkSession, extraMetadata={"state": self.stage.state, "lookups": weights}
        )
        for name, lookup in self.stage.lookups.items():
            lookup.table.write.parquet(f"{path}/lookups/{name}")


class _StageReader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind.__new__(self.kind)
        FittedStage.__init__(stage, metadata["state"])
        stage._resetUid(metadata["uid"])
        for name, weight in metadata["lookups"].items():
            table = self.sparkSession.read.parquet(f"{path}/lookups/{name}")
            stage.lookups[name] = settle(table, weight)
        return stage


class FittedStage(Model, MLReadable, MLWritable):
    """Base of all fitted stages here."""

    def __init__(self, state: dict, lookups: dict[str, Lookup] | None = None):
        super().__init__()
        self.state = state
        self.lookups = dict(lookups or {})

    def write(self):
        return _StageWriter(self)

    @classmethod
    def read(cls):
        return _StageReader(cls)
