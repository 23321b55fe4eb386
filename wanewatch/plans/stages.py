"""Feature operators as pipeline stages; what they fit is a table of its own.

``Hashing`` needs no fitting. ``Embedding``, ``LabelCodes`` and ``TargetBins`` fit a table
(vocabulary or edges) that is written next to the stage's settings and read again with it, so a
vocabulary never has to pass through the driver or into a settings file.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanewatch.functions import scalars
from wanewatch.operators import binning, features
from wanewatch.session import lookup_join


def _whole(name: str, doc: str):
    return Param(Params._dummy(), name, doc, typeConverter=TypeConverters.toInt)


class _Settings(HasInputCol, HasOutputCol):
    """Input and output column, the output named after the input if not given."""

    suffix = "out"

    def output(self) -> str:
        if self.isSet(self.outputCol):
            return self.getOutputCol()
        return f"{self.getInputCol()}_{self.suffix}"


class TableWriter(MLWriter):
    def __init__(self, instance: TableModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.mode("overwrite").parquet(f"{path}/table")


class TableReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> TableModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        made = self.kind()
        made._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(made, metadata)
        made.table = self.sparkSession.read.parquet(f"{path}/table")
        return made


class TableModel(Model, _Settings, MLWritable, MLReadable):
    """A fitted stage whose state is ``table``."""

    table: DataFrame

    def write(self) -> TableWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> TableReader:
        return TableReader(cls)

    def copy(self, extra=None) -> TableModel:
        made = super().copy(extra)
        made.table = self.table
        return made


class Hashing(Transformer, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """``width`` numbers per value: the sign of the value at its bucket; unseen values have one, too."""

    suffix = "hash"
    width = _whole("width", "buckets")

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, width=256):
        super().__init__()
        self._setDefault(width=256)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        column = self.getInputCol()
        made = features.hash_encode(dataset, column, self.getOrDefault(self.width))
        return made.withColumnRenamed(f"{column}_hash", self.output())


class EmbeddingModel(TableModel):
    suffix = "vector"
    dim = _whole("dim", "length of a vector")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        column = self.getInputCol()
        made = features.embed(dataset, column, self.table, self.getOrDefault(self.dim))
        return made.withColumnRenamed(f"{column}_vector", self.output())


class Embedding(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """One vector per value of the training rows; others get zeros."""

    suffix = "vector"
    dim = _whole("dim", "length of a vector")
    seed = _whole("seed", "of the vectors")

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, dim=32, seed=42):
        super().__init__()
        self._setDefault(dim=32, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> EmbeddingModel:
        made = EmbeddingModel()
        made._set(inputCol=self.getInputCol(), outputCol=self.output(), dim=self.getOrDefault(self.dim))
        made.table = features.embedding_table(
            dataset, self.getInputCol(), self.getOrDefault(self.dim), self.getOrDefault(self.seed)
        )
        return made


class LabelCodesModel(TableModel):
    suffix = "code"

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value = F.coalesce(scalars.text(self.getInputCol()), F.lit(features.MISSING_CATEGORY))
        table = self.table.select(F.col("category").alias("__category"), F.col("code").alias("__code"))
        joined = lookup_join(dataset.withColumn("__category", value), table, "__category", "left")
        kept = [F.col(c) for c in dataset.columns if c != self.output()]
        return joined.select(*kept, F.col("__code").alias(self.output()))


class LabelCodes(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Place of a value in the sorted values of the training rows; NULL for values not among them."""

    suffix = "code"

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LabelCodesModel:
        made = LabelCodesModel()
        made._set(inputCol=self.getInputCol(), outputCol=self.output())
        made.table = features.label_codes(dataset, self.getInputCol())
        return made


class TargetBinsModel(TableModel):
    suffix = "bin"

    def edges(self) -> list[float]:
        """Ascending edges: one more than bins."""
        return [r["edge"] for r in self.table.orderBy("edge").collect()]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = F.col(self.getInputCol())
        number = binning.bin_number(self.getInputCol(), self.edges())
        return dataset.withColumn(self.output(), F.when(x.isNotNull(), number))


class TargetBins(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Bin of a number between edges of the training rows; NULL stays NULL."""

    suffix = "bin"
    bins = _whole("bins", "number of bins")
    strategy = Param(Params._dummy(), "strategy", "quantile, uniform or kmeans", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, bins=5, strategy="quantile"):
        super().__init__()
        self._setDefault(bins=5, strategy="quantile")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TargetBinsModel:
        made = TargetBinsModel()
        made._set(inputCol=self.getInputCol(), outputCol=self.output())
        found = binning.bin_edges(dataset, self.getInputCol(), self.getOrDefault(self.bins), self.getOrDefault(self.strategy))
        made.table = dataset.sparkSession.createDataFrame([(float(e),) for e in found], "edge double")
        return made
