"""Random Fourier features: an explicit map whose inner products approximate an RBF kernel.

With it a linear model learns the kernel machine's boundary in one distributed pass per
iteration instead of building a row-by-row kernel matrix (Rahimi and Recht, 2007).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class RandomFourierFeatures(
    Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable
):
    """``sqrt(2 / D) * cos(W x + b)`` with ``W ~ N(0, 2 gamma)`` drawn from the seed.

    Only the parameters are stored: every task redraws the same small projection matrix.
    """

    components = Param(Params._dummy(), "components", "number of random features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "RBF kernel width", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="kernel_features", components=256, gamma=1.0, seed=42):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="kernel_features", components=256, gamma=1.0, seed=42)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        count = self.getOrDefault(self.components)
        gamma, seed = self.getOrDefault(self.gamma), self.getOrDefault(self.seed)

        @F.pandas_udf("array<double>")
        def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            weights = offsets = None
            for batch in batches:
                if len(batch) == 0:
                    yield pd.Series([], dtype=object)
                    continue
                points = np.stack(batch.to_numpy())
                if weights is None:
                    rng = np.random.default_rng(seed)
                    weights = rng.normal(0.0, np.sqrt(2.0 * gamma), (points.shape[1], count))
                    offsets = rng.uniform(0.0, 2.0 * np.pi, count)
                mapped = np.sqrt(2.0 / count) * np.cos(points @ weights + offsets)
                yield pd.Series(list(mapped))

        vector = array_to_vector(project(vector_to_array(F.col(self.getInputCol()))))
        return dataset.withColumn(self.getOutputCol(), vector)


def scale_gamma(df: DataFrame, features: str = "features") -> float:
    """Kernel width 1 / (slots * variance over all entries), from one aggregation."""
    entries = vector_to_array(F.col(features))
    total = F.aggregate(entries, F.lit(0.0), lambda acc, v: acc + v)
    squares = F.aggregate(entries, F.lit(0.0), lambda acc, v: acc + v * v)
    row = (
        df.select(F.size(entries).alias("slots"), total.alias("s"), squares.alias("q"))
        .agg(F.max("slots").alias("slots"), F.sum("slots").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
        .first()
    )
    variance = row["q"] / row["n"] - (row["s"] / row["n"]) ** 2
    return 1.0 / (row["slots"] * variance) if variance > 0 else 1.0
