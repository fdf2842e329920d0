"""Embeddings in few dimensions."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def principal_components(df: DataFrame, id: str, x: str, k: int = 2) -> tuple[DataFrame, list[float]]:
    """(``<id>, components array<double>``, explained shares): the first principal axes; rows without embedding are left out.

    The covariance is summed over partitions (dimensions squared), whatever the number of rows; each axis points to where its largest weight is positive.
    """
    d = df.select(id, F.col(x).cast("array<double>").alias("_x")).filter("_x is not null")
    v = d.withColumn("_v", array_to_vector("_x"))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(v)
    axes = model.pc.toArray()
    sign = [1.0 if axes[abs(axes[:, i]).argmax(), i] > 0 else -1.0 for i in range(k)]
    out = model.transform(v).select(id, vector_to_array("_p").alias("p"))
    return out.select(id, F.array(*[F.col("p")[i] * s for i, s in enumerate(sign)]).alias("components")), [float(e) for e in model.explainedVariance]
