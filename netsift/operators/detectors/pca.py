"""2-D PCA projection for display: centre, project, explained-variance ratio.

Spark's ``PCA`` does not centre, so a ``StandardScaler(withMean, withStd=False)``
stage comes first. Component signs are arbitrary; each component is flipped so that
its largest-magnitude loading is positive (deterministic output).
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pca_2d(df: DataFrame, features_col: str = "features", k: int = 2, keep: list[str] | None = None):
    """Returns (projected DataFrame with ``pc1..pck``, explained-variance ratios); without a row, null
    components and no ratio."""
    keep = keep if keep is not None else [c for c in df.columns if c != features_col]
    if df.isEmpty():
        return df.select(*keep, *(F.lit(None).cast("double").alias(f"pc{i + 1}") for i in range(k))), []
    pipe = Pipeline(stages=[StandardScaler(withMean=True, withStd=False, inputCol=features_col,
                                           outputCol="_centred"),
                            PCA(k=k, inputCol="_centred", outputCol="_pcs")])
    model = pipe.fit(df)
    pca = model.stages[1]
    comps = pca.pc.toArray()  # d × k
    signs = np.sign(comps[np.abs(comps).argmax(axis=0), range(k)])
    signs[signs == 0] = 1.0
    out = model.transform(df).withColumn("_a", vector_to_array("_pcs"))
    cols = [(F.col("_a")[i] * float(signs[i])).alias(f"pc{i + 1}") for i in range(k)]
    return out.select(*keep, *cols), [float(v) for v in pca.explainedVariance.toArray()]
