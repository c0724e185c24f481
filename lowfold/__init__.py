"""Manifold embedding, projection, clustering and quality scores as Spark jobs."""

import sys

from pyspark import cloudpickle

# Helpers that run inside tasks travel with the task, so that executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from lowfold.operators.clustering import cluster  # noqa: E402
from lowfold.operators.quality import silhouette, trustworthiness  # noqa: E402
from lowfold.plans.umap import Umap, UmapModel, apply_saved, embed_table, fit_and_save  # noqa: E402

__all__ = [
    "Umap",
    "UmapModel",
    "apply_saved",
    "cluster",
    "embed_table",
    "fit_and_save",
    "silhouette",
    "trustworthiness",
]
