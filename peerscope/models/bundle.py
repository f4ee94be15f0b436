"""Everything that scores new rows in one folder -- isolation nodes, boosted trees, bin edges, feature order, score
range, threshold and blend weights -- and scoring from that folder alone.

The bundle is bounded by the models' parameters (trees times nodes), so the driver reads it whole; rows are scored where they are.
Edge cases: a bundle of another version raises; features absent from the rows raise (a silent 0 would be another model); NULL
features count as 0, as in training; isolation scores beyond the training range are cut to 0 and 1, so no row
changes the scores of others; no rows give no scores.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.models import boost as B
from peerscope.models import isolation as I
from peerscope.operators import scoring as S

BUNDLE_VERSION = 1


def save_bundle(path: str, spark: SparkSession, model: B.BoostedModel, nodes: DataFrame, psi: int, raw_range: tuple[float, float],
                threshold: float, weights: tuple[float, float] = (S.W_SUPERVISED, S.W_UNSUPERVISED)) -> None:
    nodes.select("tree", "node", "feature", "threshold", "depth", "size").coalesce(1).write.mode("overwrite").parquet(f"{path}/isolation")
    # written last: its settings make the bundle complete
    B.save_model(model, f"{path}/boosted", spark, bundle=BUNDLE_VERSION, psi=int(psi), raw_range=[float(x) for x in raw_range],
                 threshold=float(threshold), weights=[float(w) for w in weights])


class Bundle:
    """A bundle read back: ``score`` needs nothing else."""

    def __init__(self, path: str, spark: SparkSession):
        self.model, self.settings = B.load_model(f"{path}/boosted", spark)
        if self.settings.get("bundle") != BUNDLE_VERSION:
            raise ValueError(f"{path} is not a bundle of version {BUNDLE_VERSION}")
        self.nodes = spark.read.schema(I.NODE_SCHEMA).parquet(f"{path}/isolation")

    @property
    def features(self) -> Sequence[str]:
        return self.model.features

    def score(self, rows: DataFrame, key: str = "npi", rename: Mapping[str, str] | None = None) -> DataFrame:
        """``key``, both scores, the blend, its tier and ``flagged`` (supervised score at or above the threshold).
        ``rename`` maps column names of ``rows`` to the model's."""
        rows = rows.withColumnsRenamed(dict(rename or {}))
        missing = [c for c in self.features if c not in rows.columns]
        if missing:
            raise ValueError(f"rows lack the model's features: {missing}")
        s = self.settings
        lo, hi = s["raw_range"]
        raw = I.score_forest(rows, self.nodes, s["psi"], self.features, key)
        scaled = F.lit(0.0) if hi == lo else F.least(F.greatest((F.col("iso_raw") - lo) / (hi - lo), F.lit(0.0)), F.lit(1.0))
        both = B.predict(self.model, rows, key).join(raw.select(key, scaled.alias("fraud_score_iso")), key)
        return S.ensemble(both, *s["weights"]).withColumn("flagged", F.col("fraud_score_xgb") >= s["threshold"])
