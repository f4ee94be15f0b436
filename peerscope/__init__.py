"""peerscope: peer-group anomaly analytics for prescriber claims, built on Spark.

Claim-level facts are rolled up to one row per provider (and year), cleaned,
compared with their specialty peers (benchmarks, z-scores, percentile ranks,
rule flags), scored, tiered and reported.  Every operator is a function from
DataFrames to a DataFrame; thresholds are parameters whose defaults are the
values the original analysis uses.
"""

from peerscope.session import build_session, ensure_checkpoint_dir, materialize

__all__ = ["build_session", "ensure_checkpoint_dir", "materialize"]
