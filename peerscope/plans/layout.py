"""The provider views stored bucketed and sorted by npi: joins on npi without a shuffle, lookups from one bucket.

Every stored view has the same number of buckets, dealt by Spark's hash of the key, and one sorted file a bucket (rows
are repartitioned by that hash before they are written).  Joins and groupings on the key then read bucket by bucket:
the shuffle is paid once, when the views are written, not in each query.  The key column carries a Parquet bloom
filter and no dictionary, so that a lookup opens one file and skips the row groups without its key.

The bucket count is a parameter (default: the session's shuffle partitions); choose it so that a bucket of the widest
view holds 128 to 256 MB.  Provider views have one row a key, so buckets are even; the exclusion list has a
few rows a key.

Edge cases: rows without a key share a bucket, stay in outer joins and match nothing; an empty view is an empty table with
its columns.
"""

from __future__ import annotations

import threading
import uuid
from functools import cached_property
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.operators.reports import lookup
from peerscope.plans.views import SCORE_COLUMNS, SCORED_FEATURE_COLUMNS, Workspace
from peerscope.session import ensure_checkpoint_dir, written

KEY = "npi"
VIEWS = ("providers", "provider_features", "scores", "exclusions", "alerts")


def store_bucketed(df: DataFrame, name: str, buckets: int, key: str = KEY, n_keys: int | None = None) -> str:
    """``df`` as a table of ``buckets`` files hashed and sorted by ``key``, under the session's checkpoint folder; the
    name of the table.

    ``n_keys``: the distinct keys to expect in a file, for the size of its bloom filter (default: Parquet's own)."""
    spark, tag = df.sparkSession, uuid.uuid4().hex
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/peerscope/{name}-{tag}"
    writer = (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path)
              .option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.enable.dictionary#{key}", "false"))
    if n_keys:
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", str(n_keys))
    table = f"peerscope_{name}_{tag}"
    writer.saveAsTable(table)
    written(spark, path)
    return table


def placement(table: DataFrame, buckets: int, key: str = KEY) -> DataFrame:
    """One row: rows of a bucketed table, rows in a file that is not their key's bucket, keys met in several files."""
    bucket = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)\.c\d+", 1).cast("int")
    rows = table.select(key, bucket.alias("bucket"))
    # a key's rows are in one file, so this second level has about one row a key
    by_key = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.min("bucket").alias("low"), F.max("bucket").alias("high"),
        F.count_if(~F.col("bucket").eqNullSafe(F.pmod(F.hash(key), F.lit(buckets)))).alias("astray"))
    return by_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("astray"), F.lit(0)).alias("n_astray"),
                      F.count_if(F.col("low") != F.col("high")).alias("n_split_keys"))


class BucketedViews:
    """The views of a workspace, each written once in the common layout."""

    def __init__(self, ws: Workspace, buckets: int | None = None):
        self.ws = ws
        self.buckets = buckets or int(ws.spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables: dict[str, str] = {}

    def _store(self, df: DataFrame, name: str) -> DataFrame:
        self.tables[name] = store_bucketed(df, name, self.buckets)
        return self.ws.spark.table(self.tables[name])

    @cached_property
    def providers(self) -> DataFrame:
        p = self.ws.providers
        return self._store(p.drop(*[c for c in SCORE_COLUMNS if c in p.columns]), "providers")

    @cached_property
    def provider_features(self) -> DataFrame:
        return self._store(self.ws.provider_features, "provider_features")

    @cached_property
    def scores(self) -> DataFrame:
        return self._store(self.ws.scores, "scores")

    @cached_property
    def exclusions(self) -> DataFrame:
        return self._store(self.ws.exclusions, "exclusions")

    @cached_property
    def alerts(self) -> DataFrame:
        return self._store(self.ws.alerts, "alerts")

    def scored(self) -> DataFrame:
        """J2 + J3: providers LEFT JOIN features LEFT JOIN scores, bucket by bucket."""
        f = self.provider_features.select(KEY, *SCORED_FEATURE_COLUMNS)
        return self.providers.join(f, KEY, "left").join(self.scores, KEY, "left")

    def flagged(self, flags_min: int = 1) -> DataFrame:
        """Every provider with at least ``flags_min`` flags and its percentile ranks."""
        f = self.provider_features.where(F.col("flag_count") >= flags_min).select(
            KEY, "flag_count", *[c for c in self.provider_features.columns if c.startswith("pct_")])
        return self.providers.select(KEY, "specialty", "state", "total_drug_cost").join(f, KEY)

    def excluded(self) -> DataFrame:
        """Every provider with the number of its exclusions and the first date; the grouping needs no shuffle either."""
        e = self.exclusions.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_exclusions"), F.min("exclusion_date").alias("first_excluded"))
        return self.providers.select(KEY, "specialty", "state").join(e, KEY, "left").withColumn(
            "n_exclusions", F.coalesce("n_exclusions", F.lit(0)))

    def lookup(self, npi: str) -> DataFrame:
        """C13 + C19: the page of one provider from one bucket of each view."""
        return lookup(self.scored(), npi)

    def placements(self) -> DataFrame:
        """``placement`` of every view."""
        parts = [placement(getattr(self, v), self.buckets).select(F.lit(v).alias("view"), "*") for v in VIEWS]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def drop(self) -> None:
        """Forgets the stored tables; their folders go with ``session.drop_intermediates``."""
        for view, table in self.tables.items():
            self.ws.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.__dict__.pop(view, None)
        self.tables = {}


_LOCK = threading.Lock()
_STORED: WeakKeyDictionary[Workspace, BucketedViews] = WeakKeyDictionary()


def bucketed_views(ws: Workspace) -> BucketedViews:
    """The bucketed views of a workspace, stored once for all queries."""
    with _LOCK:
        if ws not in _STORED:
            _STORED[ws] = BucketedViews(ws)
        return _STORED[ws]
