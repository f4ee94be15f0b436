"""Minority oversampling by interpolation (SMOTE; Chawla et al., 2002).

For each synthetic row: pick a minority row ``x`` uniformly, one of its ``k``
nearest minority neighbours ``nn`` uniformly, a gap ``u ~ U(0, 1)``, and emit
``x + u * (nn - x)``.  Synthetic rows are added until both classes are equal.
Distances are Euclidean on the raw features (as in the original step).

Exact k-nearest neighbours without comparing all pairs
-------------------------------------------------------
1. Equal vectors are one vector.  Of its keys only the ``k + 1`` smallest can be anyone's neighbours, since ties go to the smaller key; so a
   vector that very many rows share costs what one costs.
2. A bounded, hash-chosen set of vectors are *pivots*; each vector belongs to the cell of its nearest pivot.  Of a cell only the number of
   keys and the least and largest distance to its pivot are collected.
3. A vector at distance ``d`` from a pivot is at least ``max(d - largest, least - d)`` from everything in that cell (triangle inequality).
   First it meets the nearest cells that hold enough rows, which bounds its k-th distance from above; then, once, all other cells that
   can hold something as near.  No guesses and no retries.
4. Cells and the vectors that want them are both cut into chunks of at most ``CHUNK``; a task compares one chunk with another and keeps the
   best ``k + 1``, so neither a large cell nor one that many want is one task.

With ``group`` the neighbours of every group are listed apart (the folds of a cross-validation: the neighbours outside any one fold are
merged from the others' lists).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerscope.functions import growing, stable_hash
from peerscope.operators.ordered import ordered_stats
from peerscope.session import materialize, ship_package

K_NEIGHBORS = 5
SEED = 42
CELL_ROWS = 64              # vectors a cell is meant to hold
MAX_PIVOTS = 4096
CHUNK = 2048
SLACK = 1e-9                # bounds are widened by this share, against rounding


def _vectors(column) -> np.ndarray:
    """A column of lists of equal length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows, squares summed from the first feature to the last (as SQL adds them)."""
    out = np.zeros((len(a), len(b)))
    for j in range(min(a.shape[1], b.shape[1]) if len(a) and len(b) else 0):
        d = a[:, j, None] - b[None, :, j]
        out += d * d
    return np.sqrt(out)


def _collapsed(points: DataFrame, k: int) -> DataFrame:
    """One row a distinct vector ``_v``: its smallest key ``rep`` and, for each group, at most ``k + 1`` keys."""
    w = Window.partitionBy("_v", "_g").orderBy("key")
    few = points.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1)
    return few.groupBy("_v").agg(F.min("key").alias("rep"), F.array_sort(F.collect_list(F.struct("key", "_g"))).alias("held"))


def _placed(vectors: DataFrame, pivots) -> DataFrame:
    """Adds ``cell`` and ``away``, the nearest pivot and the distance to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, away = np.zeros(batch.num_rows, dtype=np.int32), np.zeros(batch.num_rows)
            v = _vectors(batch.column("_v"))
            for start in range(0, batch.num_rows, CHUNK):
                d = distances(v[start:start + CHUNK], pivots.value)
                cell[start:start + CHUNK] = d.argmin(1)
                away[start:start + CHUNK] = d.min(1)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("_v", "rep", "held")] + [pa.array(cell), pa.array(away)],
                                             names=["_v", "rep", "held", "cell", "away"])

    return vectors.mapInArrow(run, "_v array<double>, rep string, held array<struct<key:string,_g:int>>, cell int, away double")


def _wanted(queries: DataFrame, shared, k: int, first: bool) -> DataFrame:
    """(rep, _v, want): the cells a vector has to meet.  ``first``: the nearest ones that hold ``k + 1`` keys of every group (or all there
    are); else the others that can hold something within ``reach``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, low, high, counts = shared.value
        need = np.minimum(k + 1, counts.sum(0))
        for batch in batches:
            v, reps, want, at = _vectors(batch.column("_v")), batch.column("rep"), [], []
            for i in range(batch.num_rows):
                d = distances(v[i:i + 1], pivots)[0]
                order = np.argsort(d, kind="stable")
                enough = (np.cumsum(counts[order], 0) >= need).all(1)
                near = order[:int(enough.argmax()) + 1]
                if not first:
                    reach = batch.column("reach")[i].as_py() * (1 + SLACK)
                    cells = np.flatnonzero(np.maximum(d - high, low - d) <= reach + SLACK * d)
                    near = np.setdiff1d(cells, near)
                want.append(near)
                at.append(np.full(len(near), i))
            rows = pa.array(np.concatenate(at) if at else np.zeros(0, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([reps.take(rows), batch.column("_v").take(rows), pa.array(np.concatenate(want).astype(np.int32) if want else [], pa.int32())],
                                             names=["rep", "_v", "want"])

    return queries.mapInArrow(run, "rep string, _v array<double>, want int")


def _met(wanted: DataFrame, cells: DataFrame, k: int) -> DataFrame:
    """(rep, g, nn_key, dist): the best ``k + 1`` of each group from every pair of chunks."""
    sizes = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    asked = wanted.groupBy("want").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("parts"))
    tiles = sizes.join(asked.withColumnRenamed("want", "cell"), "cell")         # one row a cell: at most MAX_PIVOTS
    left = wanted.withColumnRenamed("want", "cell").join(tiles, "cell").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    left = left.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("cell", "chunk", "part", "rep", "_v")
    right = cells.join(tiles, "cell").withColumn("chunk", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("chunks")).cast("int"))
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("cell", "chunk", "part", "held", "_v")

    def run(one: pa.Table, two: pa.Table) -> pa.Table:
        held = sorted((x["key"], x["_g"], i) for i, own in enumerate(two.column("held").to_pylist()) for x in own)
        keys, group, of = np.array([h[0] for h in held], dtype=object), np.array([h[1] for h in held]), np.array([h[2] for h in held], dtype=np.int64)
        a, b, reps = _vectors(one.column("_v")), _vectors(two.column("_v")), np.array(one.column("rep").to_pylist(), dtype=object)
        out: list[list] = [[], [], [], []]
        for start in range(0, len(a) if held else 0, 256):
            d = distances(a[start:start + 256], b)
            for g in np.unique(group).tolist():
                own = np.flatnonzero(group == g)
                part = d[:, of[own]]
                best = np.argsort(part, axis=1, kind="stable")[:, :k + 1]       # entries are in the order of their keys
                out[0] += np.repeat(reps[start:start + 256], best.shape[1]).tolist()
                out[1] += [g] * best.size
                out[2] += keys[own[best.ravel()]].tolist()
                out[3].append(np.take_along_axis(part, best, 1).ravel())
        return pa.table({"rep": pa.array(out[0], pa.string()), "g": pa.array(out[1], pa.int32()), "nn_key": pa.array(out[2], pa.string()),
                         "dist": pa.array(np.concatenate(out[3]) if out[3] else [], pa.float64())})

    by = ["cell", "chunk", "part"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, "rep string, g int, nn_key string, dist double")


def _best(found: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy("dist", "nn_key")
    return found.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)


def minority_knn(points: DataFrame, features: Sequence[str], key: str = "npi", k: int = K_NEIGHBORS, group: str | None = None) -> DataFrame:
    """Exact ``k`` nearest neighbours (other rows) of every row: ``key``, ``nn_rank`` 1..k, ``nn_key``, ``dist``, and with ``group`` also
    ``nn_group``, the ranks being within it.  Ties in distance break by key.  Null features count as 0."""
    feats, spark = list(features), points.sparkSession
    ship_package(spark)
    v = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) + F.lit(0.0) for c in feats])
    pts = materialize(points.select(F.col(key).cast("string").alias("key"), (F.col(group).cast("int") if group else F.lit(0)).alias("_g"), v.alias("_v")), "knn_points")
    vectors = materialize(_collapsed(pts, k), "knn_vectors")
    n = vectors.count()
    tail = ", nn_group int" if group else ""
    if n == 0:
        return spark.createDataFrame([], f"{key} string, nn_rank int, nn_key string, dist double{tail}")
    m = max(1, min(MAX_PIVOTS, -(-n // CELL_ROWS)))
    chosen = vectors.orderBy(F.xxhash64("rep"), "rep").limit(m).select("_v").toArrow()      # at most MAX_PIVOTS vectors
    pivots = spark.sparkContext.broadcast(_vectors(chosen.column("_v")))
    cells = materialize(_placed(vectors, pivots), "knn_cells")
    stats = cells.groupBy("cell").agg(F.min("away").alias("low"), F.max("away").alias("high")).collect()
    sizes = cells.select("cell", F.explode("held").alias("x")).groupBy("cell", "x._g").count().collect()    # cells x groups
    groups = sorted({r["_g"] for r in sizes})
    low, high, counts = np.full(len(pivots.value), np.inf), np.full(len(pivots.value), -np.inf), np.zeros((len(pivots.value), len(groups)), dtype=np.int64)
    for r in stats:
        low[r.cell], high[r.cell] = r.low, r.high
    for r in sizes:
        counts[r.cell, groups.index(r["_g"])] = r["count"]
    shared = spark.sparkContext.broadcast((pivots.value, low, high, counts))
    queries = cells.select("rep", "_v")
    near = materialize(_best(_met(materialize(_wanted(queries, shared, k, True), "knn_wanted"), cells, k), ["rep", "g"], k + 1), "knn_near")
    reach = near.groupBy("rep").agg(F.max("dist").alias("reach"))
    more = materialize(_wanted(queries.join(growing(reach), "rep"), shared, k, False), "knn_wanted")
    found = near.drop("nn_rank").unionByName(_met(more, cells, k))
    top = materialize(_best(found, ["rep", "g"], k + 1).drop("nn_rank"), "knn_top")
    member = pts.join(growing(vectors.select("_v", "rep")), "_v").select("key", "rep")
    own = member.join(growing(top), "rep").where("key <> nn_key")
    best = _best(own, ["key", "g"], k)
    out = best.select(F.col("key").alias(key), F.col("nn_rank").cast("int"), "nn_key", "dist", *([F.col("g").alias("nn_group")] if group else []))
    return materialize(out, "knn")


def neighbours_outside(knn: DataFrame, points: DataFrame, fold: int | None, key: str = "npi", group: str = "fold", k: int = K_NEIGHBORS) -> DataFrame:
    """The ``k`` nearest neighbours among the rows of other groups than ``fold`` (None: of all groups), for the rows outside it,
    from lists that ``minority_knn`` has made with ``group``."""
    if fold is None:
        some = knn
    else:
        some = knn.where(F.col("nn_group") != fold).join(growing(points.where(F.col(group) != fold).select(key)), key, "left_semi")
    return _best(some.drop("nn_rank", "nn_group"), [key], k).withColumn("nn_rank", F.col("nn_rank").cast("int"))


def _unit(seed: int, j, draw: int):
    """Draw number ``draw`` of synthetic row ``j``: uniform in [0, 1), from the md5 of "seed-j-draw"."""
    return stable_hash(F.concat_ws("-", F.lit(str(seed)), j.cast("string"), F.lit(str(draw)))) / F.lit(float(2 ** 32))


def smote(train: DataFrame, features: Sequence[str], label: str = "is_fraud_label", key: str = "npi",
          k: int = K_NEIGHBORS, seed: int = SEED, knn: DataFrame | None = None, few: str = "raise") -> DataFrame:
    """Synthetic minority rows (label 1) so that both classes are equal in size.
    Returns rows with ``key`` (``'synthetic-<j>'``), the features and the label.
    ``knn`` may pass precomputed neighbours of the same minority rows.

    With at most ``k`` minority rows there are not ``k`` neighbours: ``few="raise"`` is an
    error, ``few="shrink"`` uses all others as neighbours (and adds nothing to fewer than two rows)."""
    if few not in ("raise", "shrink"):
        raise ValueError("few must be 'raise' or 'shrink'")
    feats = list(features)
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = int(counts.get(0, 0)), int(counts.get(1, 0))
    spark = train.sparkSession
    n_new = n0 - n1
    if n_new > 0 and n1 <= k and few == "raise":
        raise ValueError(f"{n1} minority rows; {k} neighbours need more than {k}")
    if n_new <= 0 or n1 < 2:
        return spark.createDataFrame([], train.select(key, *feats, label).schema)
    minority = train.where(F.col(label) == 1).select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                                            for c in feats])
    knn = knn if knn is not None else minority_knn(minority, feats, key, k)
    kk = min(k, n1 - 1)
    # index minority rows 0..n1-1 in a reproducible order (hash, key)
    ordered = minority.withColumn("_o", F.struct(stable_hash(F.col(key)).alias("h"), F.col(key).alias("k")))
    idx = ordered_stats(ordered, [], "_o").select("_o", F.col("n_before").alias("_idx"))
    indexed = ordered.join(growing(idx), "_o").drop("_o")
    syn = spark.range(n_new).select(
        F.col("id").alias("_j"),
        F.floor(_unit(seed, F.col("id"), 1) * F.lit(n1)).cast("long").alias("_idx"),
        (F.floor(_unit(seed, F.col("id"), 2) * F.lit(kk)) + 1).cast("int").alias("nn_rank"),
        _unit(seed, F.col("id"), 3).alias("_gap"))
    base = syn.join(growing(indexed.select("_idx", *[F.col(c) for c in [key, *feats]])), "_idx", "inner")
    base = base.join(growing(knn.select(key, "nn_rank", "nn_key")), [key, "nn_rank"], "inner")
    nb = minority.select(F.col(key).alias("nn_key"), *[F.col(c).alias(f"_nn_{c}") for c in feats])
    j = base.join(growing(nb), "nn_key", "inner")
    out = [F.concat(F.lit("synthetic-"), F.col("_j").cast("string")).alias(key)]
    out += [(F.col(c) + F.col("_gap") * (F.col(f"_nn_{c}") - F.col(c))).alias(c) for c in feats]
    out.append(F.lit(1).cast(train.schema[label].dataType).alias(label))
    return j.select(*out)
