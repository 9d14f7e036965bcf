"""Approximate nearest neighbours on several shifted Hilbert curves.

Each curve has its own random orthonormal projection to ``AXES`` dimensions
and its own shift of the grid. Spark range-partitions and sorts the vectors'
keys of all curves at once; a vector's position on a curve is its place in
its partition plus the sizes of the partitions before. Positions are cut into
blocks of ``BLOCK``; a query is held against the blocks within ``window``
positions of its own on every curve, the blocks' best are merged, and the
scores are the exact inner products of the original vectors. The queries of a
curve are cut in their order into tiles of ``BLOCK``, too: a task holds one tile
against one block, however wide the window is.

Equal vectors are one point of the index with their k + 1 smallest ids (no
more can be among a query's k nearest), so any number of copies costs one
place. For inner products of vectors of unequal length the points get one
more coordinate that makes all of them equally long (queries have 0 there);
their order by distance is then the order by inner product.

The window is fitted: for at most ``SAMPLE`` queries the exact neighbours are
found by brute force, and the window is the position distance within which
all but 1 - ``RECALL`` of them lie on their best curve.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.shipping import map_arrow
from martflow.llm.textcore import stored

CURVES = 8
AXES = 8
BITS = 7       # per axis; AXES * BITS must stay below 63
BLOCK = 8192
SAMPLE = 64
RECALL = 0.96  # of the sample's neighbours, by the fitted window
SEED = 20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place along the Hilbert curve of each row of cells (n x axes, whole
    numbers below 2**bits): Gray-code rotations undone axis by axis, highest
    bit first, then the axes' bits interleaved."""
    x = np.ascontiguousarray(cells.T).astype(np.uint64)
    axes = len(x)
    for bit in range(bits - 1, 0, -1):
        high, low = np.uint64(1 << bit), np.uint64((1 << bit) - 1)
        for axis in range(axes):
            flip = (x[axis] & high) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(flip, low, swap)
            if axis:
                x[axis] ^= swap
    for axis in range(1, axes):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] & np.uint64(1 << bit)) != 0, np.uint64((1 << bit) - 1), np.uint64(0))
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in range(axes):
            key = (key << np.uint64(1)) | ((x[axis] >> np.uint64(bit)) & np.uint64(1))
    return key.astype(np.int64)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, added up in the order of the components."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


class _Curves:
    """The projections and grids; ``fit`` holds each axis' least and greatest value."""

    def __init__(self, dim: int, longest: float, curves: int, seed: int):
        draw = np.random.default_rng(seed)
        self.longest = longest
        self.axes = min(AXES, dim + 1)
        self.project = [np.linalg.qr(draw.normal(size=(dim + 1, self.axes)))[0] for _ in range(curves)]
        self.shift = draw.random((curves, self.axes))
        self.low = self.high = None

    def points(self, vectors: np.ndarray, is_query: bool) -> np.ndarray:
        length = np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))
        if is_query:
            return np.hstack((vectors / length, np.zeros_like(length)))
        scaled = vectors / self.longest
        return np.hstack((scaled, np.sqrt(np.maximum(0, 1 - (length / self.longest) ** 2))))

    def keys(self, curve: int, points: np.ndarray) -> np.ndarray:
        at = points @ self.project[curve]
        wide = np.maximum(self.high[curve] - self.low[curve], 1e-12)
        cells = np.clip((at - self.low[curve]) / wide, 0, 1) / 2 + self.shift[curve] / 2
        return hilbert_keys(np.minimum(cells * (1 << BITS), (1 << BITS) - 1).astype(np.int64), BITS)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): distinct rows whose vector is neither null nor zero, has only
    finite components, and as many as most rows' vectors (ties: fewer)."""
    v = F.col(vector_col)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
            .where(F.coalesce(finite, F.lit(False))).where(F.exists("v", lambda x: x != 0)))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (usual["n"] if usual else 0))


def _points(rows: DataFrame, k: int) -> DataFrame:
    """(rep, v, ids): each distinct vector, its smallest id and its k + 1 smallest ids."""
    order = Window.partitionBy("v").orderBy("id")
    few = (rows.dropDuplicates(["v", "id"]).withColumn("n", F.row_number().over(order))
           .where(F.col("n") <= k + 1))
    return few.groupBy("v").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids"))


def _exact(points: DataFrame, sample: list[tuple[int, np.ndarray]], k: int) -> list[tuple[int, int]]:
    """(query, neighbour) for the k nearest points of each sampled point: one
    pass over the points, each batch giving its k best."""
    ids = np.array([i for i, _ in sample])
    queries = np.array([v for _, v in sample])
    shared = points.sparkSession.sparkContext.broadcast((ids, queries))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = shared.value
        for batch in batches:
            if batch.num_rows:
                reps = batch.column("rep").to_numpy()
                scores = queries @ _matrix(batch.column("v")).T
                scores[ids[:, None] == reps[None, :]] = -np.inf
                take = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, take.shape[1])), pa.array(reps[take].ravel()),
                     pa.array(np.take_along_axis(scores, take, axis=1).ravel())],
                    names=["query", "near", "score"])

    ranked = (map_arrow(points.select("rep", "v"), best, "query bigint, near bigint, score double")
              .where(F.col("score") > float("-inf"))
              .withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "near")))
              .where(F.col("n") <= k))
    return [(r["query"], r["near"]) for r in ranked.collect()]  # at most SAMPLE * k rows


def _ordered(points: DataFrame, curves: _Curves, n_curves: int) -> DataFrame:
    """(curve, pos, turn, rep, is_query, v): every point and query on every
    curve; turn is the number of queries before it."""
    shared = points.sparkSession.sparkContext.broadcast(curves)

    def extent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        curves = shared.value
        for batch in batches:
            if batch.num_rows:
                made = curves.points(_matrix(batch.column("v")), False)
                for curve, project in enumerate(curves.project):
                    at = made @ project
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([curve] * curves.axes), pa.array(range(curves.axes)),
                         pa.array(at.min(axis=0)), pa.array(at.max(axis=0))],
                        names=["curve", "axis", "low", "high"])

    extents = (map_arrow(points.select("v"), extent, "curve bigint, axis bigint, low double, high double")
               .groupBy("curve", "axis").agg(F.min("low").alias("low"), F.max("high").alias("high"))
               .orderBy("curve", "axis").collect())  # curves * axes rows
    curves.low = np.array([r["low"] for r in extents]).reshape(n_curves, -1)
    curves.high = np.array([r["high"] for r in extents]).reshape(n_curves, -1)
    fitted = points.sparkSession.sparkContext.broadcast(curves)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        curves = fitted.value
        for batch in batches:
            vectors = _matrix(batch.column("v"))
            asked = batch.column("asked").to_numpy(zero_copy_only=False)
            for is_query in (False, True):
                some = batch.filter(pa.array(asked)) if is_query else batch
                made = curves.points(vectors[asked] if is_query else vectors, is_query)
                for curve in range(n_curves if some.num_rows else 0):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(some.num_rows, curve, dtype=np.int32)),
                         pa.array(curves.keys(curve, made)), some.column("rep"),
                         pa.array(np.full(some.num_rows, is_query)), some.column("v")],
                        names=["curve", "key", "rep", "is_query", "v"])

    kind = points.schema["v"].dataType.simpleString()
    ranged = (map_arrow(points.select("rep", "v", "asked"), keyed,
                        f"curve int, key bigint, rep bigint, is_query boolean, v {kind}")
              .repartitionByRange("curve", "key", "rep").sortWithinPartitions("curve", "key", "rep"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, asked = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            queries = np.cumsum(batch.column("is_query").to_numpy(zero_copy_only=False).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("curve"), pa.array(np.full(n, part, dtype=np.int32)),
                 pa.array(np.arange(done, done + n)),
                 pa.array(asked + np.append(0, queries)[:-1]), batch.column("rep"),
                 batch.column("is_query"), batch.column("v")],
                names=["curve", "part", "place", "turn", "rep", "is_query", "v"])
            done += n
            asked += int(queries[-1]) if n else 0

    placed = stored(map_arrow(
        ranged, number, f"curve int, part int, place bigint, turn bigint, rep bigint, is_query boolean, v {kind}"),
        "curves")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"), F.count_if("is_query").alias("asked"))
    # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
                         F.coalesce(F.sum("asked").over(before), F.lit(0)).alias("asked"))
    return placed.join(bases, "part").select(
        "curve", (F.col("base") + F.col("place")).alias("pos"),
        (F.col("asked") + F.col("turn")).alias("turn"), "rep", "is_query", "v")


def _tiled(ordered: DataFrame, window: int, block: int) -> DataFrame:
    """(curve, block, tile, rep, is_query, v): a block's points with each tile of
    queries whose windows touch it, at most block of either."""
    seeking = (ordered.where("is_query").withColumn("tile", F.floor(F.col("turn") / block))
               .withColumn("block", F.explode(F.sequence(
                   F.floor((F.col("pos") - window) / block), F.floor((F.col("pos") + window) / block)))))
    touched = seeking.select("curve", "block", "tile").distinct()  # a row for each group
    points = (ordered.where("not is_query").withColumn("block", F.floor(F.col("pos") / block))
              .join(touched, ["curve", "block"]))
    columns = ["curve", "block", "tile", "rep", "is_query", "v"]
    return points.select(columns).unionByName(seeking.select(columns))


def _fitted_window(ordered: DataFrame, near: list[tuple[int, int]], recall: float) -> int:
    """Positions within which the share recall of the sample's neighbours lies."""
    spark = ordered.sparkSession
    if not near:
        return BLOCK
    wanted = F.broadcast(spark.createDataFrame(near, "query bigint, near bigint"))  # SAMPLE * k rows
    of_query = ordered.where("is_query").select("curve", F.col("rep").alias("query"), F.col("pos").alias("q"))
    of_near = ordered.where("not is_query").select("curve", F.col("rep").alias("near"), F.col("pos").alias("p"))
    apart = (of_near.join(wanted, "near").join(
        of_query.join(F.broadcast(spark.createDataFrame(sorted({(q,) for q, _ in near}), "query bigint")), "query"),
        ["curve", "query"])
        .groupBy("query", "near").agg(F.min(F.abs(F.col("p") - F.col("q"))).alias("apart")))
    return int(np.quantile([r["apart"] for r in apart.collect()], recall, method="higher")) + 1


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, curves: int = CURVES,
            block: int = BLOCK, recall: float = RECALL, id_col: str = "vec_id",
            vector_col: str = "embedding", seed: int = SEED) -> DataFrame:
    """query_id, rank (from 1), id, score: for every row whose id is divisible
    by ``every`` the k rows with the largest inner products (all, if fewer),
    itself left out, ties to the smaller id.

    Null ids and vectors, zero vectors, vectors with null or non-finite
    components or of an unusual number of components take no part. Equal rows
    count once; a query never meets a row of its own id.
    """
    spark = vectors.sparkSession
    empty = f"query_id bigint, rank int, `{id_col}` bigint, score double"
    rows = usable(vectors, id_col, vector_col)
    asked = rows.where(F.col("id") % every == 0).distinct()
    points = _points(rows, k)
    with_query = asked.select("v").distinct().withColumn("q", F.lit(True))
    points = stored(points.join(with_query, "v", "left")
                    .select("rep", "ids", "v", F.coalesce("q", F.lit(False)).alias("asked")), "points")
    sample = points.where("asked").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("rep", "v").collect()
    if not sample:
        return spark.createDataFrame([], empty)
    dim = len(sample[0]["v"])
    longest = points.agg(F.sqrt(F.max(F.aggregate(
        F.transform("v", lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, x: a + x)))).first()[0]
    near = _exact(points, [(r["rep"], np.array(r["v"], dtype=np.float64)) for r in sample], k)
    ordered = _ordered(points, _Curves(dim, longest, curves, seed), curves)
    window = _fitted_window(ordered, near, recall)

    blocks = _tiled(ordered, window, block)

    def search(table: pa.Table) -> pa.Table:
        is_query = table.column("is_query").to_numpy()
        reps, v = table.column("rep").to_numpy(), _matrix(table.column("v"))
        order = np.argsort(reps, kind="stable")
        at, to = order[~is_query[order]], order[is_query[order]]
        out: list[list[np.ndarray]] = [[np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)], [np.empty(0)]]
        for low in range(0, len(to) if len(at) else 0, 256):
            some = to[low:low + 256]
            rough = v[some] @ v[at].T
            last = np.partition(rough, max(0, len(at) - k - 1), axis=1)[:, max(0, len(at) - k - 1)]
            query, point = np.nonzero(rough >= last[:, None] - 1e-9 * (1 + np.abs(last[:, None])))
            out[0].append(reps[some[query]])
            out[1].append(reps[at[point]])
            out[2].append(inner_products(v[some[query]], v[at[point]]))
        return pa.table([pa.array(np.concatenate(o)) for o in out], names=["query", "rep", "score"])

    found = (blocks.groupBy("curve", "block", "tile").applyInArrow(search, "query bigint, rep bigint, score double")
             .distinct())  # a pair's score is the same on every curve
    best = (found.withColumn("n", F.row_number().over(
        Window.partitionBy("query").orderBy(F.desc("score"), "rep"))).where(F.col("n") <= k + 1))
    members = points.select("rep", "ids")
    each = (best.join(members, "rep").select("query", "score", F.explode("ids").alias("id"))
            .groupBy("query").agg(F.slice(F.sort_array(F.collect_list(
                F.struct((-F.col("score")).alias("less"), "id", "score"))), 1, k + 1).alias("near")))
    of_query = (asked.select(F.col("id").alias("query_id"), "v")
                .join(points.where("asked").select("v", F.col("rep").alias("query")), "v").select("query_id", "query"))
    return (of_query.join(each, "query").distinct()
            .select("query_id", F.posexplode(F.slice(F.filter(
                "near", lambda x: x["id"] != F.col("query_id")), 1, k)).alias("n", "x"))
            .select("query_id", (F.col("n") + 1).cast("int").alias("rank"), F.col("x.id").alias(id_col),
                    F.col("x.score").alias("score")))
