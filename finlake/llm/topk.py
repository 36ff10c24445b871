"""Exact top-k inner products by ball-tree branch and bound, shard by shard.

Vectors become integers floor(64 x), held in doubles, and are dealt to shards of bounded size by a hash;
each shard is one row: a ball tree and its vectors in tree order. Queries are packed into
blocks the same way. Every block meets every shard once: first a home shard, whose
kth scores then bound the search in all other shards. Within a shard a node is left out
for the queries whose kth score its upper bound q.c + |q| r does not reach, and nodes of
higher bound are opened first, so later ones meet higher kth scores. Equal scores are
never cut by a bound, so ties fall to the smaller vec_id exactly. Products that doubles
may not hold exactly are computed in 64-bit or, where those are too short, in Python
integers.

Defined results: rows with a null vec_id, and vectors that are null or hold null
or non-finite components, take no part; a result whose score does not fit 64 bits raises, as its
cast does in SQL, and so do components of 2**500 or more, which only doubles can hold; shorter vectors are
filled up with zeros; repeated rows of one vec_id and vector count once; fewer candidates
than k are all returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finlake.llm import common

K = 20
SCALE = 64
SHARD_ROWS = 8_192
BLOCK_QUERIES = 2_048
LEAF = 128
LOWEST = -(2**62)
# Scores are cut to this absolute value; a result that has it raises.
MOST = 2**63 - 1


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and components, whole numbers in doubles, of the rows that take part."""

    def whole(x: F.Column) -> F.Column:
        # Doubles of 2**53 or more are whole; floor() would cut them to 64 bits.
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.where("vec_id is not null and embedding is not null").where(good)
    return rows.select("vec_id", F.transform("embedding", whole).alias("v")).distinct()


def ball_tree(vectors: np.ndarray, leaf: int = LEAF):
    """Row order and nodes (first, stop, left child, right child, centre, radius) of a tree."""
    points = vectors.astype(np.float64)
    order = np.arange(len(points))
    nodes: list[list] = []

    def add(first: int, stop: int) -> int:
        own = points[order[first:stop]]
        centre = own.mean(axis=0)
        radius = float(np.sqrt(((own - centre) ** 2).sum(axis=1).max()))
        nodes.append([first, stop, -1, -1, centre, radius])
        return len(nodes) - 1

    pending = [add(0, len(points))]
    while pending:
        k = pending.pop()
        first, stop = nodes[k][:2]
        if stop - first <= leaf or nodes[k][5] == 0:
            continue
        own = points[order[first:stop]]
        far = own[np.argmax(((own - nodes[k][4]) ** 2).sum(axis=1))]
        other = own[np.argmax(((own - far) ** 2).sum(axis=1))]
        along = own @ (other - far)
        middle = (stop - first) // 2
        order[first:stop] = order[first:stop][np.argsort(along, kind="stable")]
        nodes[k][2] = add(first, first + middle)
        nodes[k][3] = add(first + middle, stop)
        pending += nodes[k][2:4]
    return order, nodes


class Shard:
    """Vectors in tree order with their tree; answers blocks of queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order, self.nodes = ball_tree(vectors)
        self.ids, self.floats = ids[order], vectors[order].astype(np.float64)
        self.norms = np.sqrt((self.floats**2).sum(axis=1))
        self.centres = np.array([n[4] for n in self.nodes])
        self.radii = np.array([n[5] for n in self.nodes])

    def _scores(self, queries: np.ndarray, norms: np.ndarray, kth: np.ndarray, part: slice, other: np.ndarray, k: int):
        """Products with the vectors of a leaf, and which of them (``other`` rows only) may be among
        the k best of a query; those are exact."""
        leaf, reach = self.floats[part], norms[:, None] * self.norms[part][None, :]
        if reach.max() < 2.0**62:
            # No partial sum is larger than the product of the norms.
            if reach.max() < 2.0**52:
                scores = np.rint(queries @ leaf.T).astype(np.int64)
            else:
                scores = queries.astype(np.int64) @ leaf.T.astype(np.int64)
            return scores, (scores >= kth[:, None]) & other
        near, error = queries @ leaf.T, np.where(reach < 2.0**52, 0.0, 1e-9 * reach)
        if len(leaf) >= k:
            surely = np.where(other, near - error, -np.inf)
            kth = np.maximum(kth, np.partition(surely, -k, axis=1)[:, -k])
        fits = (near + error >= kth[:, None]) & other
        scores = np.zeros(near.shape, np.int64)
        known = fits & (error == 0)
        scores[known] = np.rint(near[known]).astype(np.int64)
        whole = [[int(x) for x in v] for v in leaf.tolist()]
        for row in np.flatnonzero((fits & ~known).any(axis=1)).tolist():
            query = [int(x) for x in queries[row].tolist()]
            for column in np.flatnonzero(fits[row] & ~known[row]).tolist():
                scores[row, column] = min(max(sum(map(mul, query, whole[column])), -MOST), MOST)
        return scores, fits

    def search(self, query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int):
        """Per query the candidates that may be among its k best: (query row, id, score)."""
        floats = queries.astype(np.float64)
        norms = np.sqrt((floats**2).sum(axis=1))
        bounds = floats @ self.centres.T + norms[:, None] * self.radii[None, :]
        # Large terms that cancel leave an error in proportion to them, not to their sum.
        size = np.sqrt((self.centres**2).sum(axis=1)) + self.radii
        bounds += 1e-6 * (1 + np.abs(bounds)) + 1e-9 * norms[:, None] * size[None, :]
        kth = np.where(least <= LOWEST, -np.inf, least.astype(np.float64))
        best = [np.empty((0, 2), np.int64) for _ in queries]
        pending = [(0, np.arange(len(queries)))]
        while pending:
            node, rows = pending.pop()
            rows = rows[bounds[rows, node] >= kth[rows]]
            if not len(rows):
                continue
            first, stop, left, right = self.nodes[node][:4]
            if left >= 0:
                ahead = bounds[rows, left].sum() < bounds[rows, right].sum()
                # The last one put down is opened next.
                pending += [(left, rows), (right, rows)] if ahead else [(right, rows), (left, rows)]
                continue
            ids = self.ids[first:stop]
            other = ids[None, :] != query_ids[rows][:, None]
            scores, fits = self._scores(floats[rows], norms[rows], kth[rows], slice(first, stop), other, k)
            for at in np.flatnonzero(fits.any(axis=1)).tolist():
                row, found = rows[at], np.flatnonzero(fits[at])
                both = np.concatenate([best[row], np.stack([scores[at, found], ids[found]], axis=1)])
                if len(both) >= k:
                    both = both[np.lexsort((both[:, 1], -both[:, 0]))[:k]]
                    kth[row] = max(kth[row], both[-1, 0])
                best[row] = both
        rows = np.repeat(np.arange(len(queries)), [len(b) for b in best])
        both = np.concatenate(best) if best else np.empty((0, 2), np.int64)
        return rows, both[:, 1], both[:, 0]


def _matrix(raw: bytes, size: int, rows: int) -> np.ndarray:
    """Vectors back from bytes: 32-bit integers, or doubles where a group needs them."""
    return np.frombuffer(raw, "<i4" if len(raw) == 4 * size * rows else "<f8").reshape(-1, size)


def _packed(rows: DataFrame, group: str, size: int, columns: list[str]) -> DataFrame:
    """One row per group: its ids and vectors (and kth scores) as bytes."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id", kind="stable")
        vectors = np.zeros((len(frame), size), "<f8")
        for k, v in enumerate(frame["v"]):
            vectors[k, : len(v)] = v
        largest = np.abs(vectors).max()
        if largest >= 2.0**500:
            raise OverflowError("a scaled component of a vector is 2**500 or more")
        if largest < 2.0**31:
            vectors = vectors.astype("<i4")
        out = {group: [frame[group].iloc[0]], "ids": [frame["vec_id"].to_numpy("<i8").tobytes()], "vectors": [vectors.tobytes()]}
        if "kth" in columns:
            out["kth"] = [frame["kth"].to_numpy("<i8").tobytes()]
        return pd.DataFrame(out)

    extra = ", kth binary" if "kth" in columns else ""
    return rows.groupBy(group).applyInPandas(run, f"{group} int, ids binary, vectors binary{extra}")


def _searched(cells: DataFrame, size: int, k: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids, query_ids = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.query_ids, "<i8")
                shard = Shard(ids, _matrix(row.vectors, size, len(ids)))
                queries = _matrix(row.queries, size, len(query_ids))
                found, ids, scores = shard.search(query_ids, queries, np.frombuffer(row.kth, "<i8"), k)
                yield pd.DataFrame({"query_id": query_ids[found], "vec_id": ids, "score": scores})

    return cells.select("query_ids", "queries", "kth", "ids", "vectors").mapInPandas(
        run, "query_id long, vec_id long, score long"
    )


def top_k(
    vectors: DataFrame,
    is_query: F.Column,
    k: int = K,
    scale: int = SCALE,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score of each query row's k best other rows."""
    rows, _ = common.stored(quantized(vectors, scale), "topk-vectors")
    stats = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("size")).first()
    queries = rows.where(is_query)
    n_queries = queries.count()
    if not stats["size"] or not n_queries:
        empty = "query_id long, rank int, vec_id long, score long"
        return vectors.sparkSession.createDataFrame([], empty)
    size, n_shards = stats["size"], -(-stats["n"] // shard_rows)
    n_blocks = -(-n_queries // block_queries)
    spread = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    shards, _ = common.stored(_packed(rows.withColumn("shard", spread(n_shards)), "shard", size, []), "topk-shards")
    queries = queries.withColumn("block", spread(n_blocks * 7_919) % n_blocks).withColumn("kth", F.lit(LOWEST).cast("long"))

    def against(blocks: DataFrame, targets: F.Column) -> DataFrame:
        blocks = blocks.withColumnsRenamed({"ids": "query_ids", "vectors": "queries"})
        cells = blocks.withColumn("shard", F.explode(targets)).join(shards, "shard")
        return _searched(cells.repartition(F.col("block"), F.col("shard")), size, k)

    home = F.pmod(F.col("block"), F.lit(n_shards)).cast("int")
    first, _ = common.stored(against(_packed(queries, "block", size, ["kth"]), F.array(home)), "topk-first")
    reached = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low"))
    reached = reached.where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), "low")
    bounded = queries.join(reached, "vec_id", "left").withColumn("kth", F.coalesce("low", "kth")).drop("low")
    others = F.filter(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: s != home)
    rest = against(_packed(bounded, "block", size, ["kth"]), others)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    score = F.when(F.abs("score") < MOST, F.col("score")).otherwise(F.raise_error("a score does not fit 64 bits"))
    return ranked.select("query_id", "rank", "vec_id", score.cast("long").alias("score"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other rows of every row whose vec_id is divisible by 20."""
    return top_k(common.read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
