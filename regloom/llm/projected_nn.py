"""Nearest neighbours by inner product from low-dimensional stable projections.

Vectors are lifted to a common length (one more coordinate), where the largest
inner product is the smallest Euclidean distance. Blocks of vectors are
projected to ``DIMS`` Gaussian coordinates and indexed by a kd-tree. For a
query, leaves come in order of projected distance and their vectors are
verified with full precision; the squared projected distance of anything still
unseen, over the squared distance of the current last neighbour, is held
against the chi-square distribution with ``DIMS`` degrees of freedom: the
search in a block stops when a nearer vector would have come earlier with
probability ``SURE``.

Every vector is indexed; blocks hold vectors of one dimension and similar
length, are random within these bands and of bounded size, and lift to the
longest vector of their own. Every query visits every block in chunks of bounded
size, so a task holds one block and one chunk. The blocks' answers are merged by
partial top-k per query.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part; vectors of different length are different spaces;
equal vectors have equal scores and come by smaller id; rows that share an id are
queries and candidates of their own, so such an id has as many answers as rows;
null ids take no part; fewer candidates than wanted give all; other columns
are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .staging import materialize

DIMS = 8
LEAF = 64
BLOCK = 16_384
CHUNK = 512
#: Confidence, for each nearer vector, that it was seen before a block's search stops.
SURE = 0.99
#: Bands of length, each a quarter power of two, from the longest down; the last holds all shorter.
BANDS = 32
#: Leaves verified between two tests.
STEP = 16
WANTED = 20
SEED = 7


def chi_square_cdf(x: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """For even degrees of freedom: one minus a Poisson tail."""
    half = np.asarray(x, float) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, dims // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


class Tree:
    """Balanced kd-tree over points; leaves are ranges of a permutation."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        bounds = []
        todo = [(0, len(points))]
        while todo:
            a, b = todo.pop()
            if b - a <= leaf:
                bounds.append((a, b))
                continue
            part = points[self.order[a:b]]
            axis = int(np.argmax(part.max(0) - part.min(0)))
            middle = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(part[:, axis], middle, kind="introselect")]
            todo += [(a, a + middle), (a + middle, b)]
        self.leaves = sorted(bounds)
        self.low = np.array([points[self.order[a:b]].min(0) for a, b in self.leaves])
        self.high = np.array([points[self.order[a:b]].max(0) for a, b in self.leaves])

    def distances(self, query: np.ndarray) -> np.ndarray:
        """Squared distance from a query to the box of each leaf."""
        gap = np.maximum(0, np.maximum(self.low - query, query - self.high))
        return np.einsum("ij,ij->i", gap, gap)


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each summed in one order, so equal vectors have equal ones."""
    return np.ascontiguousarray(vectors * query).sum(axis=1)


def search(block: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray,
           wanted: int = WANTED, sure: float = SURE, dims: int = DIMS, rows: np.ndarray | None = None,
           query_rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, candidate id, inner product) of each query's best in a block, and the
    number of verified vectors. A query is named, and told from its own vector, by
    ``query_rows`` and ``rows``, or where these are not given by the ids."""
    rows, query_rows = ids if rows is None else rows, query_ids if query_rows is None else query_rows
    width = block.shape[1]
    directions = np.random.default_rng(SEED).standard_normal((width + 1, dims))

    def projected(x: np.ndarray, lift: np.ndarray) -> np.ndarray:
        return x @ directions[:-1] + lift[:, None] * directions[-1]

    squares = np.einsum("ij,ij->i", block, block)
    longest = float(np.sqrt(squares.max()))
    points = projected(block, np.sqrt(np.maximum(longest ** 2 - squares, 0)))
    tree = Tree(points)
    ranked = [tree.order[a:b] for a, b in tree.leaves]
    # Scaling a query to the common length changes no order of inner products.
    norms = np.sqrt(np.einsum("ij,ij->i", queries, queries))
    images = projected(queries * (longest / norms)[:, None], np.zeros(len(queries)))
    out_q, out_c, out_s, seen = [], [], [], 0
    slack = 1e-12 * longest * width  # more than products in another order can differ, per unit of the query
    for query, query_row, norm, image in zip(queries, query_rows.tolist(), norms, images):
        boxes = tree.distances(image)
        leaves = np.argsort(boxes, kind="stable")
        best_s, best = np.zeros(0), np.zeros(0, np.int64)
        at = 0
        while at < len(leaves):
            some = np.concatenate([ranked[k] for k in leaves[at:at + STEP].tolist()])
            at += STEP
            seen += len(some)
            scores = block[some] @ query
            if len(best_s) >= wanted:
                some = some[scores >= best_s[-1] - slack * norm]
            elif len(some) > wanted:
                some = some[scores >= np.partition(scores, -wanted - 1)[-wanted - 1] - slack * norm]
            some = some[rows[some] != query_row]
            best_s, best = np.concatenate((best_s, products(block[some], query))), np.concatenate((best, some))
            top = np.lexsort((rows[best], ids[best], -best_s))[:wanted]
            best_s, best = best_s[top], best[top]
            if at < len(leaves) and len(best_s) >= wanted:
                # Copies of the last one lie at its projected place: its distance is passed first.
                gap = points[best[best_s == best_s[-1]]] - image
                if boxes[leaves[at]] <= np.einsum("ij,ij->i", gap, gap).max() * (1 + 1e-9):
                    continue
                last = 2 * longest ** 2 - 2 * best_s[-1] * longest / norm
                if last <= 0 or chi_square_cdf(boxes[leaves[at]] / last, dims) >= sure:
                    break
        out_q.append(np.full(len(best_s), query_row))
        out_c.append(ids[best])
        out_s.append(best_s)
    return np.concatenate(out_q), np.concatenate(out_c), np.concatenate(out_s), seen


def usable(rows: DataFrame, id_: str, vector: str) -> DataFrame:
    """(vec_id, v, dim, square) of the vectors that take part, in double precision."""
    v = F.col(vector).cast("array<double>")
    square = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    found = rows.select(F.col(id_).cast("long").alias("vec_id"), v.alias("v"), F.when(fine, square).alias("square"))
    return (found.filter("vec_id IS NOT NULL AND size(v) > 0 AND square > 0 AND square < double('infinity')")
            .withColumn("dim", F.size("v")))


def nearest(rows: DataFrame, every: int = 20, wanted: int = WANTED, sure: float = SURE, id_: str = "vec_id",
            vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by
    ``every``, its nearest among all other rows."""
    used = materialize(usable(rows, id_, vector).withColumn("row", F.monotonically_increasing_id()), "vectors").withColumn(
        "band", F.floor(2 * F.log2("square") + 0.5))
    counts = used.groupBy("dim", "band").agg(F.count(F.lit(1)).alias("n"))
    lowest = F.max("band").over(Window.partitionBy("dim")) - (BANDS - 1)
    counts = (counts.withColumn("lowest", lowest).groupBy("dim", "lowest", F.greatest("band", "lowest").alias("band"))
              .agg(F.sum("n").alias("n")))
    facts = counts.groupBy("dim", "lowest").agg(F.sum("n").alias("_n"), F.map_from_entries(F.collect_list(
        F.struct("band", F.ceil(F.col("n") / block)))).alias("blocks"))
    spread = used.join(F.broadcast(facts), "dim").withColumn("band", F.greatest("band", "lowest"))  # a row per dimension
    placed = spread.withColumn("block", F.pmod(F.xxhash64("row"), F.element_at("blocks", F.col("band"))))
    asked = spread.filter(F.col("vec_id") % every == 0).withColumn(
        "chunk", F.pmod(F.xxhash64(F.lit("q"), "row"), F.ceil(F.col("_n") / every / CHUNK))).drop("band")
    # A query goes to every block; a block goes to every chunk of queries.
    chunks = F.sequence(F.lit(0).cast("long"), F.ceil(F.col("_n") / every / CHUNK) - 1)
    held = placed.withColumn("chunk", F.explode(chunks)).select(
        "dim", "band", "block", "chunk", "row", "vec_id", "v", F.lit(False).alias("query"))
    sent = asked.select("*", F.explode("blocks").alias("band", "_count")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_count") - 1))).select(
        "dim", "band", "block", "chunk", "row", "vec_id", "v", F.lit(True).alias("query"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        asks, has = frame[frame["query"]], frame[~frame["query"]]
        if not len(asks) or not len(has):
            return pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": []})
        q, c, s, _ = search(np.stack(has["v"].to_list()), has["vec_id"].to_numpy(), np.stack(asks["v"].to_list()),
                            asks["vec_id"].to_numpy(), wanted, sure, rows=has["row"].to_numpy(), query_rows=asks["row"].to_numpy())
        return pd.DataFrame({"row": q, "query_id": asks.set_index("row")["vec_id"].loc[q].to_numpy(), "vec_id": c, "score": s})

    found = held.unionByName(sent).groupBy("dim", "band", "block", "chunk").applyInPandas(
        run, "row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
