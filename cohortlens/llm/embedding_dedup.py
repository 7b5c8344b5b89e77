"""Embedding near-duplicates: a subspace pigeonhole join, checked exactly."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.session import materialise

from .common import connected_components

#: Dimensions of a block, vectors a cell is planned for, sample rows the cells are cut from (at most),
#: sample rows a cell needs, and rows of one side that a task compares at once.
BLOCK, CELL_ROWS, SAMPLE_ROWS, CELL_SAMPLE, CHUNK = 8, 1000, 100_000, 16, 4096
SEED = 11


def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation; it spreads a difference evenly over the blocks."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def block_columns(dim: int) -> list[np.ndarray]:
    return np.array_split(np.arange(dim), max(1, -(-dim // BLOCK)))


def unit_rows(column: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in column])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cut_cells(points: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper corners of boxes that fill the space, halved at medians of the widest side."""
    boxes = [(np.full(points.shape[1], -np.inf), np.full(points.shape[1], np.inf), points)]
    done = []
    while boxes and len(boxes) + len(done) < leaves:
        boxes.sort(key=lambda b: len(b[2]))
        lo, hi, own = boxes.pop()
        if len(own) < 2 * CELL_SAMPLE:
            done.append((lo, hi, own))
            continue
        axis = int(np.argmax(own.std(axis=0)))
        at = float(np.median(own[:, axis]))
        left = own[:, axis] < at
        if not left.any() or left.all():
            done.append((lo, hi, own))
            continue
        upper, lower = hi.copy(), lo.copy()
        upper[axis], lower[axis] = at, at
        boxes += [(lo, upper, own[left]), (lower, hi, own[~left])]
    done += boxes
    return np.stack([b[0] for b in done]), np.stack([b[1] for b in done])


def _plan(vectors: DataFrame, dims: dict[int, int], budget: float) -> dict[int, list[tuple]]:
    """For each vector length: cells of every block, from a bounded sample, and the block's radius."""
    plan = {}
    for dim, n in dims.items():
        sample = vectors.filter(F.size("vec") == dim).orderBy(F.xxhash64("node"), "node").limit(min(SAMPLE_ROWS, max(4096, n // 50)))
        points = unit_rows(sample.select("vec").toPandas().vec) @ rotation(dim)
        leaves = max(1, -(-n // CELL_ROWS))
        plan[dim] = [
            (*cut_cells(points[:, c], leaves), np.sqrt(budget * len(c) / dim) + 1e-5) for c in block_columns(dim)
        ]
    return plan


def _placed(vectors: DataFrame, shared) -> DataFrame:
    """Rows of each vector for every block and cell it lies in (``home``) or comes near enough to."""

    def run(batches):
        plan = shared.value
        for pdf in batches:
            sizes = pdf["vec"].map(len)
            for dim, part in pdf.groupby(sizes):
                x = unit_rows(part["vec"]) @ rotation(int(dim))
                nodes = part["node"].to_numpy()
                for b, (columns, (lo, hi, radius)) in enumerate(zip(block_columns(int(dim)), plan[int(dim)])):
                    y = x[:, columns]
                    data = y.astype(np.float32)
                    for cell in range(len(lo)):
                        gap = np.maximum(np.maximum(lo[cell] - y, y - hi[cell]), 0)
                        near = np.flatnonzero((gap * gap).sum(axis=1) <= radius * radius)
                        if len(near):
                            home = ((y[near] >= lo[cell]) & (y[near] < hi[cell])).all(axis=1)
                            yield pd.DataFrame(
                                {"dim": int(dim), "block": b, "cell": cell, "home": home, "node": nodes[near], "at": [data[i].tobytes() for i in near]}
                            )

    return vectors.mapInPandas(run, "dim int, block int, cell int, home boolean, node long, at binary")


def _near_pairs(shared):
    """Pairs of a home row and a near row of one cell whose block distance is within its share."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out_a, out_b = [], []
        dim, block = int(pdf["dim"].iloc[0]), int(pdf["block"].iloc[0])
        limit = np.float32(shared.value[dim][block][2] ** 2 + 1e-6)
        side = pdf["left"].to_numpy()
        node, at = pdf["node"].to_numpy(), np.frombuffer(b"".join(pdf["at"]), np.float32).reshape(len(pdf), -1)
        h, hn, n, nn = at[side], node[side], at[~side], node[~side]
        if len(h) and len(n):
            # squared distance as one product: |h|^2 + |n|^2 - 2 h n
            right = np.concatenate([-2 * n, (n * n).sum(axis=1)[:, None], np.ones((len(n), 1), np.float32)], axis=1).T.copy()
            for i in range(0, len(h), 512):
                own = h[i : i + 512]
                left = np.concatenate([own, np.ones((len(own), 1), np.float32), (own * own).sum(axis=1)[:, None]], axis=1)
                r, c = np.nonzero(left @ right <= limit)
                a, b = hn[i + r], nn[c]
                keep = a < b
                out_a.append(a[keep])
                out_b.append(b[keep])
        a = np.concatenate(out_a) if out_a else np.zeros(0, np.int64)
        return pd.DataFrame({"a": a, "b": np.concatenate(out_b) if out_b else a})

    return run


@F.pandas_udf(T.DoubleType())
def _cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    x, y = (np.stack([np.asarray(v, dtype=np.float64) for v in s]) if len(s) else np.zeros((0, 1)) for s in (a, b))
    return pd.Series((x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))))


def candidate_pairs(vectors: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a < b`` of nodes that may have a cosine of ``threshold``; none with it is missing.

    Unit vectors with that cosine differ by at most 2 - 2 threshold in squared distance, so in
    at least one block of the rotated vectors by at most the block's share. Each block is
    range-joined on its own: a vector goes to its own cell and to each cell its ball touches, and
    is compared there with the vectors at home in it. Large cells are dealt out as chunk by
    chunk comparisons, so no task holds more than two chunks.
    """
    spark = vectors.sparkSession
    dims = {r.d: r.n for r in vectors.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = _plan(vectors, dims, 2 - 2 * threshold + 1e-9)
    shared = spark.sparkContext.broadcast(plan)  # a few numbers for each cell; cells are bounded by the sample
    placed = materialise(_placed(vectors, shared), "cells")
    key = ["dim", "block", "cell"]
    chunks = placed.groupBy(*key).agg(
        F.ceil(F.count_if("home") / CHUNK).cast("int").alias("rows"), F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("others")
    )
    sized = placed.join(F.broadcast(chunks.filter("rows > 0")), key)
    draw = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    left = sized.filter("home").select(*key, F.lit(True).alias("left"), "node", "at", draw("rows").alias("i"), F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("j"))
    right = sized.select(*key, F.lit(False).alias("left"), "node", "at", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), draw("others").alias("j"))
    return left.union(right).groupBy(*key, "i", "j").applyInPandas(_near_pairs(shared), "a long, b long").distinct()


def embedding_classes(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row; links are cosines >= ``threshold``.

    Equal vectors are compared once, as one node with a number of rows. Vectors that are null,
    empty, zero, or hold null or non-finite components link with nothing; nor do vectors of different
    lengths. Rows that repeat an id are rows of one document: each row is counted as a link of the
    others only if its id differs. A null id has a null component. Ids must be whole numbers.
    """
    v = F.col(vector)
    usable = (
        F.col(id).isNotNull()
        & v.isNotNull()
        & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        & F.exists(v, lambda c: c != 0)
    )
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.when(usable, v.cast("array<double>")).alias("vec"))
    used = rows.filter("vec is not null").groupBy("vec").agg(F.min("id").alias("first"), F.count_distinct("id").alias("many"))
    # a node's number is its own, so that one id with two vectors is two nodes
    nodes = materialise(used.select(F.xxhash64("vec").alias("node"), "vec", "first", "many"), "nodes")
    if nodes.isEmpty():
        return _result(rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")))
    pairs = candidate_pairs(nodes.select("node", "vec"), threshold)
    of = lambda s: nodes.select(F.col("node").alias(s), F.col("vec").alias(f"v{s}"))
    links = pairs.join(of("a"), "a").join(of("b"), "b").filter(_cosine("va", "vb") >= threshold).select("a", "b")
    links = materialise(links, "links")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weights = nodes.select(F.col("node").alias("b"), "many")
    counts = both.join(weights, "b").groupBy(F.col("a").alias("node")).agg(F.sum("many").alias("linked"))
    # ids that share a node, or nodes that share an id, are in one component
    members = rows.filter("vec is not null").select("id", F.xxhash64("vec").alias("node")).distinct()
    firsts = nodes.select("node", "first")
    hang = members.join(firsts, "node").filter("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    name = lambda s: firsts.select(F.col("node").alias(s), F.col("first").alias(f"f{s}"))
    named = links.join(name("a"), "a").join(name("b"), "b").select(F.col("fa").alias("a"), F.col("fb").alias("b"))
    components = connected_components(named.union(hang), "a", "b").withColumnsRenamed({"id": "_id"})
    placed = rows.withColumn("node", F.xxhash64("vec")).drop("vec").join(nodes.select("node", "many"), "node", "left").join(counts, "node", "left")
    own = F.coalesce("linked", F.lit(0)) + F.coalesce(F.col("many") - 1, F.lit(0))
    return _result(
        placed.join(components, F.col("id") == F.col("_id"), "left").select("id", own.cast("long").alias("n_links"), F.coalesce("component", "id").alias("component"))
    )


def _result(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept")
    )
