"""Exact k-nearest-neighbour votes as a partitioned distance join.

Rows go to the nearest of a fixed number of pivots. The triangle inequality says which cells can
hold one of a row's k nearest (Lu et al. 2012), so only those cells are searched. Rows of a cell are
packed into blocks of bounded size and block pairs are compared as matrices: no task holds a
whole cell, and a block pair gives back at most k rows per query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numbers import hash_number
from millrace.operators.ordering import store

_DIGITS = 9  # distances are compared to this many digits, so equal vectors tie in any block


def _to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((x[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2), 0.0))


def _near_mask(q: np.ndarray, x: np.ndarray, squares: np.ndarray, k: int) -> np.ndarray:
    """(queries, rows): those that may be among the k nearest, from one matrix product. ``squares`` are the rows' own."""
    own = (q * q).sum(axis=1)
    rough = squares - 2 * (q @ x.T) + own[:, None]
    n = min(k, len(x))
    edge = np.partition(rough, n - 1, axis=1)[:, n - 1]
    # the product's rounding is far below this room; the distances that count are taken anew
    room = 1e-6 * (1 + squares.max() + own)
    # turned round, so a distance that is no number stays in
    return ~(rough > (edge + room)[:, None])


def _nearest(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of each query's k nearest rows, ties in distance by id."""
    which, rows = np.nonzero(_near_mask(q, x, (x * x).sum(axis=1), k))
    d = np.round(np.sqrt(((x[rows] - q[which]) ** 2).sum(axis=1)), _DIGITS)
    order = np.lexsort((ids[rows], d, which))
    which, rows, d = which[order], rows[order], d[order]
    best = np.arange(len(which)) - np.searchsorted(which, which) < k
    return which[best], rows[best], d[best]


def _pieces(pdf: pd.DataFrame, rows: int):
    for start in range(0, len(pdf), rows):
        yield pdf.iloc[start : start + rows]


def _vote(table: pd.DataFrame, k: int):
    """A function of (vectors, fold) to predictions: majority of the k nearest rows of other folds in ``table``."""
    vectors = {}
    for fold in [None, *table["fold"].unique()]:
        others = table[table["fold"] != fold]
        x = np.array(others["vec"].tolist(), dtype=float) if len(others) else np.zeros((0, 0))
        vectors[fold] = (x, (x * x).sum(axis=1), others["id"].to_numpy(), others["label"].to_numpy())

    def predict(q: np.ndarray, fold: int) -> list[int | None]:
        x, squares, ids, labels = vectors.get(fold, vectors[None])
        if not len(x):
            return [None] * len(q)
        out = []
        for row, near in zip(q, _near_mask(q, x, squares, k), strict=True):
            at = np.flatnonzero(near)
            d = np.round(np.sqrt(((x[at] - row) ** 2).sum(axis=1)), _DIGITS)
            best = at[np.lexsort((ids[at], d))[:k]]
            found, votes = np.unique(labels[best], return_counts=True)
            out.append(int(found[votes.argmax()]))
        return out

    return predict


def knn_fitted(points: DataFrame, k: int = 5, sample: int = 4096, seed: int = 0) -> DataFrame:
    """Out-of-fold majority vote of the k nearest rows of other folds among a drawn sample, in linear work.

    The model is the ``sample`` rows of least seeded hash (all, if there are fewer): a documented bound, so it is
    broadcast, and each batch of rows is compared with it as one matrix product. ``points`` and result are those of
    :func:`knn_classify`, ties too; a row without other folds in the sample has a null prediction.
    """
    drawn = points.orderBy(hash_number(seed, "id"), "id").limit(sample).select("id", "vec", "label", "fold").toPandas()
    sent = points.sparkSession.sparkContext.broadcast(drawn)

    def classify(batches):
        predict = _vote(sent.value, k)
        for batch in batches:
            for pdf in _pieces(batch, 512):
                predicted = pd.Series(pd.NA, index=pdf.index, dtype="Int32")
                for fold, part in pdf.groupby("fold"):
                    predicted.loc[part.index] = predict(np.array(part["vec"].tolist(), dtype=float), int(fold))
                yield pdf[["id", "fold", "label"]].assign(predicted=predicted)

    return points.select("id", "fold", "label", "vec").mapInPandas(classify, "id bigint, fold int, label int, predicted int")


def knn_classify(
    points: DataFrame, k: int = 5, n_pivots: int = 32, block: int = 1024, seed: int = 0
) -> DataFrame:
    """Out-of-fold majority vote of the k nearest rows of other folds.

    ``points`` has (id bigint, vec array<double>, label int, fold int); the result is
    (id, fold, label, predicted). Ties in distance go to the smaller id, ties in votes to
    the smaller label.
    """
    points = store(points.select("id", "vec", "label", "fold"), "knn-points")
    # a fixed number of rows, whatever the table's size
    centres = points.orderBy(hash_number(seed, "id"), "id").limit(n_pivots).select("vec").collect()
    pivots = np.array([row["vec"] for row in centres], dtype=float)

    def to_cells(batches):
        for batch in batches:
            for pdf in _pieces(batch, 4096):
                d = _to_pivots(np.array(pdf["vec"].tolist(), dtype=float), pivots)
                cell = d.argmin(axis=1)
                yield pdf.assign(cell=cell.astype("int32"), dist=d[np.arange(len(pdf)), cell])

    placed = store(
        points.mapInPandas(to_cells, "id bigint, vec array<double>, label int, fold int, cell int, dist double"),
        "knn-cells",
    )
    # at most pivots x folds rows
    stats = placed.groupBy("cell", "fold").agg(F.count("*").alias("n"), F.max("dist").alias("r")).toPandas()
    folds = sorted(int(f) for f in stats["fold"].unique())
    size, radius = {}, {}
    for f in folds:
        others = stats[stats["fold"] != f]
        size[f] = np.bincount(others["cell"], weights=others["n"], minlength=len(pivots))
        radius[f] = np.zeros(len(pivots))
        np.maximum.at(radius[f], others["cell"].to_numpy(), others["r"].to_numpy())
    blocks = np.maximum(1, -(-np.bincount(stats["cell"], weights=stats["n"], minlength=len(pivots)) // block))
    n_blocks = [int(b) for b in blocks]

    def reachable(batches):
        """The cells that may hold a query's neighbours: no farther than k rows surely are."""
        for batch in batches:
            for pdf in _pieces(batch, 4096):
                d = _to_pivots(np.array(pdf["vec"].tolist(), dtype=float), pivots)
                cells = []
                for row, fold in zip(d, pdf["fold"]):
                    n, r = size[int(fold)], radius[int(fold)]
                    upper = np.where(n > 0, row + r, np.inf)
                    nearest = np.argsort(upper, kind="stable")
                    enough = np.searchsorted(np.cumsum(n[nearest]), k)
                    limit = upper[nearest[min(enough, len(nearest) - 1)]]
                    cells.append(np.flatnonzero((n > 0) & (row - r <= limit + 1e-6)).tolist())
                yield pdf[["id", "vec", "fold"]].assign(cells=cells)

    block_of = F.pmod(F.xxhash64("id"), F.element_at(F.lit(n_blocks), F.col("cell") + 1)).alias("part")
    queries = (
        placed.mapInPandas(reachable, "id bigint, vec array<double>, fold int, cells array<int>")
        .select("id", "vec", "fold", F.explode("cells").alias("cell"))
        .withColumn("part", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-int(stats["n"].sum()) // block)))))
        .groupBy("cell", "fold", "part")
        .agg(F.collect_list(F.struct("id", "vec")).alias("q"))
        .select("cell", "fold", F.col("part").alias("q_part"), F.col("q.id").alias("q_id"), F.col("q.vec").alias("q_vec"))
    )
    train = (
        placed.withColumn("part", block_of)
        .groupBy("cell", "part")
        .agg(F.collect_list(F.struct("id", "vec", "label", "fold")).alias("t"))
        .select(
            "cell", F.col("t.id").alias("t_id"), F.col("t.vec").alias("t_vec"),
            F.col("t.label").alias("t_label"), F.col("t.fold").alias("t_fold"),
        )
    )

    def compare(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                keep = np.flatnonzero(np.asarray(row.t_fold) != row.fold)
                if not len(keep):
                    continue
                t_id = np.asarray(row.t_id)[keep]
                t_label = np.asarray(row.t_label)[keep]
                t = np.array(list(row.t_vec), dtype=float)[keep]
                q_id = np.asarray(row.q_id)
                q = np.array(list(row.q_vec), dtype=float)
                for start in range(0, len(q), 256):
                    which, rows, d = _nearest(q[start : start + 256], t, t_id, k)
                    yield pd.DataFrame({"id": q_id[start + which], "d": d, "n_id": t_id[rows], "n_label": t_label[rows]})

    near = queries.join(train, "cell").mapInPandas(compare, "id bigint, d double, n_id bigint, n_label int")
    # rank filters run before the shuffle too, so a query brings k rows per task at most
    rank = F.row_number().over(Window.partitionBy("id").orderBy("d", "n_id"))
    votes = near.withColumn("rank", rank).where(F.col("rank") <= k).groupBy("id", "n_label").agg(
        F.count("*").alias("votes")
    )
    winner = votes.groupBy("id").agg(
        F.max(F.struct(F.col("votes"), (-F.col("n_label")).alias("minus_label"))).alias("w")
    ).select("id", (-F.col("w.minus_label")).alias("predicted"))
    return placed.select("id", "fold", "label").join(winner, "id")
