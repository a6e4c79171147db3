"""Whitening of embeddings by shifted CholeskyQR over distributed Gram matrices."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstrata.llm.dense import part_number, rows_of, schema, tree_sum

SCALE, OFFSET = 1024, 100_000
# Entries of a block of rows that a task holds at once.
ENTRIES = 1 << 20
MAX_PASSES = 8
MAX_WIDTH = 4096
# Components whose spread is below this share of the first one's are rounding, not data.
RANK = 1e-11
UNIT = np.finfo(float).eps / 2
LOW32 = (1 << 32) - 1
ROW = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Fit:
    """What every task needs: count and sums (exact), components (columns), their figures."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray  # width x components, scaled so that projections have variance 1
    explained: np.ndarray
    identity_error: float = 0.0


def whole_numbers(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, x) of the rows that take part, by length of vector: x = floor(1024 c) + 100000."""
    sizes = np.asarray(lists.value_lengths().fill_null(0))
    starts = np.r_[0, np.cumsum(sizes)]
    flat = np.asarray(lists.flatten().cast(pa.float64()).fill_null(np.nan))
    for width in np.unique(sizes[sizes > 0]):
        step = max(1, ENTRIES // int(width))
        places = np.flatnonzero(sizes == width)
        for lo in range(0, len(places), step):
            at = places[lo : lo + step]
            scaled = np.floor(flat[starts[at][:, None] + np.arange(width)] * SCALE)
            fits = (np.abs(scaled) < 2.0**62).all(axis=1)  # false for nan and infinities too
            yield at[fits], scaled[fits].astype(np.int64) + OFFSET


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n x - S, exactly: as 64-bit numbers where they fit, else as Python's."""
    if not len(x):
        return x
    largest = n * max(int(x.max()), -int(x.min())) + max(map(abs, sums))
    if largest < 1 << 62:
        return n * x - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def squares(deviation: np.ndarray) -> list[int | None]:
    """Exact sum of squares per row; None where it does not fit a long."""
    if not len(deviation):
        return []
    largest = max(int(deviation.max()), -int(deviation.min()))
    if largest * largest * deviation.shape[1] < 1 << 63:
        return (deviation.astype(np.int64) ** 2).sum(axis=1).tolist()
    totals = [sum(int(v) * int(v) for v in row) for row in deviation]
    return [t if t < 1 << 63 else None for t in totals]


def solve(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular matrix, column by column."""
    done = np.empty_like(rows)
    for j in range(upper.shape[0]):
        done[:, j] = (rows[:, j] - done[:, :j] @ upper[:j, j]) / upper[j, j]
    return done


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and sums per length of vector, high and low halves apart so that none overflows."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, x in whole_numbers(batch.column(1)):
            if len(x):
                part = np.r_[len(x), (x >> 32).sum(axis=0), (x & LOW32).sum(axis=0)]
                width = x.shape[1]
                total[width] = total[width] + part if width in total else part
    for width, values in total.items():
        yield rows_of(np.array([width]), part_number(), values[None, :])


def _gram(n: int, sums: tuple[int, ...], project: Callable[[np.ndarray], np.ndarray]):
    """Partial Gram matrices of projected centred rows, one row of the matrix per block."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in whole_numbers(batch.column(1)):
                if x.shape[1] != len(sums) or not len(x):
                    continue
                rows = project(deviations(x, n, sums).astype(float) / n)
                part = rows.T @ rows
                total = part if total is None else total + part
        if total is not None:
            yield rows_of(np.arange(len(total)), part_number(), total)

    return add


def _collect_gram(rows: DataFrame, n: int, sums: tuple[int, ...], project) -> np.ndarray:
    """The whole Gram matrix on the driver: width squared numbers, whatever the row count."""
    parts = rows.mapInArrow(_gram(n, sums, project), schema("double"))
    found = {r["block"]: r["values"] for r in tree_sum(parts, "double").collect()}
    return np.array([found[i] for i in range(len(found))])


def cholesky(gram: np.ndarray, shift: float, always: bool) -> np.ndarray:
    """Upper factor of a Gram matrix; shifted by ``shift`` at first or where it must be."""
    eye = np.eye(len(gram))
    if not always:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    while True:
        try:
            return np.linalg.cholesky(gram + shift * eye).T
        except np.linalg.LinAlgError:
            shift *= 100


def _root(gram: np.ndarray) -> np.ndarray:
    """Symmetric square root of a matrix that may lack full rank."""
    values, vectors = np.linalg.eigh(gram)
    return vectors * np.sqrt(np.maximum(values, 0)) @ vectors.T


def triangular_factor(rows: DataFrame, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """A factor T with T'T = Y'Y of the centred rows Y, without squaring its condition.

    Pass k forms the Gram matrix of Y solved by all earlier factors and adds its Cholesky
    factor, the first one shifted so that rounding cannot break it. It ends when the rows
    are orthonormal. Where they lack full rank they never are; the last Gram matrix then
    enters by its square root, which is the unit matrix otherwise, so T is right either way.
    """
    width = len(sums)
    factors: list[np.ndarray] = []

    def project(y: np.ndarray) -> np.ndarray:
        for upper in factors:
            y = solve(y, upper)
        return y

    for k in range(MAX_PASSES):
        gram = _collect_gram(rows, n, sums, project)
        if factors and np.abs(gram - np.eye(width)).max() <= 100 * width * UNIT:
            break
        if not np.trace(gram) > 0:
            return np.zeros((width, width))
        if k == MAX_PASSES - 1:
            break
        # Sums run over blocks of bounded size and then up a tree, so this bound needs no n.
        shift = 11 * (ENTRIES + width * (width + 1)) * UNIT * float(np.trace(gram))
        factors.append(cholesky(gram, shift, always=k == 0))
    composed = np.eye(width)
    for upper in factors:
        composed = upper @ composed
    return _root(gram) @ composed


def _fit(rows: DataFrame, components: int) -> Fit | None:
    by_width = tree_sum(rows.mapInArrow(_sums, schema("long")), "long")
    # The commonest length, ties to the longer: one row to the driver.
    best = by_width.orderBy(F.col("values")[0].desc(), F.col("block").desc()).limit(1).collect()
    if not best:
        return None
    width, values = best[0]["block"], best[0]["values"]
    if width > MAX_WIDTH:
        raise ValueError(f"vectors of {width} entries: a Gram matrix of more than {MAX_WIDTH} squared")
    n = values[0]
    sums = tuple((h << 32) + low for h, low in zip(values[1 : width + 1], values[width + 1 :]))
    factor = triangular_factor(rows, n, sums)
    _, spread, axes = np.linalg.svd(factor)
    keep = int((spread[:components] > RANK * spread[0]).sum()) if spread[0] > 0 else 0
    if not keep:
        return None
    axes, spread_kept = axes[:keep], spread[:keep]
    lead = axes[np.arange(keep), np.abs(axes).argmax(axis=1)]
    axes = axes * np.sign(lead)[:, None]
    directions = (axes / (spread_kept / np.sqrt(n))[:, None]).T
    explained = spread_kept**2 / (spread**2).sum()
    # Deviations add up to zero exactly, so the whitened values are centred as they are.
    gram = _collect_gram(rows, n, sums, lambda y: y @ directions)
    error = float(np.abs(gram / n - np.eye(keep)).max())
    return Fit(n, sums, directions, explained, error)


def _apply(fit: Fit):
    keep = fit.directions.shape[1]

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in whole_numbers(batch.column(1)):
                if x.shape[1] != len(fit.sums) or not len(x):
                    continue
                off = deviations(x, fit.n, fit.sums)
                white = (off.astype(float) / fit.n) @ fit.directions
                repeat = np.repeat(np.arange(len(x)), keep)
                each = len(repeat)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at)).take(pa.array(repeat)),
                        pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(each, fit.n, dtype=np.int64)),
                        pa.array(squares(off), pa.int64()).take(pa.array(repeat)),
                        pa.array(white.ravel()),
                        pa.array(np.tile(fit.explained, len(x))),
                        pa.array(np.full(each, fit.identity_error)),
                    ],
                    names=[c.split()[0] for c in ROW.split(", ")],
                )

    return whiten


def whiten(
    embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = 8
) -> DataFrame:
    """One row per vector and component: its whitened coordinate and the fit's figures.

    An entry c becomes the whole number x = floor(1024 c) + 100000. Components are the
    eigenvectors of the covariance of x (divisor n), numbered from 1 by falling eigenvalue,
    each with its largest entry positive. ``deviation`` is the sum over dimensions of
    (n x - S) squared with the sums S, exact, null where it exceeds a long. ``explained`` is
    the eigenvalue's share of the trace. ``identity_error`` is measured on the whitened rows:
    the largest absolute entry of their covariance minus the identity.

    Vectors that are null, empty, or hold null or non-finite entries or entries beyond a
    long take no part; nor do vectors of another length than the commonest (ties: the longer).
    Repeated rows count and come out repeatedly; a null vec_id is kept. Components without
    spread (equal vectors, fewer vectors than components, dependent dimensions) have no
    whitened value and no row, so an empty table and equal vectors give no rows. Where
    eigenvalues tie any of the equal bases may come. Other columns are not read.

    Every pass reads the vectors anew and returns a few numbers per dimension or one Gram
    matrix, added up over a tree of tasks; rows are never shuffled.
    """
    rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    fit = _fit(rows, components)
    if fit is None:
        return rows.sparkSession.createDataFrame([], ROW)
    return rows.mapInArrow(_apply(fit), ROW)
