"""Linear and ridge fits of all folds and penalties from sufficient statistics.

One scan sums, per fold, the products of all pairs of slots: a constant, the target, every numeric column with its missing
values as 0, an indicator of those, and an indicator of every level. A fold's training sums are those of the other
folds, so imputing, scaling, encoding and fitting it need no rows: a filled column is the column plus the fill times its
indicator, and all that follows is linear. A second scan predicts the held-out rows under every candidate at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.columns import col, nan_to_null
from tabforge.operators.preprocess import Preprocessor, level_counts, numeric_fill
from tabforge.plans.aggregates import numeric_cells
from tabforge.plans.quantiles import exact_quantiles

#: Slots up to which a task holds the products of a fold as a matrix, and the driver one of each fold.
MAX_WIDTH = 256
_PARAMS = {"linear_regression": set(), "ridge": {"alpha"}}


class Slots:
    """The slots of a table: constant, target, numeric columns, their indicators, and the levels of each text column."""

    def __init__(self, df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str], max_width: int):
        self.target, self.numeric = target, list(numeric)
        self.levels = {c: sorted(v for v in per if v is not None) for c, per in level_counts(df, categorical, max_width).items()}
        means = numeric_cells(df, [target, *numeric]).groupBy("c").agg(F.avg("x").alias("m")).collect()
        found = {r.c: r.m or 0.0 for r in means}
        # sums of values near 0 keep their digits
        self.shift = np.array([found.get(i, 0.0) for i in range(1 + len(self.numeric))])
        self.first: dict[str, int] = {}
        width = 2 + 2 * len(self.numeric)
        for c, levels in self.levels.items():
            self.first[c] = width
            width += len(levels) + 1  # the last one is for a missing value
        self.width = width

    def rows(self, df: DataFrame, fold: str) -> DataFrame:
        """``fold``, the numbers, and the place of each level in its column (-1: missing)."""
        places = []
        for c, levels in self.levels.items():
            known = F.array(*[F.lit(v) for v in levels]) if levels else F.array().cast("array<string>")
            places.append(F.coalesce(F.array_position(known, col(c).cast("string")) - 1, F.lit(-1)))
        numbers = [col(c).cast("double") for c in (self.target, *self.numeric)]
        return df.select(
            col(fold).cast("int").alias("fold"),
            *[x.alias(f"x{i}") for i, x in enumerate(numbers)],
            *[p.cast("int").alias(f"c{i}") for i, p in enumerate(places)],
        ).where("x0 IS NOT NULL")

    def matrix(self, batch: pd.DataFrame) -> np.ndarray:
        n, p = len(batch), len(self.numeric)
        x = batch[[f"x{i}" for i in range(p + 1)]].to_numpy(dtype=float) - self.shift
        out = np.zeros((n, self.width))
        out[:, 0] = 1.0
        missing = np.isnan(x)
        x[missing] = 0.0
        out[:, 1 : p + 2] = x
        out[:, p + 2 : 2 * p + 2] = missing[:, 1:]
        for i, (c, levels) in enumerate(self.levels.items()):
            place = batch[f"c{i}"].to_numpy(dtype=np.int64)
            out[np.arange(n), self.first[c] + np.where(place < 0, len(levels), place)] = 1.0
        return out


def products(slots: Slots, rows: DataFrame) -> dict[int, np.ndarray]:
    """Fold -> summed products of all pairs of slots; tasks send one row a fold and pair."""
    at = np.triu_indices(slots.width)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            z, fold = slots.matrix(batch), batch["fold"].to_numpy()
            for f in np.unique(fold).tolist():
                part = z[fold == f]
                sums[f] = sums.get(f, 0.0) + part.T @ part
        for f, s in sums.items():
            flat = s[at]
            some = np.flatnonzero(flat)
            yield pd.DataFrame({"fold": f, "at": some, "v": flat[some]})

    found: dict[int, np.ndarray] = {}
    for r in rows.mapInPandas(count, "fold int, at long, v double").groupBy("fold", "at").agg(F.sum("v").alias("v")).collect():
        m = found.setdefault(r.fold, np.zeros((slots.width, slots.width)))
        i, j = at[0][r.at], at[1][r.at]
        m[i, j] = m[j, i] = r.v
    return found


class _Fit:
    """The features of one fold as combinations of slots, from the sums ``s`` of its training rows."""

    def __init__(self, slots: Slots, s: np.ndarray, fills: Mapping[str, float], prep: Preprocessor):
        n, p = s[0, 0], len(slots.numeric)
        made: list[tuple[np.ndarray, bool]] = []
        for j, c in enumerate(slots.numeric):
            if c not in fills:
                continue  # without any value
            a = np.zeros(slots.width)
            a[2 + j], a[2 + p + j] = 1.0, fills[c] - slots.shift[1 + j]
            made.append((a, prep.scale_numeric))
        for c, levels in slots.levels.items():
            first, missing = slots.first[c], slots.first[c] + len(levels)
            seen = {v: s[0, first + k] for k, v in enumerate(levels) if s[0, first + k]}
            if prep.categorical_strategy == "constant":
                fill = prep.categorical_constant
            elif seen:
                fill = min(seen, key=lambda v: (-seen[v], v))
            else:
                continue
            if s[0, missing]:
                seen.setdefault(fill, 0.0)
            for v in sorted(seen):
                a = np.zeros(slots.width)
                if v in levels:
                    a[first + levels.index(v)] = 1.0
                a[missing] = float(v == fill)
                made.append((a, False))
        self.a = np.array([a for a, _ in made]).reshape(len(made), slots.width).T
        self.mean = s[0] @ self.a / n
        gram = self.a.T @ s @ self.a - n * np.outer(self.mean, self.mean)
        spread = np.sqrt(np.maximum(np.diag(gram), 0) / n)
        # a constant column is divided by 1
        tiny = spread <= 1e-9 * np.maximum(np.abs(self.mean), 1.0)
        self.scale = np.where(np.array([scaled for _, scaled in made], bool) & ~tiny, spread, 1.0)
        self.y_mean = s[0, 1] / n
        self.gram = gram / np.outer(self.scale, self.scale)
        self.moment = (s[1] @ self.a - n * self.y_mean * self.mean) / self.scale

    def weights(self, alpha: float, y_shift: float) -> np.ndarray:
        """Weights of the slots; the constant's holds the intercept. Without a penalty the shortest exact solution."""
        if alpha:
            w = np.linalg.solve(self.gram + alpha * np.eye(len(self.gram)), self.moment) if len(self.gram) else self.moment
        else:
            w = np.linalg.pinv(self.gram, rcond=1e-11, hermitian=True) @ self.moment if len(self.gram) else self.moment
        w = w / self.scale
        out = self.a @ w
        out[0] += y_shift + self.y_mean - self.mean @ w
        return out


def _fills(df: DataFrame, slots: Slots, train: Mapping[int, np.ndarray], before: Callable, fold: str, prep: Preprocessor):
    """Fold -> column -> fill of its missing values; a column without a training value has none.

    Means come from the sums. Medians of columns that miss values are taken for all folds in the same scans.
    """
    p = len(slots.numeric)
    out: dict[int, dict[str, float]] = {}
    wanted: dict[str, tuple[int, str]] = {}
    for i, s in train.items():
        out[i] = {}
        for j, c in enumerate(slots.numeric):
            absent, n = s[0, 2 + p + j], s[0, 0]
            if absent >= n:
                continue
            if prep.numeric_strategy == "constant":
                out[i][c] = prep.numeric_constant
            elif prep.numeric_strategy == "mean" or not absent:
                out[i][c] = slots.shift[1 + j] + s[0, 2 + j] / (n - absent)
            else:
                wanted[f"f{i}_{j}"] = (i, c)
    if wanted and prep.numeric_strategy == "median":
        known = df.where(col(slots.target).isNotNull())
        split = known.select(*[F.when(before(i), col(c).cast("double")).alias(name) for name, (i, c) in wanted.items()])
        for name, q in exact_quantiles(split, {name: [0.5] for name in wanted}).items():
            i, c = wanted[name]
            out[i][c] = q[0]
    elif wanted:
        for i in sorted({i for i, _ in wanted.values()}):
            some = [c for k, c in wanted.values() if k == i]
            out[i] |= numeric_fill(df.where(before(i) & col(slots.target).isNotNull()), some, prep.numeric_strategy, prep.numeric_constant)
    return out


def held_out_predictions(
    df: DataFrame, target: str, task: str, fold: str, folds: int, model: str, candidates: Sequence[Mapping], prep: Preprocessor,
    max_width: int = MAX_WIDTH,
) -> DataFrame | None:
    """``fold, candidate, y, prediction`` of every held-out row under each of ``candidates`` (parameters of ``model``).

    ``None`` where sufficient statistics don't give the fit: another model or parameter, pooled levels, or more than
    ``max_width`` slots.
    """
    if task == "classification" or any(set(c) - _PARAMS.get(model, set()) for c in candidates) or model not in _PARAMS:
        return None
    if prep.min_frequency is not None or prep.numeric_strategy not in ("mean", "median", "most_frequent", "constant"):
        return None
    if prep.categorical_strategy not in ("most_frequent", "constant"):
        return None
    df = nan_to_null(df)
    numeric, categorical = prep.columns(df.drop(fold), target)
    if 2 + 2 * len(numeric) + len(categorical) > max_width:
        return None
    try:
        slots = Slots(df, target, numeric, categorical, max_width)
    except ValueError:  # more levels than slots
        return None
    if slots.width > max_width:
        return None
    rows = slots.rows(df, fold)
    own = products(slots, rows)
    none = np.zeros((slots.width, slots.width))
    earlier = task == "timeseries"
    before = lambda i: (F.col(fold) < i) if earlier else (F.col(fold) != i)
    train = {i: sum((s for f, s in own.items() if (f < i if earlier else f != i)), none) for i in range(1, folds + 1)}
    if any(not s[0, 0] for s in train.values()):
        return None
    fills = _fills(df, slots, train, before, fold, prep)
    weights = {}
    for i, s in train.items():
        fit = _Fit(slots, s, fills[i], prep)
        if not fit.a.size:
            return None
        alphas = [float(c.get("alpha", 1.0)) if model == "ridge" else 0.0 for c in candidates]
        weights[i] = np.stack([fit.weights(a, slots.shift[0]) for a in alphas], axis=1)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z, which = slots.matrix(batch), batch["fold"].to_numpy()
            z[:, 1] = 0.0  # the target
            for f in np.unique(which).tolist():
                if f in weights:
                    part = z[which == f] @ weights[f]
                    yield pd.DataFrame({"fold": f, "y": batch["x0"].to_numpy()[which == f], "p": list(part)})

    found = rows.mapInPandas(predict, "fold int, y double, p array<double>")
    return found.select("fold", "y", F.posexplode("p").alias("candidate", "prediction"))
