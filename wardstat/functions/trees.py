"""Boosted trees as Column expressions and as SQL text.

A tree becomes nested two-way CASEs, the margin a balanced sum of the trees
(so that neither the analyser nor the parser meets a deep expression), the
score its logistic function. Both forms add in the same order, so they agree
to the last bit of the margin.

Inputs are doubles in which a missing value is NULL (`missing_as_null`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.operators.boosting import Booster, Tree

WHOLE_STAGE = 64          # splits up to which a model is left to whole-stage code
COMPILED = 4000           # splits up to which it is generated code at all: one class holds no more


def missing_as_null(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The features as doubles, absent columns and NaN as NULL; other columns stay."""
    have = set(df.columns)

    def value(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x), x) if c in have else F.lit(None).cast("double")

    return df.withColumns({c: value(c) for c in features})


def _balanced(parts: list, add: Callable):
    while len(parts) > 1:
        parts = [add(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _fold_tree(tree: Tree, leaf: Callable, split: Callable, node: int = 0):
    if tree.feature[node] < 0:
        return leaf(tree.value[node])
    left, right = (_fold_tree(tree, leaf, split, k) for k in (tree.left[node], tree.right[node]))
    return split(tree.feature[node], tree.threshold[node], tree.missing_left[node], left, right)


def number_sql(x: float) -> str:
    """A literal that parses to exactly this double (the exponent makes it one)."""
    text = repr(float(x))
    return text if "e" in text else text + "e0"


def tree_sql(tree: Tree, features: Sequence[str]) -> str:
    """`features` are the names as the engine wants them quoted."""
    def split(f, threshold, missing_left, left, right):
        below = f"{features[f]} < {number_sql(threshold)}"
        # CASE takes an unknown condition as false: only a missing value that goes left needs saying
        return f"CASE WHEN {f'coalesce({below}, TRUE)' if missing_left else below} THEN {left} ELSE {right} END"

    return _fold_tree(tree, number_sql, split)


def margin_sql(booster: Booster, features: Sequence[str] | None = None) -> str:
    names = features or booster.features
    return _balanced([tree_sql(t, names) for t in booster.trees] or ["0e0"], lambda a, b: f"({a} + {b})")


def probability_sql(booster: Booster) -> str:
    return f"(1e0 / (1e0 + exp(-({margin_sql(booster)}))))"


def margin_column(booster: Booster) -> Column:
    """One parsed expression: building it split by split would take seconds for a large model."""
    return F.expr(margin_sql(booster, [f"`{c}`" for c in booster.features]))


def margins_of(booster: Booster, x: np.ndarray) -> np.ndarray:
    """Margins of a (rows x features) matrix in which NaN is missing, added up as the expressions do."""
    each, rows = [], np.arange(len(x))
    for t in booster.trees:
        feature, threshold, missing_left, left, right, value = (
            np.array(getattr(t, c)) for c in ("feature", "threshold", "missing_left", "left", "right", "value"))
        node = np.zeros(len(x), np.int64)
        while (live := feature[node] >= 0).any():
            v = x[rows, np.maximum(feature[node], 0)]
            go_left = np.where(np.isnan(v), missing_left[node], v < threshold[node])
            node = np.where(live, np.where(go_left, left[node], right[node]), node)
        each.append(value[node])
    return _balanced(each or [np.zeros(len(x))], lambda a, b: a + b)


def batched_probability(booster: Booster) -> Column:
    """The score from Arrow batches, for models that are too large for code."""
    @F.pandas_udf("double")
    def score(x: pd.DataFrame) -> pd.Series:
        return pd.Series(1.0 / (1.0 + np.exp(-margins_of(booster, x.to_numpy(np.float64)))))

    return score(F.struct(*[F.col(c) for c in booster.features]))


def probability_column(booster: Booster) -> Column:
    splits = sum(f >= 0 for t in booster.trees for f in t.feature)
    if splits > COMPILED:
        return batched_probability(booster)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin_column(booster)))
    if splits <= WHOLE_STAGE:
        return score
    # Code of a whole stage is one method, which cannot hold this many splits;
    # a generated projection of its own is cut into methods that the JVM
    # compiles. A stage leaves out a projection with a higher-order function:
    # this one is always false.
    never = F.exists(F.array(F.col(booster.features[0])), lambda x: F.lit(False))
    return F.when(never, F.lit(None).cast("double")).otherwise(score)
