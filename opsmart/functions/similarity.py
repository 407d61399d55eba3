"""Jaro-Winkler similarity, 0-100, ignoring case.

Spark has no such function, so this one runs as an Arrow batch function over
pairs that :mod:`opsmart.operators.fuzzy` has already narrowed down.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T


def jaro_winkler(a: str, b: str) -> float:
    """Similarity in [0, 1]; prefix weight 0.1 over at most four characters."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    spots: dict[str, list[int]] = {}
    for j, ch in enumerate(b):
        spots.setdefault(ch, []).append(j)
    left, right = [], []
    for i, ch in enumerate(a):
        for j in (free := spots.get(ch, [])):
            if j > i + reach:
                break
            if j >= i - reach:
                left.append(ch)
                right.append(j)
                free.remove(j)
                break
    if not left:
        return 0.0
    hits = len(left)
    swaps = sum(x != b[j] for x, j in zip(left, sorted(right))) // 2
    jaro = (hits / len(a) + hits / len(b) + (hits - swaps) / hits) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro)


def similarity_score(a: str | None, b: str | None) -> int | None:
    """Whole points, rounded down, with a guard against 84.99999999."""
    if a is None or b is None:
        return None
    return int(100 * jaro_winkler(a.lower(), b.lower()) + 1e-9)


@F.pandas_udf(T.IntegerType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity_score(x, y) for x, y in zip(a, b)], dtype="Int32")


# Ship this module's code with the function, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
