"""Division of a dataset into training and test rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onsetlab.functions.buckets import BUCKETS, key_bucket

SPLIT_WEIGHTS = (0.9, 0.1)
SPLIT_SEED = 42


def split_number(weights: Sequence[float] = SPLIT_WEIGHTS, key: str = "person_id") -> Column:
    """The number of the split a key belongs to, from 0, by its bucket.

    All rows of a key get the same number, on any cluster and at any
    partitioning.
    """
    if not weights or any(weight <= 0 for weight in weights):
        raise ValueError("weights must be positive")
    bounds = [round(BUCKETS * part / sum(weights)) for part in accumulate(weights)]
    if any(last <= first for first, last in zip([0, *bounds], bounds)):
        raise ValueError(f"a part holds at least one of {BUCKETS} buckets; its weight is too small")
    bucket = key_bucket(key)
    number = F.lit(len(bounds) - 1)
    for i in reversed(range(len(bounds) - 1)):
        number = F.when(bucket < bounds[i], i).otherwise(number)
    return number


def split(
    df: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS, key: str = "person_id"
) -> list[DataFrame]:
    """Divide ``df`` by key, so that no key is on both sides.

    Every part reads ``df``; stage it if it is costly. A NULL key goes to the
    last part.
    """
    number = split_number(weights, key)
    return [df.filter(number == i) for i in range(len(weights))]


def random_split(
    df: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS, seed: int = SPLIT_SEED
) -> list[DataFrame]:
    """Divide ``df`` row by row at random.

    The rows drawn depend on the partitioning as well as on the seed, and rows
    of one patient may land on both sides; prefer :func:`split`.
    """
    return df.randomSplit(list(weights), seed=seed)
