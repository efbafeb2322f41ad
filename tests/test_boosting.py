"""Second-order boosted trees against a plain version, and models that are saved and read."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import SparkSession

from onsetlab.operators import boosting, model
from onsetlab.operators.boosting import UNIT, BoostedTrees, BoostingOptions
from onsetlab.sources import versions


def plain_trees(rows, features, options):
    """Trees as nested tuples, by trying every value of every feature as a cut."""
    margins = [0.0] * len(rows)
    trees = []

    def rounded(x):
        return math.floor(abs(x) + 0.5) * (1 if x >= 0 else -1)

    def leaf(g, h):
        return -options.eta * (g / UNIT) / (h / UNIT + options.reg_lambda)

    def gain(g, h):
        return (g / UNIT) * (g / UNIT) / (h / UNIT + options.reg_lambda)

    for _ in range(options.rounds):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        gs = [rounded((a - r["target"]) * UNIT) for a, r in zip(p, rows)]
        hs = [rounded(a * (1 - a) * UNIT) for a in p]

        def grow(members, depth):
            g, h = sum(gs[i] for i in members), sum(hs[i] for i in members)
            best = None
            for f, name in enumerate(features if depth < options.max_depth else []):
                # The cut after each value, the last one with all numbers below it.
                values = sorted({r[name] for r in rows if r[name] is not None})
                for at in range(len(values)):
                    cut = values[at + 1] if at + 1 < len(values) else math.inf
                    for missing_left in (False, True):
                        left = [i for i in members if (missing_left if rows[i][name] is None else rows[i][name] < cut)]
                        if not any(rows[i][name] is not None and rows[i][name] == values[at] for i in members):
                            continue
                        gl, hl = sum(gs[i] for i in left), sum(hs[i] for i in left)
                        least = options.min_child_weight * UNIT
                        if hl < least or h - hl < least or not hl or hl == h:
                            continue
                        better = gain(gl, hl) + gain(g - gl, h - hl) - gain(g, h)
                        if better < options.gamma or better <= boosting.LEAST_GAIN:
                            continue
                        key = (-better, f, at, missing_left)
                        if best is None or key < best[0]:
                            best = key, name, cut, missing_left, left
            if best is None:
                return leaf(g, h)
            _, name, cut, missing_left, left = best
            right = sorted(set(members) - set(left))
            return name, cut, missing_left, grow(left, depth + 1), grow(right, depth + 1)

        trees.append(grow(list(range(len(rows))), 0))

        def value(node, row):
            while isinstance(node, tuple):
                name, cut, missing_left, below, above = node
                x = row[name]
                node = below if (missing_left if x is None else x < cut) else above
            return node

        margins = [m + value(trees[-1], r) for m, r in zip(margins, rows)]
    return trees, [1 / (1 + math.exp(-m)) for m in margins]


def as_tuples(node, features):
    if node.feature is None:
        return node.value
    sides = as_tuples(node.left, features), as_tuples(node.right, features)
    return features[node.feature], node.cut, node.missing_left, *sides


def close(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return a[:3] == b[:3] and close(a[3], b[3]) and close(a[4], b[4])
    return not isinstance(a, tuple) and not isinstance(b, tuple) and a == pytest.approx(b, abs=1e-9)


FEATURES = ["a", "b", "c", "same", "none"]
SCHEMA = "target int, a double, b int, c double, same int, none double"


def sample_rows(seed, n=160):
    source = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c = source.choice([1.5, 2.5, 7.0, None]), source.randrange(6), source.choice([None, -1.0, 0.0, 4.25])
        odds = (a is None) + (b > 3) - (c is not None and c < 0) + source.random() - 0.5
        rows.append({"target": int(odds > 0.5), "a": a, "b": b, "c": c, "same": -3, "none": None})
    return rows


def frame(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(
    ("seed", "options"),
    [
        (1, BoostingOptions(rounds=3, max_depth=3, subsample=1.0, gamma=0.0, min_child_weight=0.0)),
        (2, BoostingOptions(rounds=2, max_depth=5, subsample=1.0, gamma=0.5, min_child_weight=2.0)),
        (3, BoostingOptions(rounds=2, max_depth=2, subsample=1.0, gamma=4.0, min_child_weight=6.0, eta=1.0)),
    ],
)
def test_trees_equal_the_plain_version(spark, seed, options):
    rows = sample_rows(seed)
    grown = boosting.train_boosted(frame(spark, rows), FEATURES, "target", options)
    trees, risks = plain_trees(rows, FEATURES, options)
    assert [close(as_tuples(t, FEATURES), p) for t, p in zip(grown.trees, trees, strict=True)] == [True] * options.rounds
    assert any(t.feature is not None for t in grown.trees)
    scored = frame(spark, rows).select(grown.risk().alias("risk"))
    assert sorted(r[0] for r in scored.collect()) == pytest.approx(sorted(risks), abs=1e-9)


def test_gamma_and_hessian_bound_stop_splits(spark):
    rows = frame(spark, sample_rows(4))
    for options in (BoostingOptions(rounds=1, gamma=1e6), BoostingOptions(rounds=1, min_child_weight=1e6)):
        assert boosting.train_boosted(rows, FEATURES, "target", options).trees[0].feature is None


def test_rounds_learn_from_part_of_the_rows_and_do_so_again(spark):
    rows = frame(spark, sample_rows(5, 600)).coalesce(1)
    options = BoostingOptions(rounds=3, max_depth=3, gamma=0.0, min_child_weight=1.0)
    first, second = (boosting.train_boosted(rows, FEATURES, "target", options) for _ in range(2))
    assert first == second
    assert first != boosting.train_boosted(rows, FEATURES, "target", BoostingOptions(**{**vars(options), "subsample": 1.0}))


def test_many_values_are_cut_at_quantiles(spark):
    source = random.Random(6)
    data = [(int(x > 0.7), x) for x in (source.random() for _ in range(3000))]
    df = spark.createDataFrame(data, "target int, x double")
    cuts = boosting.cut_points(df, ["x"], 16)[0]
    assert 14 <= len(cuts) <= 16 and cuts == sorted(cuts)
    grown = boosting.train_boosted(df, ["x"], "target", BoostingOptions(rounds=2, bins=16, subsample=1.0))
    assert abs(grown.trees[0].cut - 0.7) < 0.1


def test_awkward_rows(spark):
    odd = [(1, float("nan")), (0, None), (None, 1.0), (1, float("inf")), (0, -0.0), (0, 0.0)]
    df = spark.createDataFrame(odd, "target int, x double")
    grown = boosting.train_boosted(df, ["x"], "target", BoostingOptions(rounds=1, subsample=1.0, gamma=0, min_child_weight=0))
    risks = [r[0] for r in df.select(grown.risk()).collect()]
    assert len(risks) == 6 and all(0 < r < 1 for r in risks)
    nothing = boosting.train_boosted(df.where("false"), ["x"], "target")
    assert nothing.trees == [] and [r[0] for r in df.limit(1).select(nothing.risk()).collect()] == [0.5]


@pytest.mark.parametrize("kind", ["second_order", "spark_ml"])
def test_scores_are_the_same_after_a_reload(spark, tmp_path, kind):
    df = frame(spark, sample_rows(7, 400)).drop("none")
    features = FEATURES[:4]
    if kind == "second_order":
        grown = model.train_second_order(df, features, BoostingOptions(gamma=0.1))
    else:
        grown = model.train(df, features, maxIter=2)
    path = str(tmp_path / "model")
    model.save_model(spark, grown, path, {"label_days": 360})
    with_keys = df.selectExpr("*", "monotonically_increasing_id() AS person_id")
    # Another session: nothing of the first one's views or frames is known there.
    other: SparkSession = spark.newSession()
    loaded = model.load_model(other, path)
    assert (loaded.features, loaded.options) == (features, {"label_days": 360})
    assert sorted(map(tuple, loaded.score(with_keys).collect())) == sorted(map(tuple, model.score(grown, with_keys).collect()))
    with pytest.raises(ValueError, match="not there: b"):
        loaded.score(with_keys.drop("b"))


def test_the_last_whole_model_is_read(spark, tmp_path):
    path = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError):
        model.load_model(spark, path)
    for feature in ("a", "b", "c"):
        model.save_model(spark, BoostedTrees([feature]), path)
    assert model.load_model(spark, path).features == ["c"]
    assert len(versions.committed(spark, path)) == 2
    # A write that stopped before it was entered.
    versions.write_once(spark, f"{versions.new_folder(path)}/model.json", "{}")
    assert model.load_model(spark, path).features == ["c"]


def test_an_entry_is_written_once(spark, tmp_path):
    path = str(tmp_path / "entries" / "1")
    assert versions.write_once(spark, path, "first") and not versions.write_once(spark, path, "second")
    assert versions.read_text(spark, path) == "first"
