"""Second-order boosted trees for a yes-or-no label, grown level by level.

In each round every row has a gradient and a Hessian of the logistic loss. Spark
sums them by node, feature and bin; the sums are whole numbers of a fixed unit,
so they do not depend on the order of the rows, and a task that runs again
changes no tree. From the sums windows find each node's best split: one row for
each node reaches the driver.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onsetlab.sources.staging import Stages, measured, session_stages

#: Gradients and Hessians are summed in this part of one.
UNIT = 1 << 24
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class BoostingOptions:
    """How trees grow. All but ``bins``, ``reg_lambda`` and ``seed``."""

    rounds: int = 10
    max_depth: int = 5
    eta: float = 0.2
    # A split has to gain at least this much, and each side's Hessian to sum to that.
    gamma: float = 4.0
    min_child_weight: float = 6.0
    # The part of the rows that a round learns from.
    subsample: float = 0.7
    reg_lambda: float = 1.0
    # A feature with more different values is cut at so many quantiles.
    bins: int = 256
    seed: int = 42


@dataclass(frozen=True)
class Node:
    """A split (rows below ``cut`` go left) or, without a feature, a leaf."""

    value: float
    feature: int | None = None
    cut: float = math.inf
    missing_left: bool = False
    gain: float = 0.0
    left: Node | None = None
    right: Node | None = None


@dataclass(frozen=True)
class BoostedTrees:
    """A trained model: its columns, trees and the options it was grown with."""

    features: list[str]
    trees: list[Node] = field(default_factory=list)
    options: BoostingOptions = BoostingOptions()

    def margin(self) -> Column:
        """The log-odds of the event, as an expression over the features."""
        total = F.lit(0.0)
        for tree in self.trees:
            total = total + self._walk(tree)
        return total

    def _walk(self, node: Node) -> Column:
        if node.feature is None:
            return F.lit(node.value)
        x = present(F.col(f"`{self.features[node.feature]}`"))
        left, right = self._walk(node.left), self._walk(node.right)
        return F.when(x.isNull(), left if node.missing_left else right).when(x < node.cut, left).otherwise(right)

    def risk(self) -> Column:
        return logistic(self.margin())

    def importances(self) -> dict[str, float]:
        """Each feature's part of the gain of all splits."""
        gains = dict.fromkeys(self.features, 0.0)

        def add(node: Node) -> None:
            if node.feature is not None:
                gains[self.features[node.feature]] += node.gain
                add(node.left)
                add(node.right)

        for tree in self.trees:
            add(tree)
        total = sum(gains.values())
        return {name: gain / total if total else 0.0 for name, gain in gains.items()}

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "trees": [asdict(t) for t in self.trees], "options": asdict(self.options)})

    @classmethod
    def from_json(cls, text: str) -> BoostedTrees:
        def node(known: dict | None) -> Node | None:
            return known and Node(**{**known, "left": node(known["left"]), "right": node(known["right"])})

        known = json.loads(text)
        return cls(known["features"], [node(t) for t in known["trees"]], BoostingOptions(**known["options"]))


def present(x: Column) -> Column:
    """A number, or null where it is missing, not a number or infinite."""
    number = x.cast("double")
    # Not a number is greater than any other here.
    return F.when(F.abs(number) < math.inf, number)


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def cut_points(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """For each feature the values at which rows may be divided, rising.

    All different values but the least, if there are no more than ``bins``;
    otherwise as many quantiles, from a summary that errs by a ten-thousandth of
    the rows. One pass, and one more for features with few values.
    """
    values = [present(F.col(f"`{name}`")) for name in features]
    ranks = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    aggregates = [F.approx_count_distinct(v).alias(f"n{i}") for i, v in enumerate(values)]
    aggregates += [F.approx_percentile(v, ranks, F.lit(10_000)).alias(f"q{i}") for i, v in enumerate(values)]
    summary = df.agg(*aggregates).first()
    # The estimate errs by a few percent, so the sets that are collected are small.
    few = [i for i in range(len(features)) if summary[f"n{i}"] <= 2 * bins]
    cuts = [sorted(set(summary[f"q{i}"] or [])) for i in range(len(features))]
    if few:
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), values[i].alias("x")) for i in few]))
        found = df.select(pairs.alias("p")).select("p.*").where(F.col("x").isNotNull()).groupBy("feature").agg(F.collect_set("x").alias("xs"))
        known = {r["feature"]: sorted(r["xs"]) for r in found.collect()}
        for i in few:
            if len(known.get(i, [])) <= bins:
                cuts[i] = known.get(i, [])[1:]
    return cuts


def train_boosted(
    df: DataFrame,
    features: Sequence[str],
    label_col: str,
    options: BoostingOptions = BoostingOptions(),
    stages: Stages | None = None,
) -> BoostedTrees:
    """Grow ``options.rounds`` trees on the rows that have a label, 0 or 1.

    A feature may be missing (null, not a number or infinite); a split learns the side
    such rows go to. Rows are staged as bins, once a round with the margin of
    the trees so far; each level of a tree is one pass over them.
    """
    stages = stages or session_stages(df.sparkSession)
    features = list(features)
    labelled = df.where(F.col(label_col).isNotNull())
    cuts = cut_points(labelled, features, options.bins)
    names = [f"b{i}" for i in range(len(features))]
    numbers = [F.coalesce(present(F.col(f"`{name}`")), F.lit(math.nan)).alias(f"x{i}") for i, name in enumerate(features)]
    binned = labelled.select(F.monotonically_increasing_id().alias("row"), F.col(label_col).cast("double").alias("y"), *numbers)
    if features:
        # A missing number gets the bin after the last one.
        binned = Bucketizer(
            splitsArray=[[-math.inf, *c, math.inf] if c else [-math.inf, 0.0, math.inf] for c in cuts],
            inputCols=[f"x{i}" for i in range(len(features))],
            outputCols=names,
            handleInvalid="keep",
        ).transform(binned)
    # A feature of one value has one bin, whatever side of 0 the value is on.
    bins = [
        (F.col(n).cast("int") if c else F.when(F.col(n) < 2, 0).otherwise(1)).alias(n) for n, c in zip(names, cuts, strict=True)
    ]
    rows = stages.stage(binned.select("row", "y", F.lit(0.0).alias("margin"), *bins), "binned")
    model = BoostedTrees(features, [], options)
    if not measured(rows)["rows"]:
        return model
    grower = _Grower(names, cuts, options)
    for number in range(options.rounds):
        tree = grower.grow(rows, number)
        model = replace(model, trees=[*model.trees, tree])
        if number + 1 < options.rounds:
            rows = stages.stage(rows.withColumn("margin", F.col("margin") + grower.leaf_value(tree)), "binned")
    return model


class _Grower:
    def __init__(self, names: list[str], cuts: list[list[float]], options: BoostingOptions):
        self.names, self.cuts, self.options = names, cuts, options

    def _walk(self, node: Node, leaf, path: str = "1") -> Column:
        """An expression over the bins: ``leaf`` of the leaf that a row falls into."""
        if node.feature is None:
            return leaf(node, path)
        b, last = F.col(self.names[node.feature]), len(self.cuts[node.feature])
        left, right = self._walk(node.left, leaf, path + "0"), self._walk(node.right, leaf, path + "1")
        below = last if math.isinf(node.cut) else self.cuts[node.feature].index(node.cut)
        return F.when(b > last, left if node.missing_left else right).when(b <= below, left).otherwise(right)

    def leaf_value(self, tree: Node) -> Column:
        return self._walk(tree, lambda node, _: F.lit(node.value))

    def grow(self, rows: DataFrame, number: int) -> Node:
        options = self.options
        if options.subsample < 1:
            drawn = F.pmod(F.xxhash64("row", F.lit(options.seed), F.lit(number)), F.lit(1 << 20))
            rows = rows.where(drawn < int(options.subsample * (1 << 20)))
        p = logistic(F.col("margin"))
        rows = rows.withColumns(
            {
                "g": F.round((p - F.col("y")) * UNIT).cast("long"),
                "h": F.round(p * (1 - p) * UNIT).cast("long"),
            }
        )
        totals = rows.agg(F.sum("g").alias("g"), F.sum("h").alias("h")).first()
        tree = self._leaf(totals["g"] or 0, totals["h"] or 0)
        # The leaves of the last level, by the way to them from the root.
        open_paths = ["1"]
        for _ in range(options.max_depth if self.names else 0):
            node = self._walk(tree, lambda _, path: F.lit(int(path, 2)))
            open_rows = rows.withColumn("node", node).where(F.col("node").isin([int(p, 2) for p in open_paths]))
            splits = {bin(r["node"])[2:]: r for r in self._best_splits(open_rows).collect()}
            if not splits:
                break
            tree = self._split(tree, splits)
            open_paths = [path + side for path in splits for side in "01"]
        return tree

    def _leaf(self, g: int, h: int) -> Node:
        return Node(-self.options.eta * (g / UNIT) / (h / UNIT + self.options.reg_lambda))

    def _split(self, node: Node, splits: dict, path: str = "1") -> Node:
        if node.feature is not None:
            return replace(node, left=self._split(node.left, splits, path + "0"), right=self._split(node.right, splits, path + "1"))
        found = splits.get(path)
        if found is None:
            return node
        cuts = self.cuts[found["feature"]]
        return Node(
            node.value,
            found["feature"],
            cuts[found["bin"]] if found["bin"] < len(cuts) else math.inf,
            found["missing_left"],
            found["gain"],
            self._leaf(found["gl"], found["hl"]),
            self._leaf(found["g"] - found["gl"], found["h"] - found["hl"]),
        )

    def _best_splits(self, rows: DataFrame) -> DataFrame:
        """``node, feature, bin, missing_left, gain`` and sums of each node that is worth a split.

        The bins up to ``bin`` go left. Of equal gains the first feature, then
        the first bin count, then missing numbers to the right.
        """
        options = self.options
        cells = F.posexplode(F.array(*self.names)).alias("feature", "bin")
        sums = rows.select("node", "g", "h", cells).groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        last = F.element_at(F.array(*[F.lit(len(c)) for c in self.cuts]), F.col("feature") + 1)
        missing = F.col("bin") > last
        every = Window.partitionBy("node", "feature")
        until = every.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        both = [
            F.struct(F.lit(False).alias("missing_left"), F.col("gl"), F.col("hl")),
            F.struct(F.lit(True).alias("missing_left"), (F.col("gl") + F.col("gm")).alias("gl"), (F.col("hl") + F.col("hm")).alias("hl")),
        ]
        of = lambda g, h: (g / UNIT) * (g / UNIT) / (h / UNIT + options.reg_lambda)
        whole = lambda name: F.sum(name).over(every)
        sides = (
            sums.select(
                "node", "feature", "bin", missing.alias("missing"),
                whole("g").alias("g"), whole("h").alias("h"),
                F.sum("g").over(until).alias("gl"), F.sum("h").over(until).alias("hl"),
                F.coalesce(F.sum(F.when(missing, F.col("g"))).over(every), F.lit(0)).alias("gm"),
                F.coalesce(F.sum(F.when(missing, F.col("h"))).over(every), F.lit(0)).alias("hm"),
            )
            .where(~F.col("missing"))
            .select("node", "feature", "bin", "g", "h", F.inline(F.array(*both)))
        )
        gr, hr = F.col("g") - F.col("gl"), F.col("h") - F.col("hl")
        gain = of(F.col("gl"), F.col("hl")) + of(gr, hr) - of(F.col("g"), F.col("h"))
        least = int(options.min_child_weight * UNIT)
        fits = (F.col("hl") >= least) & (hr >= least) & (F.col("hl") > 0) & (hr > 0)
        worth = (F.col("gain") >= options.gamma) & (F.col("gain") > LEAST_GAIN)
        order = F.struct((-F.col("gain")).alias("loss"), "feature", "bin", "missing_left", "gain", "gl", "hl", "g", "h")
        return sides.where(fits).withColumn("gain", gain).where(worth).groupBy("node").agg(F.min(order).alias("s")).select("node", "s.*")
