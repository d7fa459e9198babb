"""Fitted tree ensembles as column expressions, so that scoring stays one narrow projection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import Column
from pyspark.sql import functions as F


def _branch(node, feature: Callable[[int], Column], leaf: Callable[[object], float]) -> Column:
    if node.subtreeDepth() == 0:
        return F.lit(leaf(node))
    split = node.split()
    left = _branch(node.leftChild(), feature, leaf)
    right = _branch(node.rightChild(), feature, leaf)
    return F.when(feature(split.featureIndex()) <= split.threshold(), left).otherwise(right)


def boosted_score(model: GBTClassificationModel, feature: Callable[[int], Column]) -> Column:
    """Probability of class 1 by a boosted ensemble; ``feature(i)`` is the i-th feature."""
    margin = F.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights):
        margin = margin + weight * _branch(
            tree._java_obj.rootNode(), feature, lambda node: float(node.prediction())
        )
    return 1 / (1 + F.exp(-2 * margin))


def forest_score(model: RandomForestClassificationModel, feature: Callable[[int], Column]) -> Column:
    """Mean over the trees of the share of class 1 in the leaf."""

    def share(node) -> float:
        stats = list(node.impurityStats().stats())
        return float(stats[1] / sum(stats)) if sum(stats) else 0.0

    trees = [_branch(t._java_obj.rootNode(), feature, share) for t in model.trees]
    return sum(trees[1:], trees[0]) / len(trees)
