"""Fitted tree ensembles as tables of leaves, and as SQL that any engine evaluates.

A row says which box of feature values a leaf covers (``low`` < value <= ``high``, null where it is open) and what it adds
to the prediction, the weight of its tree included. Every tree has one leaf for every value, so a prediction is the sum of
one leaf per tree: as a column expression (``prediction_sql``), or as a join of the table and a sum.

The table has as many rows as the model has leaves, whatever the data; it is the only thing that passes the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame, Row, SparkSession

LEAVES = "tree int, leaf int, low array<double>, high array<double>, value double"
LEAF = Row("tree", "leaf", "low", "high", "value")

Bounds = tuple[float | None, ...]


def is_tree_model(model: Model) -> bool:
    return hasattr(model, "toDebugString")


def leaf_table(spark: SparkSession, model: Model) -> DataFrame:
    """The leaves as a table, to be stored."""
    return spark.createDataFrame(leaves_of(model), LEAVES)


def leaves_of(model: Model) -> list[Row]:
    """The leaves of a fitted boosted, forest or single regression tree of Spark ML over continuous features."""
    if hasattr(model, "trees"):
        trees, weights = model.trees, list(model.treeWeights)
    else:
        trees, weights = [model], [1.0]
    if "Forest" in type(model).__name__:  # a forest is the mean of its trees, boosted trees add up
        weights = [weight / sum(weights) for weight in weights]
    rows = []
    for number, (tree, weight) in enumerate(zip(trees, weights)):
        open_ = (None,) * model.numFeatures
        boxes = _boxes(tree._java_obj.rootNode(), open_, open_)
        rows += [LEAF(number, i, list(low), list(high), weight * value) for i, (low, high, value) in enumerate(boxes)]
    return rows


def _boxes(node, low: Bounds, high: Bounds) -> Iterator[tuple[Bounds, Bounds, float]]:
    """Leaves below ``node`` from left to right. Bounds only get tighter on the way down."""
    if node.getClass().getSimpleName() == "LeafNode":
        yield low, high, node.prediction()
        return
    split = node.split()
    if split.getClass().getSimpleName() != "ContinuousSplit":
        raise ValueError("only continuous features have boxes")
    at, threshold = split.featureIndex(), split.threshold()
    yield from _boxes(node.leftChild(), low, (*high[:at], threshold, *high[at + 1:]))
    yield from _boxes(node.rightChild(), (*low[:at], threshold, *low[at + 1:]), high)


def number_sql(value: float) -> str:
    """A double, exactly, in Spark's and other engines' SQL, where a plain ``1.5`` is a decimal."""
    text = repr(float(value))
    return text if "e" in text else f"{text}e0"


def prediction_sql(leaves: Sequence[Row], features: Sequence[str], of: str) -> str:
    """The prediction as SQL over the fields ``features`` of a struct or table ``of``. Terms are added in pairs of pairs,
    so that a thousand trees are ten levels deep and every engine rounds alike. NULL if a tree has no leaf for a value."""
    trees: dict[int, list[str]] = {}
    for leaf in sorted(leaves, key=lambda one: (one.tree, one.leaf)):
        box = [f"{of}.{name} > {number_sql(low)}" for name, low in zip(features, leaf.low) if low is not None]
        box += [f"{of}.{name} <= {number_sql(high)}" for name, high in zip(features, leaf.high) if high is not None]
        trees.setdefault(leaf.tree, []).append(f"WHEN {' AND '.join(box) or 'true'} THEN {number_sql(leaf.value)}")
    if not trees:
        raise ValueError("the model has no leaves")
    terms = [f"CASE {' '.join(cases)} END" for cases in trees.values()]
    while len(terms) > 1:
        terms = [f"({' + '.join(terms[i : i + 2])})" for i in range(0, len(terms), 2)]
    return terms[0]
