"""Tree ensembles as column expressions, so that expressions over arrays can hold a model.

A tree is a leaf (a number) or a ``Split``. An ensemble adds up its trees by weight, which is how boosted trees
predict. ``forest_of`` reads the trees of a fitted pipeline; its expression gives the pipeline's predictions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import ImputerModel, StringIndexerModel
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Split:
    """Rows whose ``feature`` is at most ``at`` (or, of a category, one of ``among``) go to ``low``, others to ``high``."""

    feature: str
    low: Split | float
    high: Split | float
    at: float = 0.0
    among: tuple[float, ...] | None = None


@dataclass(frozen=True)
class Forest:
    """Trees with their weights, what a missing input counts as, and the numbers of the levels of a text input."""

    trees: list[tuple[float, Split | float]]
    fill: dict[str, float] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)
    base: float = 0.0

    def inputs(self) -> list[str]:
        """Inputs that some split asks for, in alphabetical order."""
        found, waiting = set(), [tree for _, tree in self.trees]
        while waiting:
            node = waiting.pop()
            if isinstance(node, Split):
                found.add(node.feature)
                waiting += [node.low, node.high]
        return sorted(found)

    def input(self, name: str, value: Column) -> Column:
        """An input as a number: a level by its place, an unknown one after all others, a missing number by its fill."""
        if name in self.levels:
            labels = F.array(*[F.lit(x) for x in self.levels[name]])
            place = F.array_position(labels, F.coalesce(value.cast("string"), F.lit("")))
            return F.when(place > 0, place - 1).otherwise(len(self.levels[name])).cast("double")
        number = value.cast("double")
        return F.when(number.isNull() | F.isnan(number), F.lit(float(self.fill.get(name, 0.0)))).otherwise(number)

    def prediction(self, value: Callable[[str], Column]) -> Column:
        """The prediction; ``value`` gives each input as a number (see ``input``)."""
        out = F.lit(float(self.base))
        for weight, tree in self.trees:
            out = out + F.lit(float(weight)) * _tree(tree, value)
        return out


def _tree(node: Split | float, value: Callable[[str], Column]) -> Column:
    if not isinstance(node, Split):
        return F.lit(float(node))
    asked = value(node.feature)
    low = asked <= F.lit(float(node.at)) if node.among is None else asked.isin([float(x) for x in node.among])
    return F.when(low, _tree(node.low, value)).otherwise(_tree(node.high, value))


def medians_of(model: PipelineModel) -> dict[str, float]:
    """What the pipeline puts in the place of a missing number, by input."""
    found = {}
    for stage in model.stages:
        if isinstance(stage, ImputerModel):
            found |= {c: float(v) for c, v in stage.surrogateDF.first().asDict().items() if c in stage.getInputCols()}
    return found


def forest_of(model: PipelineModel) -> Forest:
    """The trees of a pipeline of ``fit_point``: indexed series, filled numbers, one vector, boosted trees.

    What is read is the model, which grows with its trees and not with any rows.
    """
    *stages, vector, last = model.stages
    names, levels, own = vector.getInputCols(), {}, {}
    for stage in stages:
        if isinstance(stage, StringIndexerModel):
            levels[stage.getInputCol()] = list(stage.labels)
            own[stage.getOutputCol()] = stage.getInputCol()
        elif isinstance(stage, ImputerModel):
            own |= dict(zip(stage.getOutputCols(), stage.getInputCols()))
    inputs = [own.get(n, n) for n in names]

    def read(node) -> Split | float:
        if node.subtreeDepth() == 0:
            return float(node.prediction())
        split = node.split()
        feature = inputs[split.featureIndex()]
        low, high = read(node.leftChild()), read(node.rightChild())
        if split.getClass().getSimpleName() == "CategoricalSplit":
            return Split(feature, low, high, among=tuple(split.leftCategories()))
        return Split(feature, low, high, at=float(split.threshold()))

    trees = [(float(w), read(tree._java_obj.rootNode())) for w, tree in zip(last.treeWeights, last.trees)]
    return Forest(trees, medians_of(model), levels)
