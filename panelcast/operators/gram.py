"""Means and centred products of many columns, and what follows from them without reading rows again.

Products of p columns are p * (p + 1) / 2 sums. They are taken in blocks of columns, each block a plain aggregate that
is merged from partial sums and small enough to compile, and each reading only the columns of its block. What reaches
the driver are p means and p * p sums, whatever the number of rows. Correlations, collinear pairs and the linear fits
of every nested set of inputs are worked out from these.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.session import settle

#: Columns of one side of a block: at most this many squared sums in one aggregate.
BLOCK = 12
#: An input of which earlier ones leave less than this share of its variance adds nothing to a fit.
LEFT_OVER = 1e-6


@dataclass(frozen=True)
class Gram:
    """``rows`` read, ``means`` of the known values, and sums of products of what lies beside the means.

    A missing value counts as the mean of its column, so it adds nothing to a product.
    """

    names: list[str]
    rows: int
    means: np.ndarray
    products: np.ndarray

    def at(self, names: Iterable[str]) -> list[int]:
        return [self.names.index(n) for n in names]

    def correlations(self) -> np.ndarray:
        """Correlation of every pair; not a number where a column is constant."""
        spread = np.sqrt(np.diag(self.products))
        with np.errstate(divide="ignore", invalid="ignore"):
            found = self.products / np.outer(spread, spread)
        found[~(spread > 0), :] = np.nan
        found[:, ~(spread > 0)] = np.nan
        return found


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The columns as doubles, flags as 0 and 1; what is no number is missing."""
    kinds = dict(df.dtypes)
    typed = [(c, F.col(c).cast("int").cast("double") if kinds[c] == "boolean" else F.col(c).try_cast("double")) for c in columns]
    return df.select(*[F.when(~F.isnan(v), v).alias(c) for c, v in typed])


def gram(df: DataFrame, columns: Iterable[str], block: int = BLOCK, settled: bool = False) -> Gram:
    """Two passes over the rows: the means, then the centred products block by block.

    Rows are settled first unless they come from files already (``settled``). An empty frame has no rows, no means and
    products of 0; a column without any value has a mean of 0 and products of 0.
    """
    names = list(columns)
    rows = numbers(df, names)
    rows = rows if settled else settle(rows)
    first = rows.agg(F.count(F.lit(1)), *[F.avg(c) for c in names]).first()
    means = np.array([m or 0.0 for m in first[1:]], dtype=float)

    # expressions as text: a call to the JVM for each of thousands of sums would take longer than the sums
    def beside(i: int) -> str:
        return f"coalesce({_quoted(names[i])} - ({float(means[i])!r}D), 0D) AS c{i}"

    parts = [range(k, min(k + block, len(names))) for k in range(0, len(names), block)]
    sums = []
    for one, other in combinations_with_replacement(parts, 2):
        cells = ", ".join(f"sum(c{i} * c{j})" for i in one for j in other if i <= j)
        centred = rows.selectExpr(*[beside(i) for i in sorted({*one, *other})])
        sums.append(centred.selectExpr(f"{one[0]} AS one", f"{other[0]} AS other", f"array({cells}) AS sums"))
    products = np.zeros((len(names), len(names)))
    for row in reduce(DataFrame.union, sums).collect() if sums else []:
        cells = [(i, j) for i in range(row.one, len(names))[:block] for j in range(row.other, len(names))[:block] if i <= j]
        for (i, j), s in zip(cells, row.sums):
            products[i, j] = products[j, i] = s or 0.0
    return Gram(names, int(first[0]), means, products)


@dataclass(frozen=True)
class LinearFit:
    """``intercept`` plus the sum of ``coefficients`` times inputs, a missing input at its mean."""

    inputs: list[str]
    coefficients: list[float]
    means: list[float]
    intercept: float

    def prediction(self) -> Column:
        """The prediction of a row, as an expression of its columns."""
        terms = [f"({self.intercept!r}D)"]
        for name, b, mean in zip(self.inputs, self.coefficients, self.means):
            if b:
                value = f"nanvl(try_cast({_quoted(name)} AS DOUBLE), NULL)"
                terms.append(f"({b!r}D) * coalesce({value}, {mean!r}D)")
        return F.expr(" + ".join(terms))


def nested_fits(g: Gram, y: str, order: Iterable[str], sizes: Iterable[int], left_over: float = LEFT_OVER) -> dict[int, LinearFit]:
    """Least-squares fits of ``y`` on the first n inputs of ``order``, for every n of ``sizes``.

    One Cholesky factor serves them all, as that of the first n inputs is its upper left corner. An input that the
    earlier ones explain but for ``left_over`` of its variance gets no coefficient, in this and all larger sets.
    """
    order = list(order)
    at = g.at(order)
    products, target = g.products[np.ix_(at, at)], g.products[at, g.names.index(y)]
    factor, reached, used = np.zeros_like(products), np.zeros(len(at)), []
    for j in range(len(at)):
        rest = products[j, j] - factor[j, :j] @ factor[j, :j]
        if products[j, j] <= 0 or rest <= left_over * products[j, j]:
            continue
        used.append(j)
        factor[j, j] = np.sqrt(rest)
        factor[j + 1 :, j] = (products[j + 1 :, j] - factor[j + 1 :, :j] @ factor[j, :j]) / factor[j, j]
        reached[j] = (target[j] - factor[j, :j] @ reached[:j]) / factor[j, j]
    fits, mean_y = {}, float(g.means[g.names.index(y)])
    for n in sizes:
        kept = [j for j in used if j < n]
        b = np.zeros(n)
        if kept:
            b[kept] = np.linalg.solve(factor[np.ix_(kept, kept)].T, reached[kept])
        means = g.means[at[:n]]
        fits[n] = LinearFit(order[:n], b.tolist(), means.tolist(), mean_y - float(b @ means))
    return fits
