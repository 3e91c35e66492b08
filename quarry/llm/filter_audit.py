"""Filter interaction audit: what every order of a set of filters keeps, removes and hides.

Each document becomes a failure mask (bit ``i``: it fails filter ``i``). Spark counts the masks per part; a
part's histogram has at most ``2**filters`` masks times the label classes, whatever the number of documents.
From it a count-weighted decision diagram is built per part: level ``k`` tests the ``k``-th filter of the
current order, equal subdiagrams are shared, leaves hold the weights (documents, good, toxic). One swap of
two adjacent levels leads from each order to the next one (every order is reached by ``n! - 1`` swaps), and
the all-pass path from the root gives the order's steps: a step removes what hangs below the fail branch.

Duplicates (filter E) are found on digests: texts are counted per (digest, id), so a text held by a third of
all rows reaches the shuffle as one row per task and cell; the owner is the smallest id table-wide.

Defined cases: null texts are empty texts, a null part is the empty string; a document without an id is never
a duplicate and owns nothing; rows that repeat the owner's id are all first; a label counts if any label
row of the id has it; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ready

LETTERS = "ABCDE"
MAX_FILTERS = 7  # an audit has n! orders
WEIGHTS = ("docs", "good", "toxic")
_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def adjacent_swaps(n: int) -> Iterator[int]:
    """Positions k (swap k with k + 1) that lead through all n! orders, each once (plain changes)."""
    items, left = list(range(n)), [True] * n
    while True:
        move = -1
        for v in range(n - 1, -1, -1):  # the largest item that can move in its direction
            at = items.index(v)
            to = at - 1 if left[v] else at + 1
            if 0 <= to < n and items[to] < v:
                move = v
                break
        if move < 0:
            return
        yield min(at, to)
        items[at], items[to] = items[to], items[at]
        for v in range(move + 1, n):
            left[v] = not left[v]


class Diagram:
    """Count-weighted decision diagram with every level kept: ``levels[k]`` are the nodes that test ``order[k]``.

    A node is ``[pass, fail, total]``; a leaf is ``[None, None, total]``. Totals are weight tuples.
    """

    def __init__(self, order: str, masks: dict[int, tuple]):
        self.order = list(order)
        zero = (0,) * len(WEIGHTS)
        leaves: dict = {}
        row = [leaves.setdefault(w, [None, None, w]) for w in (masks.get(m, zero) for m in range(1 << len(order)))]
        self.levels: list[list] = []
        for _ in order:  # bit k of a mask is the filter order[k]; the last filter is joined first
            unique: dict = {}
            half = len(row) // 2
            row = [self._node(unique, row[i], row[i + half]) for i in range(half)]
            self.levels.insert(0, list(unique.values()))
        self.root = row[0]

    @staticmethod
    def _node(unique: dict, low: list, high: list) -> list:
        key = id(low), id(high)
        if key not in unique:
            unique[key] = [low, high, tuple(a + b for a, b in zip(low[2], high[2]))]
        return unique[key]

    def swap(self, k: int) -> None:
        """Exchange levels k and k + 1 in place: nodes of level k keep their identity, the next level is made anew."""
        unique: dict = {}
        for u in self.levels[k]:
            (pp, pf, _), (fp, ff, _) = u[0], u[1]
            u[0], u[1] = self._node(unique, pp, fp), self._node(unique, pf, ff)
        self.levels[k + 1] = list(unique.values())
        self.order[k], self.order[k + 1] = self.order[k + 1], self.order[k]

    def path(self) -> list[tuple]:
        """(letter, kept, removed, fails only this) per step of the all-pass path."""
        out, node = [], self.root
        for letter in self.order:
            alone = node[1]
            while alone[0] is not None:
                alone = alone[0]
            out.append((letter, node[0][2], node[1][2], alone[2]))
            node = node[0]
        return out


def order_steps(letters: str, masks: dict[int, tuple]) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for all n! orders."""
    diagram = Diagram(letters, masks)
    paths = [("".join(diagram.order), diagram.path())]
    for k in adjacent_swaps(len(letters)):
        diagram.swap(k)
        paths.append(("".join(diagram.order), diagram.path()))
    fails, shapley = dict.fromkeys(letters, 0), dict.fromkeys(letters, 0)
    for _, path in paths:
        fails[path[0][0]] = path[0][2][0]  # first in the order: everything it fails
        for letter, _, removed, _ in path:
            shapley[letter] += removed[0]
    return [(order, i + 1, kept[0], removed[0], fails[letter] - removed[0], alone[0], removed[1], removed[2], shapley[letter])
            for order, path in paths for i, (letter, kept, removed, alone) in enumerate(path)]


def audit(masks: DataFrame, letters: str) -> DataFrame:
    """Steps of every order per part, from ``masks`` (part string, mask int, good boolean, toxic boolean, n long).

    ``masks`` may hold any number of rows; they are counted per cell before one diagram is built per part.
    """
    if not 1 <= len(letters) <= MAX_FILTERS or len(set(letters)) != len(letters):
        raise ValueError(f"1 to {MAX_FILTERS} different letters")
    cells = masks.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        table = {int(m): tuple(map(int, w)) for m, *w in zip(pdf["mask"], *(pdf[c] for c in WEIGHTS))}
        out = pd.DataFrame(order_steps(letters, table), columns=["filter_order", "step", *_COUNTS])
        out.insert(0, "part", key[0])
        return out

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)
    return ready(cells).groupBy("part").applyInPandas(run, schema)


def document_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "lang") -> DataFrame:
    """Counts of (part, mask, good, toxic) of the five document filters; bit i is ``LETTERS[i]``.

    A: under 100 words. B: under 80 % distinct words. C: over 10 % of the code points are A-Z.
    D: holds any of ``#$%&*|``. E: the text equals that of a smaller id.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("t"))
    words = F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), "")
    n, chars = F.size(words), F.char_length("t")
    upper = chars - F.char_length(F.translate("t", _AZ, ""))
    fails = [n < 100, F.size(F.array_distinct(words)) * 100 < n * 80, upper.cast("long") * 100 > chars.cast("long") * 10,
             F.col("t").rlike(r"[#$%&*|]")]
    mask = sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))
    rows = src.select("id", "part", F.unhex(F.sha2("t", 256)).alias("digest"), mask.alias("mask"))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    cell = ["digest", "part", "mask", "good", "toxic"]
    no = F.lit(False)
    per_id = (rows.join(marks, "id", "left").withColumns({"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)})
              .groupBy("id", *cell).agg(F.count(F.lit(1)).alias("n")))
    cells = per_id.groupBy(*cell).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least"))
    # one text has few cells (parts times label classes), whatever its number of copies
    owner = F.min("least.id").over(Window.partitionBy("digest"))
    first = F.col("unnamed") + F.when(F.col("least.id") == F.col("owner"), F.col("least.n")).otherwise(0)
    split = F.inline(F.array(F.struct(F.col("mask"), F.col("first").alias("n")),
                             F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("first")).alias("n"))))
    return (cells.withColumn("owner", owner).withColumn("first", first)
            .select("part", "good", "toxic", split).where(F.col("n") > 0)
            .groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")))


def audit_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    part_col: str = "lang") -> DataFrame:
    """The audit of the five document filters (see ``document_masks``) per value of ``part_col``."""
    return audit(document_masks(docs, labels, id_col, text_col, part_col), LETTERS)

