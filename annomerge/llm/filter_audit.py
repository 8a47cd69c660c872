"""How filters interact: what each order of them removes, by decision diagrams of failure masks.

Rows are reduced to a mask of the filters that they fail, and masks to weighted counts per part, at most 32 of them. Of these
each part gets a diagram: a level per filter, a node's two edges for passing and failing, equal nodes of a level shared, and
at every node the weight of the rows below. Two adjacent levels swap in place, since only their own nodes change, and a
series of such swaps visits all orders; in each the path of passing edges from the root tells all steps.

Defined cases: a null text counts as empty; a null part is the empty one; a row with a null id is a copy of nothing and has no
label; rows that share id and text are no copies of each other, but of any smaller id's; several labels of an id count once, by
their largest; other columns are not looked at; an empty table has no parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annomerge.llm.common import materialise

#: Filters in the order of their bits.
LETTERS = "ABCDE"


def text_failures(text: Column) -> list[Column]:
    """Whether a text fails A, B, C and D: few words, few different ones, many capitals, odd characters."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return [F.size(words) < 50, 100 * F.size(F.array_distinct(words)) < 65 * F.size(words), 100 * capitals > 5 * F.length(text), text.rlike("[#$%&*|]")]


def failure_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per part, ``cells``: for each mask of failures the rows, those labelled good and those labelled toxic.

    Texts are read once, to a narrow written table. Copies are found by SHA-256: the smallest id of each digest is a partial
    minimum, and only digests with two ids are joined back, so that a text with very many copies is split by Spark."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("a_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("a_part"), text.alias("a_text"))
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(text_failures(F.col("a_text")))), F.lit(0))
    narrow = materialise(rows.select("a_id", "a_part", F.unhex(F.sha2(F.col("a_text").cast("binary"), 256)).alias("a_digest"), mask.alias("a_mask")), "masks")
    first = narrow.groupBy("a_digest").agg(F.min("a_id").alias("a_first"), F.max("a_id").alias("a_last")).where("a_first < a_last").drop("a_last")
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("a_id")).agg(F.max((F.col("quality") == 1).cast("long")).alias("a_good"), F.max((F.col("toxic") == 1).cast("long")).alias("a_toxic"))
    copied = F.when(F.col("a_id") > F.col("a_first"), 1 << 4).otherwise(0)
    told = narrow.join(first, "a_digest", "left").select("a_id", "a_part", (F.col("a_mask") + copied).alias("a_mask"))
    counted = told.join(marks, "a_id", "left").groupBy("a_part", "a_mask").agg(F.count("*").alias("n"), F.sum(F.coalesce("a_good", F.lit(0))).alias("good"), F.sum(F.coalesce("a_toxic", F.lit(0))).alias("toxic"))
    return counted.groupBy(F.col("a_part").alias("part")).agg(F.collect_list(F.struct(F.col("a_mask").alias("mask"), "n", "good", "toxic")).alias("cells"))


class Diagram:
    """Levels of nodes (pass, fail), which number nodes of the next level, and behind the last level the weights of masks."""

    def __init__(self, weights: dict[int, tuple[int, ...]], variables: int):
        self.order = list(range(variables))
        none = (0,) * len(next(iter(weights.values())))
        self.leaves: list[tuple[int, ...]] = []
        self.nodes: list[list[tuple[int, int]]] = [[] for _ in range(variables)]
        self.known: list[dict] = [{} for _ in range(variables + 1)]
        self.root = self.build(0, 0, weights, none)

    def build(self, level: int, mask: int, weights: dict, none: tuple) -> int:
        if level == len(self.order):
            return self.shared(level, self.leaves, weights.get(mask, none))
        passes = self.build(level + 1, mask, weights, none)
        return self.shared(level, self.nodes[level], (passes, self.build(level + 1, mask | 1 << level, weights, none)))

    def shared(self, level: int, nodes: list, node: tuple) -> int:
        """The number of a node of a level, the same for equal ones."""
        found = self.known[level].setdefault(node, len(nodes))
        if found == len(nodes):
            nodes.append(node)
        return found

    def swap(self, level: int) -> None:
        """Exchange a level with the next. Its nodes keep their numbers, so that nothing above changes."""
        lower = self.nodes[level + 1]
        self.nodes[level + 1], self.known[level + 1] = [], {}
        again = lambda a, b: self.shared(level + 1, self.nodes[level + 1], (a, b))
        self.nodes[level] = [(again(lower[p][0], lower[f][0]), again(lower[p][1], lower[f][1])) for p, f in self.nodes[level]]
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def weight(self, level: int, node: int) -> tuple[int, ...]:
        """The sum of what lies below a node."""
        if level == len(self.order):
            return self.leaves[node]
        passes, fails = self.nodes[level][node]
        return tuple(a + b for a, b in zip(self.weight(level + 1, passes), self.weight(level + 1, fails)))

    def steps(self) -> list[tuple[int, tuple, tuple, tuple]]:
        """(filter, weight kept, weight removed, weight that fails no other) along the path of passing edges."""
        out, node = [], self.root
        for level, variable in enumerate(self.order):
            passes, fails = self.nodes[level][node]
            alone = fails
            for below in range(level + 1, len(self.order)):
                alone = self.nodes[below][alone][0]
            out.append((variable, self.weight(level + 1, passes), self.weight(level + 1, fails), self.leaves[alone]))
            node = passes
        return out


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places to swap with the next, one after the other, so that n! - 1 swaps visit all orders: the last item moves through
    the others, which change once each time it comes to an end."""
    if n < 2:
        return
    inner, at_end = [*adjacent_swaps(n - 1), None], True
    for place in inner:
        yield from range(n - 2, -1, -1) if at_end else range(n - 1)
        at_end = not at_end
        if place is not None:
            yield place if at_end else place + 1


def interactions(cells: list[dict], letters: str = LETTERS) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every order and step."""
    diagram = Diagram({c["mask"]: (c["n"], c["good"], c["toxic"]) for c in cells}, len(letters))
    paths = [(tuple(diagram.order), diagram.steps())]
    for level in adjacent_swaps(len(letters)):
        diagram.swap(level)
        paths.append((tuple(diagram.order), diagram.steps()))
    failing, shares = {}, [0] * len(letters)
    for order, steps in paths:
        failing[order[0]] = steps[0][2][0]
        for variable, _, removed, _ in steps:
            shares[variable] += removed[0]
    out = []
    for order, steps in paths:
        for k, (variable, kept, removed, alone) in enumerate(steps):
            out.append(("".join(letters[v] for v in order), k + 1, kept[0], removed[0], failing[variable] - removed[0], alone[0], removed[1], removed[2], shares[variable]))
    return out


RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(RESULT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                columns = list(zip(*[(part, *row) for row in interactions(cells)]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return failure_cells(docs, labels, id_col, text_col, part_col).select("part", "cells").mapInArrow(run, RESULT)
