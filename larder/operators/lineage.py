"""Which source columns each column of a DataFrame is made from, and by which expression.

The analysed plan names every column by an id; a projection, aggregate or window makes new ids from others, and
the leaves give the ids of source columns. A view counts as a source of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "output_column string, source_table string, source_column string, expression string, position int"


@dataclass(frozen=True)
class Edge:
    """One source column of an output column; a column made of literals alone has an edge without a source."""

    output_column: str
    source_table: str | None
    source_column: str | None
    expression: str


class _Walk:
    def __init__(self, spark: SparkSession):
        self.list = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava
        self.sources: dict[int, tuple[str, str]] = {}
        self.made: dict[int, tuple[str | None, list[int]]] = {}  # text (None: a plain rename) and inputs
        self.also: dict[int, list[int]] = {}  # columns of a union's further branches

    def ids(self, expression) -> list[int]:
        return [a.exprId().id() for a in self.list(expression.references().toSeq())]

    def name_of(self, leaf) -> str:
        kind = leaf.nodeName()
        if kind == "View":
            return _table(leaf.desc().identifier())
        if hasattr(leaf, "catalogTable") and kind.startswith("LogicalRelation") or kind == "HiveTableRelation":
            if leaf.catalogTable().isDefined():
                return _table(leaf.catalogTable().get().identifier())
        if kind.startswith("LogicalRelation") and hasattr(leaf.relation(), "location"):
            paths = self.list(leaf.relation().location().rootPaths())
            if len(paths):
                return paths[0].getName()
        return kind

    def visit(self, plan) -> None:
        kind = plan.nodeName()
        children = [] if kind == "View" else self.list(plan.children())
        if not children:
            name = self.name_of(plan)
            for a in self.list(plan.output()):
                self.sources[a.exprId().id()] = (name, a.name())
            return
        for child in children:
            self.visit(child)
        inner = []
        for sub in self.list(plan.subqueries()):
            self.visit(sub)
            inner += [a.exprId().id() for a in self.list(sub.output())]
        if kind == "Union":
            outputs = [self.list(c.output()) for c in children]
            for place, a in enumerate(self.list(plan.output())):
                others = [o[place].exprId().id() for o in outputs]
                self.also.setdefault(a.exprId().id(), []).extend(i for i in others if i != a.exprId().id())
        if kind == "Generate":
            for a in self.list(plan.generatorOutput()):
                self.made[a.exprId().id()] = (plan.generator().sql(), self.ids(plan.generator()))
        for e in self.list(plan.expressions()):
            if e.nodeName() == "Alias":
                child, text = e.child(), e.child().sql()
                plain = child.nodeName() == "AttributeReference"
                inputs = self.ids(e) + (inner if "scalarsubquery(" in text else [])
                self.made[e.exprId().id()] = (None if plain else text, inputs)

    def roots(self, i: int, seen: set[int]) -> set[tuple[str, str]]:
        if i in seen:
            return set()
        seen.add(i)
        out = {self.sources[i]} if i in self.sources else set()
        for j in [*self.made.get(i, (None, []))[1], *self.also.get(i, [])]:
            out |= self.roots(j, seen)
        return out

    def text(self, i: int, name: str) -> str:
        """The last expression that is more than another name."""
        while i in self.made:
            text, inputs = self.made[i]
            if text is not None:
                return text
            i = inputs[0]
        return self.sources[i][1] if i in self.sources else name


def _table(identifier) -> str:
    database = identifier.database()
    return f"{database.get()}.{identifier.table()}" if database.isDefined() else identifier.table()


def column_edges(df: DataFrame) -> list[Edge]:
    """The edges of all columns of ``df``, in the order of its columns. Reads the plan, no data."""
    walk = _Walk(df.sparkSession)
    plan = df._jdf.queryExecution().analyzed()
    walk.visit(plan)
    edges = []
    for a in walk.list(plan.output()):
        i, name = a.exprId().id(), a.name()
        sources = sorted(walk.roots(i, set())) or [(None, None)]
        edges += [Edge(name, t, c, walk.text(i, name)) for t, c in sources]
    return edges


def lineage_table(df: DataFrame) -> DataFrame:
    """:func:`column_edges` as rows; ``position`` is the place of the output column."""
    places = {c: i for i, c in enumerate(df.columns)}
    rows = [(e.output_column, e.source_table, e.source_column, e.expression, places[e.output_column]) for e in column_edges(df)]
    return df.sparkSession.createDataFrame(rows, SCHEMA)


def trace(last: DataFrame, *earlier: DataFrame) -> DataFrame:
    """Edges of a table followed back through the edges of the tables it is made from, nearest first.

    ``earlier`` are pairs of edges by name: a column that an earlier table doesn't list stays where it is. One row per
    output column and first source, with the number of steps between them.
    """
    out = last.select("output_column", "source_table", "source_column", F.lit(1).alias("steps"))
    for edges in earlier:
        back = edges.select(
            F.col("output_table").alias("_t"), F.col("output_column").alias("_c"),
            F.col("source_table").alias("_st"), F.col("source_column").alias("_sc"),
        )
        found = F.col("_c").isNotNull()
        out = out.join(back, (F.col("source_table") == F.col("_t")) & (F.col("source_column") == F.col("_c")), "left").select(
            "output_column",
            F.when(found, F.col("_st")).otherwise(F.col("source_table")).alias("source_table"),
            F.when(found, F.col("_sc")).otherwise(F.col("source_column")).alias("source_column"),
            (F.col("steps") + F.when(found, 1).otherwise(0)).alias("steps"),
        )
    return out.distinct()
