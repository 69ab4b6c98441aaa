"""Lookup tables as DataFrames.

The built-in tables hold 10 to 114 rows and are inlined as ``VALUES``, so Catalyst knows their size
and broadcasts them by itself. Callers may replace any table by their own DataFrame; such a table
is broadcast only after its size was checked (:func:`measured`), otherwise Spark picks the join.
"""

from __future__ import annotations

from collections.abc import Mapping
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import values

BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 64 << 20

# name -> (row source, {column: Spark type})
_TABLES = {
    "department": (
        values.departments,
        {
            "dept_no": "int", "department": "string", "alloc_no": "int", "weight": "bigint",
            "margin": "decimal(4,2)", "cost_low": "double", "cost_mode": "double",
            "cost_high": "double", "private_label_rate": "double", "brands": "array<string>",
            "n_categories": "int", "n_subcategories": "int",
        },
    ),
    "category": (
        values.categories,
        {
            "dept_no": "int", "department": "string", "cat_id": "int", "cat_no": "int",
            "category": "string", "subcategories": "array<string>",
        },
    ),
    "taxonomy": (
        values.taxonomy,
        {
            "dept_no": "int", "department": "string", "cat_id": "int", "category": "string",
            "sub_no": "int", "flat_no": "int", "subcategory": "string",
        },
    ),
    "gst_free": (values.gst_free, {"department": "string", "category": "string"}),
    "shelf_life": (
        values.shelf_life,
        {"category": "string", "shelf_life_days": "double", "wastage_rate": "double"},
    ),
    "fresh": (
        values.fresh_goods,
        {
            "spec_no": "int", "name": "string", "category": "string", "subcategory": "string",
            "unit_of_measure": "string", "pack_size": "double", "cost": "decimal(10,2)",
            "shelf_life_days": "double", "wastage_rate": "double", "months": "array<double>",
        },
    ),
    "name_template": (
        values.name_templates,
        {"subcategory": "string", "templates": "array<string>"},
    ),
}


# What identifies a row; repeated rows of a caller's table would multiply the rows they join.
_KEYS = {
    "department": ["department"],
    "category": ["department", "category"],
    "taxonomy": ["department", "category", "subcategory"],
    "gst_free": ["department", "category"],
    "shelf_life": ["category"],
    "fresh": ["spec_no"],
    "name_template": ["subcategory"],
}


def names() -> list[str]:
    return list(_TABLES)


def _cell(v, array: str) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, list):
        inner = ", ".join(_cell(x, array) for x in v)
        return array.format(inner)
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"{v!r}"
    return str(v)


def values_sql(name: str, array: str = "array({})", types: Mapping[str, str] | None = None) -> str:
    """The table as a SELECT over inline VALUES; ``array`` and ``types`` name the dialect."""
    source, schema = _TABLES[name]
    cols = list(schema)
    rows = ",\n  ".join(
        "(" + ", ".join(_cell(r[c], array) for c in cols) + ")" for r in source()
    )
    casts = ", ".join(f"cast({c} as {(types or {}).get(t, t)}) as {c}" for c, t in schema.items())
    return f"select {casts} from (values\n  {rows}) as t({', '.join(cols)})"


def measured(df: DataFrame) -> tuple[int, bool]:
    """(rows, small enough to broadcast) of a caller's table, without reading far beyond the bound.

    Rows count up to BROADCAST_ROWS + 1 only; the size is that of the rows as text.
    """
    size = F.length(F.to_json(F.struct(*df.columns)))
    head = df.limit(BROADCAST_ROWS + 1).agg(
        F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")
    )
    r = head.first()
    return r.n, r.n <= BROADCAST_ROWS and r.bytes <= BROADCAST_BYTES


_BUILTIN: WeakKeyDictionary[SparkSession, dict[str, DataFrame]] = WeakKeyDictionary()


def _builtin(spark: SparkSession, name: str) -> DataFrame:
    """A built-in table, parsed once per session."""
    tables = _BUILTIN.setdefault(spark, {})
    if name not in tables:
        tables[name] = F.broadcast(spark.sql(values_sql(name)))
    return tables[name]


class Lookups:
    """The lookup tables of one job; ``replace`` swaps in the caller's own tables."""

    def __init__(self, spark: SparkSession, replace: Mapping[str, DataFrame] | None = None):
        self.spark = spark
        self.derived: dict[str, DataFrame] = {}  # tables made from these lookups, built once
        self._own: dict[str, DataFrame] = {}
        self._rows: dict[str, int] = {}
        self._large: set[str] = set()
        for name, df in (replace or {}).items():
            if missing := set(_TABLES[name][1]) - set(df.columns):
                raise ValueError(f"lookup {name} lacks columns {sorted(missing)}")
            keys = _KEYS[name]
            if repeated := df.groupBy(*keys).count().filter("count > 1").limit(5).collect():
                shown = ", ".join(str(tuple(r[k] for k in keys)) for r in repeated)
                raise ValueError(f"lookup {name} repeats {keys}: {shown}")
            self._rows[name], small = measured(df)
            self._own[name] = F.broadcast(df) if small else df
            if not small:
                self._large.add(name)

    @classmethod
    def builtin(cls, spark: SparkSession) -> Lookups:
        """The built-in tables, shared by all jobs of a session."""
        if spark not in _SHARED:
            _SHARED[spark] = cls(spark)
        return _SHARED[spark]

    def table(self, name: str) -> DataFrame:
        """The table, with a broadcast hint if its size allows."""
        return self._own[name] if name in self._own else _builtin(self.spark, name)

    def rows(self, name: str) -> int:
        """Row count of the table."""
        if name not in self._own:
            return len(_TABLES[name][0]())
        if self._rows[name] > BROADCAST_ROWS:
            return self._own[name].count()
        return self._rows[name]

    def hint(self, df: DataFrame, *sources: str) -> DataFrame:
        """Broadcast ``df``, which has one row per row of its ``sources``, if they are all small."""
        return df if self._large & set(sources) else F.broadcast(df)


_SHARED: WeakKeyDictionary[SparkSession, Lookups] = WeakKeyDictionary()
