"""A user's own functions over sessions: one function, called from DataFrames and from SQL.

A function gets the rows of a session as Arrow tables, one or two of them, and returns a table (Arrow or pandas) with the
columns of a declared schema; the session's keys are put in front. Spark deals sessions to tasks; a session meets in one
task, so it may have at most ``most_rows`` rows (a session of an experiment has some thousands): more is an error that names
the session, not a task that runs out of memory. Sessions that only one of two tables has get the other without rows.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

MOST_ROWS = 1_000_000


def _bounded(key: tuple, most: int, *tables: pa.Table) -> None:
    for table in tables:
        if len(table) > most:
            raise ValueError(f"session {key} has {len(table)} rows, at most {most} are allowed")


def _shaped(made, key: tuple, kinds: pa.Schema) -> pa.Table:
    """What a user's function made, with the session's keys in front, in the declared names and types."""
    table = made if isinstance(made, pa.Table) else pa.Table.from_pandas(made, preserve_index=False)
    own = kinds.names[len(key) :]
    if absent := [c for c in own if c not in table.column_names]:
        raise ValueError(f"session {key}: the function's result lacks {', '.join(absent)}")
    columns = [pa.array([k] * len(table), kinds.field(i).type) for i, k in enumerate(key)]
    columns += [pa.chunked_array(table.column(c).chunks, table.schema.field(c).type).cast(kinds.field(c).type) for c in own]
    return pa.Table.from_arrays(columns, schema=kinds)


def _kinds(df: DataFrame, keys: list[str], schema: str) -> tuple[StructType, pa.Schema]:
    whole = StructType([*[df.schema[k] for k in keys], *StructType.fromDDL(schema)])
    return whole, to_arrow_schema(whole)


def apply(df: DataFrame, keys: list[str], fn: Callable, schema: str, most_rows: int = MOST_ROWS) -> DataFrame:
    """fn(table) of each session's rows: keys and the columns of schema."""
    whole, kinds = _kinds(df, keys, schema)

    def run(key, table):
        key = tuple(k.as_py() for k in key)
        _bounded(key, most_rows, table)
        return _shaped(fn(table), key, kinds)

    return df.groupBy(*keys).applyInArrow(run, whole)


def apply_two(left: DataFrame, right: DataFrame, keys: list[str], fn: Callable, schema: str, most_rows: int = MOST_ROWS) -> DataFrame:
    """fn(left table, right table) of each session that one of them has: keys and the columns of schema."""
    whole, kinds = _kinds(left, keys, schema)
    empty = [to_arrow_schema(t.schema).empty_table() for t in (left, right)]

    def run(key, a, b):
        key = tuple(k.as_py() for k in key)
        _bounded(key, most_rows, a, b)
        return _shaped(fn(a if len(a) else empty[0], b if len(b) else empty[1]), key, kinds)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, whole)


def register(spark: SparkSession, name: str, keys: list[str], fn: Callable, schema: str, left: DataFrame, right: DataFrame | None = None, most_rows: int = MOST_ROWS) -> str:
    """Makes fn a table function for SQL and returns the query that calls it over left (and right):

    ``SELECT * FROM name(TABLE(name_rows) PARTITION BY (keys))``. The view name_rows has keys, and a row of left as ``a`` or one
    of right as ``b``; it may be filtered or replaced by another table of that form. Nothing runs before the query does."""
    from pyspark.sql.functions import udtf

    whole, kinds = _kinds(left, keys, schema)
    tables = [left] if right is None else [left, right]
    forms = [t.schema for t in tables]
    arrow = [to_arrow_schema(f) for f in forms]

    class Function:
        def __init__(self):
            self.key, self.rows = None, [[] for _ in arrow]

        def eval(self, row):
            if self.key is None:
                self.key = tuple(row[k] for k in keys)
            for side, own in zip("ab", self.rows):
                if side in row and row[side] is not None:
                    own.append(row[side].asDict(recursive=True))
                    if len(own) > most_rows:
                        raise ValueError(f"session {self.key} has more than {most_rows} rows")

        def terminate(self):
            if self.key is not None:
                made = _shaped(fn(*[pa.Table.from_pylist(own, schema=kind) for own, kind in zip(self.rows, arrow)]), self.key, kinds)
                for line in made.to_pylist():
                    yield tuple(line.values())

    spark.udtf.register(name, udtf(Function, returnType=whole))
    sides = "ab"[: len(tables)]
    parts = []
    for side, table in zip(sides, tables):
        structs = [F.struct(*[F.col(f"`{c}`") for c in t.columns]) if t is table else F.lit(None).cast(form) for t, form in zip(tables, forms)]
        parts.append(table.select(*[F.col(f"`{k}`") for k in keys], *[s.alias(x) for s, x in zip(structs, sides)]))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rows.createOrReplaceTempView(f"{name}_rows")
    return f"SELECT * FROM {name}(TABLE({name}_rows) PARTITION BY ({', '.join(f'`{k}`' for k in keys)}))"
