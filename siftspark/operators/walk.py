"""Nested values as rows: every key, element and scalar of a VARIANT with its path, unfolded level by level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.session import checkpointed

#: Levels that a document may be nested at most; one that is deeper gives a row that says so.
DEPTH = 32
#: Levels that one pass unfolds; what is nested deeper is kept for the next pass.
STEP = 4
_VALUES = "array<struct<path: string, name: string, v: variant, shape: string, level: int>>"


def walk(df: DataFrame, key: list[str], value: str, depth: int = DEPTH) -> DataFrame:
    """(key columns, path, name, kind, scalar, level) of every value inside the VARIANT column, itself included, as JSON pointers.

    ``name`` is the key that holds a value (null for elements and the root), ``kind`` one of object, array, string, number,
    boolean, null, and ``scalar`` its text (null for containers and null).  Names are escaped as pointers ask (``~0``, ``~1``).  A null column gives no rows.
    Values nested deeper than ``depth`` have kind ``too_deep``.  A pass has a column for each of its levels, unfolded from the containers of the one before it, and one
    generator makes rows of all of them.  Containers that are deeper are written down, and the next pass starts from them, so that no level is unfolded from the
    root again: the input is parsed twice, for its rows and for what is deeper than the first pass.
    """
    root = F.array(_value(F.lit(""), F.lit(None).cast("string"), F.col(value), 0)).cast(_VALUES)
    rows = df.select(*key, F.when(F.col(value).isNotNull(), root).otherwise(F.array().cast(_VALUES)).alias("_0"))
    out, first, top = None, 0, 0
    while True:
        start, top = top, min(top + STEP, depth)
        for n in range(start + 1, top + 1):
            rows = rows.withColumn(f"_{n}", F.flatten(F.transform(F.filter(f"_{n - 1}", lambda x: _container(x["shape"])), lambda x: _inside(x, n))))  # noqa: B023
        found = _exploded(rows, key, F.concat(*(f"_{n}" for n in range(first, top + 1))))
        out = found if out is None else out.unionByName(found)
        if top == depth:
            break
        left = checkpointed(_exploded(rows, key, F.filter(f"_{top}", lambda x: _container(x["shape"]))))
        if not left.take(1):
            break
        rows, first = left.select(*key, F.array("_x").alias(f"_{top}")), top + 1
    kind = F.when((F.col("_x.level") == depth) & _container(F.col("_x.shape")), "too_deep").otherwise(_kind(F.col("_x.shape")))
    rows = out.select(*key, "_x.path", "_x.name", kind.alias("kind"), "_x.v", "_x.level")
    scalar = F.when(~F.col("kind").isin("object", "array", "null", "too_deep"), F.try_variant_get("v", "$", "string"))
    return rows.select(*key, "path", "name", "kind", scalar.alias("scalar"), "level")


def _exploded(rows: DataFrame, key: list[str], values: Column) -> DataFrame:
    """The values as rows.  The outer form: for the inner one Spark infers filters that work the levels out again."""
    return rows.select(*key, F.explode_outer(values).alias("_x")).where("_x is not null")


def _value(path: Column, name: Column, v: Column, level: int) -> Column:
    return F.struct(path.alias("path"), name.alias("name"), v.alias("v"), F.schema_of_variant(v).alias("shape"), F.lit(level).alias("level"))


def _inside(x: Column, level: int) -> Column:
    """The values right inside a container."""
    escaped = lambda k: F.replace(F.replace(k, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
    members = F.map_entries(F.try_variant_get(x["v"], "$", "map<string,variant>"))
    named = F.transform(members, lambda e: _value(F.concat_ws("/", x["path"], escaped(e["key"])), e["key"], e["value"], level))
    elements = F.try_variant_get(x["v"], "$", "array<variant>")
    placed = F.transform(elements, lambda e, i: _value(F.concat_ws("/", x["path"], i.cast("string")), F.lit(None).cast("string"), e, level))
    return F.when(x["shape"].startswith("OBJECT"), named.cast(_VALUES)).otherwise(placed.cast(_VALUES))


def _container(shape: Column) -> Column:
    return shape.startswith("OBJECT") | shape.startswith("ARRAY")


def _kind(shape: Column) -> Column:
    return (
        F.when(shape.startswith("OBJECT"), "object").when(shape.startswith("ARRAY"), "array").when(shape == "VOID", "null")
        .when(shape == "STRING", "string").when(shape == "BOOLEAN", "boolean").otherwise("number")
    )


def executable_parts(df: DataFrame, key: list[str], value: str, names: list[str], pattern: str) -> DataFrame:
    """(key columns, path, rule) of what a client would run: ``key`` for a key of these names (any case) whose value isn't null or
    empty, ``reference`` for a string that matches the pattern.  Only whole keys and scalars count: a title that mentions one is none."""
    rows = walk(df, key, value)
    named = F.lower("name").isin([n.lower() for n in names]) & (F.col("kind") != "null") & ~F.coalesce((F.col("kind") == "string") & (F.trim("scalar") == ""), F.lit(False))
    rule = F.when(named, "key").when((F.col("kind") == "string") & F.col("scalar").rlike(pattern), "reference").when(F.col("kind") == "too_deep", "too_deep")
    return rows.select(*key, "path", rule.alias("rule")).where("rule is not null")
