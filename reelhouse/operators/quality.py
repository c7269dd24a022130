"""Integrity of the warehouse contract: types, NOT NULL, primary and foreign keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.functions.keys import packed_id
from reelhouse.functions.values import int_or_null, numeric_or_null
from reelhouse.schemas import WAREHOUSE, Table
from reelhouse.session import staged, unbroadcast


class IntegrityError(ValueError):
    """A publish was refused."""


def convert(c: Column, to: T.DataType) -> Column:
    """Value in the column's type; text that is no such value becomes null."""
    if isinstance(to, T.IntegerType):
        return int_or_null(c.cast("string"))
    if isinstance(to, T.DoubleType):
        return numeric_or_null(c.cast("string"))
    if isinstance(to, T.BooleanType):
        return c.cast("string").try_cast("boolean")
    return c.cast(to)


def _converted(df: DataFrame, name: str, to: T.DataType) -> Column:
    if name not in df.columns:
        return F.lit(None).cast(to).alias(name)
    same = df.schema[name].dataType == to
    return F.col(name) if same else convert(F.col(name), to).alias(name)


def typed_rows(df: DataFrame, table: Table) -> DataFrame:
    """Rows in the table's column order and types.

    A column the table does not have is an error; so is a value that does not
    convert, raised when the row is written.
    """
    unknown = sorted(set(df.columns) - set(table.columns))
    if unknown:
        raise IntegrityError(f"{table.name} has no column {', '.join(unknown)}")
    checked = []
    for name, to in table.columns.items():
        value = _converted(df, name, to)
        if name in df.columns and df.schema[name].dataType != to:
            lost = F.col(name).isNotNull() & value.isNull()
            message = F.concat(
                F.lit(f"{table.name}.{name}: not a {to.simpleString()}: "),
                F.col(name).cast("string"),
            )
            value = F.when(lost, F.raise_error(message).cast(to)).otherwise(value)
        checked.append(value.alias(name))
    return df.select(*checked)


def cast_rejects(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """(column_name, value, rows) for every text that does not convert."""
    reports = []
    for name, to in types.items():
        bad = df.where(F.col(name).isNotNull() & convert(F.col(name), to).isNull())
        reports.append(
            bad.groupBy(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("rows"))
        )
    return reduce(DataFrame.unionByName, reports)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def repeated_keys(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> dict[str, DataFrame]:
    """`duplicate_keys` of (rows, key) by name, where few are expected; names without any are left out.

    Keys are counted by a hash first, in one job, and only those whose hash comes again are grouped as they are: a clean
    table shuffles eight bytes a row.
    """
    hashed = {n: df.select(*key, F.xxhash64(*key).alias("_hash")) for n, (df, key) in tables.items()}
    often = [
        df.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.lit(n).alias("_of"), "_hash")
        for n, df in hashed.items()
    ]
    again = staged(reduce(DataFrame.unionByName, often), "repeated")
    # One name per table at most.
    found = {r["_of"] for r in again.select("_of").distinct().collect()}
    return {
        n: duplicate_keys(df.join(again.where(F.col("_of") == n).select("_hash"), "_hash", "left_semi"), tables[n][1])
        for n, df in hashed.items()
        if n in found
    }


def null_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows with a null in any required column."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required]))


def orphans(df: DataFrame, fk: str, target: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose foreign key has no target row.

    Only distinct keys are looked up first; a clean table shuffles its keys, not
    its rows.
    """
    keys = target.select(F.col(key).alias(fk))
    missing = df.select(fk).distinct().join(keys, fk, "left_anti")
    return df.join(missing, fk, "left_semi")


def violations(tables: Mapping[str, DataFrame], known: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(table_name, rule, rows) of every broken rule; empty means publishable.

    With `known` tables, foreign keys may refer to their rows as well.
    """
    reports = []

    def report(table: str, rule: str, counted: DataFrame) -> None:
        reports.append(
            counted.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "rows"
            )
        )

    repeated = repeated_keys({n: (tables[n], contract.primary_key) for n, contract in WAREHOUSE.items()})
    for name, contract in WAREHOUSE.items():
        df = tables[name]
        report(name, "not null", null_violations(df, contract.required))
        if name in repeated:
            report(name, "primary key", repeated[name])
        for fk, target in contract.foreign_keys.items():
            keys = tables[target].select(packed_id("id").alias(fk))
            if known is not None:
                keys = keys.union(known[target].select(packed_id("id")))
            missing = df.select(packed_id(fk).alias(fk)).distinct().join(unbroadcast(keys), fk, "left_anti")
            report(name, f"foreign key {fk}", missing)
    return reduce(DataFrame.unionByName, reports).where("rows > 0")


def require_valid(tables: Mapping[str, DataFrame], known: Mapping[str, DataFrame] | None = None) -> None:
    """Raise if any rule is broken; the report is at most one line per rule."""
    broken = violations(tables, known).collect()
    if broken:
        lines = "; ".join(f"{r.table_name}: {r['rule']} ({r['rows']})" for r in broken)
        raise IntegrityError(f"publish refused: {lines}")
