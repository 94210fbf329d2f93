"""Column mapping and constant columns.

Each operator is a single ``select`` (renames are aliases, so a swap such as
``IsPurchase`` <-> ``IsSupplier`` is simultaneous; chained
``withColumnRenamed`` would collapse it into two equal names).
Validation only looks at ``df.columns``: no job runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import SPARK_TYPES, default_value

Mapping = list[tuple[str, str]]


class MappingError(ValueError):
    pass


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def add_constant_if_absent(df: DataFrame, name: str, value) -> DataFrame:
    """Add ``name`` as a constant only when the frame lacks it (``Division``)."""
    if value is None or name in df.columns:
        return df
    return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))


def add_constant(df: DataFrame, name: str, value, dtype: str | None = None) -> DataFrame:
    """``name`` := ``value`` on every row (replacing an existing column).

    A missing value is an error (the reference returns no frame at all).
    """
    if value is None:
        raise MappingError(f"no value for constant column '{name}'")
    v = F.lit(value)
    return df.withColumn(name, v.cast(dtype) if dtype else v)


def drop_technical(df: DataFrame, columns=("__metadata",)) -> DataFrame:
    """Drop technical columns such as the OData ``__metadata`` record."""
    return df.drop(*[c for c in columns if c in df.columns])


def empty_frame(spark: SparkSession, columns: list[str] | T.StructType) -> DataFrame:
    """An empty frame that still carries the target columns."""
    if isinstance(columns, T.StructType):
        schema = columns
    else:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.createDataFrame([], schema)


def map_keep(df: DataFrame, mapping: Mapping, tenant_column: str | None = None,
             tenant_value=None) -> DataFrame:
    """B1 (+B5, B6): rename mapped columns, keep unmapped ones, keep the order;
    fail naming every mapped target that is still missing."""
    if tenant_column:
        df = add_constant_if_absent(df, tenant_column, tenant_value)
    rename = {s: t for s, t in mapping}
    out = [_c(c).alias(rename.get(c, c)) for c in df.columns]
    result = df.select(*out)
    missing = [t for _, t in mapping if t not in result.columns]
    if missing:
        raise MappingError(f"target columns missing after mapping: {missing}")
    return result


def map_project(df: DataFrame, mapping: Mapping, tenant_column: str | None = None,
                tenant_value=None) -> DataFrame:
    """B2: as ``map_keep``, then exactly the mapping's targets in mapping order."""
    if tenant_column:
        df = add_constant_if_absent(df, tenant_column, tenant_value)
    missing = [s for s, _ in mapping if s not in df.columns]
    if missing:
        raise MappingError(f"target columns missing after mapping: {[t for s, t in mapping if s in missing]}")
    return df.select(*[_c(s).alias(t) for s, t in mapping])


def map_select(df: DataFrame, mapping: Mapping) -> DataFrame:
    """Keep the mapping's source columns only (a missing one fails), then rename."""
    missing = [s for s, _ in mapping if s not in df.columns]
    if missing:
        raise MappingError(f"source columns missing: {missing}")
    return df.select(*[_c(s).alias(t) for s, t in mapping])


def mapping_rows(rows: DataFrame, table_id: int | None = None) -> list[tuple[str, str, str | None]]:
    """Read the (small) mapping rows of one table to the driver.

    The mapping is metadata, one row per column, never data rows.
    """
    if table_id is not None:
        rows = rows.filter(F.col("TabelID") == table_id)
    return [(r["Bronkolom"], r["Doelkolom"], r["DoelDatatype"])
            for r in rows.select("Bronkolom", "Doelkolom", "DoelDatatype").collect()]


def map_lenient(df: DataFrame, mapping: Mapping) -> DataFrame:
    """Rename the mapped columns that are present, keep only those, silently
    drop everything else (also mapped columns that are absent)."""
    present = [(s, t) for s, t in mapping if s in df.columns]
    return df.select(*[_c(s).alias(t) for s, t in present])


def fill_missing(df: DataFrame, types: list[tuple[str, str]]) -> DataFrame:
    """Add declared columns that are absent with their type's default
    (int/tinyint 0, bit false, nvarchar '', others null)."""
    add = [default_value(t).alias(c) for c, t in types if c not in df.columns and t in SPARK_TYPES]
    return df.select(*[_c(c) for c in df.columns], *add) if add else df


def conform(df: DataFrame, types: list[tuple[str, str]]) -> DataFrame:
    """Select exactly the declared target columns, in declared order."""
    return df.select(*[_c(c) for c, _ in types])
