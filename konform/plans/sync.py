"""Sync planning over control tables.

Control data is small and bounded (customers x tenants x catalogue tables),
but the planner is still written as DataFrame expressions so one plan
covers every tenant at once instead of a driver loop per tenant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (projection, CATALOGUE_ENTRIES, FULL_RESYNC_REPORTING_YEAR, FULL_RESYNC_WATERMARK,
                       RESET_AFTER_YEARS, RUN_MODE_FULL)

MICROS_PER_DAY = 86_400_000_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def watermark_ts(wm) -> Column:
    """A watermark text ``yyyy-MM-ddTHH:mm:ss`` (or a timestamp) as ``timestamp_ntz``."""
    return _col(wm).try_cast("timestamp_ntz")


def age_days(wm, as_of) -> Column:
    """Whole days from the watermark to ``as_of`` (floored, like ``timedelta.days``)."""
    micros = F.timestamp_diff("MICROSECOND", watermark_ts(wm), _col(as_of).cast("timestamp_ntz"))
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("long")


def age_years(wm, as_of) -> Column:
    return age_days(wm, as_of) / F.lit(365.0)


# ---------------------------------------------------------------- E1-E3
def sync_mode(wm, as_of, run_mode, threshold_years: float = RESET_AFTER_YEARS["accounting"]) -> Column:
    """E1 (threshold 2) / E2 (threshold 1.2): ``full`` for a full run, ``reset``
    without a watermark or when it is older than the threshold, else ``regular``."""
    return (F.when(_col(run_mode) == F.lit(RUN_MODE_FULL), F.lit("full"))
            .when(watermark_ts(wm).isNull(), F.lit("reset"))
            .when(age_years(wm, as_of) > F.lit(threshold_years), F.lit("reset"))
            .otherwise(F.lit("regular")))


def erp_sync_mode(run_mode) -> Column:
    """``full`` for a full run, otherwise ``regular`` (staleness is only reported)."""
    return F.when(_col(run_mode) == F.lit(RUN_MODE_FULL), F.lit("full")).otherwise(F.lit("regular"))


def is_stale(wm, as_of, threshold_years: float) -> Column:
    return F.coalesce(age_years(wm, as_of) > F.lit(threshold_years), F.lit(False))


# ------------------------------------------------------------------- E4
def full_window_start(as_of, lineage: str = "current") -> Column:
    """1 January of the year of (as_of - 365 days); the older ERP lineage
    uses 1 January of last year."""
    d = _col(as_of).cast("date")
    if lineage == "erp_old":
        return F.make_date(F.year(d) - 1, F.lit(1), F.lit(1))
    return F.trunc(F.date_sub(d, 365), "year")


# ------------------------------------------------------------------- E5
CATALOGUE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("mode", T.StringType()),
    T.StructField("table_name", T.StringType()), T.StructField("filter_column", T.StringType()),
    T.StructField("filter_kind", T.StringType()), T.StructField("line_column", T.StringType()),
    T.StructField("columns", T.ArrayType(T.StringType())), T.StructField("line_fields", T.ArrayType(T.StringType()))])


def catalogue_rows(source: str | None = None, mode: str | None = None) -> list[tuple]:
    return [(e.source, e.mode, e.table, e.filter_column, e.filter_kind, e.line_column)
            for e in CATALOGUE_ENTRIES
            if (source is None or e.source == source) and (mode is None or e.mode == mode)]


def catalogue(spark: SparkSession, source: str | None = None, mode: str | None = None) -> DataFrame:
    """E5: the extraction catalogue as a (fixed, tiny) DataFrame, with the declared fields of each table (B14); the
    older catalogues are the sources ``accounting_o`` and ``erp_o``."""
    rows = [(*r, projection(r[0], r[2])[0], projection(r[0], r[2])[2]) for r in catalogue_rows(source, mode)]
    return spark.createDataFrame(rows, CATALOGUE_SCHEMA)


def catalogue_array(source: str, mode: str) -> Column:
    """The catalogue of one source/mode as a literal array of structs, for
    ``explode``: a bounded fan-out per tenant with no join at all."""
    items = []
    for _, _, table, col, kind, line in catalogue_rows(source, mode):
        items.append(F.struct(F.lit(table).alias("table_name"),
                              F.lit(col).cast("string").alias("filter_column"),
                              F.lit(kind).alias("filter_kind"),
                              F.lit(line).cast("string").alias("line_column")))
    return F.array(*items)


# ------------------------------------------------------------------- E6
def work_list(klanten: DataFrame, tenants: DataFrame, table_status: DataFrame,
              source: str, mode: str = "regular", application: str | None = None) -> DataFrame:
    """E6 + B11: (customer, tenant, table) work items that pass every gate.

    ``klanten(klant, klant_type, application)``: customer type 1 and the
    application; ``tenants(klant, tenant, status, ...)``: status not null and
    not 0; ``table_status(table_name, status)``: tables with status 0 are off,
    tables absent from it are off too (matched by name).  The catalogue is a
    literal array exploded per tenant; ``table_status`` is a control table of
    one row per catalogue table; the planner broadcasts it by its size.
    """
    k = klanten.filter((F.col("klant_type") == 1) &
                       (F.col("application") == F.lit(application or source)))
    t = tenants.filter(F.col("status").isNotNull() & (F.col("status") != 0))
    items = (t.join(k.select("klant"), "klant", "left_semi")
             .select("*", F.explode(catalogue_array(source, mode)).alias("_w"))
             .select("*", "_w.*").drop("_w"))
    on = table_status.filter(F.col("status").isNotNull() & (F.col("status") != 0)).select("table_name")
    return items.join(on, "table_name", "left_semi")


# ------------------------------------------------------------------- E7
def last_wins(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row per key, the one with the highest ``seq`` (last read wins).

    A ``max_by`` aggregate, so a hot key is reduced map-side (partial
    aggregation) instead of being sorted whole in one window partition.
    """
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.col(seq)).alias("_w"))
    return agg.select(*[F.col(k) for k in keys], *[F.col(f"_w.`{c}`").alias(c) for c in rest]) \
              .select(*df.columns)


# ------------------------------------------------------------------- E8
def full_resync_override(df: DataFrame, flag: str, wm_col: str, year_col: str) -> DataFrame:
    """A tenant flagged for full resync syncs from 2000-01-01T00:00:00 and
    reporting year 2000; decided per row (no leak to later tenants, V4)."""
    on = F.coalesce(F.col(flag) == 1, F.lit(False))
    return (df.withColumn(wm_col, F.when(on, F.lit(FULL_RESYNC_WATERMARK)).otherwise(F.col(wm_col)))
              .withColumn(year_col, F.when(on, F.lit(FULL_RESYNC_REPORTING_YEAR)).otherwise(F.col(year_col))))


# ------------------------------------------------------------------- E9
def resolve_database(members: DataFrame, names: DataFrame, name_col: str = "klant",
                     db_col: str = "database", pos_col: str = "db_pos",
                     list_col: str = "customers") -> DataFrame:
    """The first database (lowest position) whose customer list contains the
    name; null when none does.  ``members(database, db_pos, customers array)``
    may repeat a database over several bounded list chunks."""
    flat = members.select(F.col(db_col), F.col(pos_col), F.explode(F.col(list_col)).alias(name_col))
    first = flat.groupBy(name_col).agg(F.min_by(F.col(db_col), F.col(pos_col)).alias(db_col))
    return names.join(first, name_col, "left")
