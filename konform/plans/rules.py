"""Write-rule choice (W1, W5, W16): which delete and which write a work item gets.

Input columns: ``source``, ``run_mode`` (``full`` / other), ``table_name``,
``table_mode`` (``none`` / ``truncate`` / ``reporting_year``), ``age_years``
(null without a watermark) and ``has_keys``.  The truth table:

    source      run    condition                         delete        write
    accounting  any    Divisions                         none          upsert_preserving
    accounting  full   invoices / orders                 date_window   append
    accounting  full   ledger mutations                  year_window   append
    accounting  full   other tables                      none          none
    accounting  other  watermark older than 2 years      tenant        append
    accounting  other  truncate / reporting_year         tenant / year_window  append
    accounting  other  none, watermark and keys          none          upsert
    accounting  other  none, no watermark or no keys     none          append
    erp         full   all                               tenant        append
    erp         other  older than 1.2 years, truncate    tenant        append
    erp         other  none with / without keys          none          upsert_tenant / append
    payroll     any    Bedrijven / Looncomponenten       all / company_year  append
    metadata    any    keys / no keys                    none / all    upsert_changed / replace
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ACCOUNTING_FULL_WRITE_TABLES, STALE_DELETE_AFTER_YEARS, WRITE_CONFIG


def write_config_rows() -> list[tuple]:
    return [(c.source, c.table, c.mode, list(c.keys), c.tenant_column) for c in WRITE_CONFIG.values()]


WRITE_CONFIG_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("table_mode", T.StringType()), T.StructField("keys", T.ArrayType(T.StringType())),
    T.StructField("tenant_column", T.StringType())])


def write_configs(spark) -> DataFrame:
    """The write configuration of all 42 target tables (fixed, tiny)."""
    return spark.createDataFrame(write_config_rows(), WRITE_CONFIG_SCHEMA)


def _rule(source: Column, run_full: Column, table: Column, mode: Column, age: Column,
          has_keys: Column) -> tuple[Column, Column]:
    acc, erp, pay, meta = (source == "accounting", source == "erp", source == "payroll",
                           source == "metadata")
    acc_stale = F.coalesce(age > F.lit(STALE_DELETE_AFTER_YEARS["accounting"]), F.lit(False))
    erp_stale = F.coalesce(age > F.lit(STALE_DELETE_AFTER_YEARS["erp"]), F.lit(False))
    full_tables = table.isin(*ACCOUNTING_FULL_WRITE_TABLES)
    delete = (F.when(acc & (table == "Divisions"), "none")
              .when(acc & run_full & table.isin("Verkoopfacturen", "VerkoopOrders"), "date_window")
              .when(acc & run_full & (table == "GrootboekMutaties"), "year_window")
              .when(acc & run_full, "none")
              .when(acc & acc_stale, "tenant")
              .when(acc & (mode == "truncate"), "tenant")
              .when(acc & (mode == "reporting_year"), "year_window")
              .when(acc, "none")
              .when(erp & run_full, "tenant")
              .when(erp & (erp_stale | (mode == "truncate")), "tenant")
              .when(erp, "none")
              .when(pay & (table == "Bedrijven"), "all")
              .when(pay, "company_year")
              .when(meta & has_keys, "none")
              .when(meta, "all"))
    write = (F.when(acc & (table == "Divisions"), "upsert_preserving")
             .when(acc & run_full & full_tables, "append")
             .when(acc & run_full, "none")
             .when(acc & (acc_stale | mode.isin("truncate", "reporting_year")), "append")
             .when(acc & age.isNotNull() & has_keys, "upsert")
             .when(acc, "append")
             .when(erp & (run_full | erp_stale | (mode == "truncate")), "append")
             .when(erp & has_keys, "upsert_tenant")
             .when(erp, "append")
             .when(pay, "append")
             .when(meta & has_keys, "upsert_changed")
             .when(meta, "replace"))
    return delete, write


def choose_rule(df: DataFrame) -> DataFrame:
    """Add ``delete_rule`` and ``write_rule`` to every work item."""
    delete, write = _rule(F.col("source"), F.col("run_mode") == "full", F.col("table_name"),
                          F.col("table_mode"), F.col("age_years"), F.col("has_keys"))
    return df.withColumn("delete_rule", delete).withColumn("write_rule", write)
