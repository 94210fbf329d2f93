"""One table, end to end: landed pages -> records -> flat rows -> mapped ->
typed -> delete + write against the current target -> new target version.

Everything is lazy; nothing runs until the new version is written (or the
caller collects).  The delete and the write are applied to the same input
version and published once, so a failed typing step can no longer leave a
half-cleared table behind (deviation V2).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import POLICIES, coerce_table
from ..operators import flatten, mapping, write
from ..schemas import (DIVISION_OPERATOR_COLUMNS, column_mapping, target_types,
                       write_config)
from ..sources import payloads


@dataclass(frozen=True)
class Step:
    """What the planner decided for one (tenant, table) work item."""

    source: str
    table: str
    delete_rule: str = "none"      # none | all | tenant | year_window | date_window | company_year
    write_rule: str = "append"     # none | append | upsert | upsert_tenant | upsert_changed | upsert_preserving | replace
    tenant: object = None
    year: int | None = None
    window_start: object = None
    year_column: str | None = None
    date_column: str | None = None


def read_records(pages: DataFrame, row_schema, payload: str = "odata", keep=("tenant",),
                 resource: Column | str | None = None, path: list[str] | None = None) -> DataFrame:
    """Records of the landed pages in one of the envelope forms.

    ``resource`` is the key of a ``keyed`` payload: a name for all pages, or the page column that holds it
    (``_resource``, a column).  XML forms take the field names of ``row_schema``; ``elements`` also the path of the
    repeated element below the document root."""
    keep = list(keep)
    fields = None if row_schema is None else [f.name for f in payloads._schema(row_schema).fields]
    if payload == "odata":
        return payloads.odata_rows(pages, row_schema, keep)
    if payload == "rows":
        return payloads.envelope_rows(pages, row_schema, keep)
    if payload == "keyed":
        by_page = isinstance(resource, str) and resource in pages.columns
        return payloads.keyed_rows(pages, row_schema, F.col(resource) if by_page else resource, keep)
    if payload == "atom":
        return payloads.atom_rows(pages, fields, keep)
    if payload == "extra":
        return payloads.extra_field_rows(pages, keep)
    if payload == "wage":
        return payloads.wage_report_rows(pages, keep)
    if payload == "elements":
        return payloads.element_rows(pages, path, fields, keep)
    raise ValueError(f"unknown payload form {payload}")


def mapped_records(rows: DataFrame, source: str, table: str,
                   tenant: Column | object | None = None, year: Column | int | None = None, owner: str | None = None) -> DataFrame:
    """D7 -> B1/B3/B7: flat rows under the target's column names, not yet typed.

    ``year`` may be a column: the reporting year of each row's own tenant.  ``owner`` adds a column with the tenant (for
    tables that have none of their own)."""
    rows = mapping.drop_technical(rows)
    rows = flatten.flatten_for_table(rows, table, keep=[c for c in ("tenant", "_year") if c in rows.columns])
    if owner:
        rows = rows.withColumn("_owner", (tenant if isinstance(tenant, Column) else F.lit(tenant)).cast("long"))
    if target_types(source, table) is None:
        raise ValueError(f"no target schema for {source}.{table}")
    if source == "accounting":
        m = column_mapping(source, table)
        if tenant is not None:
            # A payload without a Division value takes the page's tenant.
            t = tenant if isinstance(tenant, Column) else F.lit(tenant)
            rows = rows.withColumn("Division", F.coalesce(F.col("Division").cast("string"), t.cast("string"))
                                   if "Division" in rows.columns else t)
        rows = mapping.map_keep(rows, m)
    elif source == "payroll":
        if year is not None and "Jaar" in [t for _, t in column_mapping(source, table)]:
            # The report's year
            rows = rows.withColumn("Jaar", year.cast("int")) if isinstance(year, Column) else mapping.add_constant(rows, "Jaar", year, "int")
        chosen = column_mapping(source, table)
        rows = mapping.map_select(rows, [*chosen, ("_owner", "_owner")] if owner else chosen)
    elif source == "erp":
        if tenant is None:
            raise ValueError("ERP rows need the environment id")
        rows = rows.withColumn("OmgevingID", tenant if isinstance(tenant, Column) else F.lit(tenant))
    return rows.withColumnRenamed("_owner", owner) if owner else rows


def typed_records(rows: DataFrame, source: str, table: str, extra: list[str] | None = None) -> DataFrame:
    """C: mapped rows, typed, in the target's column order; ``extra`` columns are passed on behind them."""
    types = target_types(source, table)
    typed = coerce_table(rows, types, POLICIES[source], keep_extra=bool(extra))
    return mapping.conform(typed, types) if not extra else typed.select(*[F.col(f"`{c}`") for c, _ in types], *extra)


def conform_records(rows: DataFrame, source: str, table: str,
                    tenant: Column | object | None = None, year: int | None = None) -> DataFrame:
    """D7 -> B1/B3/B7 -> C: flat, mapped, typed rows in the target's column order."""
    return typed_records(mapped_records(rows, source, table, tenant, year), source, table)


def _delete_predicate(step: Step, tenant_col: str | None) -> Column | None:
    r = step.delete_rule
    if r == "none":
        return None
    if r == "all":
        return F.lit(True)
    if r == "tenant":
        return write.tenant_predicate(tenant_col, step.tenant)
    if r == "year_window":
        return write.year_window_predicate(step.year_column, step.year, tenant_col, step.tenant)
    if r == "date_window":
        return write.date_window_predicate(step.date_column, step.window_start, tenant_col, step.tenant)
    if r == "company_year":
        return write.company_year_predicate(tenant_col, step.tenant, step.year_column, step.year)
    raise ValueError(f"unknown delete rule {r}")


def delete_tenant_column(source: str, table: str) -> str | None:
    """The column a tenant delete filters on: the environment (``OmgevingID``) for
    the ERP source, the table's tenant column otherwise."""
    if source == "erp":
        return "OmgevingID"
    cfg = write_config(source, table)
    return cfg.tenant_column if cfg else None


def apply_step(target: DataFrame, rows: DataFrame, step: Step) -> DataFrame:
    """The next version of ``target`` after the step's delete and write."""
    cfg = write_config(step.source, step.table)
    tenant_col = cfg.tenant_column if cfg else None
    keys = list(cfg.keys) if cfg else []
    pred = _delete_predicate(step, delete_tenant_column(step.source, step.table))
    base = write.delete_where(target, pred) if pred is not None else target
    w = step.write_rule
    if w == "none":
        return base
    if w == "append":
        return write.append(base, rows)
    if w == "upsert":
        return write.upsert(base, rows, write.upsert_keys(keys, tenant_col))
    if w == "upsert_tenant":
        return write.upsert(base, rows, write.upsert_keys(keys, tenant_col))
    if w == "upsert_changed":
        return write.upsert_changed(base, rows, keys, with_action=False)
    if w == "upsert_preserving":
        return write.upsert_preserving(base, rows, keys, {c: 0 for c in DIVISION_OPERATOR_COLUMNS
                                                           if c in target.columns})
    if w == "replace":
        return write.replace_all(base, rows)
    raise ValueError(f"unknown write rule {w}")


# ------------------------------------------------------------ all tenants at once
DELETE_RULES = ("none", "all", "tenant", "year_window", "date_window", "company_year")
#: write rules that are applied per tenant; the others concern a whole table (``apply_step``)
TENANT_WRITE_RULES = ("none", "append", "upsert", "upsert_tenant")


def checked_plan(plan: DataFrame, tenant_col: str, has_keys: bool) -> DataFrame:
    """The plan, one row per tenant; a second row for a tenant, an unknown rule, or an upsert
    of a table without keys fails the job."""
    one = plan.groupBy("tenant").agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(
        "delete_rule", "write_rule", "year", F.col("window_start").cast("timestamp_ntz").alias("window_start"))).alias("_r"))
    dr, wr = F.col("_r.delete_rule"), F.col("_r.write_rule")
    fail = lambda text: F.raise_error(F.concat(F.lit(text), F.coalesce(F.col("tenant").cast("string"), F.lit("null")))).cast("string")
    rule = (F.when(F.col("_n") > 1, fail("more than one plan row for tenant "))
            .when(~F.coalesce(dr.isin(*DELETE_RULES), F.lit(False)), fail("unknown delete rule for tenant "))
            .when(~F.coalesce(wr.isin(*TENANT_WRITE_RULES), F.lit(False)), fail("unknown write rule for tenant ")))
    if not has_keys:
        rule = rule.when(wr.isin("upsert", "upsert_tenant"), fail("upsert without keys for tenant "))
    return one.select(F.col("tenant").alias(tenant_col), dr.alias("_dr"), rule.otherwise(wr).alias("_wr"),
                      F.col("_r.year").alias("_yr"), F.col("_r.window_start").alias("_ws"))


def sync_tenants(target: DataFrame, source: DataFrame, plan: DataFrame, keys: list[str], tenant_col: str,
                 year_col: str | None = None, date_col: str | None = None,
                 key_tenant_col: str | None = None) -> DataFrame:
    """W2-W10 + W16 for every tenant of one table in a single job.

    ``plan(tenant, delete_rule, write_rule, year, window_start)`` holds one row
    per tenant (from ``rules.choose_rule``).  Only planned tenants with at least one source
    row change: their target rows are deleted by the delete rule (``tenant`` / ``all`` /
    ``year_window`` / ``date_window`` / ``company_year``), then the write rule applies -
    ``append`` adds the source rows, ``upsert`` / ``upsert_tenant`` replace target rows with
    equal keys (plus ``key_tenant_col``, default the tenant column; W10), ``none`` writes
    nothing.  Nothing is deleted where nothing arrived, and rows of unplanned tenants
    are not written.

    The target is read once: an anti-join on the upserted keys (none for a table without
    keys), then a union with the source rows.  The source is read more than once,
    so stage it where it is expensive.  Duplicate complete keys of upserted rows
    fail the job.
    """
    cols = [F.col(f"`{c}`") for c in target.columns]
    p = checked_plan(plan, tenant_col, bool(keys))
    src = source.select(*cols).join(p, tenant_col)                       # planned tenants only
    active = src.select(tenant_col).distinct()
    dr = F.col("_dr")
    yc = F.col(f"`{year_col}`") if year_col else F.lit(None)
    dc = F.col(f"`{date_col}`") if date_col else F.lit(None)
    delete = F.coalesce(
        F.when(dr.isin("tenant", "all"), F.lit(True))
        .when(dr == "year_window", yc >= F.col("_yr"))
        .when(dr == "date_window", dc >= F.col("_ws"))
        .when(dr == "company_year", yc == F.col("_yr")), F.lit(False))
    kept = target.join(p.join(active, tenant_col, "left_semi"), tenant_col, "left").filter(~delete).select(*cols)
    written = src.filter(F.col("_wr") != "none").select(*cols, "_wr")
    if not keys:
        return kept.unionByName(written.drop("_wr"))
    all_keys = write.upsert_keys(keys, key_tenant_col or tenant_col)
    replaced = write.unique_keys(written.filter(F.col("_wr") != "append").select(*[F.col(f"`{k}`") for k in all_keys]), all_keys)
    return kept.join(replaced, all_keys, "left_anti").select(*cols).unionByName(written.drop("_wr"))


def sync_tenant_partitions(spark, table_path: str, source: DataFrame, plan: DataFrame, keys: list[str],
                           tenant_col: str, target_schema, year_col: str | None = None,
                           date_col: str | None = None, key_tenant_col: str | None = None) -> dict:
    """``sync_tenants`` for a table kept in tenant partitions: only the partitions of touched
    tenants (planned, with source rows) are read and rewritten.

    The touched tenants reach the scan as a semi-join on the partition column, which the planner
    turns into dynamic partition pruning.  ``publish.commit_tenants`` then makes the
    new slices visible at once.  Returns the counts of the write."""
    from . import publish as pub

    src = pub.stage(spark, source, f"{table_path}/_staging")
    ttype = dict((f.name, f.dataType) for f in target_schema.fields)[tenant_col]
    planned = plan.select(F.col("tenant").cast(ttype).alias(tenant_col))
    touched = src.groupBy(tenant_col).count().filter("count > 0").join(planned, tenant_col, "left_semi").select(tenant_col)
    target = pub.read_tenants(spark, table_path, target_schema, tenant_col)
    target = target.join(touched, tenant_col, "left_semi").select(*[F.col(f"`{c}`") for c in target_schema.names])
    new = sync_tenants(target, src, plan, keys, tenant_col, year_col=year_col, date_col=date_col, key_tenant_col=key_tenant_col)
    counts = pub.commit_tenants(spark, new, touched, table_path, tenant_col)
    pub.unstage(spark, src)
    return counts
