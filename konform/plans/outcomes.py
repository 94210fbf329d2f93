"""The outcome of a run as a relation: one row per (customer, tenant, table).

What was planned, what landed and what was written are three relations; their full outer join says for every work
item whether it succeeded and, if not, why.  A customer's watermark moves only when all of its own items
did (G1); the run log has one row per item with its administration (G4).

    planned  landed   usable  table written   outcome
    yes      no       -       -               not ok: no page landed
    yes      yes      no      -               not ok: unreadable or missing pages
    yes      yes      yes     failed          not ok: the table's error
    yes      yes      yes     yes             ok (an answered page without records too)
    yes, of a table without write configuration   not ok
    no       yes      -       -               not planned: reported, written nowhere, blocks nobody

All of it is control data: a row per tenant and table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTCOMES = "customer string, tenant string, table_name string, planned boolean, landed boolean, ok boolean, error string"


def run_outcomes(plan: DataFrame, quality: DataFrame, written: DataFrame) -> DataFrame:
    """``plan(customer, tenant, table_name, configured)``, ``quality(tenant, table_name, n_unreadable, usable)`` of the landed
    pages and ``written(table_name, error)`` of the tables -> the columns of ``OUTCOMES``.

    A work item planned twice is one item; the error of a table counts for all of its items.
    """
    text = lambda c: F.col(c).cast("string").alias(c)
    p = (plan.groupBy(text("customer"), text("tenant"), text("table_name")).agg(F.bool_and("configured").alias("_configured")).withColumn("_planned", F.lit(True)))
    q = quality.select(text("tenant"), text("table_name"), F.col("usable").alias("_usable"), F.col("n_unreadable").alias("_bad")).withColumn("_landed", F.lit(True))
    w = written.groupBy(text("table_name")).agg(F.max("error").alias("_error"), F.lit(True).alias("_written"))
    j = p.join(q, ["tenant", "table_name"], "full_outer").join(w, "table_name", "left")
    planned, landed = F.coalesce("_planned", F.lit(False)), F.coalesce("_landed", F.lit(False))
    error = (F.when(~planned, F.lit("not planned"))
             .when(~F.col("_configured"), F.lit("no write configuration"))
             .when(~landed, F.lit("no page landed"))
             .when(~F.col("_usable"), F.concat(F.lit("unreadable or missing pages ("), F.col("_bad").cast("string"), F.lit(" unreadable)")))
             .when(F.col("_written").isNull(), F.lit("table not written"))
             .otherwise(F.col("_error")))
    return j.select("customer", "tenant", "table_name", planned.alias("planned"), landed.alias("landed"),
                    F.when(planned, error.isNull()).alias("ok"), error.alias("error"))


def customer_outcomes(outcomes: DataFrame) -> DataFrame:
    """customer, n_items, n_failed, ok: whether every planned item of the customer succeeded."""
    return (outcomes.filter("planned").groupBy("customer")
            .agg(F.count(F.lit(1)).alias("n_items"), F.count_if(~F.col("ok")).alias("n_failed"), F.bool_and("ok").alias("ok")))
