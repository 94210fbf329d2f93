"""The flagship query: one incremental sync of the sales-order lines table.

previous version  = order documents dated before 2000-01-01, landed as OData
                    pages and conformed (A1 -> D2 -> B1 -> C);
new extraction    = order documents dated from 1999-07-01 (the incremental
                    predicate is pushed into the orders scan), now carrying
                    a ``Remarks`` value;
result            = W9 upsert on the line id plus the tenant column (W10
                    key rule): every line once, the re-extracted ones updated.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import write
from ..schemas import write_config
from . import flatten_queries as fq
from ._base import load, query

_TABLE = "VerkoopOrders"
_OLD = "o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"
_NEW = "o_orderdate >= TIMESTAMP '1999-07-01 00:00:00'"


def _oracle() -> str:
    base = fq.oracle_for(_TABLE)
    return base.replace("CAST(NULL AS VARCHAR) AS O_Opmerkingen",
                        f"CASE WHEN {_NEW} THEN 'rev2' END AS O_Opmerkingen")


def order_lines_version(spark, sf, where: str, remarks: str | None = None):
    """One conformed version of the order lines: the orders matching ``where``."""
    orders = load(spark, sf, "orders").filter(F.expr(where))
    overrides = {"Remarks": f"'{remarks}'"} if remarks is not None else None
    return fq.conformed_lines(spark, sf, _TABLE, orders=orders, header_overrides=overrides)


@query("orders_sync", _oracle())
def orders_sync(spark, sf):
    cfg = write_config("accounting", _TABLE)
    previous = order_lines_version(spark, sf, _OLD)
    extraction = order_lines_version(spark, sf, _NEW, remarks="rev2")
    keys = write.upsert_keys(list(cfg.keys), cfg.tenant_column)
    return write.upsert(previous, extraction, keys)
