"""Deletes, appends and upserts as pure ``(target, source) -> new target`` functions
(W2-W15, W17, W18).

Plain parquet has no ``DELETE`` or ``MERGE``; each operator returns the next
version of the target as a DataFrame, and ``plans.publish`` writes it to a
new version folder and moves the pointer.  SQL semantics are kept:

* a delete predicate that is null never deletes (``filter(~coalesce(p, false))``);
* upsert keys match with ``=``: a null key never matches, so such a source
  row is inserted and such a target row is kept.

Joins are equi-joins on the business keys; both sides shuffle on the keys
(no broadcast of data that grows).  Restrict the target to the tenants the
source touches before calling (partition pruning on a tenant-partitioned
layout) so untouched tenants are never read.
"""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


class WriteError(ValueError):
    pass


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


# --------------------------------------------------------------- predicates
def tenant_predicate(tenant_col: str | None, tenant) -> Column:
    """``tenant = x``; everything when there is no tenant column or value."""
    if tenant_col is None or tenant is None:
        return F.lit(True)
    return _c(tenant_col).eqNullSafe(F.lit(tenant))


def year_window_predicate(year_col: str, year: int, tenant_col: str | None = None,
                          tenant=None) -> Column:
    """``year_col >= y AND tenant = x`` (``ReportingYear`` / ``Boekjaar``)."""
    p = _c(year_col) >= F.lit(int(year))
    if tenant_col is not None and tenant is not None:
        p = p & (_c(tenant_col) == F.lit(tenant))
    return p


def date_window_predicate(date_col: str, start: date | datetime | str, tenant_col: str | None = None,
                          tenant=None) -> Column:
    """``date_col >= start AND tenant = x`` (invoice / order date windows)."""
    p = _c(date_col) >= F.lit(str(start)).cast("timestamp_ntz")
    if tenant_col is not None and tenant is not None:
        p = p & (_c(tenant_col) == F.lit(tenant))
    return p


def company_year_predicate(company_col: str, company, year_col: str | None = None,
                           year: int | None = None) -> Column:
    """``company = c AND year = y`` (year optional)."""
    p = _c(company_col) == F.lit(company)
    if year_col is not None and year is not None:
        p = p & (_c(year_col) == F.lit(int(year)))
    return p


# -------------------------------------------------------------------- W2-W8
def delete_where(target: DataFrame, predicate: Column) -> DataFrame:
    """Keep every row the predicate does not select (null selects nothing)."""
    return target.filter(~F.coalesce(predicate, F.lit(False)))


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    """Add the source rows under the target's columns."""
    return target.unionByName(source.select(*[_c(c) for c in target.columns]))


# ---------------------------------------------------------------- W9-W11
def upsert_keys(keys: list[str], tenant_col: str | None) -> list[str]:
    """The tenant column joins the keys only when set and not already a key."""
    keys = list(keys)
    if tenant_col and tenant_col not in keys:
        keys.append(tenant_col)
    return keys


def duplicate_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Source keys that occur more than once (a MERGE would fail on them)."""
    return (source.groupBy(*[_c(k) for k in keys]).count()
            .filter(F.col("count") > 1))


def unique_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """``source``, failing the job where complete keys occur more than once (as a MERGE does).

    Rows with a null key may repeat."""
    return _salted_unique(source, keys).drop("_salt")


def _salted_unique(source: DataFrame, keys: list[str]) -> DataFrame:
    """``unique_keys`` with the ``_salt`` of its window: a join on the keys and this very column shuffles the
    source no second time."""
    salted = source.withColumn("_salt", _null_key_salt(source, keys))
    n = F.count(F.lit(1)).over(Window.partitionBy(*[_c(k) for k in keys], F.col("_salt")))
    complete = F.lit(True)
    for k in keys:
        complete = complete & _c(k).isNotNull()
    bad = complete & (F.col("_n") > 1)
    ok = F.when(bad, F.raise_error(F.lit(f"duplicate source keys on {keys}")).cast("boolean")).otherwise(F.lit(True))
    return salted.withColumn("_n", n).filter(ok).drop("_n")


# ------------------------------------------------------------ compact rows
#: Tables with fewer columns to pack are shuffled as they are.
PACK_FROM = 12
_SEP, _NULL = "\x01", "\x02"
_UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"
#: in front of a key that is no uuid: longer than the 16 bytes of one that is
_NO_UUID = bytes(17)


def _packable(t: T.DataType) -> bool:
    return t == T.StringType() or isinstance(t, (T.IntegralType, T.DecimalType, T.DateType, T.BooleanType))


def _packed_columns(target: DataFrame, source: DataFrame, keys: list[str]) -> list[T.StructField]:
    """The value columns that an upsert shuffles as one text; none for narrow tables and for a source without
    all of the target's columns and types.  Equal types stand together: the codec of the shuffle finds more repeats."""
    types = {f.name: f.dataType for f in source.schema.fields}
    if any(types.get(f.name) != f.dataType for f in target.schema.fields):
        return []
    fields = sorted((f for f in target.schema.fields if f.name not in keys and _packable(f.dataType)), key=lambda f: f.dataType.simpleString())
    return fields if len(fields) >= PACK_FROM else []


def _as_text(f: T.StructField) -> Column:
    c = F.unix_date(_c(f.name)) if isinstance(f.dataType, T.DateType) else _c(f.name)
    c = c.cast("string")
    if isinstance(f.dataType, T.DecimalType) and f.dataType.scale > 0:
        c = F.when(c.contains("E"), c).otherwise(F.rtrim(c, F.lit("0")))
    return c


def _from_text(text: Column, t: T.DataType) -> Column:
    return F.date_from_unix_date(text.cast("int")) if isinstance(t, T.DateType) else text.cast(t)


def _compact_key(k: Column) -> Column:
    """A text key as bytes, the 16 of a lower-case uuid where it is one.  Different keys stay different, null stays null."""
    return F.when(k.rlike(_UUID), F.unhex(F.replace(k, F.lit("-"), F.lit("")))).otherwise(F.concat(F.lit(_NO_UUID), k.cast("binary")))


def _full_key(b: Column, h: Column) -> Column:
    """The text of a key that ``_compact_key`` made; ``h`` is its hex text."""
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    return F.when(h.isNotNull(), uuid).otherwise(F.substring(b, len(_NO_UUID) + 1, 2147483647).cast("string"))


def _text_keys(df: DataFrame, keys: list[str]) -> list[str]:
    return [k for k in keys if df.schema[k].dataType == T.StringType()]


def _pack(df: DataFrame, keys: list[str], fields: list[T.StructField]) -> DataFrame:
    """``df`` with ``fields`` as one text ``_packed``, about half the bytes of a row of columns.

    Rows whose texts hold a separator or are no UTF-8 keep the list of them, ``_plain``.  The lambda over the keys
    keeps this projection out of the method of the stage before it, which would become too large to be compiled well."""
    text_keys, names = _text_keys(df, keys), [f.name for f in fields]
    rest = [c for c in df.columns if c not in names and c not in text_keys]
    texts = df.select(*[F.get(F.transform(F.array(_c(k)), _compact_key), F.lit(0)).alias(k) for k in text_keys], *[_c(c) for c in rest], F.array(*[_as_text(f) for f in fields]).alias("_texts"))
    texts = texts.withColumn("_joined", F.array_join("_texts", " "))
    texts = texts.withColumn("_simple", F.is_valid_utf8("_joined") & ~F.col("_joined").contains(_SEP) & ~F.col("_joined").contains(_NULL))
    return texts.select(*[_c(c) for c in text_keys + rest], F.when(F.col("_simple"), F.array_join("_texts", _SEP, _NULL)).alias("_packed"),
                        F.when(~F.col("_simple"), F.col("_texts")).alias("_plain"))


def _unpack(df: DataFrame, text_keys: list[str], fields: list[T.StructField]) -> DataFrame:
    rest = [c for c in df.columns if c not in text_keys and c not in ("_packed", "_plain")]
    packed = F.transform(F.split(F.col("_packed"), _SEP), lambda v: F.nullif(v, F.lit(_NULL)))
    hexed = {k: f"_hex_{k}" for k in text_keys}
    df = df.select(*[_c(c) for c in text_keys + rest], *[F.when(F.length(_c(k)) == 16, F.lower(F.hex(_c(k)))).alias(h) for k, h in hexed.items()],
                   F.coalesce(F.col("_plain"), packed).alias("_values"))
    return df.select(*[_full_key(_c(k), _c(h)).alias(k) for k, h in hexed.items()], *[_c(c) for c in rest],
                     *[_from_text(F.get(F.col("_values"), F.lit(i)), f.dataType).alias(f.name) for i, f in enumerate(fields)])


# ------------------------------------------------------------------- upsert
def upsert(target: DataFrame, source: DataFrame, keys: list[str],
           check_duplicates: bool = False) -> DataFrame:
    """Matched target rows are replaced by the source row, other source
    rows are inserted, unmatched target rows stay (removed rows are never
    deleted by an upsert, as in the reference).

    A source without some target columns updates its own columns only: a matched
    row keeps the target's value, a new row gets null.  Complete keys that
    occur twice in the source fail the job (checked inside it, or in advance with
    ``check_duplicates``; rows with a null key never match and may repeat).

    One full outer join on the keys: target and source are each evaluated
    and shuffled once (an anti-join plus union would run the source's whole
    extraction pipeline twice), wide rows in a compact form (``_pack``).  A null key
    never matches, so such rows pass through from both sides, as with ``=`` in a MERGE.
    """
    if not keys:
        raise WriteError("upsert needs key columns")
    if check_duplicates and not duplicate_keys(source.dropna(subset=keys), keys).isEmpty():
        raise WriteError(f"duplicate source keys on {keys}")            # before anything runs
    columns, packed = target.columns, _packed_columns(target, source, keys)
    if packed:
        text_keys = _text_keys(target, keys)
        target, source = (_pack(df.select(*[_c(c) for c in columns]), keys, packed) for df in (target, source))
    j, values = _marked_outer(target, source, keys)
    in_s = F.col("_in_s").isNotNull()
    cols = [_c(k) for k in keys] + [(F.when(in_s, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")) if c in source.columns
                                     else F.col(f"_t_{c}")).alias(c) for c in values]
    out = j.select(*cols)
    return (_unpack(out, text_keys, packed) if packed else out).select(*[_c(c) for c in columns])


# -------------------------------------------------------------------- W12
def _null_key_salt(df: DataFrame, keys: list[str]) -> Column:
    """0 for rows with complete keys; for a row with a null key (which can never
    match) a hash of the whole row, so such rows - possibly a large share of
    a table - spread over all join partitions instead of landing in one.
    The hash is deterministic, so a re-run task routes every row the same way."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | _c(k).isNull()
    return F.when(any_null, F.xxhash64(*[_c(c) for c in df.columns])).otherwise(F.lit(0).cast("long"))


def _marked_outer(target: DataFrame, source: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Target and source side by side on their keys; complete keys that repeat in the source fail the job."""
    values = [c for c in target.columns if c not in keys]
    t = target.select(*[_c(k) for k in keys], *[_c(c).alias(f"_t_{c}") for c in values],
                      _null_key_salt(target, keys).alias("_salt"), F.lit(True).alias("_in_t"))
    s = _salted_unique(source, keys).select(*[_c(k) for k in keys], *[_c(c).alias(f"_s_{c}") for c in values if c in source.columns],
                                            F.col("_salt"), F.lit(True).alias("_in_s"))
    # A null key never equals anything, so adding the salt to the keys changes
    # no match; it only changes where null-key rows are partitioned.
    return t.join(s, on=list(keys) + ["_salt"], how="full_outer"), values


def upsert_changed(target: DataFrame, source: DataFrame, keys: list[str],
                   text_columns: list[str] | None = None, with_action: bool = True) -> DataFrame:
    """Update a matched row only when a non-key column differs.

    Text columns compare after ``coalesce(x, '')`` (null equals empty text, as
    ``ISNULL(x,'')`` does); other columns compare null-safely (deviation V3).
    ``action`` is ``insert`` / ``update`` / ``unchanged`` / ``keep`` (target only).
    A table whose columns are all keys is insert-only (V12).
    """
    if text_columns is None:
        text_columns = [f.name for f in target.schema.fields if f.dataType.typeName() == "string"]
    j, values = _marked_outer(target, source, keys)
    given = [c for c in values if c in source.columns]       # other columns keep the target's value
    diffs = []
    for c in given:
        t, s = F.col(f"_t_{c}"), F.col(f"_s_{c}")
        if c in text_columns:
            diffs.append(F.coalesce(t, F.lit("")) != F.coalesce(s, F.lit("")))
        else:
            diffs.append(~t.eqNullSafe(s))
    changed = F.lit(False)
    for d in diffs:
        changed = changed | d
    in_t, in_s = F.col("_in_t").isNotNull(), F.col("_in_s").isNotNull()
    action = (F.when(in_t & in_s & changed, "update").when(in_t & in_s, "unchanged")
              .when(in_s, "insert").otherwise("keep"))
    take_source = action.isin("insert", "update")
    cols = [_c(k) for k in keys] + [(F.when(take_source, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")) if c in given
                                     else F.col(f"_t_{c}")).alias(c) for c in values]
    if with_action:
        cols.append(action.alias("action"))
    out = j.select(*cols)
    return out.select(*[_c(c) for c in target.columns] + ([F.col("action")] if with_action else []))


# -------------------------------------------------------------------- W13
def replace_all(target: DataFrame | None, source: DataFrame) -> DataFrame:
    """No keys -> the source replaces the whole table."""
    if target is not None:
        return source.select(*[_c(c) for c in target.columns])
    return source


# -------------------------------------------------------------------- W14
def upsert_preserving(target: DataFrame, source: DataFrame, keys: list[str],
                      preserved: dict[str, object]) -> DataFrame:
    """As an upsert, but the ``preserved`` operator columns of a matched row
    keep the target's value and a new row gets the given default."""
    j, values = _marked_outer(target, source, keys)
    in_t, in_s = F.col("_in_t").isNotNull(), F.col("_in_s").isNotNull()
    cols = [_c(k) for k in keys]
    for c in values:
        tcol = F.col(f"_t_{c}")
        if c not in preserved and c not in source.columns:
            cols.append(tcol.alias(c))
        elif c in preserved:
            dtype = target.schema[c].dataType
            cols.append(F.when(in_t, tcol).otherwise(F.lit(preserved[c]).cast(dtype)).alias(c))
        else:
            cols.append(F.when(in_s, F.col(f"_s_{c}")).otherwise(tcol).alias(c))
    return j.select(*cols).select(*[_c(c) for c in target.columns])


# -------------------------------------------------------------------- W15
def new_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct source keys that the target does not have (set difference)."""
    return (source.select(*[_c(k) for k in keys]).distinct()
            .join(target.select(*[_c(k) for k in keys]), on=keys, how="left_anti"))


# -------------------------------------------------------------------- W17
_TABLE_NAME = re.compile(r"^[a-zA-Z0-9_]+$")


def validate_write(df: DataFrame, table: str, keys) -> bool:
    """A safe table name, a key list, keys present.  Returns False for an
    empty frame (success without a write), True when a write should happen."""
    if not _TABLE_NAME.match(table or ""):
        raise WriteError(f"invalid table name {table!r}")
    if keys is not None and not isinstance(keys, (list, tuple)):
        raise WriteError("keys must be a list")
    missing = [k for k in (keys or []) if k not in df.columns]
    if missing:
        raise WriteError(f"key columns missing: {missing}")
    return not df.isEmpty()


# -------------------------------------------------------------------- W18
def write_counts(target: DataFrame, source: DataFrame, keys: list[str],
                 delete_predicate: Column | None = None) -> DataFrame:
    """One row of counts for a delete + upsert step.

    ``deleted`` rows the predicate removes from the target; of the source rows,
    ``updated`` match a remaining target key, ``inserted`` do not;
    ``written`` = source rows; ``result_rows`` = rows of the new version.
    """
    pred = F.coalesce(delete_predicate, F.lit(False)) if delete_predicate is not None else F.lit(False)
    t_keys = (target.select(*[_c(k) for k in keys], pred.cast("long").alias("_del"))
              .groupBy(*keys).agg(F.sum("_del").alias("_n_del"),
                                  F.sum(1 - F.col("_del")).alias("_n_t")))
    s_keys = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n_s"))
    j = t_keys.join(s_keys, on=keys, how="full_outer")
    has_t = F.coalesce(F.col("_n_t"), F.lit(0)) > 0
    has_s = F.col("_n_s").isNotNull()
    zero = F.lit(0).cast("long")
    return j.agg(
        F.coalesce(F.sum("_n_del"), zero).cast("long").alias("deleted"),
        F.coalesce(F.sum(F.when(has_s & has_t, F.col("_n_s"))), zero).cast("long").alias("updated"),
        F.coalesce(F.sum(F.when(has_s & ~has_t, F.col("_n_s"))), zero).cast("long").alias("inserted"),
        F.coalesce(F.sum("_n_s"), zero).cast("long").alias("written"),
        (F.coalesce(F.sum(F.when(~has_s, F.col("_n_t"))), zero)
         + F.coalesce(F.sum("_n_s"), zero)).cast("long").alias("result_rows"))
