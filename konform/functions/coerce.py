"""Type coercion to the declared target types.

Every rule is a pure ``Column -> Column`` builder made of built-in Spark
expressions, so a whole table is coerced by one ``select`` inside
whole-stage codegen.  Spark runs with ANSI mode on, where a plain ``cast``
throws; all parsing therefore goes through ``try_cast`` and an explicit
rule decides what a failed parse becomes (0, null, false, or a job
failure through ``raise_error``).

Output types (Spark):

    int -> bigint            tinyint -> smallint (0-255)
    decimal -> decimal(38,10) bit -> boolean
    nvarchar -> string       uniqueidentifier -> string (lower 8-4-4-4-12)
    date -> date             datetime -> timestamp_ntz
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECIMAL = T.DecimalType(38, 10)

SPARK_TYPES = {
    "int": T.LongType(),
    "tinyint": T.ShortType(),
    "decimal": DECIMAL,
    "bit": T.BooleanType(),
    "nvarchar": T.StringType(),
    "uniqueidentifier": T.StringType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
}

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
# ISO date, optional time with optional fraction and optional offset (dropped).
_ISO_RE = (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
           r"([T ][0-9]{1,2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?$")
# Day-first Dutch notation: dd-MM-yyyy with an optional time.
_DMY_RE = r"^([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})( [0-9]{1,2}:[0-9]{2}:[0-9]{2})?$"
_MS_DATE_RE = r"^/Date\((-?[0-9]+)\)/$"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _is_numeric(dtype) -> bool:
    return isinstance(dtype, _NUMERIC)


def _text(c: Column) -> Column:
    return c.cast("string")


# --------------------------------------------------------------------- C1, C2
def to_int(c: Column) -> Column:
    """Numeric parse, fraction truncated toward zero; null or unparsable -> 0."""
    s = F.trim(_text(c))
    # try_cast to bigint accepts integral text only ('1.9' is null), so the
    # double path handles fractions and exponents, truncating toward zero.
    return F.coalesce(s.try_cast("bigint"), s.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def to_tinyint(c: Column, strict: bool = True) -> Column:
    """Null -> 0, wrapped into 0-255; unparsable text fails the table when strict."""
    s = F.trim(_text(c))
    parsed = F.coalesce(s.try_cast("bigint"), s.try_cast("double").try_cast("bigint"))
    value = F.pmod(F.coalesce(parsed, F.lit(0).cast("bigint")), F.lit(256)).cast("smallint")
    if not strict:
        return value
    bad = c.isNotNull() & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("tinyint: cannot parse "), s))
                  .cast("smallint")).otherwise(value)


# ------------------------------------------------------------------------- C3
def decimal_fits(c: Column) -> Column:
    """Does the text hold a number without more decimals than the target keeps?"""
    s = F.trim(_text(c))
    kept, wide = s.try_cast(DECIMAL), s.try_cast("decimal(38,28)")
    cut = F.when(s.rlike("[eE]"), wide.isNotNull() & (wide != kept)).otherwise(s.rlike(r"\.[0-9]{10}[0-9]*[1-9]"))
    return kept.isNotNull() & ~cut


def to_decimal(c: Column, strict: bool = True) -> Column:
    """Null stays null; exact decimal; bad text fails the table when strict.

    Decimals beyond the target's scale are rounded away; the audit (C13) counts them."""
    conv = F.trim(_text(c)).try_cast(DECIMAL)
    if not strict:
        return conv
    bad = c.isNotNull() & conv.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("decimal: cannot parse "), _text(c)))
                  .cast(DECIMAL)).otherwise(conv)


# ------------------------------------------------------------------------- C4
def to_bit(c: Column) -> Column:
    """C4: case-insensitive 'true'/'1' -> true; everything else, null included -> false."""
    return F.coalesce(F.lower(_text(c)).isin("true", "1"), F.lit(False))


# --------------------------------------------------------------------- C5-C7
def to_string(c: Column, trim: bool = False) -> Column:
    """C5 (trim=True, accounting) / C6 / C7: text, null stays null (deviation V1)."""
    s = _text(c)
    return F.trim(s) if trim else s


# --------------------------------------------------------------------- C8, C9
def _uuid_hex(c: Column) -> Column:
    s = F.replace(F.replace(_text(c), F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    s = F.regexp_replace(s, r"^[{}]+|[{}]+$", "")
    return F.replace(s, F.lit("-"), F.lit(""))


def _uuid_canonical(h: Column) -> Column:
    return F.lower(F.regexp_replace(h, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def to_uuid(c: Column, strict: bool = True, numeric_input: bool = False) -> Column:
    """C8 (strict: invalid fails the table) / C9 (lenient: invalid or numeric -> null)."""
    if numeric_input:
        if strict:
            return F.when(c.isNotNull(), F.raise_error(F.lit("uuid: numeric value"))
                          .cast("string"))
        return F.lit(None).cast("string")
    s = _text(c)
    # Fast path: text already in canonical lower-case form needs no rewriting.
    is_canonical = s.rlike(r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")
    h = _uuid_hex(c)
    valid = h.rlike(r"^[0-9a-fA-F]{32}$")
    canon = F.when(is_canonical, s).when(valid, _uuid_canonical(h))
    if not strict:
        return canon
    return F.when(c.isNotNull() & canon.isNull(),
                  F.raise_error(F.concat(F.lit("uuid: invalid value "), s)).cast("string")
                  ).otherwise(canon)


# ------------------------------------------------------------------- C10, C11
def _epoch_ms_to_ts(ms: Column) -> Column:
    # Pure arithmetic on a zone-less timestamp: independent of the session time zone.
    return F.timestamp_add("MILLISECOND", ms, F.expr(_EPOCH))


def _ms_date_value(s: Column) -> Column:
    # A prefix test first keeps the regex off every other value.
    return F.when(s.startswith("/Date("), F.regexp_extract(s, _MS_DATE_RE, 1).try_cast("bigint"))


def to_datetime(c: Column, numeric_input: bool = False, temporal_input: bool = False) -> Column:
    """C11: epoch ms for numbers, ``/Date(ms)/``, then ISO forms (an offset is dropped,
    never converted), then ``dd-MM-yyyy[ HH:mm:ss]``; anything else -> null."""
    if temporal_input:
        return c.cast("timestamp_ntz")
    if numeric_input:
        return _epoch_ms_to_ts(c.try_cast("bigint"))
    s = F.trim(_text(c))
    from_ms = _epoch_ms_to_ts(_ms_date_value(s))
    # Casting text to timestamp_ntz ignores a trailing zone offset (Z, +hh,
    # +hhmm, +hh:mm), which is exactly "drop the offset, keep the wall time".
    iso = F.when(s.rlike(_ISO_RE), s.try_cast("timestamp_ntz"))
    dmy = F.when(s.rlike(_DMY_RE),
                 F.regexp_replace(s, _DMY_RE, "$3-$2-$1$4").try_cast("timestamp_ntz"))
    return F.coalesce(from_ms, iso, dmy)


def to_date(c: Column, temporal_input: bool = False) -> Column:
    """``/Date(ms)/`` -> UTC date of the epoch ms; else the general parse; failure -> null."""
    if temporal_input:
        return c.cast("date")
    s = F.trim(_text(c))
    # No text has two of these forms, so one branch each will do: little generated code for tables with many dates.
    ms = F.regexp_extract(s, _MS_DATE_RE, 1).try_cast("bigint")
    return (F.when(s.startswith("/Date("), F.date_from_unix_date(F.floor(ms / F.lit(86400000)).cast("int")))
            .when(s.rlike(_ISO_RE), s.try_cast("timestamp_ntz").cast("date"))
            .when(s.rlike(_DMY_RE), F.regexp_replace(s, _DMY_RE, "$3-$2-$1$4").try_cast("timestamp_ntz").cast("date")))


# ------------------------------------------------------------------------ C12
def datetime_text(c: Column) -> Column:
    """The older lineage's text form of a datetime."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# ------------------------------------------------------------------- policies
@dataclass(frozen=True)
class Policy:
    """What a source does with a missing column, an unknown type, and text/uuid rules.

    missing: 'error' | 'default' (B10 fill) | 'skip'
    unknown_type: 'error' | 'skip'
    uuid: 'strict' (C8) | 'lenient' (C9)
    trim_text: True for the accounting source (C5)
    strict_numbers: bad decimal / tinyint text fails the table
    """

    missing: str = "error"
    unknown_type: str = "error"
    uuid: str = "strict"
    trim_text: bool = False
    strict_numbers: bool = True


ACCOUNTING = Policy(missing="error", unknown_type="error", uuid="strict", trim_text=True)
ERP = Policy(missing="default", unknown_type="error", uuid="lenient", trim_text=False)
PAYROLL = Policy(missing="error", unknown_type="error", uuid="lenient", trim_text=False)
METADATA = Policy(missing="skip", unknown_type="skip", uuid="lenient", trim_text=False)
POLICIES = {"accounting": ACCOUNTING, "erp": ERP, "payroll": PAYROLL, "metadata": METADATA}


def default_value(ref_type: str) -> Column:
    """The fill value of a missing column of ``ref_type``."""
    if ref_type in ("int", "tinyint"):
        v = F.lit(0)
    elif ref_type == "bit":
        v = F.lit(False)
    elif ref_type == "nvarchar":
        v = F.lit("")
    else:
        v = F.lit(None)
    return v.cast(SPARK_TYPES[ref_type])


def convert(c: Column, ref_type: str, dtype=None, policy: Policy = ERP) -> Column:
    """Coerce one column to ``ref_type`` following ``policy``."""
    numeric = _is_numeric(dtype) if dtype is not None else False
    temporal = isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))
    if ref_type == "int":
        return to_int(c)
    if ref_type == "tinyint":
        return to_tinyint(c, strict=policy.strict_numbers)
    if ref_type == "decimal":
        return to_decimal(c, strict=policy.strict_numbers)
    if ref_type == "bit":
        return to_bit(c)
    if ref_type == "nvarchar":
        return to_string(c, trim=policy.trim_text)
    if ref_type == "uniqueidentifier":
        return to_uuid(c, strict=policy.uuid == "strict", numeric_input=numeric)
    if ref_type == "date":
        return to_date(c, temporal_input=temporal)
    if ref_type == "datetime":
        return to_datetime(c, numeric_input=numeric, temporal_input=temporal)
    raise ValueError(f"unknown type '{ref_type}'")


def coerce_table(df: DataFrame, types: list[tuple[str, str]], policy: Policy = ERP,
                 keep_extra: bool = True) -> DataFrame:
    """Apply the declared ``(column, type)`` list in one ``select``.

    Columns keep their input order; declared columns missing from ``df``
    are handled by ``policy.missing`` and appended in declaration order.
    """
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    declared = dict(types)
    for col, t in types:
        if t not in SPARK_TYPES and policy.unknown_type == "error":
            raise ValueError(f"unknown type '{t}' for column '{col}'")
    missing = [c for c, _ in types if c not in dtypes]
    if missing and policy.missing == "error":
        raise ValueError(f"columns missing for type conversion: {missing}")
    # Stage 1 computes every conversion once with the lenient rule; stage 2 only
    # checks the computed value for the strict rules (a failed strict value
    # fails the job).  Two projections keep the regex-heavy conversion from
    # being evaluated again inside the failure check.
    lenient = Policy(policy.missing, policy.unknown_type, "lenient", policy.trim_text, False)
    stage1, stage2 = [], []
    for i, name in enumerate(df.columns):
        t = declared.get(name)
        raw = F.col(f"`{name}`")
        if t is None or t not in SPARK_TYPES:
            if keep_extra or t is not None:
                stage1.append(raw)
                stage2.append(F.col(f"`{name}`"))
            continue
        strict = ((t in ("decimal", "tinyint") and policy.strict_numbers)
                  or (t == "uniqueidentifier" and policy.uuid == "strict"))
        if not strict:
            stage1.append(convert(raw, t, dtypes[name], policy).alias(name))
            stage2.append(F.col(f"`{name}`"))
            continue
        tmp, flag = f"__conv{i}", f"__given{i}"
        stage1 += [convert(raw, t, dtypes[name], lenient).alias(tmp), raw.isNotNull().alias(flag)]
        if t == "tinyint":
            # the lenient tinyint maps failures to 0: re-check parseability
            txt = F.trim(_text(raw))
            ok = F.coalesce(txt.try_cast("bigint"), txt.try_cast("double").try_cast("bigint")).isNotNull() \
                | raw.isNull()
            stage1[-1] = (~ok).alias(flag)
            bad = F.col(flag)
        else:
            bad = F.col(flag) & F.col(tmp).isNull()
        stage2.append(F.when(bad, F.raise_error(F.lit(f"{t}: cannot convert column {name}"))
                             .cast(SPARK_TYPES[t])).otherwise(F.col(tmp)).alias(name))
    if policy.missing == "default":
        for c, t in types:
            if c in missing and t in SPARK_TYPES:
                stage1.append(default_value(t).alias(c))
                stage2.append(F.col(f"`{c}`"))
    return df.select(*stage1).select(*stage2)


def _failed(raw: Column, t: str, dtype, policy: Policy) -> Column:
    """Is the value given (not null) but does not convert under the lenient rule?"""
    if t in ("int", "tinyint"):
        # failures become 0: count text that is neither integral nor numeric
        s = F.trim(_text(raw))
        conv = F.coalesce(s.try_cast("bigint"), s.try_cast("double").try_cast("bigint"))
    elif t == "bit":
        conv = F.when(F.lower(_text(raw)).isin("true", "1", "false", "0"), F.lit(True))
    elif t == "decimal":
        conv = F.when(decimal_fits(raw), F.lit(True))        # bad text, or decimals that would be cut
    else:
        conv = convert(raw, t, dtype, Policy(policy.missing, policy.unknown_type, "lenient", policy.trim_text, False))
    return raw.isNotNull() & conv.isNull()


def audit(df: DataFrame, types: list[tuple[str, str]], policy: Policy = ERP) -> DataFrame:
    """One row with, per declared column present, the number of values that were
    given (not null) but did not convert (null after the lenient rule)."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count_if(_failed(F.col(f"`{c}`"), t, dtypes[c], policy)).alias(c) for c, t in types if c in dtypes and t in SPARK_TYPES]
    if not aggs:
        return df.sparkSession.createDataFrame([(0,)], "no_columns int")
    return df.agg(*aggs)


def audit_values(df: DataFrame, types: list[tuple[str, str]], policy: Policy = ERP) -> DataFrame:
    """Every distinct bad value: ``column_name, type_name, value, n``.

    One pass: each row yields only its bad values, which are counted map-side."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    bad = [F.when(_failed(F.col(f"`{c}`"), t, dtypes[c], policy),
                  F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("type_name"), _text(F.col(f"`{c}`")).alias("value")))
           for c, t in types if c in dtypes and t in SPARK_TYPES]
    if not bad:
        return df.sparkSession.createDataFrame([], "column_name string, type_name string, value string, n long")
    return (df.select(F.explode(F.array_compact(F.array(*bad))).alias("_b")).select("_b.*")
            .groupBy("column_name", "type_name", "value").agg(F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------------------ C14
SQL_TYPE_NAMES = {
    "int": "int", "integer": "int", "bigint": "bigint", "smallint": "smallint",
    "tinyint": "smallint", "bit": "boolean", "boolean": "boolean",
    "nvarchar": "string", "varchar": "string", "string": "string", "text": "string",
    "uniqueidentifier": "string", "date": "date", "datetime": "timestamp_ntz",
    "datetime2": "timestamp_ntz", "timestamp": "timestamp_ntz", "float": "double",
    "double": "double", "real": "float",
}


def spark_type_name(sql_type: str | None) -> str | None:
    """Translate a declared target type name (SQL Server or Spark spelling)."""
    if sql_type is None or not str(sql_type).strip():
        return None
    t = str(sql_type).strip().lower()
    base = t.split("(")[0].strip()
    if base in ("decimal", "numeric"):
        return t.replace("numeric", "decimal")
    if base in ("nvarchar", "varchar", "char", "nchar"):
        return "string"
    return SQL_TYPE_NAMES.get(base, t)


def metadata_cast(df: DataFrame, types: dict[str, str | None]) -> DataFrame:
    """C14: ``try_cast`` every present column that has a declared type, in one select."""
    exprs = []
    for name in df.columns:
        t = spark_type_name(types.get(name))
        c = F.col(f"`{name}`")
        exprs.append(c.try_cast(t).alias(name) if t else c)
    return df.select(*exprs)
