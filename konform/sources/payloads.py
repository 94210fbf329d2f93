"""Readers of landed API payloads.

A landed page is one row ``(source, tenant, table, page_no, body, next_token)``;
``body`` is the raw response text.  Every reader turns a DataFrame of pages
into a DataFrame of records with built-in JSON/XML expressions and
``explode``, so pages are parsed in parallel wherever they sit.  Row
schemas are always declared (never inferred): a fixed schema is what makes
the job restartable and streaming-capable.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import chains

LANDED_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("tenant", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("page_no", T.LongType()),
    T.StructField("body", T.StringType()),
    T.StructField("next_token", T.StringType()),
    # which extraction a page belongs to (null where a tenant has one at a time)
    T.StructField("extraction", T.StringType()),
])

XML_OPTIONS = {"ignoreNamespace": "true"}


def _schema(schema) -> T.StructType:
    if isinstance(schema, str):
        return T._parse_datatype_string(schema)
    return schema


def _strings(fields) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def _expand(df: DataFrame, struct_col: str, keep: list[str]) -> DataFrame:
    return df.select(*[F.col(k) for k in keep], F.col(f"{struct_col}.*"))


# ------------------------------------------------------------------------- A1
def odata_items(body: Column, row_schema) -> Column:
    """The record array of one OData JSON response.

    ``{"d": [...]}`` -> its items; ``{"d": {"results": [...]}}`` -> its items;
    ``{"d": {...}}`` without ``results`` -> none; an object without ``d`` is
    itself one record; a bare list -> its items; anything else -> none.
    """
    row_schema = _schema(row_schema)
    arr = T.ArrayType(row_schema)
    d_list = T.StructType([T.StructField("d", arr)])
    d_results = T.StructType([T.StructField("d", T.StructType([T.StructField("results", arr)]))])
    # Each body is parsed once by the matching ``from_json`` (OData writes ``d`` as the only
    # top-level key); anchored patterns tell the shape wherever the text begins.  Bodies with
    # ``d`` after other keys take the slower generic path.
    generic_d = F.trim(F.get_json_object(body, "$.d"))
    generic = (F.when(generic_d.isNull(), F.array(F.from_json(body, row_schema)))
               .when(generic_d.startswith("["), F.from_json(generic_d, arr))
               .when(generic_d.startswith("{"), F.from_json(F.get_json_object(body, "$.d.results"), arr)))
    # The usual shape comes first, known by its first bytes: a pattern that fails walks the whole body.
    return (F.when(body.startswith('{"d":{') | body.rlike(r'^\s*\{\s*"d"\s*:\s*\{'), F.from_json(body, d_results)["d"]["results"])
            .when(body.rlike(r"^\s*\["), F.from_json(body, arr))
            .when(body.rlike(r'^\s*\{\s*"d"\s*:\s*\['), F.from_json(body, d_list)["d"])
            .when(body.rlike(r'^\s*\{\s*"d"\s*:'), F.lit(None).cast(arr))
            .when(body.rlike(r"^\s*\{"), generic))


def odata_next(body: Column) -> Column:
    """A2: the ``d.__next`` link of a response (null on the last page)."""
    return F.get_json_object(body, "$.d.__next")


def odata_rows(pages: DataFrame, row_schema, keep: list[str] | None = None,
               body: str = "body") -> DataFrame:
    """A1 + A2: all records of all pages, one row each; ``keep`` carries page columns."""
    keep = list(keep or [])
    exploded = pages.select(*keep, F.explode(odata_items(F.col(body), row_schema)).alias("_r"))
    return _expand(exploded, "_r", keep)


# ------------------------------------------------------------------------- A2
def _per_page(pages: DataFrame, keys: list[str], page_no: str, next_token: str, body: str | None, extra: list[Column]) -> DataFrame:
    """One row per chain and page number: ``copies`` and whether they are equal; no body moves."""
    parts = [F.col(next_token), *([F.col(body)] if body else [])]
    digest = F.xxhash64(*parts)
    return pages.groupBy(*keys, F.col(page_no).alias("_page")).agg(
        F.count(F.lit(1)).alias("copies"), (F.min(digest) == F.max(digest)).alias("same"),
        F.bool_and(F.col(next_token).isNull()).alias("final"), *extra)


def _per_chain(per_page: DataFrame, keys: list[str], extra: list[Column]) -> DataFrame:
    """A chain is complete when its pages follow each other without a gap from the first number to the last, the last
    page and no other has no next token, and pages that landed again are equal."""
    return (per_page.groupBy(*keys)
            .agg(F.sum("copies").alias("n_pages"), F.max("_page").alias("last_page"), F.count_if("final").alias("n_final"),
                 F.count(F.lit(1)).alias("_distinct"), F.min("_page").alias("_first"), F.count_if(~F.col("same")).alias("_conflicts"),
                 F.max_by("final", "_page").alias("_last_final"), *extra)
            .withColumn("complete", F.coalesce((F.col("n_final") == 1) & F.col("_last_final") & (F.col("_conflicts") == 0)
                                               & (F.col("_distinct") == F.col("last_page") - F.col("_first") + 1), F.lit(False))))


def chain_status(pages: DataFrame, keys: list[str], page_no: str = "page_no",
                 next_token: str = "next_token") -> DataFrame:
    """A2: is every chain of numbered pages complete?  (``chains.chain_report`` follows links instead.)

    Two partial aggregates, per page and per chain: no page bodies move.  Copies of a page count as equal
    when their next tokens are (``page_quality`` compares the bodies too).
    """
    return (_per_chain(_per_page(pages, keys, page_no, next_token, None, []), keys, [])
            .select(*keys, "n_pages", "last_page", "n_final", "complete"))


def complete_pages(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Pages of complete chains only (a left-semi join on the chain keys)."""
    ok = chain_status(pages, keys).filter("complete").select(*keys)
    return pages.join(ok, keys, "left_semi")


# ------------------------------------------------------------ observed fields
def record_texts(body: Column, payload: str = "odata", resource: Column | str | None = None) -> Column:
    """The records of one JSON page, each as its own JSON text."""
    texts = T.ArrayType(T.StringType())
    if payload == "rows":
        inner = F.get_json_object(body, "$.rows")
    elif payload == "keyed":
        inner = F.element_at(F.from_json(body, T.MapType(T.StringType(), T.StringType())), F.lit(resource) if isinstance(resource, str) else resource)
    else:
        d = F.trim(F.get_json_object(body, "$.d"))
        inner = (F.when(body.rlike(r"^\s*\["), body).when(d.isNull(), F.concat(F.lit("["), body, F.lit("]")))
                 .when(d.startswith("{"), F.get_json_object(body, "$.d.results")).otherwise(d))
    return F.from_json(inner, texts)


#: the element whose children are a record's fields, by payload form (``elements``: the last of the path)
XML_RECORDS = {"atom": "properties", "extra": "element", "wage": None, "elements": None}


def element_names(record: Column, name: str) -> Column:
    """The local names of the children of one element, given as its own XML text (no children: null)."""
    parsed = F.from_xml(F.concat(F.lit("<x>"), record, F.lit("</x>")), T.StructType([T.StructField(name, T.VariantType())]), XML_OPTIONS)[name]
    # an element without children is a plain value; names with a leading underscore are attributes
    names = F.when(F.schema_of_variant(parsed).startswith("OBJECT"), F.json_object_keys(F.to_json(parsed)))
    return F.filter(names, lambda n: ~n.startswith("_"))


def observed_fields(pages: DataFrame, payload: str = "odata", resource: Column | str | None = None, keep: list[str] | None = None,
                    body: str = "body", path: list[str] | None = None) -> DataFrame:
    """The field names that occur in any record (per ``keep``), with the number of records that carry them.

    One aggregate over the parsed records, JSON or XML: the union of keys of any number of pages."""
    keep = list(keep or [])
    if payload in XML_PAYLOADS:
        name = XML_RECORDS[payload] or (path or [None])[-1]
        if name is None:
            raise ValueError(f"the path of the repeated element is needed for {payload}")
        records = pages.select(*keep, F.explode(elements(scrub_char_refs(strip_bom(F.col(body))), name)).alias("_r"))
        names = element_names(F.col("_r"), name)
    else:
        records = pages.select(*keep, F.explode(record_texts(F.col(body), payload, resource)).alias("_r"))
        names = F.json_object_keys("_r")
    return records.select(*keep, F.explode(names).alias("field")).groupBy(*keep, "field").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------ readable pages
JSON_PAYLOADS = ("odata", "rows", "keyed")
XML_PAYLOADS = ("atom", "extra", "wage", "elements")


def readable(body: Column, payload: str) -> Column:
    """Can the whole body be parsed?  A page that cannot (an error page, a body cut
    off in transit, no body at all) gives no rows, and must not pass for an empty page."""
    if payload in JSON_PAYLOADS:
        ok = F.json_object_keys(body).isNotNull() | F.json_array_length(body).isNotNull()
    elif payload in XML_PAYLOADS:
        text = scrub_char_refs(strip_bom(body))
        parsed = F.from_xml(text, "_bad string", {**XML_OPTIONS, "columnNameOfCorruptRecord": "_bad"})
        ok = body.isNotNull() & parsed["_bad"].isNull()
    else:
        raise ValueError(f"unknown payload form {payload}")
    return F.coalesce(ok, F.lit(False))


def page_quality(pages: DataFrame, keys: list[str], payload: str = "odata", body: str = "body",
                 page_no: str = "page_no", next_token: str = "next_token", first_page: int | None = None) -> DataFrame:
    """Per chain: ``n_pages``, ``n_unreadable``, ``complete`` (A2) and ``usable`` - every page
    readable and the chain followed to its end.  With ``first_page``, numbered chains must begin there (without it a
    chain whose first pages are still to come looks whole).

    Pages with an ``own`` and a ``nxt`` link (see ``chains``) are followed by their links, others by
    their numbers.  Partial aggregates; no body moves."""
    bad = F.sum((~readable(F.col(body), payload)).cast("long"))
    if {"own", "nxt"} <= set(pages.columns):
        broken = pages.groupBy(*keys).agg(bad.alias("n_unreadable"))
        found = chains.chain_report(pages, keys, body).join(broken, keys)
    else:
        found = _per_chain(_per_page(pages, keys, page_no, next_token, body, [bad.alias("_bad")]), keys, [F.sum("_bad").alias("n_unreadable")])
        if first_page is not None:
            found = found.withColumn("complete", F.col("complete") & (F.col("_first") == first_page))
    return (found.withColumn("usable", (F.col("n_unreadable") == 0) & F.col("complete"))
            .select(*keys, "n_pages", "n_unreadable", "complete", "usable"))


# ------------------------------------------------------------------------- A3
def envelope_rows(pages: DataFrame, row_schema, keep: list[str] | None = None,
                  body: str = "body", field: str = "rows") -> DataFrame:
    """A3: ``{"rows": [...]}`` -> one row per record; an empty envelope gives none."""
    keep = list(keep or [])
    env = T.StructType([T.StructField(field, T.ArrayType(_schema(row_schema)))])
    exploded = pages.select(*keep, F.explode(F.from_json(F.col(body), env)[field]).alias("_r"))
    return _expand(exploded, "_r", keep)


# -------------------------------------------------------------------- A4, A11
def resource_of(endpoint: Column) -> Column:
    """The last path segment of an endpoint (``.../admdat`` -> ``admdat``)."""
    return F.element_at(F.split(F.regexp_replace(endpoint, r"/*([?].*)?$", ""), "/"), -1)


def keyed_rows(pages: DataFrame, row_schema, resource: Column | str,
               keep: list[str] | None = None, body: str = "body") -> DataFrame:
    """A4: the records under the key named after the endpoint's last segment."""
    keep = list(keep or [])
    res = F.lit(resource) if isinstance(resource, str) else resource
    as_map = F.from_json(F.col(body), T.MapType(T.StringType(), T.ArrayType(_schema(row_schema))))
    exploded = pages.select(*keep, F.explode(F.element_at(as_map, res)).alias("_r"))
    return _expand(exploded, "_r", keep)


def administrations(pages: DataFrame, row_schema, keep: list[str] | None = None) -> DataFrame:
    """The administrations list ``data['admdat']``."""
    return keyed_rows(pages, row_schema, "admdat", keep)


# ------------------------------------------------------------------------- A7
def scrub_char_refs(body: Column) -> Column:
    """Delete every hexadecimal character reference before parsing."""
    return F.regexp_replace(body, "&#x[0-9A-Fa-f]+;", "")


def strip_bom(body: Column) -> Column:
    return F.regexp_replace(body, "^\\x{FEFF}", "")


# ------------------------------------------------------------------------- A5
_SPECIAL = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>"


def plain_xml(xml: Column) -> Column:
    """The same document without comments and processing instructions, and with CDATA sections as escaped text, so that
    ``<`` only begins a tag."""
    part = lambda x: F.when(x.startswith("<![CDATA["), F.replace(F.replace(F.replace(
        F.substring(x, F.lit(10), F.length(x) - 12), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))).otherwise(F.lit(""))
    between, special = F.split(xml, _SPECIAL, -1), F.regexp_extract_all(xml, F.lit(_SPECIAL), F.lit(0))
    whole = F.array_join(F.zip_with(between, special, lambda a, x: F.concat(a, F.coalesce(part(x), F.lit("")))), "")
    return F.when(F.contains(xml, F.lit("<!")) | F.contains(xml, F.lit("<?")), whole).otherwise(xml)


def elements(xml: Column, name: str) -> Column:
    """Every element of this local name as its own XML text, at any depth (it must not nest in itself).

    In ``plain_xml`` a ``<`` is always a tag and a ``>`` inside an attribute is quoted, so the ends found are the element's own."""
    tag = rf"(?:[\w.-]+:)?{re.escape(name)}"
    attributes = r"""(?:[^>"'/]++|"[^"]*+"|'[^']*+'|/(?!>))*+"""
    return F.regexp_extract_all(plain_xml(xml), F.lit(rf"(?s)<{tag}(?=[\s/>]){attributes}(?:/>|>.*?</{tag}\s*>)"), F.lit(0))


def atom_rows(pages: DataFrame, fields: list[str], keep: list[str] | None = None,
              body: str = "body") -> DataFrame:
    """A5 + A7: one row per ``entry``, a column per local name below its ``properties``
    (inside ``content`` or beside it).

    Values stay text (typing is the coercion step); an empty element is null, and an entry without
    properties gives a row of nulls.
    """
    keep = list(keep or [])
    entries = pages.select(*keep, F.explode(elements(scrub_char_refs(F.col(body)), "entry")).alias("_e"))
    props = F.from_xml(F.get(elements(F.col("_e"), "properties"), F.lit(0)), _strings(fields), XML_OPTIONS)
    return entries.select(*keep, props.alias("_p")).select(
        *keep, *[F.nullif(F.col(f"_p.{f}"), F.lit("")).alias(f) for f in fields])


def atom_next_link(body: Column) -> Column:
    """A2 for Atom: the ``href`` of ``link[@rel='next']`` (null on the last page)."""
    return F.nullif(F.xpath_string(scrub_char_refs(body), F.lit("/*/link[@rel='next']/@href")),
                    F.lit(""))


# ------------------------------------------------------------------------- A6
EXTRA_FIELDS = ("ItemID", "Modified", "Number", "Description", "Value")


def extra_field_rows(pages: DataFrame, keep: list[str] | None = None, body: str = "body",
                     element: str = "element") -> DataFrame:
    """Each ``element``, at any depth, gives the five fixed fields, trimmed; absent -> null."""
    keep = list(keep or [])
    found = pages.select(*keep, F.explode(elements(scrub_char_refs(F.col(body)), element)).alias("_e"))
    parsed = found.select(*keep, F.from_xml("_e", _strings(EXTRA_FIELDS), XML_OPTIONS).alias("_x"))
    return parsed.select(*keep, *[F.trim(F.col(f"_x.{f}")).alias(f) for f in EXTRA_FIELDS])


# ------------------------------------------------------------------------- A8
WAGE_COMPANY = ("CompanyID", "CompanyName", "CompanyNumber", "PeriodType")
WAGE_EMPLOYEE = ("EmployeeID", "EmployeeName", "EmployeeNumber")
WAGE_COMPONENT = ("ComponentGuid", "ComponentNumber", "ComponentName", "CumulativeValue")
WAGE_VALUE = ("ComponentValue", "Period", "Run")


def wage_report_schema() -> T.StructType:
    value = _strings(WAGE_VALUE)
    component = T.StructType(list(_strings(WAGE_COMPONENT).fields) + [
        T.StructField("Values", T.StructType([T.StructField("Value", T.ArrayType(value))]))])
    employee = T.StructType(list(_strings(WAGE_EMPLOYEE).fields) + [
        T.StructField("WageComponentsList", T.StructType([
            T.StructField("WageComponents", T.ArrayType(component))]))])
    return T.StructType(list(_strings(WAGE_COMPANY).fields) + [
        T.StructField("EmployeesList", T.StructType([
            T.StructField("Employees", T.ArrayType(employee))]))])


def wage_report_rows(pages: DataFrame, keep: list[str] | None = None, body: str = "body") -> DataFrame:
    """Company -> employee -> component -> value, one row per value.

    Three inner ``explode``s: a level without children yields no row.
    """
    keep = list(keep or [])
    rep = pages.select(*keep, F.from_xml(strip_bom(F.col(body)), wage_report_schema(),
                                         XML_OPTIONS).alias("_c"))
    emp = rep.select(*keep, "_c", F.explode("_c.EmployeesList.Employees").alias("_e"))
    comp = emp.select(*keep, "_c", "_e", F.explode("_e.WageComponentsList.WageComponents").alias("_w"))
    val = comp.select(*keep, "_c", "_e", "_w", F.explode("_w.Values.Value").alias("_v"))
    return val.select(*keep,
                      *[F.col(f"_c.{f}").alias(f) for f in WAGE_COMPANY],
                      *[F.col(f"_e.{f}").alias(f) for f in WAGE_EMPLOYEE],
                      *[F.col(f"_w.{f}").alias(f) for f in WAGE_COMPONENT],
                      *[F.col(f"_v.{f}").alias(f) for f in WAGE_VALUE])


# ------------------------------------------------------------------------- A9
def element_rows(pages: DataFrame, path: list[str], fields: list[str],
                 keep: list[str] | None = None, body: str = "body") -> DataFrame:
    """Every element at ``path`` (below the document root) is a row, its
    children's local names are the columns (namespaces ignored, BOM stripped)."""
    keep = list(keep or [])
    *parents, element = path
    node: T.DataType = T.StructType([T.StructField(element, T.ArrayType(_strings(fields)))])
    for p in reversed(parents):
        node = T.StructType([T.StructField(p, node)])
    parsed = F.from_xml(strip_bom(F.col(body)), node, XML_OPTIONS)
    arr = parsed
    for p in parents:
        arr = arr[p]
    exploded = pages.select(*keep, F.explode(arr[element]).alias("_e"))
    return exploded.select(*keep, *[F.nullif(F.col(f"_e.{f}"), F.lit("")).alias(f) for f in fields])


def element_union_rows(pages: DataFrame, element: str, keep: list[str] | None = None, body: str = "body") -> DataFrame:
    """A9 without declared fields: every ``element`` at any depth is a row, and the columns are the union of the
    children's local names over all records, in alphabetical order (found by one aggregate over the pages).

    No element anywhere: no columns but ``keep`` and no rows."""
    keep = list(keep or [])
    found = observed_fields(pages, "elements", path=[element], body=body).select("field").collect()      # one per field of the API
    fields = sorted(r["field"] for r in found)
    records = pages.select(*keep, F.explode(elements(scrub_char_refs(strip_bom(F.col(body))), element)).alias("_r"))
    row = F.from_xml(F.col("_r"), _strings(fields or ["_none"]), XML_OPTIONS)
    return records.select(*keep, row.alias("_p")).select(*keep, *[F.nullif(F.col(f"_p.`{f}`"), F.lit("")).alias(f) for f in fields])


def read_elements(spark: SparkSession, path: str, element: str, fields: list[str]) -> DataFrame:
    """A9 over landed XML files: the XML reader splits files on ``rowTag`` in parallel."""
    return (spark.read.format("xml").option("rowTag", element).option("ignoreNamespace", "true")
            .schema(_strings(fields)).load(path))


# ------------------------------------------------------------------------ A10
def unnest_list(df: DataFrame, col: str, fields: list[str] | None = None) -> DataFrame:
    """A10: explode a list-of-records column (outer: an empty list keeps its row)
    and expand its fields as ``<col>_<field>``; the list column is dropped."""
    elem = df.schema[col].dataType.elementType
    names = fields or [f.name for f in elem.fields]
    others = [F.col(f"`{c}`") for c in df.columns if c != col]
    exploded = df.select(*others, F.explode_outer(col).alias("_x"))
    return exploded.select(*others, *[F.col(f"_x.{f}").alias(f"{col}_{f}") for f in names])


# ------------------------------------------------------------------------ A14
DIVISION_FIELDS = ("Entiteit", "Division", "CustomerCode", "CustomerName",
                   "CompanySizeDescription", "State", "City", "HID")


def division_projection(df: DataFrame) -> DataFrame:
    """The eight tenant fields; ``CustomerName`` is ``Class_02.Description`` and
    null when ``Class_02`` is null (a struct field of a null struct is null)."""
    return df.select(F.col("Description").alias("Entiteit"),
                     F.col("Code").alias("Division"),
                     F.col("CustomerCode"),
                     F.col("Class_02.Description").alias("CustomerName"),
                     F.col("CompanySizeDescription"), F.col("State"), F.col("City"),
                     F.col("Hid").alias("HID"))
