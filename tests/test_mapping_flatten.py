"""B1-B10 and D1-D7 on literal tables."""

import pytest
from pyspark.sql import functions as F

from konform.operators import flatten, mapping
from konform.schemas import NESTED, column_mapping

from conftest import rows


def test_map_keep_swap_and_missing(spark):
    df = spark.createDataFrame([(1, True, False, "x")], "ID long, IsPurchase boolean, IsSupplier boolean, extra string")
    out = mapping.map_keep(df, column_mapping("accounting", "Relaties")[-3:-1] + [("ID", "ID")])
    assert out.columns == ["ID", "IsSupplier", "IsPurchase", "extra"]
    assert tuple(out.first()) == (1, True, False, "x")
    with pytest.raises(mapping.MappingError):
        mapping.map_keep(df, [("Nope", "Target")])


def test_map_keep_adds_tenant_if_absent(spark):
    df = spark.createDataFrame([(1,)], "ID long")
    out = mapping.map_keep(df, [("Division", "AdministratieCode")], "Division", 42)
    assert tuple(out.first()) == (1, 42)
    df2 = spark.createDataFrame([(1, 7)], "ID long, Division int")
    assert tuple(mapping.map_keep(df2, [("Division", "AdministratieCode")], "Division", 42).first()) == (1, 7)


def test_map_project_select_lenient(spark):
    df = spark.createDataFrame([(1, "a", "z")], "a long, b string, c string")
    m = [("b", "B"), ("a", "A")]
    assert mapping.map_project(df, m).columns == ["B", "A"]
    assert mapping.map_select(df, m).columns == ["B", "A"]
    with pytest.raises(mapping.MappingError):
        mapping.map_select(df, [("q", "Q")])
    assert mapping.map_lenient(df, [("b", "B"), ("q", "Q")]).columns == ["B"]


def test_constants_empty_and_defaults(spark):
    df = spark.createDataFrame([(1, ("u",))], "a long, __metadata struct<uri:string>")
    df = mapping.drop_technical(df)
    assert df.columns == ["a"]
    with pytest.raises(mapping.MappingError):
        mapping.add_constant(df, "OmgevingID", None)
    out = mapping.fill_missing(df, [("a", "int"), ("n", "int"), ("b", "bit"), ("s", "nvarchar"), ("d", "date")])
    assert tuple(out.first()) == (1, 0, False, "", None)
    empty = mapping.empty_frame(spark, ["X", "Y"])
    assert empty.columns == ["X", "Y"] and empty.count() == 0


def _invoice_docs(spark):
    doc = NESTED["Verkoopfacturen"]
    hdr = {f: f"h_{f}" for f in doc.header_fields}
    line_t = flatten.line_struct_type(["ID", "Description", "AmountDC"])
    data = [(tuple(hdr.values()) + (([("l1", "first", "1.5"), ("l2", "second", "2")],),)),
            (tuple(v + "x" for v in hdr.values()) + (([],),))]
    cols = ", ".join(f"{f} string" for f in doc.header_fields)
    return spark.createDataFrame(data, f"{cols}, SalesInvoiceLines {line_t.simpleString()}")


def test_explode_lines_invoice(spark):
    out = flatten.flatten_for_table(_invoice_docs(spark), "Verkoopfacturen")
    assert out.count() == 2                              # the header without lines is dropped
    r = out.filter(F.col("ID") == "l1").first()
    assert r["Invoice_Description"] == "h_Description" and r["Description"] == "first"
    assert r["EmployeeFullName"] is None                  # absent line field
    with pytest.raises(flatten.FlattenError):
        flatten.explode_lines(_invoice_docs(spark).drop("Currency"), NESTED["Verkoopfacturen"])


def test_explode_lines_order_missing_header_is_null(spark):
    doc = NESTED["VerkoopOrders"]
    line_t = flatten.line_struct_type(["ID"])
    df = spark.createDataFrame([("o1", ([("l",)],))], f"OrderID string, SalesOrderLines {line_t.simpleString()}")
    r = flatten.flatten_for_table(df, "VerkoopOrders").first()
    assert r["OrderID"] == "o1" and r["Order_Description"] is None and r["ID"] == "l"
    assert set(doc.line_fields) <= set(flatten.flatten_for_table(df, "VerkoopOrders").columns)


INTERLEAVED = [
    # tenant, seq, QuotationID, Currency, Description, Amount
    ("a", 1, None, "LINE0", "orphan line", 1.0),     # before any header: keeps own values
    ("a", 2, "Q1", "EUR", "header 1", 9.0),
    ("a", 3, None, None, "line 1a", 2.0),
    ("a", 4, None, "XXX", "line 1b", 3.0),            # header overwrites Currency
    ("a", 5, "Q2", None, "header 2", 9.0),            # header with a null field
    ("a", 6, None, "YYY", "line 2a", 4.0),            # ... overwrites with null
    ("b", 1, None, "B", "line in other tenant", 5.0),
]


@pytest.mark.parametrize("bucket_rows", [1, 2, 3, 1 << 20])
def test_forward_fill_buckets_agree(spark, bucket_rows):
    df = spark.createDataFrame(INTERLEAVED, "tenant string, seq long, QuotationID string, Currency string, "
                                            "Description string, Amount double")
    out = flatten.forward_fill_lines(df, "QuotationID", ["Currency"], "seq", ["tenant"], bucket_rows=bucket_rows)
    assert rows(out, "tenant", "seq", "QuotationID", "Currency", "Description") == sorted([
        ("a", 1, None, "LINE0", "orphan line"),
        ("a", 3, "Q1", "EUR", "line 1a"),
        ("a", 4, "Q1", "EUR", "line 1b"),
        ("a", 6, "Q2", None, "line 2a"),
        ("b", 1, None, "B", "line in other tenant")], key=repr)


def test_forward_fill_document(spark):
    df = spark.createDataFrame([(1, "Q1", "EUR", None), (2, None, None, "l")],
                               "seq long, QuotationID string, Currency string, ID string").withColumn("t", F.lit(1))
    out = flatten.forward_fill_document(df, "Offertes", "seq", ["t"])
    assert [tuple(r) for r in out.select("QuotationID", "Currency", "ID").collect()] == [("Q1", "EUR", "l")]


def test_fill_by_document_keeps_the_line_description(spark):
    from konform.operators import flatten
    schema = "tenant string, seq long, InvoiceID string, Description string, Quantity double"
    for t in ("1", None):                                    # a null tenant is a stream of its own
        df = spark.createDataFrame([(t, 0, "i1", "HEAD", None), (t, 1, None, "line one", 1.0), (t, 900, None, "line two", 2.0),
                                    (t, 901, "i2", None, None), (t, 902, None, "line three", 3.0)], schema)
        for bucket in (1, 2, 1000):
            out = flatten.forward_fill_document(df, "Verkoopfacturen", "seq", ["tenant"], bucket_rows=bucket)
            got = sorted((r["seq"], r["InvoiceID"], r["Description"], r["Invoice_Description"]) for r in out.collect())
            assert got == [(1, "i1", "line one", "HEAD"), (900, "i1", "line two", "HEAD"), (902, "i2", "line three", None)]


def test_empty_frame_carries_its_columns(spark):
    from pyspark.sql import types as T

    from konform.operators import mapping
    assert mapping.empty_frame(spark, ["a", "b"]).dtypes == [("a", "string"), ("b", "string")]
    assert mapping.empty_frame(spark, T.StructType([T.StructField("n", T.LongType())])).dtypes == [("n", "bigint")]


@pytest.mark.parametrize("name", ["lines_invoice", "lines_order", "lines_quotation", "orders_sync"])
def test_document_queries_generate_methods_that_the_jvm_compiles(spark, name):
    from konform.catalogue import QUERIES
    from conftest import SF_SMALL

    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().debug().codegenToSeq()
        sizes = [parts.apply(k)._3().maxMethodCodeSize() for k in range(parts.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    assert sizes and max(sizes) < 8000                          # HotSpot leaves larger methods to its interpreter


def test_headers_are_typed_before_their_lines():
    from konform.catalogue.flatten_queries import header_types

    for table in ("Verkoopfacturen", "VerkoopOrders", "Offertes"):
        got = header_types(table)
        assert "Currency" in got and not {t for _, t in got.values()} & {"uniqueidentifier", "decimal", "tinyint"}
        assert not set(got) - set(NESTED[table].header_fields)
        assert not {f for f in got if f != "Description"} & set(NESTED[table].line_fields)
