"""A1-A15 on literal payloads."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from konform.sources import payloads
from konform.sources.control import read_delimited

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def pages(spark, bodies):
    return spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "page_no long, body string")


def test_odata_six_shapes(spark):
    bodies = ['{"d":{"results":[{"id":1,"name":"a"},{"id":2,"name":"b"}],"__next":"x"}}',
              '{"d":[{"id":3,"name":"c"}]}',
              '[{"id":4,"name":"d"}]',
              '{"id":5,"name":"e"}',
              '{"d":{"__count":"0"}}',
              '42',
              '{"x":1,"d":[{"id":6,"name":"f"}]}']
    got = sorted(r["id"] for r in payloads.odata_rows(pages(spark, bodies), ROW).collect())
    assert got == [1, 2, 3, 4, 5, 6]


def test_odata_next_and_chain_status(spark):
    df = spark.createDataFrame(
        [("t1", 1, "n"), ("t1", 2, None), ("t2", 1, "n"), ("t2", 2, "n"), ("t3", 1, None), ("t3", 2, "n")],
        "tenant string, page_no long, next_token string")
    st = {r["tenant"]: r["complete"] for r in payloads.chain_status(df, ["tenant"]).collect()}
    assert st == {"t1": True, "t2": False, "t3": False}
    assert payloads.complete_pages(df, ["tenant"]).count() == 2
    nxt = spark.createDataFrame([('{"d":{"results":[],"__next":"u2"}}',)], "body string")
    assert nxt.select(payloads.odata_next(F.col("body"))).first()[0] == "u2"


def test_row_envelope_and_empty(spark):
    got = payloads.envelope_rows(pages(spark, ['{"rows":[{"id":1,"name":"a"}]}', '{"rows":[]}']), ROW)
    assert [tuple(r) for r in got.collect()] == [(1, "a")]


def test_keyed_rows_by_endpoint(spark):
    df = spark.createDataFrame([("/api/v1/admdat?skip=0", '{"admdat":[{"id":7,"name":"x"}]}'),
                                ("/api/v1/other", '{"admdat":[{"id":8,"name":"y"}]}')],
                               "endpoint string, body string")
    got = payloads.keyed_rows(df, ROW, payloads.resource_of(F.col("endpoint")))
    assert [r["id"] for r in got.collect()] == [7]
    assert [r["id"] for r in payloads.administrations(df, ROW).collect()] == [7, 8]


def test_atom_entries_scrub_and_empty(spark):
    body = ('<feed xmlns="http://www.w3.org/2005/Atom" xmlns:m="urn:m" xmlns:d="urn:d">'
            '<link rel="next" href="/p2"/>'
            '<entry><content><m:properties><d:ID>1</d:ID><d:Name>A&#x1F;B</d:Name><d:Empty></d:Empty>'
            '</m:properties></content></entry>'
            '<entry><content><m:properties><d:ID>2</d:ID><d:Name>C</d:Name></m:properties></content></entry></feed>')
    df = pages(spark, [body])
    got = [tuple(r) for r in payloads.atom_rows(df, ["ID", "Name", "Empty"]).collect()]
    assert got == [("1", "AB", None), ("2", "C", None)]
    assert df.select(payloads.atom_next_link(F.col("body"))).first()[0] == "/p2"


def test_extra_fields_trimmed(spark):
    body = "<r><element><ItemID> 9 </ItemID><Number> 3</Number></element></r>"
    got = payloads.extra_field_rows(pages(spark, [body])).first()
    assert (got["ItemID"], got["Number"], got["Value"]) == ("9", "3", None)


def test_wage_report_inner_levels(spark):
    body = ("<R><CompanyID>1</CompanyID><CompanyName>Co</CompanyName><EmployeesList>"
            "<Employees><EmployeeID>10</EmployeeID><WageComponentsList>"
            "<WageComponents><ComponentGuid>g1</ComponentGuid><Values>"
            "<Value><ComponentValue>5.5</ComponentValue><Period>1</Period><Run>1</Run></Value>"
            "<Value><ComponentValue>6.5</ComponentValue><Period>2</Period><Run>1</Run></Value>"
            "</Values></WageComponents></WageComponentsList></Employees>"
            "<Employees><EmployeeID>11</EmployeeID><WageComponentsList></WageComponentsList></Employees>"
            "</EmployeesList></R>")
    got = payloads.wage_report_rows(pages(spark, [body])).select("EmployeeID", "ComponentValue").collect()
    assert sorted(tuple(r) for r in got) == [("10", "5.5"), ("10", "6.5")]


def test_element_rows_bom_and_reader(spark, tmpdir_path):
    body = "﻿<E xmlns:s=\"urn:s\"><s:B><L><Company><ID>1</ID><Name>X</Name></Company>" \
           "<Company><ID>2</ID></Company></L></s:B></E>"
    got = payloads.element_rows(pages(spark, [body]), ["B", "L", "Company"], ["ID", "Name"])
    assert sorted(tuple(r) for r in got.collect()) == [("1", "X"), ("2", None)]
    path = os.path.join(tmpdir_path, "companies.xml")
    with open(path, "w") as f:
        f.write("<root><x><Company><ID>3</ID><Name>Y</Name></Company></x><Company><ID>4</ID></Company></root>")
    rd = payloads.read_elements(spark, path, "Company", ["ID", "Name"])
    assert sorted(r["ID"] for r in rd.collect()) == ["3", "4"]


def test_unnest_list_outer(spark):
    df = spark.createDataFrame([(1, [(1, "a"), (2, "b")]), (2, [])],
                               "k int, line array<struct<n:int,s:string>>")
    got = sorted(tuple(r) for r in payloads.unnest_list(df, "line").collect())
    assert got == [(1, 1, "a"), (1, 2, "b"), (2, None, None)]
    assert payloads.unnest_list(df, "line").columns == ["k", "line_n", "line_s"]


def test_division_projection(spark):
    df = spark.createDataFrame([("1", "E", None), ("2", "F", ("Cust",))],
                               "Code string, Description string, Class_02 struct<Description:string>")
    df = df.select("*", *[F.lit(None).cast("string").alias(c) for c in
                          ["CompanySizeDescription", "State", "City", "Hid", "CustomerCode"]])
    got = sorted((r["Division"], r["CustomerName"]) for r in payloads.division_projection(df).collect())
    assert got == [("1", None), ("2", "Cust")]


def test_delimited_sample(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "q.csv")
    with open(path, "w") as f:
        f.write("QuotationID,Description,AmountDC\nQ1,Head,-0\n,Line,12.5\n")
    schema = T.StructType([T.StructField("QuotationID", T.StringType()),
                           T.StructField("Description", T.StringType()),
                           T.StructField("AmountDC", T.DoubleType())])
    got = [tuple(r) for r in read_delimited(spark, path, schema).collect()]
    assert got == [("Q1", "Head", -0.0), (None, "Line", 12.5)]


def test_readable_and_page_quality(spark):
    bodies = [('{"d":{"results":[]}}', "odata", True), ('  [{"a":1}]', "odata", True), ('{"d":{"results":[{"a":1}', "odata", False),
              ("<html>502</html>", "odata", False), ("", "odata", False), (None, "odata", False), ('{"rows":[{"a":', "rows", False),
              ("<f><entry/></f>", "atom", True), ("<f><entry>", "atom", False), ('{"d":[]}', "atom", False), (None, "wage", False)]
    for body, payload, want in bodies:
        df = spark.createDataFrame([(body,)], "body string")
        assert df.select(payloads.readable(F.col("body"), payload)).first()[0] is want, body
    df = spark.createDataFrame([("1", 0, bodies[0][0], "n"), ("1", 1, bodies[2][0], None), ("2", 0, bodies[0][0], "n"), ("3", 0, bodies[0][0], None)],
                               "tenant string, page_no long, body string, next_token string")
    got = {r["tenant"]: (r["n_pages"], r["n_unreadable"], r["complete"], r["usable"]) for r in payloads.page_quality(df, ["tenant"]).collect()}
    assert got == {"1": (2, 1, True, False), "2": (1, 0, False, False), "3": (1, 0, True, True)}


def test_whole_bodies_decide_the_shape(spark):
    pad = " " * 90 + "\n" * 64
    df = spark.createDataFrame([(pad + '{"d":' + pad + '{"results":[{"a":"1"}]}}',), (pad + '[{"a":"2"}]',), ('{' + pad + '"d":[{"a":"3"}]}',)], "body string")
    assert sorted(r["a"] for r in payloads.odata_rows(df, "a string").collect()) == ["1", "2", "3"]
    ends = spark.createDataFrame([("/api/admdat/",), ("/api/admdat",), ("/api/admdat/?x=1",), ("/api/admdat?x=a/b",)], "e string")
    assert {r[0] for r in ends.select(payloads.resource_of(F.col("e"))).collect()} == {"admdat"}


def test_elements_at_any_depth(spark):
    atom = ('<feed xmlns:m="m" xmlns:d="d"><entry><content/><m:properties><d:A>1</d:A></m:properties></entry>'
            '<x><entry><content><m:properties><d:A m:null="true"/></m:properties></content></entry></x></feed>')
    df = spark.createDataFrame([(atom,)], "body string")
    assert sorted((r["A"] for r in payloads.atom_rows(df, ["A"]).collect()), key=str) == ["1", None]
    extra = "<r><element><ItemID> a </ItemID></element><list><y><element><ItemID>b</ItemID></element></y></list><element/></r>"
    got = payloads.extra_field_rows(spark.createDataFrame([(extra,)], "body string")).collect()
    assert sorted((r["ItemID"] for r in got), key=str) == [None, "a", "b"]


def test_observed_fields(spark):
    df = spark.createDataFrame([('{"d":{"results":[{"a":1,"b":null},{"a":2}]}}',), ('[{"c":{"x":1}}]',), ('{"e":1}',)], "body string")
    assert {r["field"]: r["n"] for r in payloads.observed_fields(df).collect()} == {"a": 2, "b": 1, "c": 1, "e": 1}
    rows_ = spark.createDataFrame([('{"rows":[{"a":1}]}',)], "body string")
    assert [r["field"] for r in payloads.observed_fields(rows_, "rows").collect()] == ["a"]


ATOM = ("<?xml version=\"1.0\"?><feed xmlns='http://a' xmlns:m='http://m' xmlns:d='http://d'><!-- <entry> --><entry a='x>y'><content><m:properties>"
        "<d:ID m:type='Edm.Guid'>abc</d:ID><d:Name><![CDATA[a </entry> <b> & <!-- q -->]]></d:Name><d:Nul m:null='true'/></m:properties></content></entry>"
        "<entry><m:properties><d:ID>q</d:ID></m:properties></entry><entry><id>3</id></entry><entry/></feed>")
SOAP = ("<Root xmlns='u'><Result><Company a='1'><ID>001</ID><Name>x &amp; y &lt;z&gt;</Name></Company><Company><ID>2</ID>"
        "<Extra><![CDATA[</Company> & <b>]]></Extra></Company><Company/></Result></Root>")


def test_atom_entries_with_cdata_comments_and_without_properties(spark):
    d = spark.createDataFrame([(1, ATOM), (2, "<feed/>"), (3, None), (4, "not xml")], "k int, body string")
    got = rows(payloads.atom_rows(d, ["ID", "Name", "Nul"], ["k"]))
    assert got == sorted([(1, "abc", "a </entry> <b> & <!-- q -->", None), (1, "q", None, None), (1, None, None, None), (1, None, None, None)], key=repr)
    fields = {r["field"]: r["n"] for r in payloads.observed_fields(d, "atom").collect()}
    assert fields == {"ID": 2, "Name": 1, "Nul": 1}


def test_union_of_keys(spark):
    d = spark.createDataFrame([(1, SOAP), (2, "<R><Company><Z>1</Z></Company></R>"), (3, None)], "k int, body string")
    got = payloads.element_union_rows(d, "Company", ["k"])
    assert got.columns == ["k", "Extra", "ID", "Name", "Z"]
    assert rows(got) == sorted([(1, None, "001", "x & y <z>", None), (1, "</Company> & <b>", "2", None, None), (1, None, None, None, None),
                                (2, None, None, None, "1")], key=repr)
    assert payloads.element_union_rows(d, "None", ["k"]).collect() == []


def test_extra_fields_in_cdata(spark):
    body = "<x><element><ItemID>1</ItemID><Description><![CDATA[ </element> ]]></Description></element><element/></x>"
    got = rows(payloads.extra_field_rows(spark.createDataFrame([(body,)], "body string")))
    assert got == sorted([("1", None, None, "</element>", None), (None,) * 5], key=repr)
