"""Runs over several tenants and customers: each keeps its own rule, year and outcome, and nothing is lost or multiplied."""

import json
import os

from pyspark.sql import functions as F

from konform.plans import outcomes, publish
from konform.plans.run import finish_run, item_log, run_source, stored_schema
from konform.schemas import column_mapping

from conftest import rows

RUN_START = "2024-06-30 12:00:00"
PAGES = "source string, tenant string, table string, page_no long, body string, next_token string"
WORK = "customer string, tenant long, table_name string, watermark string, reporting_year int"


def landed(spark, source, table, *pages):
    return spark.createDataFrame([(source, t, table, n, body, nxt) for t, n, body, nxt in pages], PAGES)


def work(spark, *items):
    return spark.createDataFrame([(c, t, table, None, y) for c, t, table, y in items], WORK)


def rubriek(n, field="ID"):
    rec = {s: None for s, _ in column_mapping("accounting", "GrootboekRubriek") if s != "Division"}
    rec.update({field: f"00000000-0000-0000-0000-{n:012d}", "Description": "N"})
    return json.dumps({"d": {"results": [rec]}})


def companies(*ids, drop=None):
    fields = [s for s, _ in column_mapping("payroll", "Bedrijven")]
    one = lambda i: "".join(f"<{f}>{i if f in ('ID', 'Number') else f'name {i}'}</{f}>" for f in fields if f != drop)
    return "<R><Result>" + "".join(f"<Company>{one(i)}</Company>" for i in ids) + "</Result></R>"


def go(spark, root, source, pages, items, **kw):
    return run_source(spark, source, pages, items, root, RUN_START, **kw)


def test_gaps_and_repeats_of_pages(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "chains")
    items = work(spark, ("K", 1, "GrootboekRubriek", 2023))
    run = lambda *p: go(spark, root, "accounting", landed(spark, "accounting", "GrootboekRubriek", *p), items)
    stored = lambda: publish.read_tenants(spark, f"{root}/accounting/GrootboekRubriek", stored_schema("accounting", "GrootboekRubriek"),
                                          "AdministratieCode").count()
    assert not run(("1", 0, rubriek(1), "n"), ("1", 2, rubriek(3), None)).ok               # a lost middle page
    r = run(("1", 0, rubriek(1), "n"), ("1", 1, rubriek(2), None), ("1", 1, rubriek(2), None))
    assert r.ok and stored() == 2                                                          # a page that landed twice counts once
    assert not run(("1", 0, rubriek(1), "n"), ("1", 1, rubriek(2), None), ("1", 1, rubriek(3), None)).ok
    assert stored() == 2


def test_pages_followed_by_their_links(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "links")
    items = work(spark, ("K", 1, "GrootboekRubriek", 2023))

    def run(*pages):
        df = spark.createDataFrame([("accounting", "1", "GrootboekRubriek", 0, b, None, own, nxt) for own, nxt, b in pages], PAGES + ", own string, nxt string")
        return go(spark, root, "accounting", df, items)

    assert run(("b", None, rubriek(3)), (None, "a", rubriek(1)), ("a", "b", rubriek(2))).ok
    assert not run((None, "a", rubriek(1)), ("b", None, rubriek(2))).ok                     # the chain leads nowhere
    assert not run((None, "a", rubriek(1)), ("a", "a", rubriek(2))).ok                      # round in a circle


def test_payroll_companies_of_a_broken_tenant_stay(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "companies")
    items = work(spark, ("K", 1, "Bedrijven", 2023), ("L", 2, "Bedrijven", 2023))
    run = lambda a, b: go(spark, root, "payroll", landed(spark, "payroll", "Bedrijven", ("1", 0, a, None), ("2", 0, b, None)), items,
                          payload="elements", path=["Result", "Company"])
    stored = lambda: rows(publish.read_current(spark, f"{root}/payroll/Bedrijven"), "BedrijfID")
    assert run(companies(10, 11), companies(20)).ok and stored() == [(10,), (11,), (20,)]
    r = run(companies(10, 12), "<html>502")
    assert not r.ok and stored() == [(10,), (12,), (20,)]
    assert rows(outcomes.customer_outcomes(r.items), "customer", "ok") == [("K", True), ("L", False)]
    # an element that is absent everywhere fails the table instead of becoming 0
    r = run(companies(10, drop="ID"), companies(20, drop="ID"))
    assert not r.ok and "missing" in r.outcomes[0]["error"] and stored() == [(10,), (12,), (20,)]


def wage(company, n):
    value = "".join(f"<Value><ComponentValue>{i}</ComponentValue><Period>{i}</Period><Run>1</Run></Value>" for i in range(1, n + 1))
    return (f"<Report><CompanyID>{company}</CompanyID><CompanyName>c</CompanyName><CompanyNumber>{company}</CompanyNumber><EmployeesList><Employees>"
            f"<EmployeeID>1</EmployeeID><EmployeeName>e</EmployeeName><EmployeeNumber>1</EmployeeNumber><WageComponentsList><WageComponents>"
            f"<ComponentGuid>00000000-0000-0000-0000-000000000001</ComponentGuid><ComponentNumber>1</ComponentNumber><ComponentName>x</ComponentName>"
            f"<Values>{value}</Values></WageComponents></WageComponentsList></Employees></EmployeesList></Report>")


def test_every_tenant_has_its_own_year(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "years")
    items = work(spark, ("K", 1, "Looncomponenten", 2022), ("K", 2, "Looncomponenten", 2023))
    pages = landed(spark, "payroll", "Looncomponenten", ("1", 0, wage(1, 1), None), ("2", 0, wage(2, 2), None), ("9", 0, wage(9, 1), None))
    for _ in range(2):
        r = go(spark, root, "payroll", pages, items, payload="wage")
        assert r.ok, r.outcomes
        got = publish.read_tenants(spark, f"{root}/payroll/Looncomponenten", stored_schema("payroll", "Looncomponenten"), "BedrijfID")
        assert rows(got, "BedrijfID", "Jaar") == [(1, 2022), (2, 2023), (2, 2023)]         # nothing doubled, tenant 9 is not planned
    assert rows(r.items, "tenant", "planned", "ok") == [("1", True, True), ("2", True, True), ("9", False, None)]


def test_divisions_of_tenants_with_different_years(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "divisions")
    m = column_mapping("accounting", "Divisions")
    body = lambda *ids: json.dumps({"d": {"results": [{s: (d if t == "Division" else "x" if t == "Entiteit" else None) for s, t in m} for d in ids]}})
    pages = landed(spark, "accounting", "Divisions", ("1", 0, body(1), None), ("2", 0, body(2), None), ("9", 0, body(9), None))
    r = go(spark, root, "accounting", pages, work(spark, ("K", 1, "Divisions", 2022), ("K", 2, "Divisions", 2023)))
    assert r.ok, r.outcomes
    assert rows(publish.read_current(spark, f"{root}/accounting/Divisions"), "Division", "Status") == [(1, 0), (2, 0)]


def test_outcomes_block_their_own_customer(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "own")
    items = work(spark, ("A", 1, "GrootboekRubriek", 2023), ("B", 2, "GrootboekRubriek", 2023), ("C", 3, "NoSuchTable", 2023), ("D", 4, "GrootboekRubriek", 2023))
    r = go(spark, root, "accounting", landed(spark, "accounting", "GrootboekRubriek", ("1", 0, rubriek(1), None), ("4", 0, rubriek(4), "more")), items)
    assert not r.ok and r.watermark is None
    got = {c: e for c, e in rows(r.items, "customer", "error")}
    assert got["A"] is None and got["B"] == "no page landed" and got["C"] == "no write configuration" and "missing pages" in got["D"]
    config = spark.createDataFrame([(c, "2024-01-01T00:00:00", 2020) for c in "ABCDE"], "klant string, watermark string, reporting_year int")
    adm = spark.createDataFrame([(1, 7, "A", 70, "adm")], "tenant long, KlantID int, KlantNaam string, AdministratieID int, AdministratieNaam string")
    state, log = os.path.join(tmpdir_path, "state"), os.path.join(tmpdir_path, "log")
    finish_run(spark, r, item_log(r, adm, "accounting", 5, "run", RUN_START), log, config, ["klant"], RUN_START, "Wijzigingen", state)
    moved = {k: (w, y) for k, w, y in rows(spark.read.parquet(state), "klant", "watermark", "reporting_year")}
    assert moved.pop("A") == ("2024-06-30T12:00:00", 2023) and set(moved.values()) == {("2024-01-01T00:00:00", 2020)}
    written = spark.read.parquet(log)
    assert written.count() == 4 and rows(written.filter("KlantID = 7"), "AdministratieID", "Tabel", "TypeActie") == [(70, "GrootboekRubriek", "INFO")]
    assert written.filter(F.col("Actie").contains("no page landed")).count() == 1


def test_values_that_do_not_fit_are_kept_in_one_audit_table(spark, tmpdir_path):
    bad = companies(10, 11).replace("<Number>11</Number>", "<Number>eleven</Number>")
    r = go(spark, os.path.join(tmpdir_path, "audit"), "payroll", landed(spark, "payroll", "Bedrijven", ("1", 0, bad, None)), work(spark, ("K", 1, "Bedrijven", 2023)),
           payload="elements", path=["Result", "Company"])
    found = [x.asDict() for x in r.audit.collect()]
    assert r.outcomes[0]["bad_values"] == sum(x["n"] for x in found) == 1
    assert found[0]["table_name"] == "Bedrijven" and "eleven" in map(str, found[0].values())


def test_a_run_without_any_page(spark, tmpdir_path):
    empty = landed(spark, "accounting", "GrootboekRubriek", ("1", 0, rubriek(1), None)).limit(0)
    r = go(spark, os.path.join(tmpdir_path, "none"), "accounting", empty, work(spark, ("A", 1, "GrootboekRubriek", 2023)))
    assert not r.ok and r.watermark is None


def test_keyed_tables_are_routed_by_their_endpoints(spark, tmpdir_path):
    """One run over two tables whose records stand under different keys."""
    root = os.path.join(tmpdir_path, "keyed")
    rec = lambda table, n: {s: None for s, _ in column_mapping("accounting", table) if s != "Division"} | {"ID": f"00000000-0000-0000-0000-{n:012d}"}
    tables = {"GrootboekRubriek": "/v1/grbrub/", "ArtikelGroepen": "/v1/artgrp?x=1"}
    keys = {"GrootboekRubriek": "grbrub", "ArtikelGroepen": "artgrp"}
    pages = landed(spark, "accounting", "GrootboekRubriek", ("1", 0, json.dumps({"grbrub": [rec("GrootboekRubriek", 1)], "artgrp": []}), None)).unionByName(
        landed(spark, "accounting", "ArtikelGroepen", ("1", 0, json.dumps({"artgrp": [rec("ArtikelGroepen", 2), rec("ArtikelGroepen", 3)]}), None)))
    from konform.sources.control import with_endpoints
    endpoints = spark.createDataFrame(list(tables.items()), "TabelNaam string, Endpoint string")
    items = with_endpoints(work(spark, *[("K", 1, t, 2023) for t in keys]), endpoints)
    r = go(spark, root, "accounting", pages, items, payload="keyed")
    assert r.ok, r.outcomes
    assert {o["table"]: o["rows"] for o in r.outcomes} == {"GrootboekRubriek": 1, "ArtikelGroepen": 2}
