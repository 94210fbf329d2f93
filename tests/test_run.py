"""A whole accounting run: plan -> one job per table -> outcomes -> watermark."""

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from konform.plans import publish, runs
from konform.plans.run import log_entries, row_schema_for, run_source

from conftest import SF_SMALL

RUN_START = "2024-06-30 12:00:00"


def _pages(spark, label, bad_voorraad=False):
    p = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    uuid = F.concat_ws("-", *[F.substring(F.md5(F.col("p_partkey").cast("string")), a, b)
                              for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    rec = F.to_json(F.struct(uuid.alias("ID"), F.col("p_brand").alias("Code"),
                             F.concat(F.col("p_name"), F.lit(label)).alias("Description")))
    tenant = F.when(F.col("p_partkey") < 100, "1").otherwise("2")
    pages = (p.select(tenant.alias("tenant"), F.floor(F.col("p_partkey") / 25).alias("page_no"), rec.alias("rec"))
             .groupBy("tenant", "page_no")
             .agg(F.concat(F.lit('{"d":{"results":['), F.concat_ws(",", F.collect_list("rec")), F.lit("]}}"))
                  .alias("body"))
             .select(F.lit("accounting").alias("source"), "tenant", F.lit("ArtikelGroepen").alias("table"),
                     F.col("page_no").cast("long"), "body",
                     # every page but a tenant's last names the next one
                     F.when(F.col("page_no") < F.max("page_no").over(Window.partitionBy("tenant")), "next").alias("next_token")))
    if bad_voorraad:
        bad = spark.createDataFrame([("accounting", "1", "Voorraad", 0, '{"d":{"results":[{"ID":"not-a-uuid"}]}}', None)],
                                    pages.schema)
        pages = pages.unionByName(bad)
    return pages


def _work(spark, tables):
    rows = [(1, t, "2024-01-01T00:00:00", 2023) for t in tables] + [(2, t, None, 2023) for t in tables]
    return spark.createDataFrame(rows, "tenant long, table_name string, watermark string, reporting_year int")


def test_row_schema_for_documents():
    s = row_schema_for("accounting", "Offertes")
    assert "QuotationLines" in s.names and "QuotationID" in s.names
    assert row_schema_for("erp", "Tarieven").names == ["OmgevingID", "Administratie_Code", "ProjectID", "Verkoopprijs"]


def test_run_source_upserts_appends_and_blocks_watermark(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "tables")
    parts = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    n, n1 = parts.count(), parts.filter("p_partkey < 100").count()
    r1 = run_source(spark, "accounting", _pages(spark, " v1"), _work(spark, ["ArtikelGroepen"]), root, RUN_START,
                    in_place=False)
    assert r1.ok and r1.watermark == "2024-06-30T12:00:00"
    t = publish.read_current(spark, f"{root}/accounting/ArtikelGroepen")
    assert t.count() == n and t.columns == ["ID", "Code", "Omschrijving", "AdministratieCode"]
    # second run: tenant 1 (fresh watermark, keys) upserts; tenant 2 (no watermark) appends
    r2 = run_source(spark, "accounting", _pages(spark, " v2", bad_voorraad=True),
                    _work(spark, ["ArtikelGroepen", "Voorraad"]), root, RUN_START, in_place=False)
    outcome = {o["table"]: o["ok"] for o in r2.outcomes}
    assert outcome == {"ArtikelGroepen": True, "Voorraad": False}
    assert r2.watermark is None                       # a failed table blocks the watermark
    t = publish.read_current(spark, f"{root}/accounting/ArtikelGroepen")
    t1 = t.filter("AdministratieCode = 1")
    assert t1.count() == n1 and t1.filter(F.col("Omschrijving").endswith(" v2")).count() == n1
    assert t.filter("AdministratieCode = 2").count() == 2 * (n - n1)
    log = runs.log_rows(spark, log_entries(r2, "K", 7, "Wijzigingen", None))
    assert log.filter("TypeActie = 'ERROR'").count() == 1


def test_run_source_in_place(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "inplace")
    parts = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    n, n1 = parts.count(), parts.filter("p_partkey < 100").count()
    r1 = run_source(spark, "accounting", _pages(spark, " v1"), _work(spark, ["ArtikelGroepen"]), root, RUN_START)
    assert r1.ok
    base = f"{root}/accounting/ArtikelGroepen"
    assert sorted(os.listdir(base))[:2] == ["AdministratieCode=1", "AdministratieCode=2"]
    r2 = run_source(spark, "accounting", _pages(spark, " v2"), _work(spark, ["ArtikelGroepen"]), root, RUN_START,
                    in_place=True)
    assert r2.ok
    from konform.plans.run import target_schema
    t = spark.read.schema(target_schema("accounting", "ArtikelGroepen")).parquet(base)
    assert t.filter("AdministratieCode = 1").count() == n1
    assert t.filter("AdministratieCode = 2").count() == 2 * (n - n1)


PAGE_SCHEMA = "source string, tenant string, table string, page_no long, body string, next_token string"


def _landed(spark, *pages, table="GrootboekRubriek", source="accounting"):
    return spark.createDataFrame([(source, t, table, n, body, nxt) for t, n, body, nxt in pages], PAGE_SCHEMA)


def _rubriek(n, naam="N", field="Description"):
    from konform.schemas import column_mapping
    import json
    rec = {s: None for s, _ in column_mapping("accounting", "GrootboekRubriek") if s != "Division"}
    rec.update({"ID": f"00000000-0000-0000-0000-{n:012d}", field: naam})
    return json.dumps({"d": {"results": [rec]}})


def _stored(spark, root, table="GrootboekRubriek"):
    from konform.plans.run import target_schema
    t = publish.read_tenants(spark, f"{root}/accounting/{table}", target_schema("accounting", table), "AdministratieCode")
    return sorted((r["AdministratieCode"], r["ID"][-2:]) for r in t.collect())


def test_nothing_is_lost_to_missing_or_broken_pages(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "loss")
    go = lambda *pages: run_source(spark, "accounting", _landed(spark, *pages), _work(spark, ["GrootboekRubriek"]), root, RUN_START)
    assert go(("1", 0, _rubriek(1), None), ("2", 0, _rubriek(2), None)).ok
    both = [(1, "01"), (2, "02")]
    assert _stored(spark, root) == both
    # tenant 2 lands nothing: it stays, and the watermark with it; an answered page without records is no failure
    r = go(("1", 0, _rubriek(1), None))
    assert not r.ok and r.watermark is None and "no page landed" in r.outcomes[0]["error"] and _stored(spark, root) == both
    assert go(("1", 0, _rubriek(1), None), ("2", 0, '{"d":{"results":[]}}', None)).ok and _stored(spark, root) == both
    # an error page, a body that is cut off, a page chain that stops short: the tenant stays, the watermark too
    for bad in ("<html>502</html>", _rubriek(3)[:-4], "", None):
        r = go(("1", 0, _rubriek(1), None), ("2", 0, bad, None))
        assert not r.ok and r.watermark is None and _stored(spark, root) == both
    r = go(("1", 0, _rubriek(1), None), ("2", 0, _rubriek(4), "next"))
    assert not r.ok and _stored(spark, root) == both
    # a page behind any number of blanks is read
    assert go(("1", 0, _rubriek(1), None), ("2", 0, " " * 200 + "\n" * 100 + _rubriek(5).replace('{"d":', '{"d":' + " " * 90), None)).ok
    assert _stored(spark, root) == [(1, "01"), (2, "05")]


def test_a_field_the_api_dropped_fails_the_strict_map(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "strict")
    body = _rubriek(1).replace('"ID"', '"Id2"')
    r = run_source(spark, "accounting", _landed(spark, ("1", 0, body, None)), _work(spark, ["GrootboekRubriek"]), root, RUN_START)
    assert not r.ok and "missing" in r.outcomes[0]["error"] and r.items.filter("tenant = 1 and not ok").count() == 1


def test_divisions_keep_the_operator_columns(spark, tmpdir_path):
    from konform.plans.run import stored_schema
    from konform.schemas import column_mapping, target_types
    import json
    root = os.path.join(tmpdir_path, "div")
    base = f"{root}/accounting/Divisions"
    names = [c for c, _ in target_types("accounting", "Divisions")]
    row = {c: None for c in stored_schema("accounting", "Divisions").names} | {"Division": 1, "Entiteit": "old", "Status": 2, "Volledige_sync": 1}
    publish.publish(spark, spark.createDataFrame([tuple(row[c] for c in stored_schema("accounting", "Divisions").names)],
                                                 stored_schema("accounting", "Divisions")), base)
    m = column_mapping("accounting", "Divisions") or [(c, c) for c in names]
    recs = [{s: (d if t == "Division" else "new" if t == "Entiteit" else None) for s, t in m} for d in (1, 2)]
    r = run_source(spark, "accounting", _landed(spark, ("1", 0, json.dumps({"d": {"results": recs}}), None), table="Divisions"),
                   spark.createDataFrame([(1, "Divisions", None, 2023)], "tenant long, table_name string, watermark string, reporting_year int"),
                   root, RUN_START)
    assert r.ok, r.outcomes
    got = sorted((x["Division"], x["Entiteit"], x["Status"], x["Volledige_sync"]) for x in publish.read_current(spark, base).collect())
    assert got == [(1, "new", 2, 1), (2, "new", 0, 0)]


def test_finish_run_writes_log_and_state(spark, tmpdir_path):
    from konform.plans.run import RunResult, finish_run
    log, state = os.path.join(tmpdir_path, "log"), os.path.join(tmpdir_path, "state")
    config = spark.createDataFrame([("K", "2024-01-01T00:00:00", 2022)], "klant string, watermark string, reporting_year int")
    for ok, want in ((True, ("2024-06-30T12:00:00", 2023)), (False, ("2024-01-01T00:00:00", 2022))):
        r = RunResult([{"table": "T", "ok": ok, "error": "broke"}])
        entries = log_entries(r, "K", 7, "Wijzigingen", None, klant_id=3, administration=(4, "A"), application="accounting")
        finish_run(spark, r, entries, log, config, ["klant"], RUN_START, "Wijzigingen", state)
        got = spark.read.parquet(state).first()
        assert (got["watermark"], got["reporting_year"]) == want
    rows_ = spark.read.parquet(log)
    assert rows_.count() == 2 and len(rows_.columns) == 11 and rows_.filter("KlantID = 3 and AdministratieID = 4 and TypeActie = 'ERROR'").count() == 1


def test_payroll_xml_run(spark, tmpdir_path):
    """XML forms go through the same run: unreadable reports are an error, the year is a constant."""
    from konform.schemas import column_mapping
    root = os.path.join(tmpdir_path, "payroll")
    fields = [s for s, t in column_mapping("payroll", "Bedrijven") if t != "Jaar"]
    item = "".join(f"<{f}>{'1' if 'ID' in f or 'Number' in f else 'x'}</{f}>" for f in fields)
    body = f"<Company_GetListResponse><Result><Company>{item}</Company></Result></Company_GetListResponse>"
    work = spark.createDataFrame([(1, "Bedrijven", None, 2023)], "tenant long, table_name string, watermark string, reporting_year int")
    go = lambda b: run_source(spark, "payroll", _landed(spark, ("1", 0, b, None), table="Bedrijven", source="payroll"), work, root, RUN_START,
                              payload="elements", path=["Result", "Company"])
    r = go(body)
    assert r.ok and r.outcomes[0]["rows"] == 1, r.outcomes
    assert not go(body[:-9]).ok
