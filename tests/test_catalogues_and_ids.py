"""Older catalogues, projection lists, run ids, the staged merge's statements and metadata-driven failures."""

import os

import duckdb

from konform.functions.predicates import projected
from konform.plans import publish, runs, sync
from konform.plans.metadata_run import metadata_work, run_metadata, table_schema
from konform.schemas import projection
from konform.sources import control

from conftest import rows


def test_older_catalogues(spark):
    n = lambda source, mode: sync.catalogue(spark, source, mode).count()
    assert [n("accounting_o", m) for m in ("reset", "regular", "full")] == [18, 18, 3]
    assert [n("erp_o", m) for m in ("regular", "full")] == [14, 1]
    lists = {r["table_name"]: (r["columns"], r["line_fields"]) for r in sync.catalogue(spark, "accounting", "regular").collect()}
    assert lists["ArtikelGroepen"][0] == [s for s, _ in [("ID", 0), ("Code", 0), ("Description", 0), ("Division", 0)]] and lists["ArtikelGroepen"][1] == []
    header, line_column, fields = projection("accounting", "VerkoopOrders")
    assert lists["VerkoopOrders"] == (header, fields) and line_column == "SalesOrderLines" and "LineNumber" in fields


def test_a_projection_reads_only_the_listed_leaves(spark, tmpdir_path):
    df = spark.createDataFrame([("1", "h", "w", ([("a", 1, "x"), ("b", 2, "y")],)), ("2", "h", "w", ([],)), ("3", "h", "w", None)],
                               "ID string, H string, Wide string, L struct<results: array<struct<ID: string, N: int, Wide: string>>>")
    df.write.parquet(f"{tmpdir_path}/nested")
    out = projected(spark.read.parquet(f"{tmpdir_path}/nested"), ["ID"], "L", ["ID", "N"])
    assert rows(out) == [("1", "a", 1), ("1", "b", 2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "struct<ID:string,L:struct<results:array<struct<ID:string,N:int>>>>" in plan.replace(" ", "") and "Wide" not in plan.split("ReadSchema")[1]


def test_run_ids_are_claimed_before_work_starts(spark, tmpdir_path):
    log = os.path.join(tmpdir_path, "log")
    assert [runs.claim_run_id(spark, log) for _ in range(3)] == [1, 2, 3]              # no log yet: concurrent runs still differ
    runs.append_log(runs.log_rows(spark, [{"ScriptID": 41}]), log)
    assert runs.claim_run_id(spark, log) == 42 and runs.claim_run_id(spark, log) == 43


class _Statements:
    def __init__(self, con):
        self.con = con

    def executeUpdate(self, sql):  # noqa: N802 - the JDBC name
        self.con.execute(sql)


def test_staged_merge_statements():
    """The generated SQL, run by DuckDB: change detection, preserved columns, null keys."""
    q = lambda c: f'"{c}"'

    def merged(staged, **kw):
        con = duckdb.connect()
        con.execute('CREATE TABLE T ("K" BIGINT, "V" VARCHAR, "Status" INTEGER)')
        con.execute("INSERT INTO T VALUES (1, 'a', 5), (2, 'b', 6), (NULL, 'n', 7)")
        con.execute('CREATE TABLE S ("K" BIGINT, "V" VARCHAR, "Status" INTEGER)')
        con.executemany("INSERT INTO S VALUES (?, ?, ?)", staged)
        publish._merge_staged(_Statements(con), "T", "S", ["K", "V", "Status"], ["K"], kw.get("changed_only", False), kw.get("preserved", {}), q)
        return sorted(con.execute("SELECT * FROM T").fetchall(), key=repr)

    staged = [(1, "a", 5), (2, None, 9), (3, "c", 1), (None, "m", 2)]
    whole = sorted([(1, "a", 5), (2, None, 9), (3, "c", 1), (None, "n", 7), (None, "m", 2)], key=repr)
    assert merged(staged) == whole and merged(staged, changed_only=True) == whole
    kept = sorted([(1, "a", 5), (2, None, 6), (3, "c", 0), (None, "n", 7), (None, "m", 0)], key=repr)
    assert merged(staged, preserved={"Status": 0}) == kept


def test_metadata_runs_report_what_is_not_configured(spark, tmpdir_path):
    adm = spark.createDataFrame([(1, "A", 10, True), (2, "B", 20, True)], control.ADMINISTRATIE)
    links = spark.createDataFrame([(1, 1, "Goed", True), (2, 2, "ZonderMapping", True), (2, 3, "Uit", False)], control.TABEL_ADMIN_KOPPELING)
    tables = spark.createDataFrame([(1, "fin", "Goed", "/g"), (2, "fin", "ZonderMapping", "/z"), (3, "fin", "Uit", "/u")], control.TABELLEN)
    maps = spark.createDataFrame([(1, "id", "ID", "int")], control.TABELLEN_MAPPING)
    pages = spark.createDataFrame([("1", "Goed", 0, '{"g":[{"id":"7","meer":"x"},{"id":"geen"}]}', None), ("2", "ZonderMapping", 0, '{"z":[{"id":1}]}', None)],
                                  "tenant string, table string, page_no long, body string, next_token string")
    work = metadata_work(adm, links, tables, "fin")
    assert rows(work, "customer", "table_name", "endpoint") == [("10", "Goed", "/g"), ("20", "ZonderMapping", "/z")]
    r = run_metadata(spark, pages, work, maps, {}, str(tmpdir_path), "2024-06-30 12:00:00")
    assert rows(r.items, "customer", "ok") == [("10", True), ("20", False)] and r.watermark is None
    assert rows(publish.read_current(spark, f"{tmpdir_path}/Goed"), "ID") == sorted([(7,), (None,)], key=repr)
    assert [f.simpleString() for f in table_schema([("a", "X", "int"), ("b", "X", "bit"), ("c", "Y", None)]).fields] == ["X:int", "Y:string"]
