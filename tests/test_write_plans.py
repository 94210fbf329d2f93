"""W2-W19, E1-E9, G1-G7 on literal tables; versioned publish, JDBC and the stream."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from konform.functions.text import elapsed_hms, local_time, message_tail
from konform.operators import write
from konform.plans import publish, rules, runs, sync
from konform.schemas import write_config

from conftest import rows

T_SCHEMA = "k long, t int, v string, p double"


def test_delete_null_never_deletes(spark):
    df = spark.createDataFrame([(1, 1, "a", 1.0), (2, None, "b", 2.0), (3, 2, "c", 3.0)], T_SCHEMA)
    assert rows(write.delete_where(df, F.col("t") == 1), "k") == [(2,), (3,)]
    assert rows(write.delete_where(df, write.tenant_predicate("t", None)), "k") == []
    assert rows(write.delete_where(df, write.year_window_predicate("t", 2, "v", "c")), "k") == [(1,), (2,)]


def test_upsert_null_keys_and_duplicates(spark):
    tgt = spark.createDataFrame([(1, 1, "a", 1.0), (None, 1, "n", 0.0), (2, 1, "b", 2.0)], T_SCHEMA)
    src = spark.createDataFrame([(2, 1, "B", 9.0), (None, 1, "N", 0.0), (3, 1, "c", 3.0)], T_SCHEMA)
    out = write.upsert(tgt, src, ["k"])
    assert rows(out, "k", "v") == sorted([(1, "a"), (None, "n"), (2, "B"), (None, "N"), (3, "c")], key=repr)
    dup = spark.createDataFrame([(1, 1, "x", 1.0), (1, 1, "y", 1.0)], T_SCHEMA)
    with pytest.raises(write.WriteError):
        write.upsert(tgt, dup, ["k"], check_duplicates=True)
    assert write.upsert_keys(["k"], "t") == ["k", "t"] and write.upsert_keys(["k", "t"], "t") == ["k", "t"]


def test_upsert_changed_actions(spark):
    tgt = spark.createDataFrame([(1, 1, None, 1.0), (2, 1, "b", 2.0), (4, 1, "d", 4.0)], T_SCHEMA)
    src = spark.createDataFrame([(1, 1, "", 1.0), (2, 1, "b", 2.5), (3, 1, "c", 3.0)], T_SCHEMA)
    out = write.upsert_changed(tgt, src, ["k"])
    assert rows(out, "k", "action", "p") == [(1, "unchanged", 1.0), (2, "update", 2.5),
                                             (3, "insert", 3.0), (4, "keep", 4.0)]


def test_upsert_preserving_and_new_keys(spark):
    tgt = spark.createDataFrame([(1, "a", 5, 1), (2, "b", 6, 0)], "d long, n string, Status int, Volledige_sync int")
    src = spark.createDataFrame([(1, "A"), (3, "C")], "d long, n string")
    out = write.upsert_preserving(tgt, src, ["d"], {"Status": 0, "Volledige_sync": 0})
    assert rows(out) == [(1, "A", 5, 1), (2, "b", 6, 0), (3, "C", 0, 0)]
    assert rows(write.new_keys(tgt, src, ["d"])) == [(3,)]


def test_append_replace_validate_counts(spark):
    tgt = spark.createDataFrame([(1, 1, "a", 1.0), (2, 3, "b", 2.0)], T_SCHEMA)
    src = spark.createDataFrame([(2, 1, "B", 2.0), (5, 1, "e", 5.0)], T_SCHEMA)
    assert write.append(tgt, src).count() == 4
    assert rows(write.replace_all(tgt, src), "k") == [(2,), (5,)]
    with pytest.raises(write.WriteError):
        write.validate_write(src, "bad name;", ["k"])
    with pytest.raises(write.WriteError):
        write.validate_write(src, "ok", ["zz"])
    assert write.validate_write(src, "ok", ["k"]) is True
    assert write.validate_write(src.limit(0), "ok", ["k"]) is False
    c = write.write_counts(tgt, src, ["k"], F.col("t") == 3).first()
    assert (c.deleted, c.updated, c.inserted, c.written, c.result_rows) == (1, 0, 2, 2, 3)


def test_publish_versions_and_idempotence(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "tbl")
    df = spark.createDataFrame([(1, "a")], "k long, t string")
    p1 = publish.publish(spark, df, base, tenant_column="t")
    p2 = publish.publish(spark, df.union(df), base)
    assert publish.versions(spark, base) == [1, 2] and p2.endswith("v=00000002")
    assert publish.read_current(spark, base).count() == 2
    assert publish.publish(spark, df, base, version=2) == p2 and publish.read_current(spark, base).count() == 2
    assert p1.endswith("v=00000001")


def test_jdbc_sink_in_memory_derby(spark):
    url = "jdbc:derby:memory:konform_test;create=true"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "K BIGINT, V STRING")
    publish.to_jdbc(df, url, "SYNC_T", mode="overwrite", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    back = (spark.read.format("jdbc").option("url", url).option("dbtable", "SYNC_T")
            .option("driver", "org.apache.derby.jdbc.EmbeddedDriver").load())
    assert rows(back) == [(1, "a"), (2, "b")]


def test_jdbc_staged_upsert(spark):
    url = "jdbc:derby:memory:konform_staged;create=true"
    driver = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    publish.to_jdbc(spark.createDataFrame([(1, "a"), (2, "b")], "K BIGINT, V STRING"), url, "T", "overwrite", driver)
    new = spark.createDataFrame([(2, "B"), (3, "c")], "K BIGINT, V STRING")
    read = lambda: rows(spark.read.format("jdbc").option("url", url).option("dbtable", "T").options(**driver).load())
    assert publish.to_jdbc_staged(spark, new, url, "T", keys=["K"], properties=driver) == 2
    assert read() == [(1, "a"), (2, "B"), (3, "c")]
    # a failure after staging leaves the target as it was
    with pytest.raises(Exception):
        publish.to_jdbc_staged(spark, new.withColumnRenamed("V", "W"), url, "T", keys=["K"], properties=driver)
    assert read() == [(1, "a"), (2, "B"), (3, "c")]


def test_sync_modes_and_windows(spark):
    as_of = F.lit("2024-06-30 12:00:00").cast("timestamp_ntz")
    df = spark.createDataFrame([("2023-01-01T00:00:00", "Wijzigingen"), (None, "Wijzigingen"),
                                ("2022-06-30T13:00:00", "Wijzigingen"), ("2022-06-29T11:00:00", "Wijzigingen"),
                                ("2024-01-01T00:00:00", "Volledig")], "wm string, run string")
    got = [tuple(r) for r in df.select(sync.sync_mode("wm", as_of, "run", 2.0),
                                       sync.sync_mode("wm", as_of, "run", 1.2),
                                       sync.erp_sync_mode("run")).collect()]
    assert got == [("regular", "reset", "regular"), ("reset", "reset", "regular"),
                   ("regular", "reset", "regular"), ("reset", "reset", "regular"), ("full", "full", "full")]
    d = spark.createDataFrame([(dt.date(2024, 12, 31),), (dt.date(2023, 3, 1),)], "d date")
    got = [tuple(r) for r in d.select(sync.full_window_start(F.col("d")),
                                      sync.full_window_start(F.col("d"), "erp_old")).collect()]
    assert got == [(dt.date(2024, 1, 1), dt.date(2023, 1, 1)), (dt.date(2022, 1, 1), dt.date(2022, 1, 1))]


def test_last_wins_override_resolve(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")], "k string, s int, v string")
    assert rows(sync.last_wins(df, ["k"], "s")) == [("a", 3, "z"), ("b", 1, "q")]
    t = spark.createDataFrame([(1, "2024-01-01T00:00:00", 2023), (0, "2024-01-01T00:00:00", 2023)],
                              "f int, wm string, ry int")
    assert rows(sync.full_resync_override(t, "f", "wm", "ry")) == [
        (0, "2024-01-01T00:00:00", 2023), (1, "2000-01-01T00:00:00", 2000)]
    members = spark.createDataFrame([("db1", 0, ["x", "y"]), ("db2", 1, ["y", "z"])],
                                    "database string, db_pos int, customers array<string>")
    names = spark.createDataFrame([("x",), ("y",), ("z",), ("w",)], "klant string")
    assert rows(sync.resolve_database(members, names)) == [("w", None), ("x", "db1"), ("y", "db1"), ("z", "db2")]


def test_work_list_gates(spark):
    k = spark.createDataFrame([("K1", 1, "accounting"), ("K2", 2, "accounting")], "klant string, klant_type int, application string")
    t = spark.createDataFrame([("K1", 10, 1), ("K1", 11, 0), ("K2", 12, 1)], "klant string, tenant int, status int")
    s = spark.createDataFrame([("Budget", 1), ("Relaties", 0)], "table_name string, status int")
    out = sync.work_list(k, t, s, "accounting", "regular")
    assert rows(out, "klant", "tenant", "table_name") == [("K1", 10, "Budget")]


def test_write_rules_truth_table(spark):
    cases = [("accounting", "full", "VerkoopOrders", "none", None, True, "date_window", "append"),
             ("accounting", "full", "GrootboekMutaties", "none", 0.1, True, "year_window", "append"),
             ("accounting", "full", "Budget", "none", 0.1, True, "none", "none"),
             ("accounting", "other", "Divisions", "none", 5.0, True, "none", "upsert_preserving"),
             ("accounting", "other", "Relaties", "none", 2.5, True, "tenant", "append"),
             ("accounting", "other", "GrootboekRubriek", "truncate", 0.1, True, "tenant", "append"),
             ("accounting", "other", "ReportingBalance", "reporting_year", 0.1, True, "year_window", "append"),
             ("accounting", "other", "Relaties", "none", 0.1, True, "none", "upsert"),
             ("accounting", "other", "Relaties", "none", None, True, "none", "append"),
             ("erp", "full", "Budget", "truncate", 0.1, True, "tenant", "append"),
             ("erp", "other", "Forecasts", "none", 1.5, True, "tenant", "append"),
             ("erp", "other", "Forecasts", "none", 0.1, True, "none", "upsert_tenant"),
             ("erp", "other", "Verlof", "none", 0.1, False, "none", "append"),
             ("payroll", "other", "Bedrijven", "truncate", 0.1, True, "all", "append"),
             ("payroll", "other", "Looncomponenten", "truncate", 0.1, True, "company_year", "append"),
             ("metadata", "other", "X", "none", None, True, "none", "upsert_changed"),
             ("metadata", "other", "X", "none", None, False, "all", "replace")]
    df = spark.createDataFrame(cases, "source string, run_mode string, table_name string, table_mode string, "
                                      "age_years double, has_keys boolean, exp_delete string, exp_write string")
    bad = rules.choose_rule(df).filter("delete_rule <> exp_delete OR write_rule <> exp_write").collect()
    assert bad == []
    assert write_config("payroll", "Looncomponenten").extra_tenant_columns == ("Jaar",)
    assert rules.write_configs(spark).count() == 42


def test_runs_and_text(spark):
    res = spark.createDataFrame([("c1", True, "2024-01-01T00:00:00"), ("c1", False, "2024-01-02T00:00:00"),
                                 ("c2", True, "2024-01-03T00:00:00")], "k string, ok boolean, wm string")
    adv = {r["k"]: r["new_watermark"] for r in
           runs.advance_watermark(res, ["k"], "ok", "2024-06-30 12:00:00", "Wijzigingen", "wm").collect()}
    assert adv == {"c1": "2024-01-02T00:00:00", "c2": "2024-06-30T12:00:00"}
    empty = spark.createDataFrame([], "ScriptID int")
    assert runs.next_run_id(empty).first()[0] == 1
    log = runs.log_rows(spark, [{"KlantID": 1, "Actie": "start", "ScriptID": 7}])
    assert log.count() == 1 and len(log.columns) == 11
    m = spark.createDataFrame([("Run - table X - done-ok", 3725, dt.datetime(2024, 7, 1, 10, 0))],
                              "m string, s long, ts timestamp_ntz")
    r = m.select(message_tail(F.col("m")), message_tail(F.col("m"), "-"), elapsed_hms(F.col("s")),
                 local_time(F.col("ts"))).first()
    assert tuple(r) == ("done-ok", "ok", "01:02:05", dt.datetime(2024, 7, 1, 12, 0))


def test_publish_with_observed_counts(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "obs")
    tgt = spark.createDataFrame([(1, 1, "a", 1.0), (2, 1, "b", 2.0)], T_SCHEMA)
    src = spark.createDataFrame([(2, 1, "b", 2.5), (3, 1, "c", 3.0)], T_SCHEMA)
    path, counts = publish.publish_with_counts(spark, write.upsert_changed(tgt, src, ["k"]), base,
                                               action_col="action")
    assert counts == {"rows": 3, "insert": 1, "update": 1, "unchanged": 0, "keep": 1}
    assert publish.read_current(spark, base).columns == ["k", "t", "v", "p"]


def test_sync_tenant_partitions_in_place(spark, tmpdir_path):
    from pyspark.sql import types as T

    from konform.plans.table_sync import sync_tenant_partitions
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.IntegerType()),
                           T.StructField("v", T.StringType()), T.StructField("p", T.DoubleType())])
    path = os.path.join(tmpdir_path, "parted")
    spark.createDataFrame([(1, 1, "a", 1.0), (2, 2, "b", 2.0), (3, 3, "c", 3.0), (4, 3, "d", 4.0)], schema) \
        .write.partitionBy("t").parquet(path)
    untouched = sorted(os.listdir(os.path.join(path, "t=2")))
    src = spark.createDataFrame([(1, 1, "A", 9.0), (5, 1, "e", 5.0)], schema)
    plan = spark.createDataFrame([(1, "none", "upsert", None, None), (3, "tenant", "append", None, None)],
                                 "tenant int, delete_rule string, write_rule string, year int, window_start string")
    before3 = sorted(os.listdir(os.path.join(path, "t=3")))
    counts = sync_tenant_partitions(spark, path, src, plan, ["k"], "t", schema)
    assert counts == {"rows": 2}
    out = spark.read.schema(schema).parquet(path)
    # tenant 3 is planned for a delete, but nothing arrived for it: it stays
    assert rows(out, "k", "t", "v") == [(1, 1, "A"), (2, 2, "b"), (3, 3, "c"), (4, 3, "d"), (5, 1, "e")]
    assert sorted(os.listdir(os.path.join(path, "t=2"))) == untouched      # tenant 2 never rewritten
    assert sorted(os.listdir(os.path.join(path, "t=3"))) == before3
    assert not [n for n in os.listdir(path) if n.startswith("_pending")] and not os.listdir(os.path.join(path, "_staging"))


def test_interrupted_commit_is_finished_before_the_next_read(spark, tmpdir_path):
    from konform.plans import publish as pub
    path = os.path.join(tmpdir_path, "redo")
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "k long, t int")
    df.write.partitionBy("t").parquet(path)
    # a commit that was cut off after its marker: the slice is whole, the table still old
    spark.createDataFrame([(1,), (3,)], "t int").write.parquet(f"{path}/_pending/touched")
    spark.createDataFrame([(9, 1)], "k long, t int").write.parquet(f"{path}/_pending/rows")
    for _ in range(2):
        assert rows(pub.read_tenants(spark, path, df.schema, "t"), "k", "t") == [(2, 2), (9, 1)]
    # one that was cut off before its marker never happened
    spark.createDataFrame([(1,)], "t int").write.parquet(f"{path}/_pending/touched")
    assert rows(pub.read_tenants(spark, path, df.schema, "t"), "k", "t") == [(2, 2), (9, 1)]


def _sync(spark, tgt, src, plan, keys=("k",), **kw):
    from konform.plans.table_sync import sync_tenants
    schema = "k long, t int, v string"
    p = spark.createDataFrame(plan, "tenant int, delete_rule string, write_rule string, year int, window_start string")
    return rows(sync_tenants(spark.createDataFrame(tgt, schema), spark.createDataFrame(src, schema), p, list(keys), "t", **kw), "k", "t", "v")


def test_sync_tenants_changes_only_planned_tenants_with_rows(spark):
    tgt = [(1, 1, "a"), (2, 2, "b"), (3, 3, "c"), (4, None, "n")]
    plan = [(1, "tenant", "append", None, None), (2, "tenant", "append", None, None)]
    # 2: nothing arrived; 3 and 9: not planned; null tenant: never matches
    assert _sync(spark, tgt, [(7, 1, "x"), (8, 9, "y"), (8, 3, "z"), (5, None, "m")], plan) == \
        sorted([(7, 1, "x"), (2, 2, "b"), (3, 3, "c"), (4, None, "n")], key=repr)
    assert _sync(spark, tgt, [(7, 1, "x")], [(1, "none", "none", None, None)]) == sorted(tgt, key=repr)
    assert _sync(spark, tgt, [(7, 1, "x")], [(1, "tenant", "append", None, None)], keys=()) == \
        sorted([(7, 1, "x"), (2, 2, "b"), (3, 3, "c"), (4, None, "n")], key=repr)


@pytest.mark.parametrize("src,plan,keys,text", [
    ([(1, 1, "x"), (1, 1, "y")], [(1, "none", "upsert", None, None)], ("k",), "duplicate source keys"),
    ([(1, 1, "x")], [(1, "none", "append", None, None), (1, "none", "append", None, None)], ("k",), "more than one plan row"),
    ([(1, 1, "x")], [(1, "none", "merge", None, None)], ("k",), "unknown write rule"),
    ([(1, 1, "x")], [(1, "gone", "append", None, None)], ("k",), "unknown delete rule"),
    ([(1, 1, "x")], [(1, "none", "upsert", None, None)], (), "upsert without keys"),
])
def test_sync_tenants_fails_rather_than_guesses(spark, src, plan, keys, text):
    with pytest.raises(Exception, match=text):
        _sync(spark, [(1, 1, "a")], src, plan, keys)


def test_upsert_duplicate_and_partial_sources(spark):
    tgt = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k long, v string, p double")
    part = spark.createDataFrame([(2, 9.0), (3, 8.0)], "k long, p double")
    assert rows(write.upsert(tgt, part, ["k"])) == sorted([(1, "a", 1.0), (2, "b", 9.0), (3, None, 8.0)], key=repr)
    assert rows(write.upsert_changed(tgt, part, ["k"], with_action=False)) == sorted([(1, "a", 1.0), (2, "b", 9.0), (3, None, 8.0)], key=repr)
    twice = spark.createDataFrame([(2, "x", 9.0), (2, "y", 8.0)], tgt.schema)
    with pytest.raises(Exception, match="duplicate source keys"):
        write.upsert(tgt, twice, ["k"]).collect()
    nulls = spark.createDataFrame([(None, "x", 9.0), (None, "y", 8.0)], tgt.schema)      # null keys never match
    assert write.upsert(tgt, nulls, ["k"]).count() == 4


def test_erp_deletes_by_environment(spark):
    from konform.plans.table_sync import Step, apply_step
    tgt = spark.createDataFrame([(1, 10, "p", None), (2, 10, "p", None), (1, 11, "q", None)],
                                "OmgevingID long, Administratie_Code long, ProjectID string, Verkoopprijs decimal(38,10)")
    out = apply_step(tgt, tgt.limit(0), Step("erp", "Tarieven", delete_rule="tenant", write_rule="append", tenant=1))
    assert rows(out, "OmgevingID", "Administratie_Code") == [(2, 10)]


def test_sync_tenants_company_year_and_all(spark):
    from konform.plans.table_sync import sync_tenants
    tgt = spark.createDataFrame([(1, 10, 2024, 1.0), (2, 10, 2025, 2.0), (3, 11, 2025, 3.0), (4, 12, 2025, 4.0)],
                                "k long, BedrijfID long, Jaar int, v double")
    src = spark.createDataFrame([(5, 10, 2025, 5.0), (6, 11, 2024, 6.0)], "k long, BedrijfID long, Jaar int, v double")
    plan = spark.createDataFrame([(10, "company_year", "append", 2025, None), (11, "all", "append", None, None)],
                                 "tenant long, delete_rule string, write_rule string, year int, window_start string")
    out = sync_tenants(tgt, src, plan, ["k"], "BedrijfID", year_col="Jaar")
    # company 10: only its 2025 rows go; company 11: all its rows go; company 12 has no plan row: kept
    assert rows(out, "k") == [(1,), (4,), (5,), (6,)]


def test_untouched_tenants_are_pruned_from_the_scan(spark, tmpdir_path):
    """The touched tenants prune the target's partitions at run time: other tenants' files are not read."""
    from pyspark.sql import types as T
    path, staged = os.path.join(tmpdir_path, "pruned"), os.path.join(tmpdir_path, "staged")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.IntegerType())])
    spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 8).cast("int").alias("t")).write.partitionBy("t").parquet(path)
    spark.createDataFrame([(1, 3), (2, 3)], schema).write.parquet(staged)
    src = spark.read.parquet(staged)
    touched = src.groupBy("t").count().filter("count > 0").select("t")
    target = publish.read_tenants(spark, path, schema, "t").join(touched, "t", "left_semi")
    assert target.count() == 50
    assert "dynamicpruning" in target._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def plain_plans(spark):
    """Plans as planned: no broadcasts, nothing re-planned while it runs."""
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    was = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upserts_shuffle_each_side_once(spark, plain_plans):
    k = F.nullif(F.col("id"), F.lit(-1)).alias("k")                              # a key that may be null
    tgt, src = spark.range(20).select(k, F.lit("a").alias("v")), spark.range(10, 30).select(k, F.lit("b").alias("v"))
    for out in (write.upsert(tgt, src, ["k"]), write.upsert_changed(tgt, src, ["k"]), write.upsert_preserving(tgt, src, ["k"], {"v": "x"})):
        assert _plan(out).count("Exchange hashpartitioning") == 2, _plan(out)
        assert out.count() == 30


ODD_TEXTS = ["", " ", "a", "\x01", "\x02", "a\x01b", "x\x02", "\n", "é€", None]
ODD_KEYS = ["0a1b2c3d-0000-1111-2222-333344445555", "0A1B2C3D-0000-1111-2222-333344445555", "0a1b2c3d-0000-1111-2222-333344445555\n",
            "0a1b2c3d00001111222233334444555", "abcd----", "", "sixteen letters.", "\x00" * 16, "é", None]


def _wide(spark, rows_, shift):
    """Rows of all kinds of columns; texts, numbers and dates at their odd ends."""
    df = spark.createDataFrame([(k, i + shift, ODD_TEXTS[(i + shift) % len(ODD_TEXTS)]) for i, k in rows_], "k string, i int, s string")
    i = F.col("i")
    bad = F.when(i % 4 == 0, F.unhex(F.lit("61C328")).cast("string")).when(i % 4 == 1, F.unhex(F.lit("C3")).cast("string")).otherwise(F.lit("ok"))
    small = F.when(i % 5 == 0, F.expr("CAST('0.0000000001' AS DECIMAL(38,10))")).when(i % 5 == 1, F.expr("CAST(0 AS DECIMAL(38,10))")).when(
        i % 5 == 2, F.expr("CAST('-1234567890123456789012345678.0987654320' AS DECIMAL(38,10))")).when(i % 5 == 3, (i * 100).cast("decimal(38,10)"))
    return df.select(
        "k", F.when(i % 6 != 0, F.lit(7)).cast("bigint").alias("tenant"), "i", *[F.col("s").alias(f"s{n}") for n in range(3)], F.coalesce("s", F.lit("-")).alias("s3"),
        F.when(i % 3 == 0, bad).alias("bad"), F.lit(None).cast("string").alias("nothing"), small.alias("dec"), (i * 100).cast("decimal(9,0)").alias("whole"),
        F.expr("CAST('1E-10' AS DECIMAL(38,20))").alias("tiny"), (i % 2 == 0).alias("even"), i.cast("tinyint").alias("tiny_int"),
        F.when(i % 2 == 0, F.date_sub(F.lit("1900-01-01").cast("date"), i * 400)).alias("day"), (i / 3).alias("double"), F.array(i, i + 1).alias("list"),
        F.lit("2024-03-31 02:30:00").cast("timestamp_ntz").alias("at"))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_wide_upsert_moves_compact_rows_and_returns_every_value(spark, monkeypatch, ansi):
    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        tgt = _wide(spark, [*enumerate(ODD_KEYS * 2)], 0)                       # a key may repeat in the target
        src = _wide(spark, [*enumerate(ODD_KEYS[3:] + ["new", None])], 5)
        keys = ["k", "tenant"]

        def seen(out):
            assert out.columns == tgt.columns and out.dtypes == tgt.dtypes
            texts = [F.hex(F.col(c).cast("binary")).alias(c) if t == "string" else F.col(c) for c, t in out.dtypes]
            return sorted((tuple(r) for r in out.select(*texts).collect()), key=repr)

        out = write.upsert(tgt, src, keys)
        assert "_packed" in _plan(out)
        got = seen(out)
        monkeypatch.setattr(write, "PACK_FROM", 1000)
        plain = write.upsert(tgt, src, keys)
        assert "_packed" not in _plan(plain) and got == seen(plain) and len(got) > 20
        monkeypatch.undo()
        with pytest.raises(Exception, match="duplicate source keys"):
            write.upsert(tgt, src.unionByName(src.filter("tenant is not null and k is not null").limit(1)), keys).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)


def test_wide_upsert_of_a_partial_source_keeps_the_other_columns(spark):
    tgt = _wide(spark, [(1, "a"), (2, "b")], 0)
    src = _wide(spark, [(2, "b"), (3, "c")], 5).drop("s0", "dec")
    got = {r["k"]: r for r in write.upsert(tgt, src, ["k"]).collect()}
    assert got["b"]["i"] == 7 and got["b"]["s0"] == "a" and got["c"]["s0"] is None and len(got) == 3


def test_orders_sync_moves_columns_of_lines_once_and_compact_rows(spark, plain_plans):
    from conftest import SF_SMALL

    from konform.catalogue import QUERIES

    lines = _plan(QUERIES["orders_sync"](spark, SF_SMALL)).split("\n")
    dealt = [k for k, line in enumerate(lines) if "REPARTITION_BY_COL" in line]
    assert sorted("ReusedExchange" in lines[k] for k in dealt) == [False, True]      # one shuffle of lines for both versions
    assert not any("md5" in line for line in lines[dealt[0]:dealt[0] + 4])          # of the table's columns
    wide = [k for k, line in enumerate(lines) if "Exchange hashpartitioning(OR_OrderRegelID" in line]
    assert len(wide) == 2 and all("AS _packed#" in "".join(lines[k:k + 4]) for k in wide)
