"""A12, A13, B15, E5 and G4 on control tables written to a scratch folder."""

import datetime as dt
import os

from konform.plans import runs, sync
from konform.schemas import CATALOGUE_ENTRIES, TARGETS, WRITE_CONFIG
from konform.sources import control

from conftest import rows


def test_control_scans_with_equality_filters(spark, tmpdir_path):
    adm = os.path.join(tmpdir_path, "adm")
    spark.createDataFrame([(1, "100", 7, True), (2, "200", 7, False), (3, "300", 8, True)],
                          control.ADMINISTRATIE).write.parquet(adm)
    a = control.read_control(spark, adm, control.ADMINISTRATIE)
    assert rows(control.administrations_for(a, 7), "AdministratieID") == [(1,)]
    tab = spark.createDataFrame([(1, "exact", "Relaties", "crm/Accounts"), (2, "afas", "Relaties", "Demo_Relaties")],
                                control.TABELLEN)
    assert rows(control.tables_for_application(tab, "exact"), "TabelID") == [(1,)]
    assert rows(control.endpoint_for(control.tables_for_application(tab, "afas"), "Relaties")) == [
        ("Relaties", "Demo_Relaties")]
    m = spark.createDataFrame([(1, "a", "A", "int"), (2, "b", "B", None)], control.TABELLEN_MAPPING)
    assert rows(control.mapping_for_table(m, 2), "Bronkolom") == [("b",)]
    k = spark.createDataFrame([(1, 5, "Relaties", True), (1, 6, "Budget", False)], control.TABEL_ADMIN_KOPPELING)
    assert rows(control.links_for_administration(k, 1), "TabelNaam") == [("Relaties",)]


def test_control_map_last_wins(spark):
    cfg = spark.createDataFrame([("Laatste_sync", "2024-01-01T00:00:00", 1), ("Laatste_sync", "2024-02-01T00:00:00", 2),
                                 ("ReportingYear", "2023", 1)], "Config string, Waarde string, seq int")
    assert rows(control.control_map(cfg, ["Config"], "seq"), "Config", "Waarde") == [
        ("Laatste_sync", "2024-02-01T00:00:00"), ("ReportingYear", "2023")]


def test_catalogue_and_fixed_values():
    def count(source, mode):
        return sum(1 for e in CATALOGUE_ENTRIES if e.source == source and e.mode == mode)
    assert (count("accounting", "reset"), count("accounting", "regular"), count("accounting", "full")) == (19, 19, 5)
    assert (count("erp", "regular"), count("erp", "full")) == (20, 20)
    assert {s: len(t) for s, t in TARGETS.items()} == {"accounting": 20, "erp": 20, "payroll": 2}
    assert len(TARGETS["accounting"]["Artikelen"]) == 75 and len(WRITE_CONFIG) == 42


def test_catalogue_frame(spark):
    assert sync.catalogue(spark, "accounting", "full").count() == 5


def test_log_append(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "log")
    entry = {"KlantID": 1, "KlantNaam": "K", "Tabel": "Relaties", "DatumTijd": dt.datetime(2024, 1, 1),
             "Actie": "Relaties - done", "TypeActie": "INFO", "ScriptType": "Wijzigingen", "ScriptID": 3}
    runs.append_log(runs.log_rows(spark, [entry, dict(entry, Tabel="Budget")]), path)
    runs.append_log(runs.log_rows(spark, [dict(entry, ScriptID=4)]), path)
    log = spark.read.parquet(path)
    assert log.count() == 3 and runs.next_run_id(log).first()[0] == 5


def test_scratch_paths_use_the_sessions_checkpoint_dir(spark):
    from konform.session import checkpoint_dir, scratch_path
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured and checkpoint_dir(spark) == configured
    assert scratch_path(spark, "staging/x").startswith(configured.rstrip("/") + os.sep)
