"""Extractions that arrive over several batches are applied once and whole."""

import itertools
import json
import os

import pytest

from konform.plans import publish
from konform.schemas import column_mapping
from konform.streaming.landed_stream import UnreadablePage, held_pages, start_landed_sync, sync_batch

from conftest import rows

PAGES = "source string, tenant string, table string, page_no long, body string, next_token string, extraction string"
PLAN = "tenant long, delete_rule string, write_rule string, year int, window_start string"
FIELDS = ("ID", "Code", "Description")
ROW = ", ".join(f"{f} string" for f in FIELDS)


def body(*ids):
    names = [s for s, _ in column_mapping("accounting", "ArtikelGroepen") if s != "Division"]
    return json.dumps({"d": {"results": [{s: None for s in names} | {"ID": f"00000000-0000-0000-0000-{i:012d}", "Code": "c"} for i in ids]}})


def page(tenant, n, text, more, extraction=None):
    return ("accounting", tenant, "ArtikelGroepen", n, text, "next" if more else None, extraction)


def stored(spark, base):
    t = publish.read_current(spark, base)
    return [] if t is None else sorted((r["AdministratieCode"], int(r["ID"][-3:])) for r in t.collect())


def batches(spark, base, plan, *parts):
    out = []
    for k, part in enumerate(parts):
        sync_batch(spark, spark.createDataFrame(list(part), PAGES), k, base, "accounting", "ArtikelGroepen", ROW, plan=plan)
        out.append(stored(spark, base))
    return out


@pytest.fixture()
def plan(spark):
    return spark.createDataFrame([(1, "tenant", "append", None, None), (2, "tenant", "append", None, None)], PLAN)


def test_any_split_gives_the_table_of_one_batch(spark, tmpdir_path, plan):
    pages = [page("1", 0, body(1), True), page("1", 1, body(2, 3), True), page("1", 2, body(4), False)]
    want = [(1, 1), (1, 2), (1, 3), (1, 4)]
    splits = [[pages], [[p] for p in pages], [[p] for p in reversed(pages)], [pages[1:], pages[:1]], [[pages[0], pages[0]], pages[1:]]]
    for k, split in enumerate(splits):
        base = os.path.join(tmpdir_path, f"s{k}")
        after = batches(spark, base, plan, *split)
        assert after[-1] == want and all(a == [] for a in after[:-1]), split
        assert held_pages(spark, base).count() == 0


def test_the_next_extraction_replaces_the_last_and_others_stay(spark, tmpdir_path, plan):
    after = batches(spark, os.path.join(tmpdir_path, "t"), plan,
                    [page("1", 0, body(1), True), page("2", 0, body(9), False)], [page("1", 1, body(2), False)],
                    [page("1", 0, body(5), True)], [page("1", 1, body(6), False)])
    assert after == [[(2, 9)], [(1, 1), (1, 2), (2, 9)], [(1, 1), (1, 2), (2, 9)], [(1, 5), (1, 6), (2, 9)]]


def test_two_extractions_in_one_batch_are_applied_in_their_order(spark, tmpdir_path, plan):
    part = [page("1", 0, body(1), False, "a"), page("1", 0, body(2), True, "b"), page("1", 1, body(3), False, "b")]
    assert batches(spark, os.path.join(tmpdir_path, "two"), plan, part) == [[(1, 2), (1, 3)]]


def test_a_broken_page_changes_nothing_until_it_lands_again(spark, tmpdir_path, plan):
    base = os.path.join(tmpdir_path, "broken")
    after = batches(spark, base, plan, [page("1", 0, body(1), False)], [page("1", 0, body(2), True), page("1", 1, "<html>502", False)],
                    [page("2", 0, body(8), False)], [page("1", 1, body(3), False)])
    assert after == [[(1, 1)], [(1, 1)], [(1, 1), (2, 8)], [(1, 2), (1, 3), (2, 8)]]


def test_a_replay_finds_the_state_it_started_from(spark, tmpdir_path, plan):
    base = os.path.join(tmpdir_path, "replay")
    go = lambda k, *p: sync_batch(spark, spark.createDataFrame(list(p), PAGES), k, base, "accounting", "ArtikelGroepen", ROW, plan=plan)
    assert go(0, page("1", 0, body(1), True)) is None and go(0, page("1", 0, body(1), True)) is None
    assert go(1, page("1", 1, body(2), False)).endswith("v=00000001") and go(1, page("1", 1, body(2), False)) is None
    assert stored(spark, base) == [(1, 1), (1, 2)] and publish.versions(spark, base) == [1]


def test_pages_that_stand_alone_fail_when_unreadable(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "alone")
    with pytest.raises(UnreadablePage):
        batches(spark, base, None, [page("1", 0, body(1), False), page("1", 1, "<html>", False)])
    assert stored(spark, base) == []


def test_the_stream_itself_in_chain_form(spark, tmpdir_path, plan):
    landed, base = os.path.join(tmpdir_path, "landed"), os.path.join(tmpdir_path, "target")
    for k, p in enumerate(itertools.chain([page("1", 1, body(2), False)], [page("1", 0, body(1), True)])):
        spark.createDataFrame([p], PAGES).coalesce(1).write.parquet(f"{landed}/b{k}")
        start_landed_sync(spark, landed + "/*", base, "accounting", "ArtikelGroepen", ROW, os.path.join(tmpdir_path, "ckpt"), plan=plan).awaitTermination()
    assert stored(spark, base) == [(1, 1), (1, 2)]
    assert rows(held_pages(spark, base)) == []
