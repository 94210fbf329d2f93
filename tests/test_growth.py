"""Work that must not grow faster than the input: what moves, how often, and what reaches the driver."""
from pyspark.sql.readwriter import DataFrameWriter

from konform.operators import flatten
from konform.sources import chains


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ forward fill
def interleaved(spark):
    # streams: one with a name, one without; header values differ, the lines of 20 spread over several buckets of 4
    data = [(t, s, f"H{t}{s}" if s in (0, 3, 20) else None, None if s in (0, 3, 20) else f"line {s}", "x" if s == 3 else None)
            for t in ("a", None) for s in [0, 1, 2, 3, 5, 6, 13, 14, 20, 21, 30]] + [("b", 2, None, "early", None), (None, None, None, "unplaced", None)]
    return spark.createDataFrame(data, "tenant string, seq long, ID string, line string, note string")


def test_forward_fill_moves_rows_once_and_equals_the_unbucketed_window(spark):
    def fill(rows):
        df = flatten.forward_fill_lines(interleaved(spark), "ID", ["ID", "note"], "seq", ["tenant"], bucket_rows=rows)
        return df, sorted((tuple(r) for r in df.collect()), key=repr)
    whole, small = fill(1 << 20), fill(4)
    assert whole[1] == small[1]
    assert ("a", 14, "Ha3", "line 14", "x") in small[1] and (None, 30, "HNone20", "line 30", None) in small[1]
    assert ("b", 2, None, "early", None) in small[1] and (None, None, None, "unplaced", None) in small[1]
    text = plan(small[0])
    # lines are exchanged once, and never joined back to their bucket's header
    assert "Join" not in text
    final = text.split("Initial Plan")[-1]
    assert final.count("REPARTITION_BY_COL") == 1


def test_fill_with_header_rows_landed_twice(spark):
    twice = interleaved(spark).union(interleaved(spark))
    got = flatten.forward_fill_lines(twice, "ID", ["ID", "note"], "seq", ["tenant"], bucket_rows=4).groupBy("tenant", "seq", "ID", "line", "note").count()
    assert {r["count"] for r in got.collect()} == {2} and got.count() == 18


# ------------------------------------------------------------------ chains of pages
def test_ranking_sends_no_pages_to_the_driver(spark, monkeypatch):
    plans = []
    write = DataFrameWriter.parquet

    def spy(self, *args, **kw):
        plans.append(plan(self._df))
        return write(self, *args, **kw)
    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    n = 9
    pages = spark.createDataFrame([(c, f"p{i}" if i else None, f"p{i + 1}" if i < n - 1 else "p1" if c == 1 else None, f"{c}{i}")
                                   for c in (0, 1, 2) for i in range(n) if (c, i) != (2, 4)], "chain long, own string, nxt string, body string")
    ranks = chains.ranked_pages(pages, ["chain"])
    got = {(r.chain, r.own): (r["last"], r["left"]) for r in ranks.collect()}
    assert all(got[0, f"p{i}" if i else ""] == ("p8", n - 1 - i) for i in range(n))
    assert all(v == (None, None) for (c, _), v in got.items() if c == 1)
    assert got[2, "p5"] == ("p8", 3) and got[2, "p3"] == (None, None) and got[2, ""] == (None, None)
    assert len(plans) > 3 and not any("Broadcast" in p for p in [*plans, plan(ranks)])
    # pages that are done are not dealt again: all of a finished chain point to one page
    assert all("Union" in p for p in plans[1:])
