"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic).  Raking scales the cells
in turn so that each marginal meets its target share, source by source, language by language, topic by topic.
Rounds go on until no factor is further from 1 than ``TOLERANCE``, or until they stop getting closer: then
some targets contradict each other (a value that only occurs with one other value has that value's margin too),
and ``margins`` reports what was reached.

A document is drawn with the probability ``min(1, rate * multiplier)`` of its cell, where the multiplier is weight / tokens and
the rate makes the expected tokens drawn the share ``keep`` of all: cells that reach 1 are kept whole, and the
others give what is missing.  So a rare value beside a large corpus changes its own cells only.  The draw
compares the probability with a hash of the id, so it is repeatable.

DataFrame functions only.  Texts are read for the cell sums and for the draw; the cells are a table in the
shared folder, written anew each round: partial sums per value, joined back; no task holds all cells, however many
values a margin has.

Topic: the first marker of ``TOPICS`` that a text contains, else ``prose``
(callers may pass any column expression).

Defined results: null source, language or topic values form cells of their own
(shown as ``none``); a null or empty text has no tokens and the topic ``empty``;
documents in cells without tokens, or with a target of 0, are not drawn; a
target for a value that does not occur is left out and the others rescaled;
rows that share an id are drawn by the same number; an empty table gives no
rows; other columns are kept by ``mix`` and ignored by ``probabilities``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path

MARGINS = ("source", "lang", "topic")
#: marker text -> topic
TOPICS = (("@", "contact"), ("://", "link"), ("password", "secret"), ("AKIA", "secret"), ("icense", "licence"))
DRAW_BITS = 52
KEEP = 0.5                     # share of the tokens to draw
ROUNDS = 30                    # at most
TOLERANCE = 1e-6               # furthest factor from 1 in the last round
STALLED = 0.95                 # a round that leaves more than this share of the last round's change ends the raking
#: target share of a value: its token share to this power
POWERS = {"source": 0.7, "lang": 0.8, "topic": 0.9}


def topic_of(text: Column) -> Column:
    out = F.when(text.isNull() | (text == ""), F.lit("empty"))
    for mark, name in TOPICS:
        out = out.when(F.contains(text, F.lit(mark)), F.lit(name))
    return out.otherwise(F.lit("prose"))


def tokens_of(text: Column) -> Column:
    """Tokens between blanks."""
    return F.when(text.isNull() | (text == ""), F.lit(0)).otherwise(
        F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("long")


def with_cells(docs: DataFrame, text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
               topic: Column | None = None) -> DataFrame:
    """``docs`` with the cell columns ``_source _lang _topic`` and ``_tokens``."""
    text = F.col(text_col)
    name = lambda c: F.coalesce(c.cast("string"), F.lit("none"))
    return docs.withColumns({"_source": name(F.col(source_col)), "_lang": name(F.col(lang_col)),
                             "_topic": name(topic if topic is not None else topic_of(text)), "_tokens": tokens_of(text)})


def _targets(cells: DataFrame, power: dict[str, float], targets: dict[str, dict[str, float]]) -> dict[str, DataFrame]:
    """For each margin: value, target (in tokens, together those of all cells)."""
    out = {}
    for m in MARGINS:
        sums = cells.groupBy(f"_{m}").agg(F.sum("tokens").alias("_n"))
        if m in targets:
            pairs = [F.lit(v) for kv in targets[m].items() for v in kv]
            want = F.coalesce(F.create_map(*pairs)[F.col(f"_{m}")], F.lit(0.0)) if pairs else F.lit(0.0)
        else:
            want = F.pow(F.col("_n").cast("double"), F.lit(power[m]))
        out[m] = sums.withColumn("_want", want)
    return out


def rake(cells: DataFrame, power: dict[str, float] | None = None, targets: dict[str, dict[str, float]] | None = None,
         rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (_source, _lang, _topic, tokens) with ``weight``, the raked tokens of the cell.

    A margin's target shares are those given, or its token shares raised to ``power`` (below 1: rare values
    gain).  Cells without tokens or with a target of 0 are left out."""
    spark = cells.sparkSession
    base = scratch_path(spark, f"raking-{uuid.uuid4().hex}")
    kept, (power, targets) = cells.filter("tokens > 0"), (POWERS | (power or {}), targets or {})
    # values with a target of 0 go, and with them what else only they held
    for m, want in _targets(kept, power, targets).items():
        if m in targets:
            kept = kept.join(want.filter("_want > 0").select(f"_{m}"), f"_{m}", "left_semi")
    kept.write.parquet(f"{base}/cells")
    kept = spark.read.parquet(f"{base}/cells")
    total = kept.agg(F.sum("tokens")).first()[0]
    out = kept.withColumn("weight", F.col("tokens").cast("double"))
    for m, want in _targets(kept, power, targets).items():
        whole = want.agg(F.sum("_want")).first()[0]
        out = out.join(want.select(f"_{m}", (F.col("_want") / F.lit(whole) * F.lit(float(total or 0))).alias(f"_t_{m}")), f"_{m}")
    out.write.parquet(f"{base}/0")
    names, last = [*[f"_{m}" for m in MARGINS], "tokens", "weight", *[f"_t_{m}" for m in MARGINS]], None
    done = 0
    for r in range(1, rounds + 1 if total else 1):
        now = spark.read.parquet(f"{base}/{r - 1}").select(*names, F.lit(0.0).alias("_change"))
        for m in MARGINS:
            # a partial sum per value, sent back to its cells
            sums = now.groupBy(f"_{m}").agg(F.sum("weight").alias("_w"))
            factor = F.col(f"_t_{m}") / F.col("_w")
            now = now.join(sums, f"_{m}").select(*[c for c in names if c != "weight"], (F.col("weight") * factor).alias("weight"),
                                                 F.greatest("_change", F.abs(factor - 1)).alias("_change"))
        seen = Observation(f"raking {r}")
        now.observe(seen, F.max("_change").alias("change")).write.parquet(f"{base}/{r}")
        change, done = seen.get["change"], r
        if change <= TOLERANCE or (last is not None and change > STALLED * last):
            break
        last = change
    return spark.read.parquet(f"{base}/{done}").select(*[f"_{m}" for m in MARGINS], "tokens", "weight")


def solve_rate(cells: DataFrame, keep: float) -> float:
    """The rate at which the expected tokens drawn are ``keep`` of all tokens.

    Starts below it and rises: cells at 1 are counted whole and the rate of the others is what is missing, until no more cells
    reach 1.  One aggregate over the cells per step."""
    m = F.col("weight") / F.col("tokens")
    goal = keep * float(cells.agg(F.sum("tokens")).first()[0] or 0)
    rate = 0.0
    while True:
        full = m * F.lit(rate) >= 1
        c, w = cells.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not w:
            return rate
        now = (goal - float(c)) / w
        if now <= rate * (1 + 1e-12):
            return rate
        rate = now


def margins(cells: DataFrame, power: dict[str, float] | None = None, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """margin, value, target and reached share of the raked ``cells`` (from ``rake``): which margins were met."""
    power, targets, out = POWERS | (power or {}), targets or {}, None
    for m, want in _targets(cells, power, targets).items():
        whole = want.agg(F.sum("_want").alias("_s"))
        got = cells.groupBy(f"_{m}").agg(F.sum("weight").alias("_w"))
        total = cells.agg(F.sum("weight").alias("_ws"))
        rows = (want.join(got, f"_{m}").join(F.broadcast(whole)).join(F.broadcast(total))          # one row each
                .select(F.lit(m).alias("margin"), F.col(f"_{m}").alias("value"), (F.col("_want") / F.col("_s")).alias("target"),
                        (F.col("_w") / F.col("_ws")).alias("reached")))
        out = rows if out is None else out.unionByName(rows)
    return out


def draw_number(id_col: Column) -> Column:
    """A number in [0, 1) from the id."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("double") / float(1 << DRAW_BITS)


def mix(docs: DataFrame, id_col: str = "doc_id", rate: float | None = None, keep: float = KEEP, text_col: str = "text",
        source_col: str = "source", lang_col: str = "lang", topic: Column | None = None, **raking) -> DataFrame:
    """``docs`` with ``_source _lang _topic _tokens _probability _drawn``; the rate is solved for ``keep`` unless given."""
    spark = docs.sparkSession
    base = scratch_path(spark, f"mixing-{uuid.uuid4().hex}")
    marked = with_cells(docs, text_col, source_col, lang_col, topic)
    keys = [f"_{m}" for m in MARGINS]
    marked.groupBy(*keys).agg(F.sum("_tokens").alias("tokens")).write.parquet(f"{base}/sums")
    rake(spark.read.parquet(f"{base}/sums"), **raking).write.parquet(f"{base}/raked")
    cells = spark.read.parquet(f"{base}/raked")
    rate = solve_rate(cells, keep) if rate is None else float(rate)
    # written and read back: the planner sees the table's size, so it sends the cells to the texts (up to
    # its broadcast limit) rather than the texts to the cells
    cells.select(*keys, F.least(F.lit(rate) * F.col("weight") / F.col("tokens"), F.lit(1.0)).alias("_probability")).write.parquet(f"{base}/cells")
    per_cell = spark.read.parquet(f"{base}/cells")
    return (marked.join(per_cell, keys, "left").fillna(0.0, ["_probability"])
            .withColumn("_drawn", draw_number(F.col(id_col)) < F.col("_probability")))


def probabilities(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """id, source, lang, topic, tokens, probability, drawn of every document."""
    m = mix(docs, id_col, **kw)
    return m.select(id_col, F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"),
                    F.col("_tokens").alias("tokens"), F.round("_probability", 9).alias("probability"), F.col("_drawn").alias("drawn"))


def draw(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The drawn documents, with the columns they came with."""
    return mix(docs, id_col, **kw).filter("_drawn").select(*[F.col(f"`{c}`") for c in docs.columns])


def oracle(rounds: int = ROUNDS, keep: float = KEEP) -> str:
    """The same as DuckDB SQL over ``documents``."""
    topic = "".join(f" WHEN contains(text, '{k}') THEN '{v}'" for k, v in TOPICS)
    share = lambda c, m: f"""wanted_{c} AS (SELECT {c}, pow(sum(n), {POWERS[m]}) AS x FROM cells GROUP BY {c}),
t_{c} AS (SELECT {c}, x / (SELECT sum(x) FROM wanted_{c}) * (SELECT sum(n) FROM cells) AS t{c} FROM wanted_{c})"""  # noqa: E731
    return f"""WITH RECURSIVE marked AS (SELECT doc_id, coalesce(source, 'none') AS s, coalesce(lang, 'none') AS l,
  CASE WHEN text IS NULL OR text = '' THEN 'empty'{topic} ELSE 'prose' END AS t,
  CASE WHEN text IS NULL OR text = '' THEN 0 ELSE strlen(text) - strlen(replace(text, ' ', '')) + 1 END AS n FROM documents),
cells AS (SELECT s, l, t, CAST(sum(n) AS DOUBLE) AS n FROM marked GROUP BY ALL HAVING sum(n) > 0),
{share('s', 'source')},
{share('l', 'lang')},
{share('t', 'topic')},
rake AS (
  SELECT 0 AS k, s, l, t, n, n AS w, ts, tl, tt, CAST(NULL AS DOUBLE) AS change, CAST(NULL AS DOUBLE) AS was
  FROM cells JOIN t_s USING (s) JOIN t_l USING (l) JOIN t_t USING (t)
  UNION ALL
  SELECT k + 1, s, l, t, n, w3, ts, tl, tt,
         max(greatest(abs(xs - 1), abs(xl - 1), abs(xt - 1))) OVER (), change
  FROM (SELECT *, w2 * xt AS w3 FROM (SELECT *, tt / sum(w2) OVER (PARTITION BY t) AS xt FROM
       (SELECT *, w1 * xl AS w2 FROM (SELECT *, tl / sum(w1) OVER (PARTITION BY l) AS xl FROM
       (SELECT *, w * xs AS w1 FROM (SELECT *, ts / sum(w) OVER (PARTITION BY s) AS xs FROM rake
        WHERE k < {rounds} AND (change IS NULL OR (change > {TOLERANCE} AND (was IS NULL OR change <= {STALLED} * was))))))))) ),
raked AS (SELECT s, l, t, n, w, w / n AS m FROM rake WHERE k = (SELECT max(k) FROM rake)),
-- cells by multiplier: the first so many are kept whole, the rate of the others gives what is missing
ranks AS (SELECT *, row_number() OVER (ORDER BY m DESC, s, l, t) AS i, coalesce(sum(n) OVER o, 0) AS whole,
                 sum(w) OVER (ORDER BY m, s DESC, l DESC, t DESC) AS rest
          FROM raked WINDOW o AS (ORDER BY m DESC, s, l, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rates AS (SELECT i, m, ({keep} * (SELECT sum(n) FROM raked) - whole) / rest AS r FROM ranks),
rate AS (SELECT arg_min(r, i) AS r FROM rates WHERE r * m <= 1 + 1e-9),
p AS (SELECT s, l, t, least(r * m, 1.0) AS p FROM raked, rate)
SELECT doc_id, m.s AS source, m.l AS lang, m.t AS topic, CAST(m.n AS BIGINT) AS tokens, round(coalesce(p.p, 0.0), 9) AS probability,
  CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / {float(1 << DRAW_BITS)} < coalesce(p.p, 0.0) AS drawn
FROM marked m LEFT JOIN p USING (s, l, t)"""
