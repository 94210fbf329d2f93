"""Personal data: candidate spans scored by gradient-boosted trees.

1. *Generators* propose spans.  The strict ones are the base formats (e-mail, IP,
   card, phone); the high-recall ones propose looser, overlapping forms
   (spelled-out e-mail, numbers without a country code, cards with other
   separators, numeric hosts in brackets, IPv6).
2. *Boosted trees* (``pyspark.ml``) score candidates from format features (length,
   digits, separators, groups) and context features (the characters and words
   beside the span).  They learn from the strict formats: candidates that pass
   every check against those of the same shape that fail one.  The outcome of a
   check is never a feature.  Every match of the strict e-mail format passes, and it
   looks unlike a spelled-out one, so each is learned from spelled out (``at``,
   ``[at]``, ``dot`` ...) and, as its near miss, as the end of a sentence about its
   name; a loose e-mail whose dot ends a sentence, or with no ending that
   domains have, is an example of failing, too.
3. *Calibrated thresholds*: per kind the smallest score at which candidates that
   are held out from training reach the wanted precision; nothing is added of a kind
   whose held-out candidates lack either outcome.

Base spans always stay; selected candidates that overlap nothing of their kind
are added, the best score first.

One scan reads the texts; everything after works on the candidate rows.

Defined results: a null or empty text has no spans (the digest of the empty
string); offsets are code points, ends exclusive; repeated rows are each returned,
with equal spans; rows that share an id are told apart by their texts; without
training examples of both outcomes nothing is added to the base; other columns are
ignored.
"""

from __future__ import annotations

import bisect
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from . import textvec as tv

KINDS = ("email", "ip", "card", "phone")
TRAIN_ROWS = 8_000              # bound of the sample of candidates that the trees are fitted on
PRECISION = 0.98                # of added spans, on candidates that are held out
BINS = 200
# fixed patterns of the base formats
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MAIL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-@")
DOTTED = re.compile(r"[0-9][0-9.]*")
# high-recall generators
LOOSE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?(?:\[at\]|\(at\)|\{at\}|＠|\sat\s)\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\.|\[dot\]|\(dot\)|\sdot\s)\s?[A-Za-z]{2,24}){1,3}"),
    "ip": re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}:?[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])|(?<![0-9.])[0-9]{1,3}(?:\s?\[?\.\]?\s?[0-9]{1,3}){3}(?![0-9.])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20./_-]{0,3}[0-9]{3,6}){2,4}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:00[0-9]{1,3}[\x20./-]?)?\(?[0-9]{2,5}\)?(?:[\x20./-]{1,2}[0-9]{2,5}){2,4}(?![0-9])"),
}
# a dot or at-sign spelled out, as people do
SPELLED = ((" at ", "."), (" at ", " dot "), ("[at]", "."), (" [at] ", " [dot] "), ("(at)", "."), (" (at) ", " (dot) "), ("＠", "."), ("{at}", " dot "))
SENTENCE = re.compile(r"\.\s")
ENDINGS = frozenset("""com org net edu gov mil int info biz name pro aero coop museum jobs mobi travel app dev xyz online site shop tech
    store blog cloud email agency berlin hamburg bayern koeln wien paris london nyc example test invalid local""".split())
CUES = {
    "email": re.compile(r"mail|kontakt|contact|correo|courriel", re.I),
    "ip": re.compile(r"\bip\b|host|server|addr|serveur|servidor", re.I),
    "card": re.compile(r"card|visa|karte|carte|tarjeta|iban|konto", re.I),
    "phone": re.compile(r"phone|tel|call|fax|mobil|whatsapp|ruf", re.I),
}
FEATURES = ["kind_ix", "length", "digits", "groups", "longest_group", "separators", "separator_kinds", "brackets", "letters",
            "dots", "ats", "first_plus", "first_zero", "distinct_digits", "before_word", "before_digit", "after_word",
            "after_digit", "before_space", "after_stop", "cue", "digit_density", "line_start", "base_overlap"]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(t: str) -> list[tuple[int, int]]:
    """Leftmost matches of the e-mail format.  A match needs its local part directly before an ``@``, so
    only the runs of allowed characters around one are looked at, each character once."""
    out, at, done = [], t.find("@"), 0
    while at >= 0:
        lo = at
        while lo > done and t[lo - 1] in MAIL_CHARS and t[lo - 1] != "@":
            lo -= 1
        nxt = at + 1
        if lo < at:
            m = DOMAIN.match(t, at + 1)
            if m:
                out.append((lo, m.end()))
                done = nxt = m.end()
        done = max(done, at + 1)
        at = t.find("@", nxt)
    return out


def base_candidates(t: str):
    """(kind, start, end, passes) of every leftmost match of the base formats."""
    out = [("email", a, b, True) for a, b in emails(t)]
    for run in DOTTED.finditer(t):
        if run.group().count(".") >= 3:
            for m in IP.finditer(t, run.start(), run.end()):
                out.append(("ip", *m.span(), all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m.group().split("."))))
    for m in CARD.finditer(t):
        d = re.sub("[^0-9]", "", m.group())
        if len(d) >= 12:
            out.append(("card", *m.span(), 16 <= len(d) <= 19 and luhn(d)))
    for m in PHONE.finditer(t):
        out.append(("phone", *m.span(), 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15))
    return out


def loose_candidates(t: str):
    for kind, p in LOOSE.items():
        for m in p.finditer(t):
            yield kind, *m.span()


def plausible_email(s: str) -> bool:
    """May a loose e-mail be one?  Not if its dot ends a sentence or its ending is none that domains have."""
    end = re.split("[^A-Za-z]", s)[-1].lower()
    return not SENTENCE.search(s) and (len(end) == 2 or end in ENDINGS)


def spelled(t: str, a: int, b: int) -> list[tuple[str, int, int, int]]:
    """(text around, start, end, label) of an e-mail spelled out, and of its near miss in prose."""
    local, _, domain = t[a:b].rpartition("@")
    left, right = t[max(0, a - 32):a], t[b:b + 12]
    at, dot = SPELLED[zlib.crc32(t[a:b].encode()) % len(SPELLED)]
    word = re.match(r"\W*([^\W\d_]{2,12})", right)
    miss = f"{local} at {domain.partition('.')[0]}. {(word[1] if word else local).capitalize()}"
    return [(left + s + right, len(left), len(left) + len(s), label)
            for s, label in ((local + at + domain.replace(".", dot), 1), (miss, 0))]


class Spans:
    """Spans of one kind, which do not overlap: how many overlap another one, by two binary searches."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]

    def overlapping(self, a: int, b: int) -> int:
        return max(0, bisect.bisect_left(self.starts, b) - bisect.bisect_right(self.ends, a))


def features(t: str, kind: str, a: int, b: int, base: list[Spans]) -> list[float]:
    s, left, right = t[a:b], t[max(0, a - 32):a], t[b:b + 12]
    groups = re.findall("[0-9]+", s)
    seps = re.findall("[^0-9A-Za-z]", s)
    near = t[max(0, a - 24):a] + right
    return [KINDS.index(kind), len(s), sum(map(len, groups)), len(groups), max(map(len, groups), default=0), len(seps), len(set(seps)),
            sum(c in "()[]{}" for c in s), sum(c.isalpha() for c in s), s.count("."), s.count("@"), s[:1] == "+", s[:1] == "0",
            len(set("".join(groups))), left[-1:].isalpha(), left[-1:].isdigit(), right[:1].isalpha(), right[:1].isdigit(),
            left[-1:].isspace(), right[:1] in tuple(".,;!?\n"), CUES[kind].search(left) is not None,
            sum(c.isdigit() for c in near) / max(1, len(near)), not left or left[-1] == "\n",
            sum(x.overlapping(a, b) for x in base)]


HAS = tv.byte_table(b"0123456789@")
FULLWIDTH_AT = "＠".encode()


def candidate_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row key, kind, span, base (passes the base format), label (1 passes, 0 fails, null unknown), features."""
    schema = "_row long, kind string, a long, b long, base boolean, label int, " + ", ".join(f"{f} double" for f in FEATURES)
    fields = [s.rpartition(" ")[0] for s in schema.split(", ")]

    def scan(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            col = batch.column(1)
            out = []
            for lo, hi, data, off in tv.chunks(col):
                some = np.concatenate(([0], np.cumsum(HAS[data])))
                hits = some[off[1:]] > some[off[:-1]]
                word_at = re.compile(rb"[\s\[({]at[\s\])}]|" + FULLWIDTH_AT)
                whole = data.tobytes()
                for m in word_at.finditer(whole):
                    hits[np.searchsorted(off, m.start(), "right") - 1] = True
                for r in np.flatnonzero(hits):
                    t = whole[off[r]:off[r + 1]].decode("utf-8", "replace")
                    found = base_candidates(t)
                    spans = {k: Spans([(a, b) for kk, a, b, ok in found if kk == k and ok]) for k in KINDS}
                    every = list(spans.values())
                    seen = set()
                    for kind, a, b, ok in found:
                        seen.add((kind, a, b))
                        out.append((int(keys[lo + r]), kind, a, b, ok, int(ok), *map(float, features(t, kind, a, b, []))))
                        if kind == "email":
                            for around, x, y, label in spelled(t, a, b):
                                out.append((int(keys[lo + r]), kind, a, b, False, label, *map(float, features(around, kind, x, y, []))))
                    for kind, a, b in loose_candidates(t):
                        if (kind, a, b) not in seen and not spans[kind].overlapping(a, b):
                            seen.add((kind, a, b))
                            label = 0 if kind == "email" and not plausible_email(t[a:b]) else None
                            out.append((int(keys[lo + r]), kind, a, b, False, label, *map(float, features(t, kind, a, b, every))))
                if len(out) >= 2000:
                    yield to_batch(out)
                    out = []
            if out:
                yield to_batch(out)

    def to_batch(rows):
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32()] + [pa.float64()] * len(FEATURES)
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=fields)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(scan, schema)


def _score(cands: DataFrame, base_rows: int) -> DataFrame | None:
    """Candidates with the trees' score; None where there is nothing to learn from."""
    labelled = cands.filter(F.col("label").isNotNull()).withColumn("_h", F.xxhash64("_row", "kind", "a"))
    train = (labelled.filter(F.pmod("_h", F.lit(4)) != 0).orderBy("_h", "_row", "a", "b", "base", "label").limit(base_rows)
             .select(*FEATURES, F.col("label").cast("double").alias("label")).coalesce(1))
    seen = {r["label"] for r in train.select("label").distinct().collect()}
    if len(seen) < 2:
        return None
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="_x")
    rows = assemble.transform(train).persist()              # at most base_rows, read once a round of boosting
    try:
        model = GBTClassifier(featuresCol="_x", labelCol="label", maxIter=12, maxDepth=4, maxBins=32, seed=7).fit(rows)
    finally:
        rows.unpersist()
    return (model.transform(assemble.transform(cands.withColumn("_h", F.xxhash64("_row", "kind", "a"))))
            .withColumn("_p", F.element_at(vector_to_array("probability"), 2))
            .select("_row", "kind", "a", "b", "base", "label", "_h", "_p"))


def thresholds(scored: DataFrame, precision: float) -> dict[str, float]:
    """Per kind, the smallest score from which held-out candidates reach the precision (counts per score bin); above
    every score where all of them passed, or none."""
    held = scored.filter(F.col("label").isNotNull() & (F.pmod("_h", F.lit(4)) == 0))
    bins = (held.groupBy("kind", F.least(F.floor(F.col("_p") * BINS), F.lit(BINS - 1)).alias("bin"))
            .agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")).collect())       # at most kinds x bins rows
    out = {}
    for kind in KINDS:
        good = np.zeros(BINS); n = np.zeros(BINS)
        for r in bins:
            if r["kind"] == kind:
                good[r["bin"]], n[r["bin"]] = r["good"], r["n"]
        above_good, above = np.cumsum(good[::-1])[::-1], np.cumsum(n[::-1])[::-1]
        fit = np.flatnonzero((above >= 5) & (above_good >= precision * above) & (0 < good.sum() < n.sum()))
        out[kind] = fit[0] / BINS if len(fit) else 2.0
    return out


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION,
         train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: id, spans array<struct<kind, start, end, base, score>> sorted by kind (as in
    KINDS) and start."""
    spark = docs.sparkSession
    key = F.xxhash64(F.col(id_col), F.col(text_col))                       # the same in every scan, whoever runs it
    keyed = docs.select(key.alias("_row"), F.col(text_col).alias("_t"))
    path = scratch_path(spark, f"pii-{_fresh()}")
    candidate_rows(keyed, "_row", "_t").write.parquet(path)                 # the texts are read once
    cands = spark.read.parquet(path).dropDuplicates(["_row", "kind", "a", "b", "base", "label"])        # equal rows share their candidates
    scored = _score(cands, train_rows)
    if scored is None:
        spans = cands.filter("base").select("_row", "kind", "a", "b", "base", F.lit(1.0).alias("_p"))
    else:
        cut = F.create_map(*[F.lit(v) for kv in thresholds(scored, precision).items() for v in kv])
        # what is chosen does not overlap within a kind: loose candidates of a kind are the leftmost matches of one pattern, and
        # those that overlap a base span of their kind are not proposed
        chosen = scored.filter(F.col("base") | (F.col("label").isNull() & (F.col("_p") >= cut[F.col("kind")])))
        spans = chosen.select("_row", "kind", "a", "b", "base", "_p")
    order = F.array_position(F.lit(list(KINDS)), F.col("kind")).cast("int")
    per_doc = (spans.groupBy("_row").agg(F.sort_array(F.collect_list(
        F.struct(order.alias("o"), F.col("a").alias("start"), F.col("b").alias("end"), "kind", "base", F.col("_p").alias("score")))).alias("spans")))
    ids = docs.select(key.alias("_row"), F.col(id_col))
    return (ids.join(per_doc, "_row", "left")
            .withColumn("spans", F.coalesce("spans", F.array().cast(per_doc.schema["spans"].dataType))).drop("_row"))


def _fresh() -> str:
    import uuid

    return uuid.uuid4().hex


def contract(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digest of the base spans, all spans as text, and how many were added and found in all."""
    text = lambda s: F.concat_ws(",", F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    base = F.filter("spans", lambda x: x["base"])
    n = lambda k: F.size(F.filter(base, lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(id_col, *[n(k) for k in KINDS], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
                        (F.size("spans") - F.size(base)).cast("long").alias("n_added"), F.size("spans").cast("long").alias("n_spans"))
