"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of the ring; a row belongs to the first
point clockwise of its key's hash.  A shard takes rows up to its bound; rows
beyond it continue clockwise to the next point whose shard has room.  With
``slack=0`` the bounds are the floor or ceiling of the mean, so the counts of
any two shards differ by at most one (law ``rows``).

Overflow needs only *counts*: the rows of an arc go, in hash order, to its own
shard until that is full and then to the shards further on.  So the number of
rows per arc (``shards * vnodes`` numbers, whatever the input) is all that
reaches the driver, and the plan it returns - which stretch of an arc's order
goes to which shard - has at most ``arcs + shards`` entries.  Each row then finds
its rank on the arc in two levels: a running count over fine hash cells, each dealt into
``SALTS`` parts by row, and its place within a part.  So no task ever holds an arc, a shard, or all
rows of one key: a key with a third of the rows spreads over the parts of its cell.

Defined results: a null id hashes like any other value; a null text has the
fixed overhead as its size and crc 0; rows that repeat an id are placed
separately, in the order of their text's checksum (equal rows are
interchangeable); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path

RING_BITS = 62
SALTS = 64
OVERHEAD_BYTES = 16


@dataclass(frozen=True)
class Stretch:
    """Rows [start, end) of an arc's hash order go to ``shard``, whose slots go on from ``slot``."""

    arc: int
    start: int
    end: int
    shard: int
    slot: int


def ring_points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise."""
    point = lambda s, v: int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") >> (64 - RING_BITS)
    return sorted((point(s, v), s) for s in range(shards) for v in range(vnodes))


def key_hash(key: Column) -> Column:
    """Position of a key on the ring: the leading bits of its md5."""
    h = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 16), 16, 10).cast("decimal(20,0)")
    return F.floor(h / F.lit(1 << (64 - RING_BITS)).cast("decimal(20,0)")).cast("long")


def plan_stretches(counts: dict[int, int], points: list[tuple[int, int]], shards: int, slack: float = 0.0) -> list[Stretch]:
    """Which part of each arc goes to which shard, from the row count of every arc.

    Bounded loads: shard s takes at most its bound; what overflows goes on clockwise.
    """
    total = sum(counts.values())
    if slack:
        room = [-int(-total * (1 + slack) // shards)] * shards
    else:
        room = [total // shards + (s < total % shards) for s in range(shards)]
    n, filled, out = len(points), [0] * shards, []
    # first every arc fills its own shard, then overflow looks for room further on
    left = {}
    for a in sorted(counts):
        s = points[a][1]
        take = min(counts[a], room[s] - filled[s])
        if take:
            out.append(Stretch(a, 0, take, s, filled[s]))
            filled[s] += take
        if take < counts[a]:
            left[a] = take
    for a in sorted(left):
        at, k = left[a], a
        while at < counts[a]:
            k = (k + 1) % n
            s = points[k][1]
            take = min(counts[a] - at, room[s] - filled[s])
            if take:
                out.append(Stretch(a, at, at + take, s, filled[s]))
                filled[s] += take
                at += take
    return out


def _arc(position: Column, points: list[tuple[int, int]], cell_bits: int) -> Column:
    """Index of the first point at or after the position: a table over the leading bits narrows the
    choice to the few points of one cell."""
    pos = [p for p, _ in points]
    shift = RING_BITS - cell_bits
    cells = 1 << cell_bits
    low = [bisect.bisect_left(pos, c << shift) for c in range(cells + 1)]
    cell = F.shiftright(position, shift).cast("int")
    start = F.element_at(F.lit(low), cell + 1)
    stop = F.element_at(F.lit(low), cell + 2)
    inside = F.slice(F.lit(pos), start + 1, F.greatest(stop - start, F.lit(0)))
    return ((start + F.size(F.filter(inside, lambda p: p < position))) % len(pos)).cast("int")


def assign(docs: DataFrame, shards: int = 40, vnodes: int = 32, slack: float = 0.0, id_col: str = "doc_id",
           text_col: str = "text", fine_bits: int = 16) -> DataFrame:
    """id, size, text_crc32, shard, slot, arc of every row.

    ``fine_bits`` leading bits of the position make the cells within which ranks are counted (16 bits and 64 parts
    serve 400 billion rows with some 100,000 in a part; raise it beyond that).
    """
    spark = docs.sparkSession
    points = ring_points(shards, vnodes)
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        key_hash(F.col(id_col)).alias("_pos"))
    path = scratch_path(spark, f"ring-{uuid.uuid4().hex}")
    # texts are read once; the row number that salts equal rows is stored with them, so every later pass sees the same one
    (rows.withColumn("_arc", _arc(F.col("_pos"), points, 10))
     .withColumn("_cell", F.shiftright("_pos", RING_BITS - fine_bits).cast("int"))
     .withColumn("_salt", F.pmod(F.xxhash64("text_crc32", F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
     .write.parquet(path))
    rows = spark.read.parquet(path)
    per_cell = rows.groupBy("_arc", "_cell", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    counts = {r["_arc"]: r["n"] for r in per_cell.groupBy("_arc").agg(F.sum("_n").alias("n")).collect()}
    plan = plan_stretches(counts, points, shards, slack)
    schema = pa.schema({"_arc": pa.int32(), "_from": pa.int64(), "_to": pa.int64(), "_shard": pa.int32(), "_slot": pa.int64()})
    # an Arrow table: rows of Python objects would start Python workers of their own kind, which stay beside the others
    stretches = spark.createDataFrame(pa.Table.from_pylist(
        [{"_arc": s.arc, "_from": s.start, "_to": s.end, "_shard": s.shard, "_slot": s.slot} for s in plan], schema))
    # the arc that wraps around zero is ordered by position like any other, so cells need no turning
    before = per_cell.select("_arc", "_cell", "_salt", (F.sum("_n").over(
        Window.partitionBy("_arc").orderBy("_cell", "_salt").rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))
    inner = Window.partitionBy("_arc", "_cell", "_salt").orderBy("_pos", "_id", "text_crc32", "size")
    ranked = (rows.withColumn("_k", F.row_number().over(inner) - 1)
              .join(before, ["_arc", "_cell", "_salt"])
              .withColumn("_rank", F.coalesce("_before", F.lit(0)) + F.col("_k")))
    # at most arcs + shards rows, whatever the input
    placed = ranked.join(F.broadcast(stretches), "_arc").filter((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    return placed.select(F.col("_id").alias(id_col), "size", "text_crc32", F.col("_shard").alias("shard"),
                         (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot"), F.col("_arc").alias("arc"))


def shard_rows(docs: DataFrame, shards: int = 40, **kw) -> DataFrame:
    """The contract form: law ``rows`` (counts at most one apart)."""
    return assign(docs, shards, **kw).select(
        kw.get("id_col", "doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
