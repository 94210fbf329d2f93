"""Watermark, reporting year, run ids and the run log."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RUN_MODE_CHANGES, WATERMARK_FORMAT
from ..sources.control import LOG_SCHEMA


def advance_watermark(results: DataFrame, key: list[str], ok: str, run_start, run_mode,
                      old_watermark: str) -> DataFrame:
    """G1: per customer, the new watermark is the run *start* when every table
    succeeded and the run is a changes run; otherwise the old one stays.

    ``results`` has one row per (customer, table) outcome; ``bool_and`` is a
    partial aggregate, so a customer with many tables never sits in one task
    whole.  Any failure blocks the advance (deviation V5)."""
    start = run_start if isinstance(run_start, Column) else F.lit(str(run_start)).cast("timestamp_ntz")
    start_text = F.date_format(start, WATERMARK_FORMAT)
    agg = results.groupBy(*key).agg(F.bool_and(F.coalesce(F.col(ok), F.lit(False))).alias("all_ok"),
                                    F.max(F.col(old_watermark)).alias("old_watermark"))
    mode = F.lit(run_mode) if not isinstance(run_mode, Column) else run_mode
    advance = F.col("all_ok") & (mode == F.lit(RUN_MODE_CHANGES))
    return agg.withColumn("new_watermark", F.when(advance, start_text).otherwise(F.col("old_watermark"))) \
              .withColumn("advanced", advance)


def reporting_year(as_of) -> Column:
    """The reporting year is the current year minus one."""
    c = F.lit(str(as_of)).cast("timestamp_ntz") if not isinstance(as_of, Column) else as_of
    return (F.year(c) - 1).cast("int")


def next_run_id(log: DataFrame, col: str = "ScriptID") -> DataFrame:
    """``max + 1``, 1 for an empty log (one partial aggregate)."""
    return log.agg((F.coalesce(F.max(F.col(col)).cast("long"), F.lit(0).cast("long")) + 1).alias("next_run_id"))


def claim_run_id(spark: SparkSession, log_path: str, col: str = "ScriptID") -> int:
    """G3 for concurrent runs: the next id, claimed before any work starts.

    A claim is an empty file named by the id beside the log, created only if it does not exist (which the file system does
    atomically); a run that finds its id taken tries the next one, so no two runs ever share one."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{log_path.rstrip('/')}_ids")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    log = jvm.org.apache.hadoop.fs.Path(log_path)
    last = next_run_id(spark.read.schema(LOG_SCHEMA).parquet(log_path), col).first()[0] - 1 if fs.exists(log) else 0
    fs.mkdirs(folder)
    claimed = [int(st.getPath().getName()) for st in fs.listStatus(folder) if st.getPath().getName().isdigit()]
    n = max([last, *claimed]) + 1
    while True:
        try:
            fs.create(jvm.org.apache.hadoop.fs.Path(folder, str(n)), False).close()
            return n
        except Py4JJavaError as e:
            if not fs.exists(jvm.org.apache.hadoop.fs.Path(folder, str(n))):
                raise e                                      # not a lost race
            n += 1


def log_rows(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Buffered log entries of one run (one per table step) as a DataFrame
    with the fixed 11-field schema; written with one append per run."""
    names = LOG_SCHEMA.names
    rows = [tuple(e.get(n) for n in names) for e in entries]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def log_frame(outcomes: DataFrame, application: str, run_id: int, script: str, at) -> DataFrame:
    """G4 for a frame of outcomes (customer, administration, table, ``ok``, ``error``): the 11 log fields."""
    action = F.concat(F.col("Tabel"), F.lit(" - "), F.when(F.col("ok"), F.lit("synchronised")).otherwise(F.col("error")))
    at = at if isinstance(at, Column) else F.lit(str(at)).cast("timestamp_ntz")
    extra = {"ApplicatieNaam": F.lit(application), "DatumTijd": at.cast("timestamp_ntz"), "Actie": action,
             "TypeActie": F.when(F.col("ok"), "INFO").otherwise("ERROR"), "ScriptType": F.lit(script), "ScriptID": F.lit(run_id)}
    return outcomes.select(*[(extra[f.name] if f.name in extra else F.col(f.name)).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA.fields])


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)

