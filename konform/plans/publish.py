"""Versioned publish of a target table and the JDBC sink.

A table lives in ``<root>/<table>/v=<NNNNNNNN>/`` folders.  Each write of a
new version goes to a fresh folder (never over the folder being read, which
Spark forbids), partitioned by tenant when a tenant column exists.  A
version is visible once its ``_SUCCESS`` marker exists - Spark's output
committer writes it last - so readers always see the highest committed
version and a failed or half-written job is simply ignored.  An executor
lost mid-write only re-runs its tasks; the committer keeps the folder whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions of a table (folders ``v=N`` holding ``_SUCCESS``)."""
    fs, p, jvm = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
    return sorted(out)


def current_path(spark: SparkSession, base: str) -> str | None:
    v = versions(spark, base)
    return f"{base}/v={v[-1]:08d}" if v else None


def read_current(spark: SparkSession, base: str, schema=None) -> DataFrame | None:
    path = current_path(spark, base)
    if path is None:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def publish(spark: SparkSession, df: DataFrame, base: str, tenant_column: str | None = None,
            version: int | None = None) -> str:
    """Write ``df`` as the next version of the table at ``base``; return its path.

    An explicit ``version`` (a stream's batch id) makes a replay idempotent:
    when that version is already committed nothing is written again.
    """
    v = versions(spark, base)
    nxt = version if version is not None else ((v[-1] + 1) if v else 1)
    path = f"{base}/v={nxt:08d}"
    if nxt in v:
        return path
    # An uncommitted folder (a failed attempt) is nobody's current version: replace it.
    # Static mode: the folder is new and written whole, and only the static
    # committer leaves the _SUCCESS marker readers rely on.
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if tenant_column:
        w = w.partitionBy(tenant_column)
    w.parquet(path)
    return path


def publish_with_counts(spark: SparkSession, df: DataFrame, base: str, tenant_column: str | None = None,
                        version: int | None = None, action_col: str | None = None) -> tuple[str, dict]:
    """``publish`` plus W18 row counts gathered by ``observe`` during the write
    itself (no second pass): rows written and, given an action column such as
    ``upsert_changed``'s, the rows per action.  A version that is already
    committed is not written again and reports no counts."""
    if version is not None and version in versions(spark, base):
        return f"{base}/v={version:08d}", {}
    obs = Observation("publish_counts")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if action_col:
        metrics += [F.count_if(F.col(action_col) == a).alias(a) for a in ("insert", "update", "unchanged", "keep")]
    observed = df.observe(obs, *metrics)
    path = publish(spark, observed.drop(action_col) if action_col else observed, base, tenant_column, version)
    return path, obs.get


def to_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
            properties: dict | None = None, batchsize: int = 10_000) -> None:
    """Write a DataFrame to a JDBC table (batched inserts, one connection
    per partition).  An upsert is computed in Spark first, so the database
    only ever receives an append or a truncate-and-load of the new rows."""
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", str(batchsize)).mode(mode))
    if mode == "overwrite":
        w = w.option("truncate", "true")
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def to_jdbc_staged(spark: SparkSession, df: DataFrame, url: str, table: str, keys: list[str] | None = None,
                   properties: dict | None = None, batchsize: int = 10_000, changed_only: bool = False,
                   preserved: dict[str, object] | None = None) -> int:
    """Upsert (with ``keys``) or append through a staging table, in one transaction.

    Executors only write the staging table, which each run names for itself.  If its row count is not the number of
    rows Spark produced (a retried task inserted twice), or a complete key was staged twice, nothing reaches the target.  Then one connection
    (with the same ``properties`` as the writers: user, password) replaces the matching rows and inserts the staged ones, or
    rolls back.  With ``changed_only`` matched rows that are equal in every column stay untouched (W12); ``preserved`` columns
    keep the target's value and get the given default in new rows (W14).  Returns the rows staged.
    """
    import uuid

    staging = f"{table}_STAGING_{uuid.uuid4().hex[:12].upper()}"
    obs = Observation("jdbc_rows")
    to_jdbc(df.observe(obs, F.count(F.lit(1)).alias("rows")), url, staging, "overwrite", properties, batchsize)
    produced = obs.get["rows"]
    jvm = spark.sparkContext._jvm
    login = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        if k != "driver":                                    # the writers' option, not the database's
            login.setProperty(str(k), str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, login)
    q = lambda c: f'"{c}"'
    try:
        conn.setAutoCommit(False)
        st = conn.createStatement()
        rs = st.executeQuery(f"SELECT count(*) FROM {staging}")
        rs.next()
        staged = rs.getLong(1)
        if staged != produced:
            raise RuntimeError(f"{staging} holds {staged} rows, {produced} were produced")
        if keys:
            complete = " AND ".join(f"{q(k)} IS NOT NULL" for k in keys)
            names = ", ".join(q(k) for k in keys)
            rs = st.executeQuery(f"SELECT count(*) FROM (SELECT {names} FROM {staging} WHERE {complete} GROUP BY {names} HAVING count(*) > 1) d")
            rs.next()
            if rs.getLong(1):
                raise RuntimeError(f"{rs.getLong(1)} keys were staged more than once")
        if keys and (changed_only or preserved):
            _merge_staged(st, table, staging, df.columns, keys, changed_only, preserved or {}, q)
        else:
            if keys:
                same = " AND ".join(f"s.{q(k)} = {table}.{q(k)}" for k in keys)
                st.executeUpdate(f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {same})")
            cols = ", ".join(q(c) for c in df.columns)
            st.executeUpdate(f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging}")
        conn.commit()
        st.executeUpdate(f"DROP TABLE {staging}")
        conn.commit()
    except Exception:
        conn.rollback()
        st = conn.createStatement()
        st.executeUpdate(f"DROP TABLE {staging}")
        conn.commit()
        raise
    finally:
        conn.close()
    return produced


def _merge_staged(st, table: str, staging: str, columns: list[str], keys: list[str], changed_only: bool, preserved: dict[str, object], q) -> None:
    """Set-based update of matched rows and insert of new ones; null keys never match."""
    same = " AND ".join(f"s.{q(k)} = {table}.{q(k)}" for k in keys)
    values = [c for c in columns if c not in keys and c not in preserved]
    if values:
        differs = " OR ".join(f"(s.{q(c)} <> {table}.{q(c)} OR (s.{q(c)} IS NULL AND {table}.{q(c)} IS NOT NULL) OR (s.{q(c)} IS NOT NULL AND {table}.{q(c)} IS NULL))"
                              for c in values) if changed_only else "1 = 1"
        sets = ", ".join(f"{q(c)} = (SELECT s.{q(c)} FROM {staging} s WHERE {same})" for c in values)
        st.executeUpdate(f"UPDATE {table} SET {sets} WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {same} AND ({differs}))")
    given = [c for c in columns if c not in preserved]
    fixed = {c: f"'{v}'" if isinstance(v, str) else str(v) for c, v in preserved.items()}
    into = ", ".join(q(c) for c in [*given, *fixed])
    what = ", ".join([*(f"s.{q(c)}" for c in given), *fixed.values()])
    # rows that were there before are told from new ones by their keys, so the update above does not matter here
    st.executeUpdate(f"INSERT INTO {table} ({into}) SELECT {what} FROM {staging} s WHERE NOT EXISTS (SELECT 1 FROM {table} WHERE {same})")


# ------------------------------------------------ tenant-partitioned, in place
def stage(spark: SparkSession, df: DataFrame, root: str) -> DataFrame:
    """Write ``df`` once below ``root`` (beside the target, on the same shared store) and read it back:
    an expensive input is computed once, and its lineage is cut (a lost executor re-reads the
    staged files instead of recomputing the extraction).  ``unstage`` removes it."""
    import uuid

    path = f"{root}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(spark: SparkSession, staged: DataFrame) -> None:
    _remove(spark, staged._staged_path)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def _partition_value(v) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if v is None else str(v)


def read_tenants(spark: SparkSession, table_path: str, schema, tenant_col: str) -> DataFrame:
    """The tenant-partitioned table, after finishing a commit that was interrupted."""
    _apply_pending(spark, table_path, tenant_col)
    if not _exists(spark, table_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(table_path)


def commit_tenants(spark: SparkSession, new_slice: DataFrame, touched: DataFrame, table_path: str, tenant_col: str) -> dict:
    """Replace the partitions of the ``touched`` tenants with ``new_slice``; other tenants' files stay untouched.

    The slice is first written whole to ``_pending``; its success marker is the commit.  Moving it into the
    table (a dynamic partition overwrite, then removing partitions that became empty) can be repeated: an
    interrupted commit is finished before the table is next read, and never applied to rows it already holds."""
    pending = f"{table_path}/_pending"
    _remove(spark, pending)
    touched.select(tenant_col).write.parquet(f"{pending}/touched")
    obs = Observation("slice_counts")
    new_slice.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(f"{pending}/rows")
    _apply_pending(spark, table_path, tenant_col)
    return obs.get


def _apply_pending(spark: SparkSession, table_path: str, tenant_col: str) -> None:
    pending = f"{table_path}/_pending"
    if not _exists(spark, f"{pending}/rows/_SUCCESS"):
        return
    rows, touched = spark.read.parquet(f"{pending}/rows"), spark.read.parquet(f"{pending}/touched")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(tenant_col).parquet(table_path))
    # tenants left without rows: their partitions go, one by one
    for r in touched.join(rows.select(tenant_col).distinct(), tenant_col, "left_anti").toLocalIterator():
        _remove(spark, f"{table_path}/{tenant_col}={_partition_value(r[0])}")
    _remove(spark, pending)
