"""Control-table scans (A12, A13) and the landed-page / CSV readers.

Control tables are small, bounded by the number of customers, tenants and
tables; they are read with fixed schemas and equality filters that Catalyst
pushes into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .payloads import LANDED_SCHEMA

# Fixed control-table schemas (column names are the source system's contract).
ADMINISTRATIE = T.StructType([
    T.StructField("AdministratieID", T.IntegerType()), T.StructField("AdministratieCode", T.StringType()),
    T.StructField("KlantID", T.IntegerType()), T.StructField("Actief", T.BooleanType())])
TABELLEN = T.StructType([
    T.StructField("TabelID", T.IntegerType()), T.StructField("ApplicatieNaam", T.StringType()),
    T.StructField("TabelNaam", T.StringType()), T.StructField("Endpoint", T.StringType())])
TABEL_ADMIN_KOPPELING = T.StructType([
    T.StructField("AdministratieID", T.IntegerType()), T.StructField("TabelID", T.IntegerType()),
    T.StructField("TabelNaam", T.StringType()), T.StructField("Actief", T.BooleanType())])
TABELLEN_MAPPING = T.StructType([
    T.StructField("TabelID", T.IntegerType()), T.StructField("Bronkolom", T.StringType()),
    T.StructField("Doelkolom", T.StringType()), T.StructField("DoelDatatype", T.StringType())])
LOG_SCHEMA = T.StructType([
    T.StructField("KlantID", T.IntegerType()), T.StructField("KlantNaam", T.StringType()),
    T.StructField("AdministratieID", T.IntegerType()), T.StructField("AdministratieNaam", T.StringType()),
    T.StructField("ApplicatieNaam", T.StringType()), T.StructField("Tabel", T.StringType()),
    T.StructField("DatumTijd", T.TimestampNTZType()), T.StructField("Actie", T.StringType()),
    T.StructField("TypeActie", T.StringType()), T.StructField("ScriptType", T.StringType()),
    T.StructField("ScriptID", T.IntegerType())])


def read_control(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


# ------------------------------------------------------------------------ A12
def administrations_for(df: DataFrame, klant_id: int, active: bool = True) -> DataFrame:
    return df.filter((F.col("KlantID") == klant_id) & (F.col("Actief") == active))


def tables_for_application(df: DataFrame, application: str) -> DataFrame:
    return df.filter(F.col("ApplicatieNaam") == application)


def mapping_for_table(df: DataFrame, table_id: int) -> DataFrame:
    return df.filter(F.col("TabelID") == table_id)


def links_for_administration(df: DataFrame, administratie_id: int, active: bool = True) -> DataFrame:
    return df.filter((F.col("AdministratieID") == administratie_id) & (F.col("Actief") == active))


def endpoint_for(tables: DataFrame, table_name: str) -> DataFrame:
    """The endpoint row(s) of one table name."""
    return tables.filter(F.col("TabelNaam") == table_name).select("TabelNaam", "Endpoint")


def with_endpoints(work: DataFrame, tables: DataFrame) -> DataFrame:
    """B15 for a whole work list: the endpoint of each item's table (null for a table without one), so that one run
    serves tables of any number of endpoints.  A table listed more than once takes the alphabetically first."""
    known = tables.groupBy(F.col("TabelNaam").alias("table_name")).agg(F.min("Endpoint").alias("endpoint"))
    return work.drop("endpoint").join(known, "table_name", "left")


# ------------------------------------------------------------------------ A13
def control_map(df: DataFrame, key: list[str], seq: str) -> DataFrame:
    """A13 + E7: a control table as a key/value relation, the last row per key wins."""
    from ..plans.sync import last_wins

    return last_wins(df, key, seq)


# ------------------------------------------------------------- landed and CSV
def read_landed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed pages ``(source, tenant, table, page_no, body, next_token)``."""
    return spark.read.format(fmt).schema(LANDED_SCHEMA).load(path)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """A delimited sample with a header row, read with an explicit schema."""
    return (spark.read.option("header", True).option("sep", sep).option("mode", "FAILFAST")
            .schema(schema).csv(path))
