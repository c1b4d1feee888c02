"""Results stay exact when one key holds a third of the rows.

Skewed copies of the fixtures are written to parquet once, then the Spark
plans and the DuckDB SQL run on the same files.
"""

import datetime as dt
import os
import tempfile

import duckdb
from pyspark.sql import functions as F

from conftest import SF01
from oracle_check import compare
from tvlens.operators.overlap import overlap_flags
from tvlens.plans import gold
from tvlens.plans.catalog import round_doubles
from tvlens.plans.oracle import VIEWING_SUMMARY_CTES, VS_DOUBLES, rounded, with_ctes
from tvlens.sources.tables import crm, partner, read_table, viewing_logs

AS_OF = dt.date(2024, 1, 31)


def test_customer_summary_with_a_hot_customer(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tvlens-skew-"), "logs")
    logs = viewing_logs(read_table(spark, SF01, "events"))
    hot = logs.withColumn(
        "customer_id",
        F.when(F.col("log_id").cast("long") % 3 == 0, F.lit("HOT")).otherwise(F.col("customer_id")),
    )
    hot.write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.where("customer_id = 'HOT'").count() * 3 >= stored.count() - 2

    con = duckdb.connect()
    con.execute(f"CREATE VIEW logs AS SELECT * FROM read_parquet('{path}/*.parquet')")
    sql = rounded(with_ctes(*VIEWING_SUMMARY_CTES) + "SELECT * FROM viewing_summary", VS_DOUBLES)
    # averages of doubles: an exact tie at the 7th decimal may round either way
    assert compare(round_doubles(gold.viewing_summary(stored)), con, sql, tol=1.5e-6) == []


def test_overlap_with_a_hot_email_and_many_nulls(spark):
    root = tempfile.mkdtemp(prefix="tvlens-skew-")
    c = crm(read_table(spark, SF01, "customer"), AS_OF).select("customer_id", "email", "phone")
    # a third of the rows share one e-mail that the partner also has; a fifth have none
    key = F.col("customer_id").cast("long")
    skewed = c.withColumn(
        "email",
        F.when(key % 3 == 0, F.lit("c0@example.com")).when(key % 5 == 1, F.lit(None)).otherwise(F.col("email")),
    )
    p = partner(read_table(spark, SF01, "supplier"))
    skewed.write.parquet(os.path.join(root, "crm"))
    p.write.parquet(os.path.join(root, "partner"))
    sc = spark.read.parquet(os.path.join(root, "crm"))
    sp = spark.read.parquet(os.path.join(root, "partner"))

    got = overlap_flags(sc, sp, [("email", "email"), ("phone", "phone")])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW crm AS SELECT * FROM read_parquet('{root}/crm/*.parquet')")
    con.execute(f"CREATE VIEW partner AS SELECT * FROM read_parquet('{root}/partner/*.parquet')")
    sql = """SELECT customer_id, email, phone,
      EXISTS (SELECT 1 FROM partner s WHERE s.email = c.email OR s.phone = c.phone) AS in_partner FROM crm c"""
    assert compare(got.select("customer_id", "email", "phone", "in_partner"), con, sql) == []
