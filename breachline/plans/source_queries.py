"""Queries over files written from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from breachline.operators import profiles as P
from breachline.plans.fixture import JUDGED, judged, rounded, table
from breachline.plans.registry import query
from breachline.settings import work_path
from breachline.sources import mappings, readers, writers


def _folder(spark, name: str) -> str:
    return work_path(spark, name)


@query("SELECT o_orderpriority, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
def csv_with_inferred_types(spark, sf_dir):
    path = _folder(spark, "plain-csv")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    orders.write.option("header", True).csv(path)
    back = readers.read_csv_inferred(spark, path)
    return back.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")
    )


@query(
    """SELECT doc_id, '"' || text || '", ' || source || ' "end"' AS text FROM documents"""
)
def csv_with_doubled_quotes(spark, sf_dir):
    """Whole texts with quotes, commas and line breaks, written as CSV and read again."""
    path = _folder(spark, "quoted-csv")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit('"'), "text", F.lit('", '), "source", F.lit(' "end"')).alias("text")
    )
    docs.write.options(header=True, quote='"', escape='"').csv(path)
    return readers.read_csv_quoted(spark, path, "doc_id long, text string", multiline=True)


@query(
    """SELECT status, count(*) AS n, count(total) AS with_total FROM (
  SELECT o_orderstatus AS status, o_totalprice AS total FROM orders UNION ALL SELECT l_linestatus, NULL FROM lineitem) GROUP BY 1"""
)
def mixed_folder(spark, sf_dir):
    """Parquet and CSV files of one folder, columns matched by name."""
    path = _folder(spark, "mixed")
    orders = table(spark, sf_dir, "orders")
    orders.select(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total")).write.parquet(
        f"{path}/a"
    )
    items = table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("status"))
    items.write.option("header", True).csv(f"{path}/b")
    return readers.read_mixed(spark, path).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.count("total").alias("with_total")
    )


@query("SELECT n_name, n_regionkey, CAST(NULL AS VARCHAR) AS missing_table FROM nation")
def single_table_file(spark, sf_dir):
    """One exact Parquet object, and none where the name does not exist."""
    nation = readers.read_table_file(spark, f"{sf_dir}/nation.parquet")
    absent = readers.read_table_file(spark, f"{sf_dir}/absent.parquet")
    note = F.lit(None if absent is None else "found").cast("string")
    return nation.select("n_name", "n_regionkey", note.alias("missing_table"))


@query("SELECT 'o_orderstatus' AS columna, count(DISTINCT o_orderstatus) AS unicos_n, count(*) AS total_filas_dataset FROM orders UNION ALL SELECT 'o_totalprice', count(DISTINCT o_totalprice), count(*) FROM orders")
def stored_report(spark, sf_dir):
    """A quality report written as one CSV file and read back."""
    path = _folder(spark, "report")
    report = P.missing_profile(table(spark, sf_dir, "orders").select("o_orderstatus", "o_totalprice"))
    writers.write_report(report, path)
    schema = "columna string, tipo_dato string, nulos_n long, nulos_pct double, unicos_n long, total_filas_dataset long"
    back = readers.read_csv_inferred(spark, path, schema)
    return back.select("columna", "unicos_n", "total_filas_dataset")


@query(
    """SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS mean_quantity FROM lineitem GROUP BY 1"""
)
def stored_layer(spark, sf_dir):
    path = _folder(spark, "layer")
    writers.write_layer(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity"), path)
    back = readers.read_layer(spark, path)
    return rounded(
        back.groupBy("l_returnflag").agg(
            F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("mean_quantity")
        )
    )


@query(
    f"""WITH {JUDGED}, d AS (SELECT agency, max(sla_days) AS sla FROM judged GROUP BY agency)
SELECT agency AS key, sla AS value FROM d WHERE agency IS NOT NULL AND sla IS NOT NULL"""
)
def lookup_pairs(spark, sf_dir):
    terms = judged(spark, sf_dir).groupBy("agency").agg(F.max("sla_days").alias("sla"))
    return mappings.nested_lookup_to_table(terms, "agency", "sla")
