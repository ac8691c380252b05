"""The encounter table derived from the order and customer tables.

The text below is plain SQL that means the same to Spark and to the engine used
for the side-by-side check, so both sides start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.sources.layout import DRUG_COMBINATIONS, DRUGS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _drug(position: int, name: str) -> str:
    return (
        f"CASE (tp+{7 * position})%53 WHEN 0 THEN 'Up' WHEN 1 THEN 'Down' "
        f"WHEN 2 THEN 'Steady' WHEN 3 THEN 'Steady' ELSE 'No' END AS {name}"
    )


def encounter_sql(
    orders: str = "orders", customer: str = "customer", extra: tuple[str, ...] = ()
) -> str:
    """One row per order, shaped as a hospital encounter."""
    rotating = [d for d in DRUGS if d not in ("examide", "citoglipton", "insulin")]
    drugs = ",\n  ".join(
        _drug(i, name) for i, name in enumerate(rotating + DRUG_COMBINATIONS)
    )
    more = "".join(f",\n  {e}" for e in extra)
    return f"""SELECT
  o_orderkey AS encounter_id, o_custkey AS patient_nbr,
  CASE WHEN tp%45=0 THEN '?' ELSE c_mktsegment END AS race,
  CASE WHEN o_orderkey%5003=7 THEN 'Unknown/Invalid' WHEN o_orderkey%2=0 THEN 'Female' ELSE 'Male' END AS gender,
  '[' || CAST(((tp*7+o_custkey)%10)*10 AS STRING) || '-' || CAST(((tp*7+o_custkey)%10)*10+10 AS STRING) || ')' AS age,
  CASE WHEN tp%100<97 THEN '?' ELSE '[' || CAST((tp%8)*25 AS STRING) || '-' || CAST((tp%8)*25+25 AS STRING) || ')' END AS weight,
  CAST(1+tp%8 AS INT) AS admission_type_id,
  CAST(1+tp%29 AS INT) AS discharge_disposition_id,
  CAST(1+tp%23 AS INT) AS admission_source_id,
  CAST(1+(tp%97)%14 AS INT) AS time_in_hospital,
  CASE tp%10 WHEN 0 THEN '?' WHEN 1 THEN '?' WHEN 2 THEN '?' WHEN 3 THEN '?' WHEN 4 THEN 'MC' WHEN 5 THEN 'MC' WHEN 6 THEN 'HM' WHEN 7 THEN 'SP' WHEN 8 THEN 'BC' ELSE 'MD' END AS payer_code,
  CASE WHEN tp%19<9 THEN '?' ELSE 'Specialty' || CAST(tp%19 AS STRING) END AS medical_specialty,
  CAST(1+tp%131 AS INT) AS num_lab_procedures,
  CAST((tp%31)%7 AS INT) AS num_procedures,
  CAST(1+tp%81 AS INT) AS num_medications,
  CAST(CASE WHEN tp%37<30 THEN 0 ELSE tp%37-29 END AS INT) AS number_outpatient,
  CAST(CASE WHEN tp%41<36 THEN 0 ELSE tp%41-35 END AS INT) AS number_emergency,
  CAST(CASE WHEN tp%43<24 THEN 0 ELSE (tp%43-23)%6 END + CASE WHEN tp%9=0 THEN 2 ELSE 0 END AS INT) AS number_inpatient,
  CASE WHEN tp%71=0 THEN '?' WHEN tp%50=0 THEN 'V57' ELSE CAST(250+tp%400 AS STRING) || CASE WHEN tp%3=0 THEN '.' || CAST(tp%100 AS STRING) ELSE '' END END AS diag_1,
  CASE WHEN tp%53=0 THEN '?' WHEN tp%60=0 THEN 'E909' ELSE CAST(250+(tp+o_custkey)%400 AS STRING) END AS diag_2,
  CASE WHEN tp%47=0 THEN '?' ELSE CAST(250+(tp*3+o_custkey)%400 AS STRING) END AS diag_3,
  CAST(1+tp%16 AS INT) AS number_diagnoses,
  CASE tp%20 WHEN 0 THEN 'Norm' WHEN 1 THEN '>200' WHEN 2 THEN '>300' ELSE 'None' END AS max_glu_serum,
  CASE tp%11 WHEN 0 THEN 'Norm' WHEN 1 THEN '>7' WHEN 2 THEN '>8' ELSE 'None' END AS A1Cresult,
  {drugs},
  'No' AS examide, 'No' AS citoglipton,
  CASE tp%7 WHEN 0 THEN 'Up' WHEN 1 THEN 'Down' WHEN 2 THEN 'Steady' WHEN 3 THEN 'Steady' ELSE 'No' END AS insulin,
  CASE WHEN tp%13<6 THEN 'Ch' ELSE 'No' END AS change,
  CASE WHEN tp%17<13 THEN 'Yes' ELSE 'No' END AS diabetesMed,
  CASE WHEN tp%9=0 THEN '<30' WHEN tp%9<=3 THEN '>30' ELSE 'NO' END AS readmitted{more}
FROM (SELECT o.*, c.c_mktsegment, c.c_name, CAST(round(o_totalprice*100) AS BIGINT) AS tp
      FROM {orders} o JOIN {customer} c ON o_custkey=c_custkey) t"""


def spread(df: DataFrame) -> DataFrame:
    """Rebalance an input that arrives in fewer parts than there are cores.

    A table of many files keeps its partitioning; one small file would otherwise feed
    a single task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def encounters(spark: SparkSession, folder: str, extra: tuple[str, ...] = ()) -> DataFrame:
    orders = table(spark, folder, "orders").drop("o_orderpriority")
    return spark.sql(
        encounter_sql("{orders}", "{customer}", extra),
        orders=spread(orders),
        customer=table(spark, folder, "customer"),
    )
