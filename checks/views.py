"""Requests and salaries derived from the test tables: once as DataFrames, once as SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffcast.settings import Settings

AS_OF = date(2001, 8, 2)
CONF = Settings(as_of=AS_OF)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order becomes a request; parts and documents are assigned to orders in turn, all of them."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("_part"), "p_type")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_doc"), "text")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("_order"))
        .agg(F.count("*").alias("n_lines"), F.count_if(F.col("l_returnflag") != "R").alias("n_kept"))
    )
    customers = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("_cust"), "n_name")
    )
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    orders = table(spark, sf_dir, "orders").withColumns(
        {
            "_doc_ref": k % docs.select(F.count("*")).scalar(),
            "_part_ref": k % part.select(F.count("*")).scalar(),
        }
    )
    joined = (
        orders.join(customers, F.col("_cust") == c)
        .join(part, F.col("_part") == F.col("_part_ref"))
        .join(lines, F.col("_order") == k, "left")
        # Texts come last, so that no other join shuffles them.
        .join(docs, F.col("_doc") == F.col("_doc_ref"))
    )
    created = F.col("o_orderdate").cast("date")

    def text(prefix, value):
        return F.concat(F.lit(prefix), value.cast("string"))

    return joined.select(
        text("REQ", k).alias("request_code"),
        F.when(F.col("o_orderstatus") == "O", "Open")
        .when(F.col("o_orderstatus") == "F", "Closed")
        .otherwise(F.when(k % 3 == 0, "Discarded").otherwise("Open"))
        .alias("status"),
        created.alias("request_creation_date"),
        F.when(k % 7 != 0, F.date_add(created, (k % 180).cast("int"))).alias("closure_date"),
        F.date_add(created, (k % 61 - 30).cast("int")).alias("need_date"),
        F.coalesce("n_kept", F.lit(0)).cast("int").alias("positions_filled"),
        F.coalesce(F.col("n_lines") - k % 2, F.lit(0)).cast("int").alias("required_positions"),
        F.when(k % 2 == 0, F.col("o_totalprice") / 10000).otherwise(F.col("o_totalprice") / 5).alias("desired_salary"),
        text("C", c % 100).alias("client_code"),
        text("F", c % 100).alias("final_client"),
        text("A", c % 40).alias("sales_agent"),
        F.when(k % 5 == 0, "HR1|HR2").otherwise(text("HR", c % 20)).alias("hr_manager"),
        F.col("n_name").alias("region"),
        F.col("p_type").alias("job_role"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "100% Remote")
        .when(F.col("o_orderpriority") == "2-HIGH", "Hybrid")
        .otherwise("On-site")
        .alias("remote_work"),
        F.when(k % 4 == 0, "Negotiated Rate").otherwise("Fixed").alias("rate_type"),
        F.when(k % 11 == 0, "Forecast").otherwise("Real").alias("request_type"),
        F.when(k % 6 == 0, "Madrid Centro")
        .when(k % 6 == 1, "Cualquier lugar")
        .when(k % 6 == 3, "La Coruña")
        .when(k % 6 == 4, "Oslo")
        .when(k % 6 == 5, "Zona Sevilla")
        .alias("work_area"),
        F.when(k % 4 == 1, "English")
        .when(k % 4 == 2, "English|Spanish")
        .when(k % 4 == 3, "French| English ")
        .alias("languages"),
        F.when(k % 29 != 0, (k % 12 + 1).cast("int")).alias("job_level"),
        F.when(k % 5 != 0, ((k * 7) % 101).cast("double")).alias("consolidation_probability"),
        F.when(k % 6 != 0, ((k * 13) % 101).cast("double")).alias("coverage_probability"),
        F.col("text").alias("minimum_requirements"),
        (k % 400 - 20).cast("double").alias("tech_hours"),
        (c % 300).cast("double").alias("community_tech_hours"),
        (k % 97).cast("double").alias("applicant_tech_hours_12"),
        (k % 83).cast("double").alias("applicant_tenure"),
        (c % 71).cast("double").alias("tech_tenure"),
        F.when(k % 3 == 0, 0.0).otherwise((20000 + k % 30000).cast("double")).alias("average_salary"),
        F.when(k % 2 == 0, 0.0).otherwise((18000 + k % 25000).cast("double")).alias("average_salary_12"),
        F.col("o_orderpriority").alias("priority"),
        F.when(k % 2 == 0, "T&M").otherwise("Fixed").alias("service_type"),
        (k % 5).cast("int").alias("request_difficulty"),
    )


REQUESTS_SQL = """
requests AS (
  SELECT 'REQ' || k AS request_code,
    CASE WHEN o_orderstatus = 'O' THEN 'Open' WHEN o_orderstatus = 'F' THEN 'Closed'
         WHEN k % 3 = 0 THEN 'Discarded' ELSE 'Open' END AS status,
    created AS request_creation_date,
    CASE WHEN k % 7 <> 0 THEN created + CAST(k % 180 AS INTEGER) END AS closure_date,
    created + CAST(k % 61 - 30 AS INTEGER) AS need_date,
    CAST(coalesce(n_kept, 0) AS INTEGER) AS positions_filled,
    CAST(coalesce(n_lines - k % 2, 0) AS INTEGER) AS required_positions,
    CASE WHEN k % 2 = 0 THEN o_totalprice / 10000 ELSE o_totalprice / 5 END AS desired_salary,
    'C' || c % 100 AS client_code, 'F' || c % 100 AS final_client, 'A' || c % 40 AS sales_agent,
    CASE WHEN k % 5 = 0 THEN 'HR1|HR2' ELSE 'HR' || c % 20 END AS hr_manager,
    n_name AS region, p_type AS job_role,
    CASE o_orderpriority WHEN '1-URGENT' THEN '100% Remote' WHEN '2-HIGH' THEN 'Hybrid' ELSE 'On-site' END AS remote_work,
    CASE WHEN k % 4 = 0 THEN 'Negotiated Rate' ELSE 'Fixed' END AS rate_type,
    CASE WHEN k % 11 = 0 THEN 'Forecast' ELSE 'Real' END AS request_type,
    CASE k % 6 WHEN 0 THEN 'Madrid Centro' WHEN 1 THEN 'Cualquier lugar' WHEN 3 THEN 'La Coruña'
               WHEN 4 THEN 'Oslo' WHEN 5 THEN 'Zona Sevilla' END AS work_area,
    CASE k % 4 WHEN 1 THEN 'English' WHEN 2 THEN 'English|Spanish' WHEN 3 THEN 'French| English ' END AS languages,
    CASE WHEN k % 29 <> 0 THEN CAST(k % 12 + 1 AS INTEGER) END AS job_level,
    CASE WHEN k % 5 <> 0 THEN CAST((k * 7) % 101 AS DOUBLE) END AS consolidation_probability,
    CASE WHEN k % 6 <> 0 THEN CAST((k * 13) % 101 AS DOUBLE) END AS coverage_probability,
    text AS minimum_requirements,
    CAST(k % 400 - 20 AS DOUBLE) AS tech_hours, CAST(c % 300 AS DOUBLE) AS community_tech_hours,
    CAST(k % 97 AS DOUBLE) AS applicant_tech_hours_12, CAST(k % 83 AS DOUBLE) AS applicant_tenure,
    CAST(c % 71 AS DOUBLE) AS tech_tenure,
    CASE WHEN k % 3 = 0 THEN 0.0::DOUBLE ELSE CAST(20000 + k % 30000 AS DOUBLE) END AS average_salary,
    CASE WHEN k % 2 = 0 THEN 0.0::DOUBLE ELSE CAST(18000 + k % 25000 AS DOUBLE) END AS average_salary_12,
    o_orderpriority AS priority, CASE WHEN k % 2 = 0 THEN 'T&M' ELSE 'Fixed' END AS service_type,
    CAST(k % 5 AS INTEGER) AS request_difficulty
  FROM (SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS created,
          o_orderkey % (SELECT count(*) FROM part) AS part_ref,
          o_orderkey % (SELECT count(*) FROM documents) AS doc_ref, * FROM orders) o
  JOIN customer ON c_custkey = c
  JOIN nation ON n_nationkey = c_nationkey
  JOIN part ON p_partkey = part_ref
  JOIN documents ON doc_id = doc_ref
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, count(*) FILTER (WHERE l_returnflag <> 'R') AS n_kept
             FROM lineitem GROUP BY l_orderkey) l ON l_orderkey = k
)"""


def salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item becomes a salary row."""
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    )
    return joined.select(
        F.col("l_extendedprice").alias("salary"),
        F.when(F.col("l_linenumber") == 7, F.lit(date(2001, 7, 1))).otherwise(F.lit(date(2001, 8, 1)))
        .alias("insertion_date"),
        F.round(F.col("l_discount") * 1000).cast("int").alias("remote_percentage"),
        F.concat("p_type", F.when(F.col("p_partkey") % 5 == 0, " Area 3").otherwise(""), F.lit(" L01")).alias("profile"),
        F.col("l_quantity").cast("int").alias("tenure"),
        F.col("n_name").alias("region"),
        (F.col("p_size") % 12 + 1).alias("job_level"),
    )


SALARY_SQL = """
salary AS (
  SELECT l_extendedprice AS salary,
    CASE WHEN l_linenumber = 7 THEN DATE '2001-07-01' ELSE DATE '2001-08-01' END AS insertion_date,
    CAST(round(l_discount * 1000) AS INTEGER) AS remote_percentage,
    p_type || CASE WHEN p_partkey % 5 = 0 THEN ' Area 3' ELSE '' END || ' L01' AS profile,
    CAST(l_quantity AS INTEGER) AS tenure, n_name AS region, p_size % 12 + 1 AS job_level
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey
)"""

# The rules of cleaning and outcome, written again in SQL.
CLEANED_SQL = (
    REQUESTS_SQL
    + """,
settled AS (
  SELECT * EXCLUDE (status, required_positions),
    CASE WHEN required_positions > positions_filled THEN required_positions ELSE positions_filled END AS required_positions,
    positions_filled::DOUBLE / nullif(CASE WHEN required_positions > positions_filled THEN required_positions ELSE positions_filled END, 0) AS coverage_rate,
    status AS raw_status
  FROM requests
  WHERE request_creation_date >= DATE '2001-08-02' - 540
    AND (status IS NULL OR status NOT IN ('Discarded', 'Hibernated', 'Active'))
),
ruled AS (
  SELECT *, CASE
      WHEN raw_status = 'Open' AND positions_filled IN (1, 2) AND coverage_rate >= 1.0 THEN 'Closed'
      WHEN raw_status = 'Open' AND positions_filled = 3 AND coverage_rate >= 0.66 THEN 'Closed'
      WHEN raw_status = 'Open' AND positions_filled = 4 AND coverage_rate >= 0.75 THEN 'Closed'
      WHEN raw_status = 'Open' AND positions_filled = 5 AND coverage_rate >= 0.70 THEN 'Closed'
      WHEN raw_status = 'Open' AND positions_filled >= 6 AND coverage_rate >= 0.25 THEN 'Closed'
      WHEN raw_status = 'Open' AND positions_filled IS NOT NULL THEN 'Open'
      WHEN raw_status = 'Closed' THEN 'Closed' END AS rule_status
  FROM settled
),
forced AS (
  SELECT *, CASE WHEN rule_status = 'Open' AND DATE '2001-08-02' - request_creation_date > 180 THEN 'Closed'
                 ELSE rule_status END AS status
  FROM ruled
),
outcome AS (
  SELECT * EXCLUDE (raw_status, rule_status, tech_hours),
    CASE WHEN tech_hours < 0 THEN 0.0::DOUBLE ELSE tech_hours END AS tech_hours,
    CASE WHEN status = 'Closed' THEN CAST(closure_date - request_creation_date AS INTEGER) END AS duration
  FROM forced
  WHERE NOT (status = 'Closed' AND closure_date IS NULL)
    AND region IS DISTINCT FROM 'Administrative Management'
    AND (desired_salary IS NULL OR desired_salary > 5) AND request_type = 'Real'
),
cleaned AS (
  SELECT *, CASE
      WHEN status = 'Open' THEN -1
      WHEN duration > 90 THEN 0
      WHEN positions_filled IN (1, 2) AND coverage_rate >= 1.0 THEN 1
      WHEN positions_filled = 3 AND coverage_rate >= 0.66 THEN 1
      WHEN positions_filled = 4 AND coverage_rate >= 0.70 THEN 1
      WHEN positions_filled = 5 AND coverage_rate >= 0.60 THEN 1
      ELSE 0 END AS target
  FROM outcome
)"""
)

# Rows with client, job level and a plausible salary.
ELIGIBLE_SQL = (
    CLEANED_SQL
    + """,
salaried AS (
  SELECT *, CASE WHEN desired_salary >= 5 AND desired_salary < 100 THEN desired_salary * 1000 ELSE desired_salary END AS RequestSalary
  FROM cleaned WHERE client_code IS NOT NULL AND job_level IS NOT NULL
),
eligible AS (
  SELECT * FROM salaried WHERE RequestSalary IS NULL OR NOT (RequestSalary >= 100 AND RequestSalary < 8000)
)"""
)

SALARY_LEVELS_SQL = (
    SALARY_SQL
    + """,
levelled AS (
  SELECT salary, regexp_replace(left(replace(profile, 'Area 3', ''), greatest(length(replace(profile, 'Area 3', '')) - 4, 0)), '\\s+$', '') AS profile,
    job_level, CASE WHEN remote_percentage = 100 THEN 'Fully Remote' WHEN remote_percentage > 0 AND remote_percentage < 100 THEN 'Hybrid' ELSE 'On-site' END AS remote,
    region, CASE WHEN tenure <= 12 THEN 'new' WHEN tenure <= 48 THEN 'settled' END AS band
  FROM salary WHERE insertion_date = (SELECT max(insertion_date) FROM salary) AND salary > 0
)"""
)


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n" + select


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staffcast.plans.cleaning import clean_requests

    return clean_requests(requests(spark, sf_dir), CONF)


def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staffcast.plans.features import FeatureModel

    return FeatureModel(CONF).eligible(prepared(spark, sf_dir))
