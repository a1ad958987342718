"""Checks of scans, filters, row rules, strings and dates."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from checks import views as V
from checks.registry import query
from staffcast import settings as S
from staffcast.functions import rules, text
from staffcast.operators import encoding, filters, scaling
from staffcast.operators.output import prediction_table
from staffcast.operators.sampling import hash_percent
from staffcast.plans import cleaning
from staffcast.sinks.tables import replace_partitions
from staffcast.sources.snapshots import read_latest, write_snapshot
from staffcast.sources.tables import parse_records
from staffcast.staging import staging_root

DATES = ("request_creation_date", "closure_date", "need_date")


def _sql(select, *ctes):
    return V.with_ctes(*(ctes or (V.REQUESTS_SQL,)), select=select)


# ---- scans and sinks -------------------------------------------------------------


@query(
    "scan_requests",
    _sql("""SELECT * REPLACE (CAST(request_creation_date AS VARCHAR) AS request_creation_date,
      CAST(closure_date AS VARCHAR) AS closure_date, CAST(need_date AS VARCHAR) AS need_date) FROM requests"""),
)
def scan_requests(spark, sf_dir):
    return V.requests(spark, sf_dir).withColumns({c: text.iso_day(F.col(c)) for c in DATES})


@query(
    "scan_salary",
    _sql("SELECT * REPLACE (CAST(insertion_date AS VARCHAR) AS insertion_date) FROM salary", V.SALARY_SQL),
)
def scan_salary(spark, sf_dir):
    return V.salary(spark, sf_dir).withColumn("insertion_date", text.iso_day(F.col("insertion_date")))


@query(
    "latest_snapshot",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)",
)
def latest_snapshot(spark, sf_dir):
    """Yearly snapshots written and the newest read back."""
    orders = V.table(spark, sf_dir, "orders")
    path = f"{staging_root(spark)}/checks/snapshots-{uuid.uuid4().hex}"
    first, last = orders.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    for year in range(first, last + 1):
        write_snapshot(orders.filter(F.year("o_orderdate") == year), path, date(year, 12, 31))
    return read_latest(spark, path).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "parse_events_json",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.absent') AS absent FROM events",
)
def parse_events_json(spark, sf_dir):
    return parse_records(V.table(spark, sf_dir, "events"), "props", "k int, absent string", ["event_id"])


@query(
    "replace_partition",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 1998 THEN o_totalprice * 2 ELSE o_totalprice END AS amount,
       CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders""",
)
def replace_partition(spark, sf_dir):
    """Write all years, then replace the later ones twice; earlier years and row counts must stand."""
    orders = V.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("amount"), F.year("o_orderdate").alias("order_year")
    )
    path = f"{staging_root(spark)}/checks/replaced-{uuid.uuid4().hex}"
    replace_partitions(orders, path, "order_year")
    later = orders.filter("order_year >= 1998").withColumn("amount", F.col("amount") * 2)
    for _ in range(2):
        replace_partitions(later, path, "order_year")
    return spark.read.parquet(path)


# ---- filters ---------------------------------------------------------------------


@query(
    "filter_recent",
    _sql("SELECT request_code FROM requests WHERE request_creation_date >= DATE '2001-08-02' - 540"),
)
def filter_recent(spark, sf_dir):
    return filters.recent(V.requests(spark, sf_dir), V.AS_OF, V.CONF.model_days).select("request_code")


@query(
    "filter_status",
    _sql("SELECT request_code, status FROM requests WHERE status IS NULL OR status NOT IN ('Discarded', 'Hibernated', 'Active')"),
)
def filter_status(spark, sf_dir):
    return filters.without_values(V.requests(spark, sf_dir), "status", S.IGNORED_STATUSES).select("request_code", "status")


@query(
    "filter_region",
    _sql("SELECT request_code, region, work_area FROM requests WHERE region IS DISTINCT FROM 'NATION_3' AND work_area IS DISTINCT FROM 'Oslo'"),
)
def filter_region(spark, sf_dir):
    rows = filters.without_values(V.requests(spark, sf_dir), "region", ["NATION_3"])
    return filters.without_values(rows, "work_area", ["Oslo"]).select("request_code", "region", "work_area")


@query(
    "filter_salary",
    _sql("SELECT request_code, desired_salary, consolidation_probability FROM requests WHERE (desired_salary IS NULL OR desired_salary > 5) AND (consolidation_probability IS NULL OR consolidation_probability > 50)"),
)
def filter_salary(spark, sf_dir):
    rows = filters.above(V.requests(spark, sf_dir), "desired_salary", 5)
    return filters.above(rows, "consolidation_probability", 50).select(
        "request_code", "desired_salary", "consolidation_probability"
    )


@query("filter_type", _sql("SELECT request_code, request_type FROM requests WHERE request_type = 'Real'"))
def filter_type(spark, sf_dir):
    return filters.only_value(V.requests(spark, sf_dir), "request_type", S.KEPT_REQUEST_TYPE).select(
        "request_code", "request_type"
    )


@query(
    "filter_closed_undated",
    _sql("SELECT request_code, status FROM requests WHERE status IS NULL OR NOT (status = 'Closed' AND closure_date IS NULL)"),
)
def filter_closed_undated(spark, sf_dir):
    return filters.without_undated_closed(V.requests(spark, sf_dir)).select("request_code", "status")


@query("dropna_subset", _sql("SELECT request_code, job_level FROM requests WHERE client_code IS NOT NULL AND job_level IS NOT NULL"))
def dropna_subset(spark, sf_dir):
    return V.requests(spark, sf_dir).na.drop(subset=["client_code", "job_level"]).select("request_code", "job_level")


@query(
    "dropna_any",
    _sql("SELECT request_code, job_level, languages, work_area FROM requests WHERE job_level IS NOT NULL AND languages IS NOT NULL AND work_area IS NOT NULL"),
)
def dropna_any(spark, sf_dir):
    return V.requests(spark, sf_dir).select("request_code", "job_level", "languages", "work_area").na.drop("any")


@query(
    "filter_salary_band",
    _sql("SELECT request_code, RequestSalary FROM eligible", V.ELIGIBLE_SQL),
)
def filter_salary_band(spark, sf_dir):
    return V.eligible(spark, sf_dir).select("request_code", "RequestSalary")


@query(
    "latest_rows",
    _sql("SELECT salary, profile, region FROM salary WHERE insertion_date = (SELECT max(insertion_date) FROM salary) AND salary > 0", V.SALARY_SQL),
)
def latest_rows(spark, sf_dir):
    return filters.latest_rows(V.salary(spark, sf_dir)).filter("salary > 0").select("salary", "profile", "region")


@query(
    "split_open_closed",
    _sql("SELECT request_code, CASE WHEN target = -1 THEN 'open' ELSE 'closed' END AS side FROM cleaned", V.CLEANED_SQL),
)
def split_open_closed(spark, sf_dir):
    opened, closed = filters.split_by_target(V.prepared(spark, sf_dir))
    return opened.select("request_code", F.lit("open").alias("side")).unionByName(
        closed.select("request_code", F.lit("closed").alias("side"))
    )


@query(
    "anti_key",
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)",
)
def anti_key(spark, sf_dir):
    large = V.table(spark, sf_dir, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return V.table(spark, sf_dir, "customer").join(large, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query(
    "semi_key",
    "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)",
)
def semi_key(spark, sf_dir):
    large = V.table(spark, sf_dir, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return V.table(spark, sf_dir, "customer").join(large, "c_custkey", "left_semi").select("c_custkey", "c_name")


# ---- row rules -------------------------------------------------------------------


@query(
    "required_positions",
    _sql("SELECT request_code, CASE WHEN required_positions > positions_filled THEN required_positions ELSE positions_filled END AS required FROM requests"),
)
def required_positions(spark, sf_dir):
    rule = rules.required_positions(F.col("required_positions"), F.col("positions_filled"))
    return V.requests(spark, sf_dir).select("request_code", rule.alias("required"))


@query("coverage_rate", _sql("SELECT request_code, positions_filled::DOUBLE / nullif(required_positions, 0) AS coverage FROM requests"))
def coverage_rate(spark, sf_dir):
    rate = rules.coverage_rate(F.col("positions_filled"), F.col("required_positions"))
    return V.requests(spark, sf_dir).select("request_code", rate.alias("coverage"))


@query("clamp", _sql("SELECT request_code, CASE WHEN tech_hours < 0 THEN 0.0::DOUBLE ELSE tech_hours END AS hours FROM requests"))
def clamp(spark, sf_dir):
    return V.requests(spark, sf_dir).select("request_code", rules.clamp_negative(F.col("tech_hours")).alias("hours"))


@query("status_rules", _sql("SELECT request_code, rule_status FROM ruled", V.CLEANED_SQL))
def status_rules(spark, sf_dir):
    rows = filters.without_values(
        filters.recent(V.requests(spark, sf_dir), V.AS_OF, V.CONF.model_days), "status", S.IGNORED_STATUSES
    )
    filled = F.col("positions_filled")
    coverage = rules.coverage_rate(filled, rules.required_positions(F.col("required_positions"), filled))
    return rows.select("request_code", rules.settled_status(F.col("status"), filled, coverage).alias("rule_status"))


@query("forced_close", _sql("SELECT request_code, status FROM forced", V.CLEANED_SQL))
def forced_close(spark, sf_dir):
    return cleaning.settle(V.requests(spark, sf_dir), V.CONF).select("request_code", "status")


@query("duration_days", _sql("SELECT request_code, duration FROM cleaned", V.CLEANED_SQL))
def duration_days(spark, sf_dir):
    return V.prepared(spark, sf_dir).select("request_code", "duration")


@query("target_label", _sql("SELECT request_code, target FROM cleaned", V.CLEANED_SQL))
def target_label(spark, sf_dir):
    return V.prepared(spark, sf_dir).select("request_code", "target")


@query(
    "job_level_band",
    _sql("""SELECT request_code, CASE WHEN job_level <= 5 THEN 'high_level' WHEN job_level BETWEEN 6 AND 9 THEN 'senior'
      WHEN job_level >= 10 THEN 'junior' ELSE '0' END AS band FROM requests"""),
)
def job_level_band(spark, sf_dir):
    return V.requests(spark, sf_dir).select("request_code", rules.job_level_band(F.col("job_level")).alias("band"))


@query(
    "salary_units",
    _sql("SELECT request_code, CASE WHEN desired_salary >= 5 AND desired_salary < 100 THEN desired_salary * 1000 ELSE desired_salary END AS salary FROM requests"),
)
def salary_units(spark, sf_dir):
    return V.requests(spark, sf_dir).select("request_code", rules.full_salary(F.col("desired_salary")).alias("salary"))


@query(
    "remote_status",
    _sql("""SELECT salary, profile, CASE WHEN remote_percentage = 100 THEN 'Fully Remote'
      WHEN remote_percentage > 0 AND remote_percentage < 100 THEN 'Hybrid' ELSE 'On-site' END AS remote FROM salary""", V.SALARY_SQL),
)
def remote_status(spark, sf_dir):
    return V.salary(spark, sf_dir).select(
        "salary", "profile", rules.remote_status(F.col("remote_percentage")).alias("remote")
    )


@query(
    "salary_ratios",
    _sql("""SELECT request_code, desired_salary / nullif(average_salary, 0) AS ratio,
      desired_salary / nullif(average_salary_12, 0) AS ratio_12,
      CASE WHEN average_salary_12 / nullif(average_salary, 0) > 1 THEN 1 ELSE 0 END AS growth FROM requests"""),
)
def salary_ratios(spark, sf_dir):
    return V.requests(spark, sf_dir).select(
        "request_code",
        F.try_divide("desired_salary", "average_salary").alias("ratio"),
        F.try_divide("desired_salary", "average_salary_12").alias("ratio_12"),
        rules.growth_flag(F.col("average_salary_12"), F.col("average_salary")).alias("growth"),
    )


@query(
    "prob_category",
    _sql("""SELECT request_code,
      CASE WHEN consolidation_probability >= 75 THEN 1 WHEN consolidation_probability >= 40 THEN 0 ELSE -1 END AS consolidation,
      CASE WHEN coverage_probability >= 75 THEN 1 WHEN coverage_probability >= 40 THEN 0 ELSE -1 END AS coverage FROM requests"""),
)
def prob_category(spark, sf_dir):
    return V.requests(spark, sf_dir).select(
        "request_code",
        rules.probability_band(F.col("consolidation_probability")).alias("consolidation"),
        rules.probability_band(F.col("coverage_probability")).alias("coverage"),
    )


@query(
    "mixed_prob",
    _sql("""SELECT request_code, CASE WHEN coverage_probability >= 75 AND consolidation_probability >= 75 THEN 2
      WHEN coverage_probability >= 75 OR consolidation_probability >= 75 THEN 1
      WHEN coverage_probability <= 30 AND consolidation_probability <= 30 THEN -1 ELSE 0 END AS mixed FROM requests"""),
)
def mixed_prob(spark, sf_dir):
    band = rules.mixed_band(F.col("coverage_probability"), F.col("consolidation_probability"))
    return V.requests(spark, sf_dir).select("request_code", band.alias("mixed"))


@query(
    "multi_resources",
    _sql("SELECT request_code, CASE WHEN required_positions > 1 THEN 1 WHEN required_positions = 1 THEN 0 ELSE -1 END AS several FROM requests"),
)
def multi_resources(spark, sf_dir):
    return V.requests(spark, sf_dir).select(
        "request_code", rules.several_positions(F.col("required_positions")).alias("several")
    )


@query(
    "equality_flags",
    _sql("""SELECT request_code, CAST(rate_type IS NOT DISTINCT FROM 'Negotiated Rate' AS INTEGER) AS negotiated,
      CAST(remote_work IS NOT DISTINCT FROM '100% Remote' AS INTEGER) AS full_remote,
      CAST(languages IS NOT DISTINCT FROM 'English' AS INTEGER) AS english_only FROM requests"""),
)
def equality_flags(spark, sf_dir):
    return V.requests(spark, sf_dir).select(
        "request_code",
        rules.equals_flag(F.col("rate_type"), S.NEGOTIATED_RATE).alias("negotiated"),
        rules.equals_flag(F.col("remote_work"), S.FULL_REMOTE_REQUEST).alias("full_remote"),
        rules.equals_flag(F.col("languages"), "English").alias("english_only"),
    )


@query(
    "fill_constant",
    _sql("SELECT request_code, coalesce(work_area, 'Any location') AS work_area, coalesce(languages, 'No') AS languages FROM requests"),
)
def fill_constant(spark, sf_dir):
    filled = {"work_area": S.ANY_LOCATION, "languages": S.NO_LANGUAGE}
    return V.requests(spark, sf_dir).select("request_code", "work_area", "languages").fillna(filled)


SCALED = ("l_quantity", "l_extendedprice", "l_discount", "one")


@query(
    "minmax_scale",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        f"round(coalesce(({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0), 0), 9) AS {c}"
        for c in SCALED
    )
    + " FROM (SELECT *, 1.0::DOUBLE AS one FROM lineitem)",
)
def minmax_scale(spark, sf_dir):
    rows = V.table(spark, sf_dir, "lineitem").withColumn("one", F.lit(1.0))
    scaled = scaling.scale_columns(rows, ["l_orderkey", "l_linenumber"], scaling.fit_bounds(rows, SCALED))
    return scaled.select("l_orderkey", "l_linenumber", *[F.round(c, 9).alias(c) for c in SCALED])


def _scored(spark, sf_dir):
    """Open requests with a probability taken from a digest of their key."""
    opened, _ = filters.split_by_target(V.prepared(spark, sf_dir))
    share = hash_percent(F.col("request_code")) / 100
    return opened.select(
        "request_code",
        "tech_hours",
        F.col("applicant_tenure"),
        share.alias("probability"),
        (share >= 0.5).cast("int").alias("prediction"),
    )


SCORED_SQL = V.CLEANED_SQL + """,
scored AS (
  SELECT *, CAST(CAST('0x' || substr(md5(request_code), 1, 8) AS BIGINT) % 100 AS DOUBLE) / 100 AS probability
  FROM cleaned WHERE target = -1
)"""


@query(
    "output_table",
    _sql("""SELECT request_code, priority, region, required_positions, desired_salary,
      CAST(probability >= 0.5 AS INTEGER) AS prediction, probability, CAST(NULL AS DOUBLE) AS probability_80,
      CAST(NULL AS DOUBLE) AS salary_80, 0.67::DOUBLE AS roc_auc, '2001-08-02' AS insertion_date,
      '{"tech_hours":' || CAST(tech_hours AS VARCHAR) || ',"applicant_tenure":' || CAST(applicant_tenure AS VARCHAR) || '}' AS relevant_features,
      '1.0' AS model_version, probability AS recalculated_probability, FALSE AS pending_update FROM scored""", SCORED_SQL),
)
def output_table(spark, sf_dir):
    made = prediction_table(
        _scored(spark, sf_dir), V.prepared(spark, sf_dir), V.AS_OF, 0.6712, ["tech_hours", "applicant_tenure"]
    )
    return made.withColumn("insertion_date", text.iso_day(F.col("insertion_date")))


@query(
    "relevant_features",
    """SELECT l_orderkey, l_linenumber, '{"l_quantity":' || CAST(l_quantity AS VARCHAR) || ',"l_linenumber":'
       || CAST(CAST(l_linenumber AS DOUBLE) AS VARCHAR) || '}' AS relevant_features FROM lineitem""",
)
def relevant_features(spark, sf_dir):
    return V.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", text.feature_map(["l_quantity", "l_linenumber"]).alias("relevant_features")
    )


# ---- strings, lists, dates -------------------------------------------------------


def fold_sql(column: str) -> str:
    folded = f"strip_accents(lower(coalesce({column}, '')))"
    for letter, spelling in text.SPELLED_OUT.items():
        folded = f"replace({folded}, '{letter}', '{spelling}')"
    return folded


@query("fold_text", f"SELECT doc_id, {fold_sql('text')} AS folded FROM documents")
def fold_text(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select("doc_id", text.fold_text(F.col("text")).alias("folded"))


@query("profile_clean", _sql("SELECT DISTINCT profile AS cleaned FROM levelled", V.SALARY_LEVELS_SQL))
def profile_clean(spark, sf_dir):
    rows = filters.latest_rows(V.salary(spark, sf_dir)).filter("salary > 0")
    return rows.select(text.clean_profile(F.col("profile")).alias("cleaned")).distinct()


@query(
    "count_delims",
    _sql("SELECT request_code, CAST(len(string_split(hr_manager, '|')) AS INTEGER) AS managers, CAST(len(string_split(hr_manager, '|')) > 1 AS INTEGER) AS several FROM requests"),
)
def count_delims(spark, sf_dir):
    managers = F.col("hr_manager")
    return V.requests(spark, sf_dir).select(
        "request_code", text.count_values(managers).alias("managers"), text.several_values(managers).alias("several")
    )


@query(
    "num_languages",
    _sql("""SELECT request_code, CAST(CASE WHEN languages IS NULL THEN 0
      ELSE len(string_split(languages, '|')) END AS INTEGER) AS n, coalesce(languages, 'No') AS languages FROM requests"""),
)
def num_languages(spark, sf_dir):
    listed = F.col("languages")
    return V.requests(spark, sf_dir).select(
        "request_code", text.count_values(listed).alias("n"), F.coalesce(listed, F.lit(S.NO_LANGUAGE)).alias("languages")
    )


@query(
    "explode_values",
    _sql("SELECT request_code, trim(unnest(string_split(coalesce(languages, 'No'), '|'))) AS language FROM requests"),
)
def explode_values(spark, sf_dir):
    return encoding.explode_values(V.requests(spark, sf_dir), "request_code", "languages", "language", S.NO_LANGUAGE)


ZONE_SQL = (
    "coalesce(list_filter(list_transform(regexp_split_to_array(lower(coalesce(work_area, 'Any location')), '\\s+'), "
    "lambda w: CASE w "
    + " ".join(f"WHEN '{word}' THEN '{zone}'" for word, zone in S.WORK_ZONES.items())
    + " END), lambda z: z IS NOT NULL)[1], 'Other')"
)


@query("map_first_token", _sql(f"SELECT request_code, {ZONE_SQL} AS zone FROM requests"))
def map_first_token(spark, sf_dir):
    return V.requests(spark, sf_dir).select("request_code", text.work_zone(F.col("work_area")).alias("zone"))


@query("month_name", _sql("SELECT request_code, monthname(closure_date) AS month FROM requests"))
def month_name(spark, sf_dir):
    return V.requests(spark, sf_dir).select("request_code", text.month_name(F.col("closure_date")).alias("month"))


@query(
    "early_request",
    _sql("""SELECT request_code, CAST(request_creation_date < need_date AS INTEGER) AS early,
      CAST(need_date - request_creation_date AS INTEGER) AS days,
      CAST(sign(need_date - request_creation_date) AS INTEGER) AS side FROM requests"""),
)
def early_request(spark, sf_dir):
    created, needed = F.col("request_creation_date"), F.col("need_date")
    return V.requests(spark, sf_dir).select(
        "request_code",
        text.early_flag(created, needed).alias("early"),
        F.datediff(needed, created).alias("days"),
        text.lead_sign(created, needed).alias("side"),
    )


@query(
    "parse_dates",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
       CAST(try_cast(left(o_orderpriority, 10) AS DATE) AS VARCHAR) AS none FROM orders""",
)
def parse_dates(spark, sf_dir):
    stamp = F.col("o_orderdate").cast("string")
    return V.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.iso_day(text.to_day(stamp)).alias("day"),
        text.iso_day(text.to_day(F.col("o_orderpriority"))).alias("none"),
    )
