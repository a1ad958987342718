"""Checks of joins, aggregations, bins, encoders, selection, outliers and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.registry import query
from checks.rows import ZONE_SQL, fold_sql
from checks.stop_words import STOP_WORDS
from staffcast import settings as S
from staffcast.functions import rules, text
from staffcast.functions.wide import double_array
from staffcast.operators import (
    binning, correlation, encoding, fallback, near_search, outliers, profile, quantiles, rates, sampling, shares,
    training, upsert,
)
from staffcast.plans import features as P
from staffcast.staging import stage


def _sql(select, *ctes):
    return V.with_ctes(*(ctes or (V.REQUESTS_SQL,)), select=select)


# ---- shares, rates, medians ------------------------------------------------------


@query(
    "value_shares",
    "SELECT source, count(*) AS n, count(*)::DOUBLE / (SELECT count(source) FROM documents) AS share FROM documents WHERE source IS NOT NULL GROUP BY source",
)
def value_shares(spark, sf_dir):
    return shares.value_shares(V.table(spark, sf_dir, "documents"), "source")


@query("distinct_values", _sql("SELECT DISTINCT client_code FROM requests"))
def distinct_values(spark, sf_dir):
    return shares.distinct_values(V.requests(spark, sf_dir), "client_code")


def _rare_sql(column: str, percent: float, source: str) -> str:
    return (
        f"CASE WHEN {column} IN (SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} "
        f"HAVING count(*)::DOUBLE / (SELECT count({column}) FROM {source}) * 100 >= {percent}) THEN {column} ELSE 'Other' END"
    )


def _rare_query(region, job_role, zone):
    return _sql(
        f"SELECT request_code, {_rare_sql('region', region, 'zoned')} AS region, {_rare_sql('job_role', job_role, 'zoned')} AS job_role, "
        f"CASE WHEN {_rare_sql('zone', zone, 'zoned')} = 'Any location' THEN 'Any location' ELSE 'Localized' END AS zone FROM zoned",
        V.ELIGIBLE_SQL + f", zoned AS (SELECT *, {ZONE_SQL} AS zone FROM eligible)",
    )


@query("group_rare_defaults", _rare_query(V.CONF.region_percent, V.CONF.role_percent, V.CONF.zone_percent))
def group_rare_defaults(spark, sf_dir):
    return _grouped(spark, sf_dir, V.CONF.region_percent, V.CONF.role_percent, V.CONF.zone_percent)


@query("group_rare", _rare_query(4, 16.6, 2))
def group_rare(spark, sf_dir):
    return _grouped(spark, sf_dir, 4, 16.6, 2)


def _grouped(spark, sf_dir, region, job_role, zone):
    rows = V.eligible(spark, sf_dir).withColumn("zone", text.work_zone(F.col("work_area")))
    kept = shares.frequent_values(rows, {"region": region, "job_role": job_role, "zone": zone})
    zone = shares.group_rare(F.col("zone"), kept["zone"])
    return rows.select(
        "request_code",
        shares.group_rare(F.col("region"), kept["region"]).alias("region"),
        shares.group_rare(F.col("job_role"), kept["job_role"]).alias("job_role"),
        F.when(zone == S.ANY_LOCATION, zone).otherwise(S.LOCALIZED).alias("zone"),
    )


def _rate_ctes(columns) -> str:
    parts = []
    for c in columns:
        parts.append(
            f"""rate_{c} AS (SELECT {c} AS v, count(*) FILTER (WHERE target = 1)::DOUBLE / count(*) * 100 AS rate FROM cleaned
              WHERE client_code IS NOT NULL AND {c} IS NOT NULL GROUP BY {c}
              HAVING count(*) >= 5 AND count(*) FILTER (WHERE target = 1) > 0),
            good_{c} AS (SELECT v FROM rate_{c} WHERE rate >= (SELECT quantile_cont(rate, 0.75) FROM rate_{c}))"""
        )
    return ",".join(parts)


RATED = ("client_code", "sales_agent", "hr_manager")
FAVOURABLE_SQL = _sql(
    "SELECT request_code, "
    + ", ".join(f"CAST({c} IN (SELECT v FROM good_{c}) AS INTEGER) AS {P.RATE_FLAGS[c]}" for c in RATED)
    + " FROM cleaned WHERE client_code IS NOT NULL",
    V.CLEANED_SQL,
    _rate_ctes(RATED),
)


@query("favourable_rate", FAVOURABLE_SQL)
def favourable_rate(spark, sf_dir):
    rows = stage(V.prepared(spark, sf_dir).select("request_code", "target", *RATED), "rated")
    rows = rows.na.drop(subset=["client_code"])
    found = stage(rates.favourable_values(rates.success_rates(rows, RATED)), "favourable")
    flagged = rates.add_favourable_flags(rows, found, P.RATE_FLAGS)
    return flagged.select("request_code", *P.RATE_FLAGS.values())


@query(
    "favourable_clients",
    _sql(
        """SELECT request_code, status, target, coverage_rate,
          CAST(client_code IN (SELECT v FROM good_client_code) AS INTEGER) AS FavorableClient
          FROM cleaned WHERE client_code IS NOT NULL""",
        V.CLEANED_SQL,
        _rate_ctes(["client_code"]),
    ),
)
def favourable_clients(spark, sf_dir):
    """Flagship: cleaning, outcome, success rates, favourable flag."""
    rows = stage(
        V.prepared(spark, sf_dir)
        .na.drop(subset=["client_code"])
        .select("request_code", "client_code", "status", "target", "coverage_rate"),
        "flagship",
    )
    found = stage(rates.favourable_values(rates.success_rates(rows, ["client_code"])), "favourable")
    flagged = rates.add_favourable_flags(rows, found, {"client_code": "FavorableClient"})
    return flagged.select("request_code", "status", "target", "coverage_rate", "FavorableClient")


@query("group_median", _sql("SELECT region, median(community_tech_hours) AS hours FROM requests WHERE region IS NOT NULL GROUP BY region"))
def group_median(spark, sf_dir):
    return fallback.group_median(V.requests(spark, sf_dir), "region", "community_tech_hours", "hours")


@query(
    "default_fill",
    """WITH known AS (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS v FROM events),
    medians AS (SELECT user_id, median(v) AS m FROM known WHERE v IS NOT NULL GROUP BY user_id)
    SELECT event_id, coalesce(v, m, 0) AS value FROM known LEFT JOIN medians USING (user_id)""",
)
def default_fill(spark, sf_dir):
    known = V.table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    medians = stage(fallback.group_median(known, "user_id", "value", "median"), "medians")
    return fallback.fill_default(known, medians, "user_id", "value", "median").select("event_id", "value")


def _level_ctes(name: str, source: str, levels, value: str, where: str) -> str:
    parts = []
    for i, level in enumerate(levels):
        keys = ", ".join(level)
        complete = " AND ".join(f"{k} IS NOT NULL" for k in level)
        parts.append(
            f"{name}{i} AS (SELECT {keys}, median({value}) AS m FROM {source} WHERE {where} AND {complete} GROUP BY {keys})"
        )
    return ", ".join(parts)


def _level_joins(name: str, levels, spelled=None) -> str:
    spelled = spelled or {}
    joins = []
    for i, level in enumerate(levels):
        on = " AND ".join(f"{name}{i}.{k} = {spelled.get(k, 'e.' + k)}" for k in level)
        joins.append(f"LEFT JOIN {name}{i} ON {on}")
    return "\n".join(joins)


def _first_level(name: str, own: str) -> str:
    return f"coalesce({own}, " + ", ".join(f"{name}{i}.m" for i in range(4)) + ")"


SPELLED = {
    "profile": "e.job_role",
    "remote": "CASE WHEN e.remote_work = '100% Remote' THEN 'Fully Remote' ELSE e.remote_work END",
}
FILLED_SQL = V.with_ctes(
    V.ELIGIBLE_SQL,
    V.SALARY_LEVELS_SQL,
    _level_ctes("usual", "levelled", S.SALARY_LEVELS, "salary", "band = 'settled'"),
    _level_ctes("fresh", "levelled", S.SALARY_LEVELS, "salary", "band = 'new'"),
    _level_ctes("consol", "eligible", S.CONSOLIDATION_LEVELS, "consolidation_probability", "consolidation_probability >= 0"),
    _level_ctes("cover", "eligible", S.COVERAGE_LEVELS, "coverage_probability", "coverage_probability >= 0"),
    f"""priced AS (
      SELECT e.*, {_first_level('usual', 'CASE WHEN average_salary > 0 THEN average_salary END')} AS ProfileAvgSalary,
        {_first_level('fresh', 'CASE WHEN average_salary_12 > 0 THEN average_salary_12 END')} AS ProfileAvgSalary12
      FROM eligible e
      {_level_joins('usual', S.SALARY_LEVELS, SPELLED)}
      {_level_joins('fresh', S.SALARY_LEVELS, SPELLED)}
    )""",
    f"""filled AS (
      SELECT e.*, {_first_level('consol', 'CASE WHEN consolidation_probability >= 0 THEN consolidation_probability END')} AS ApplicantProbability,
        {_first_level('cover', 'CASE WHEN coverage_probability >= 0 THEN coverage_probability END')} AS TechProbability,
        RequestSalary / nullif(ProfileAvgSalary, 0) AS DesiredSalaryRatio, RequestSalary / nullif(ProfileAvgSalary12, 0) AS DesiredSalaryRatio12
      FROM priced e
      {_level_joins('consol', S.CONSOLIDATION_LEVELS)}
      {_level_joins('cover', S.COVERAGE_LEVELS)}
    )""",
    select="",
)


@query("median_fallback_salary", FILLED_SQL + "SELECT request_code, ProfileAvgSalary, ProfileAvgSalary12 FROM filled")
def median_fallback_salary(spark, sf_dir):
    medians = stage(P.salary_medians(V.salary(spark, sf_dir)), "salary_medians")
    rows = P.fill_salaries(V.eligible(spark, sf_dir), medians)
    return rows.select("request_code", "ProfileAvgSalary", "ProfileAvgSalary12")


@query("median_fallback_consol", FILLED_SQL + "SELECT request_code, ApplicantProbability FROM filled")
def median_fallback_consol(spark, sf_dir):
    rows, source = V.eligible(spark, sf_dir), "consolidation_probability"
    medians = stage(P.probability_medians(rows, source, S.CONSOLIDATION_LEVELS), "consolidation")
    filled = P.fill_probability(rows, medians, S.CONSOLIDATION_LEVELS, source, "ApplicantProbability")
    return filled.select("request_code", "ApplicantProbability")


@query("median_fallback_cover", FILLED_SQL + "SELECT request_code, TechProbability FROM filled")
def median_fallback_cover(spark, sf_dir):
    rows, source = V.eligible(spark, sf_dir), "coverage_probability"
    medians = stage(P.probability_medians(rows, source, S.COVERAGE_LEVELS), "coverage")
    filled = P.fill_probability(rows, medians, S.COVERAGE_LEVELS, source, "TechProbability")
    return filled.select("request_code", "TechProbability")


@query(
    "neg_corr_flag",
    _sql(
        """SELECT request_code, coalesce((SELECT CAST(coalesce(m1, m0) < coalesce(m0, m1) AS INTEGER) FROM means WHERE means.job_role = e.job_role), 0) AS neg_corr
           FROM eligible e""",
        V.ELIGIBLE_SQL,
        """means AS (SELECT job_role, avg(RequestSalary) FILTER (WHERE target = 0) AS m0, avg(RequestSalary) FILTER (WHERE target = 1) AS m1
           FROM eligible WHERE target <> -1 GROUP BY job_role)""",
    ),
)
def neg_corr_flag(spark, sf_dir):
    rows = V.eligible(spark, sf_dir)
    effect = stage(profile.negative_salary_effect(rows, "job_role", "RequestSalary"), "effect")
    flagged = P.fallback.lookup_join(rows, effect.select("job_role", "neg_corr"), ["job_role"])
    return flagged.select("request_code", F.coalesce("neg_corr", F.lit(0)).alias("neg_corr"))


@query("etl_initial", _sql("SELECT * FROM cleaned", V.CLEANED_SQL))
def etl_initial(spark, sf_dir):
    """All columns of the cleaned requests with their outcome."""
    return V.prepared(spark, sf_dir)


# ---- quantiles and bins ----------------------------------------------------------

MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


QUANTILE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS name, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
    f"round(quantile_cont({c}, 0.75), 6) AS q75 FROM lineitem"
    for c in MEASURES
)


def _quantiles(spark, sf_dir, state_rows):
    cells = V.table(spark, sf_dir, "lineitem").select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("x")) for c in MEASURES]))
    )
    found = quantiles.group_quantiles(cells, ["name"], "x", [0.25, 0.5, 0.75], state_rows)
    return found.select("name", *[F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(("q25", "q50", "q75"))])


@query("quantile", QUANTILE_SQL)
def quantile(spark, sf_dir):
    return _quantiles(spark, sf_dir, None)


@query("quantile_narrowed", QUANTILE_SQL)
def quantile_narrowed(spark, sf_dir):
    """All groups by narrowing ranges, as for groups of any size."""
    return _quantiles(spark, sf_dir, 0)


def bin_sql(column: str, parts: int) -> str:
    probs = ", ".join(f"{p:.17e}" for p in binning.bin_probs(parts))
    edges = f"(SELECT list_distinct(quantile_cont({column}, [{probs}])) FROM filled)"
    return (
        f"CASE WHEN {column} IS NOT NULL AND len({edges}) > 1 THEN "
        f"CAST(greatest(0, len(list_filter({edges}, lambda v: v < {column})) - 1) AS INTEGER) END"
    )


BIN_CHECKS = {
    "qcut_salary": "RequestSalary",
    "qcut_med": "ProfileAvgSalary",
    "qcut_med12": "ProfileAvgSalary12",
    "qcut_ratio": "DesiredSalaryRatio",
    "qcut_ratio12": "DesiredSalaryRatio12",
    "qcut_consol": "ApplicantProbability",
    "qcut_cover": "TechProbability",
    "qcut_tech_hours": "tech_hours",
    "qcut_comm_hours": "community_tech_hours",
    "qcut_app_hours": "applicant_tech_hours_12",
    "qcut_app_tenure": "applicant_tenure",
    "qcut_tech_tenure": "tech_tenure",
}


def _filled(spark, sf_dir, column):
    """Eligible rows with the column to bin; fitted tables only where the column needs them."""
    rows = V.eligible(spark, sf_dir)
    if column == "ApplicantProbability":
        medians = P.probability_medians(rows, "consolidation_probability", S.CONSOLIDATION_LEVELS)
        return P.fill_probability(
            rows, stage(medians, "medians"), S.CONSOLIDATION_LEVELS, "consolidation_probability", column
        )
    if column == "TechProbability":
        medians = P.probability_medians(rows, "coverage_probability", S.COVERAGE_LEVELS)
        return P.fill_probability(rows, stage(medians, "medians"), S.COVERAGE_LEVELS, "coverage_probability", column)
    if column.startswith(("Profile", "DesiredSalaryRatio")):
        rows = P.fill_salaries(rows, stage(P.salary_medians(V.salary(spark, sf_dir)), "salary_medians"))
        return rows.withColumns(
            {
                "DesiredSalaryRatio": F.try_divide("RequestSalary", "ProfileAvgSalary"),
                "DesiredSalaryRatio12": F.try_divide("RequestSalary", "ProfileAvgSalary12"),
            }
        )
    return rows


def _bin_check(column):
    names = P.BINS[column]

    def run(spark, sf_dir):
        rows = stage(_filled(spark, sf_dir, column).select("request_code", column), "to_bin")
        edges = binning.fit_edges(rows, {column: list(names)})[column]
        return rows.select(
            "request_code", *[binning.bin_index(F.col(column), edges[n]).alias(name) for n, name in names.items()]
        )

    return run


for _key, _column in BIN_CHECKS.items():
    query(
        _key,
        FILLED_SQL
        + "SELECT request_code, "
        + ", ".join(f"{bin_sql(_column, n)} AS {name}" for n, name in P.BINS[_column].items())
        + " FROM filled",
    )(_bin_check(_column))


# ---- sorts, limits, splits, set operations -----------------------------------------


@query("sort_desc", "SELECT p_partkey, p_retailprice, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1 AS place FROM part")
def sort_desc(spark, sf_dir):
    """Rows in descending order; ``place`` is counted over the sorted partitions, without one task for all."""
    rows = V.table(spark, sf_dir, "part").select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey")
    rows = stage(rows.withColumn("at", F.monotonically_increasing_id()), "sorted")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = {r["part"]: r["n"] for r in rows.groupBy(part.alias("part")).count().withColumnRenamed("count", "n").collect()}
    before, total = [], 0
    for p in sorted(counts):
        before.append((p, total))
        total += counts[p]
    starts = spark.createDataFrame(before, "part long, before long")
    return rows.withColumn("part", part).join(F.broadcast(starts), "part").select("p_partkey", "p_retailprice", (F.col("before") + place).alias("place"))


@query(
    "top_quantile",
    """WITH sold AS (SELECT l_partkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_partkey)
    SELECT * FROM sold WHERE quantity >= (SELECT quantile_cont(quantity, 0.75) FROM sold)""",
)
def top_quantile(spark, sf_dir):
    sold = stage(
        V.table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity")), "sold"
    )
    cut = quantiles.column_quantiles(sold, {"quantity": [0.75]})["quantity"][0]
    return sold.filter(F.col("quantity") >= cut)


@query(
    "hash_split",
    """SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 85
       THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def hash_split(spark, sf_dir):
    train, test = sampling.hash_split(V.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 85)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "union_all",
    """SELECT c_custkey AS k, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier""",
)
def union_all(spark, sf_dir):
    customers = V.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance"))
    suppliers = V.table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("k"))
    return customers.unionByName(suppliers)


@query(
    "union_missing_cols",
    """SELECT c_custkey AS k, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier""",
)
def union_missing_cols(spark, sf_dir):
    customers = V.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = V.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("balance"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query("join_target", _sql("SELECT r.request_code, r.priority, c.target FROM requests r LEFT JOIN cleaned c USING (request_code)", V.CLEANED_SQL))
def join_target(spark, sf_dir):
    targets = V.prepared(spark, sf_dir).select("request_code", "target")
    return V.requests(spark, sf_dir).select("request_code", "priority").join(targets, "request_code", "left")


REQUEST_COLUMNS = (
    "request_code", "status", "request_creation_date", "closure_date", "need_date", "positions_filled", "required_positions",
    "desired_salary", "client_code", "final_client", "sales_agent", "hr_manager", "region", "job_role", "remote_work",
    "rate_type", "request_type", "work_area", "languages", "job_level", "consolidation_probability",
    "coverage_probability", "minimum_requirements", "tech_hours", "community_tech_hours", "applicant_tech_hours_12",
    "applicant_tenure", "tech_tenure", "average_salary", "average_salary_12", "priority", "service_type", "request_difficulty",
)


# ---- reports ---------------------------------------------------------------------


@query(
    "null_profile",
    _sql("SELECT count(*) AS n_rows, " + str(len(REQUEST_COLUMNS)) + " AS n_columns, CAST(sum("
         + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in REQUEST_COLUMNS) + ") AS BIGINT) AS n_missing FROM requests"),
)
def null_profile(spark, sf_dir):
    return profile.null_profile(V.requests(spark, sf_dir))


@query(
    "confusion",
    """SELECT quality AS label, count(*) FILTER (WHERE toxic = 0) AS predicted_0, count(*) FILTER (WHERE toxic = 1) AS predicted_1
       FROM labels GROUP BY quality""",
)
def confusion(spark, sf_dir):
    return profile.confusion(V.table(spark, sf_dir, "labels"), "quality", "toxic")


@query(
    "auc_eval",
    """WITH scored AS (SELECT quality AS label, (doc_id * 37) % 101 AS score FROM labels),
    ranked AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored)
    SELECT count(*) AS n, round((sum(r) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
      / (count(*) FILTER (WHERE label = 1)::DOUBLE * count(*) FILTER (WHERE label = 0)), 8) AS auc FROM ranked""",
)
def auc_eval(spark, sf_dir):
    scored = V.table(spark, sf_dir, "labels").withColumn("score", F.col("doc_id") * 37 % 101)
    area = training.exact_auc(scored, "quality", "score")
    return scored.agg(F.count("*").alias("n"), F.round(F.lit(area), 8).alias("auc"))


@query(
    "class_weights",
    """SELECT doc_id, count(*) OVER ()::DOUBLE / ((SELECT count(DISTINCT quality) FROM labels) * count(*) OVER (PARTITION BY quality)) AS weight FROM labels""",
)
def class_weights(spark, sf_dir):
    return sampling.with_class_weights(V.table(spark, sf_dir, "labels"), "quality").select("doc_id", "weight")


@query(
    "fold_assign",
    """SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1) % 5 AS INTEGER) AS fold FROM orders""",
)
def fold_assign(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.stratified_folds(orders, "o_orderkey", "o_orderstatus", 5)


# ---- encoders --------------------------------------------------------------------


@query(
    "multi_value_counts",
    _sql("""SELECT request_code, language, count(*) AS n FROM
      (SELECT request_code, trim(unnest(string_split(coalesce(languages, 'No'), '|'))) AS language FROM requests) GROUP BY ALL"""),
)
def multi_value_counts(spark, sf_dir):
    return encoding.value_counts_by_key(V.requests(spark, sf_dir), "request_code", "languages", "language", S.NO_LANGUAGE)


LANGUAGES = ("English", "French", "Spanish")


@query(
    "crosstab",
    _sql("SELECT request_code, " + ", ".join(
        f"CAST(coalesce(len(list_filter(string_split(languages, '|'), lambda v: trim(v) = '{v}')), 0) AS INTEGER) AS lang_{v}"
        for v in LANGUAGES) + " FROM requests"),
)
def crosstab(spark, sf_dir):
    rows = V.requests(spark, sf_dir)
    found = encoding.fit_values(rows, "languages")
    columns = encoding.value_columns("languages", found, "lang_")
    return rows.select("request_code", *[c.alias(name) for name, c in columns.items()])


TOKENS_SQL = (
    f"tokens AS (SELECT doc_id, unnest(regexp_extract_all({fold_sql('text')}, '\\w\\w+')) AS term FROM documents), "
    f"words AS (SELECT * FROM tokens WHERE term NOT IN ({', '.join(repr(w) for w in STOP_WORDS)})), "
    "vocabulary AS (SELECT term FROM words GROUP BY term HAVING count(DISTINCT doc_id) >= (SELECT count(*) FROM documents) * 0.05::DOUBLE)"
)


@query(
    "keyword_counts",
    "WITH " + TOKENS_SQL + " SELECT doc_id, term, count(*) AS n FROM words WHERE term IN (SELECT term FROM vocabulary) GROUP BY doc_id, term",
)
def keyword_counts(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    folded, stop = text.fold_text(F.col("text")), encoding.default_stop_words()
    terms = encoding.fit_terms(docs, folded, stop, V.CONF.min_word_share)
    return encoding.term_counts(docs, "doc_id", folded, stop, terms)


@query(
    "merge_terms",
    """WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '\\w\\w+') AS words FROM (SELECT doc_id, text || ' api apis english' AS text FROM documents))
    SELECT doc_id, CAST(len(list_filter(words, lambda w: w IN ('api', 'apis'))) AS INTEGER) AS kw_api_group,
      CAST(len(list_filter(words, lambda w: w = 'english')) AS INTEGER) AS kw_english FROM t""",
)
def merge_terms(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit(" api apis english")).alias("text"))
    made = encoding.add_term_columns(docs, F.lower("text"), [], ["api", "apis", "english"])
    return made.drop("text")


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STATUSES = ("F", "O", "P")


@query(
    "one_hot",
    "SELECT o_orderkey, "
    + ", ".join(f"CAST(o_orderpriority = '{v}' AS INTEGER) AS \"o_orderpriority_{v}\"" for v in PRIORITIES)
    + ", "
    + ", ".join(f"CAST(o_orderstatus = '{v}' AS INTEGER) AS \"o_orderstatus_{v}\"" for v in STATUSES)
    + " FROM orders",
)
def one_hot(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders")
    columns = encoding.one_hot_columns(encoding.fit_categories(orders, ["o_orderpriority", "o_orderstatus"]))
    return orders.select("o_orderkey", *[c.alias(name) for name, c in columns.items()])


@query(
    "one_hot_wide",
    """WITH pairs AS (SELECT DISTINCT unnest(['p_name', 'p_brand']) AS c, unnest([p_name, p_brand]) AS v FROM part),
    places AS (SELECT c, v, row_number() OVER (ORDER BY c COLLATE "C", v COLLATE "C") - 1 AS at FROM pairs WHERE v IS NOT NULL)
    SELECT p_partkey, unnest([n.at, b.at]) AS position FROM part JOIN places n ON n.c = 'p_name' AND n.v = p_name
      JOIN places b ON b.c = 'p_brand' AND b.v = p_brand""",
)
def one_hot_wide(spark, sf_dir):
    """One-hot positions of columns with very many values."""
    part = V.table(spark, sf_dir, "part")
    made = encoding.one_hot_sparse(part, "p_partkey", encoding.fit_index(part, ["p_name", "p_brand"]))
    return made.select("p_partkey", F.explode("positions").alias("position"))


@query("align_columns", "SELECT p_partkey, p_size, 0.0::DOUBLE AS absent, p_retailprice FROM part")
def align_columns(spark, sf_dir):
    return encoding.align_columns(V.table(spark, sf_dir, "part"), ["p_partkey"], ["p_size", "absent", "p_retailprice"])


# ---- correlations and outliers ----------------------------------------------------

NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "late_tax", "one")
NUMBERS_SQL = """numbers AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax,
  CASE WHEN l_linenumber > 2 THEN l_tax * l_quantity END AS late_tax, 1.0::DOUBLE AS one,
  CAST(l_returnflag = 'R' AS INTEGER) AS target FROM lineitem)"""


def _numbers(spark, sf_dir):
    return V.table(spark, sf_dir, "lineitem").select(
        *NUMBERS[:4],
        F.when(F.col("l_linenumber") > 2, F.col("l_tax") * F.col("l_quantity")).alias("late_tax"),
        F.lit(1.0).alias("one"),
        (F.col("l_returnflag") == "R").cast("int").alias("target"),
    )


def _corr_sql(a: str, b: str) -> str:
    # A constant column gives NaN or NULL; both mean that there is no correlation.
    return f"round(CASE WHEN isfinite(corr({a}, {b})) THEN corr({a}, {b}) END, 6)"


@query(
    "target_corr",
    "WITH " + NUMBERS_SQL + " ".join(
        (" UNION ALL " if i else " ") + f"SELECT '{c}' AS name, {_corr_sql(c, 'target')} AS r FROM numbers"
        for i, c in enumerate((*NUMBERS, "target"))
    ),
)
def target_corr(spark, sf_dir):
    found = correlation.target_correlations(_numbers(spark, sf_dir), NUMBERS, "target")
    return found.select("name", F.round("r", 6).alias("r"))


@query(
    "corr_matrix",
    "WITH " + NUMBERS_SQL + " " + " UNION ALL ".join(
        f"SELECT '{a}' AS first, '{b}' AS second, {_corr_sql(a, b)} AS r FROM numbers"
        for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:]
    ),
)
def corr_matrix(spark, sf_dir):
    return correlation.correlation_table(_numbers(spark, sf_dir), NUMBERS).withColumn("r", F.round("r", 6))


LOF_SQL = """WITH p AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    ranked AS (SELECT a.vec_id AS i, b.vec_id AS j, list_distance(a.v, b.v) AS d,
      row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS n
      FROM p a JOIN p b ON a.vec_id <> b.vec_id),
    near AS (SELECT i, j, d FROM ranked WHERE n <= 7),
    far AS (SELECT i, max(d) AS k FROM near GROUP BY i),
    density AS (SELECT near.i, 1 / (avg(greatest(d, k)) + 1e-10) AS lrd FROM near JOIN far ON far.i = near.j GROUP BY near.i)
    SELECT near.i AS vec_id, round(avg(o.lrd) / any_value(s.lrd), 6) AS lof, CAST(avg(o.lrd) / any_value(s.lrd) > 1.5 AS INTEGER) AS outlier
    FROM near JOIN density o ON o.i = near.j JOIN density s ON s.i = near.i GROUP BY near.i"""


def _lof(spark, sf_dir, search):
    found = outliers.local_outlier_factor(V.table(spark, sf_dir, "embeddings"), "vec_id", F.col("embedding"), 7, search=search)
    return found.select("vec_id", F.round("lof", 6).alias("lof"), (F.col("lof") > 1.5).cast("int").alias("outlier"))


@query("lof", LOF_SQL)
def lof(spark, sf_dir):
    return _lof(spark, sf_dir, "exact")


@query("lof_hashes", LOF_SQL)
def lof_hashes(spark, sf_dir):
    """Neighbours by random hashes: all of them up to the size of a block, most of them beyond."""
    return _lof(spark, sf_dir, "hashes")


@query(
    "lof_recall",
    _sql(
        """SELECT 'embeddings' AS points, count(DISTINCT embedding) AS vectors, true AS enough FROM embeddings
           UNION ALL SELECT 'requests', count(*), true FROM (SELECT DISTINCT coalesce(CAST(required_positions AS DOUBLE), 0),
             coalesce(CAST(RequestSalary AS DOUBLE), 0), coalesce(CAST(tech_hours AS DOUBLE), 0), coalesce(CAST(job_level AS DOUBLE), 0),
             coalesce(CAST(tech_tenure AS DOUBLE), 0) FROM eligible WHERE target <> -1)""",
        V.ELIGIBLE_SQL,
    ),
)
def lof_recall(spark, sf_dir):
    """Whether blocks of 100 rows, far fewer than there are, find nine tenths of the seven nearest that the exact search finds."""
    closed = V.eligible(spark, sf_dir).filter("target <> -1")
    numbers = double_array(["required_positions", "RequestSalary", "tech_hours", "job_level", "tech_tenure"], "0.0D")
    embeddings = V.table(spark, sf_dir, "embeddings")
    rows = []
    for name, df, key, vector in (("embeddings", embeddings, "vec_id", F.col("embedding")), ("requests", closed, "request_code", numbers)):
        points = df.select(F.col(key).alias("id"), vector.cast("array<double>").alias("v"))
        copies, residents = outliers.distinct_vectors(points, 7)
        try:
            found, _ = near_search.nearest_by_hashes(residents, 7, block_rows=100)
        except near_search.NotFound as short:
            # What was found is judged all the same.
            found = short.found
        share = near_search.recall(found, stage(outliers.nearest(residents, 7), "exact"))
        rows.append((name, copies.count(), share >= 0.9))
    return spark.createDataFrame(rows, "points string, vectors long, enough boolean")


# ---- upserts -----------------------------------------------------------------------

LAST_SQL = """SELECT user_id, last(event_type ORDER BY ts, event_id) AS event_type,
  last(value ORDER BY ts, event_id) FILTER (WHERE event_type <> 'error') AS value FROM events WHERE {} GROUP BY user_id"""


@query(
    "upsert_coalesce",
    f"""WITH old AS ({LAST_SQL.format("ts < TIMESTAMP '2024-01-16'")}), new AS ({LAST_SQL.format("ts >= TIMESTAMP '2024-01-16'")})
    SELECT coalesce(new.user_id, old.user_id) AS user_id, coalesce(new.event_type, old.event_type) AS event_type,
      coalesce(new.value, old.value) AS value FROM old FULL OUTER JOIN new ON old.user_id = new.user_id""",
)
def upsert_coalesce(spark, sf_dir):
    """The second half of the events put over the state after the first half."""
    events = V.table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))

    def state(rows):
        return upsert.fold_events(rows, "user_id", ["ts", "event_id"], ["event_type", "value"])

    middle = F.lit("2024-01-16").cast("timestamp")
    return upsert.coalescing_upsert(
        state(events.filter(F.col("ts") < middle)), state(events.filter(F.col("ts") >= middle)), "user_id"
    )


DEFAULTS_SQL = "".join(
    f", med_{c} AS (SELECT {k} AS g, median({c}) AS m FROM requests WHERE request_creation_date < DATE '2001-01-01' AND {k} IS NOT NULL GROUP BY {k})"
    for c, k in upsert.DEFAULT_MEDIANS.items()
)


@query(
    "new_defaults",
    _sql(
        "SELECT request_code, status, positions_filled, "
        + ", ".join(
            f"coalesce(CASE WHEN request_difficulty < 2 THEN {c} END, med_{c}.m, 0) AS {c}" for c in upsert.DEFAULT_MEDIANS
        )
        + " FROM requests "
        + " ".join(f"LEFT JOIN med_{c} ON med_{c}.g = requests.{k}" for c, k in upsert.DEFAULT_MEDIANS.items())
        + " WHERE request_creation_date >= DATE '2001-01-01'",
        V.REQUESTS_SQL + DEFAULTS_SQL,
    ),
)
def new_defaults(spark, sf_dir):
    """Requests of 2001 lacking some fields, completed from the earlier ones."""
    rows = V.requests(spark, sf_dir)
    known, new = rows.filter("request_creation_date < '2001-01-01'"), rows.filter("request_creation_date >= '2001-01-01'")
    partial = new.withColumns(
        {c: F.when(F.col("request_difficulty") < 2, F.col(c)) for c in upsert.DEFAULT_MEDIANS}
    ).withColumn("change_date", F.lit(None).cast("date"))
    done = upsert.new_request_defaults(partial, upsert.default_medians(known), V.AS_OF)
    return done.select("request_code", "status", "positions_filled", *upsert.DEFAULT_MEDIANS)
