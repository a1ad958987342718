"""Features of requests: fit the small tables on the data, then apply them to any rows.

``fit`` stages the cleaned rows once, then reads them column by column. What it learns is either a
bounded list of numbers and names (kept in the model and applied as literals) or a table (kept as
Parquet and applied by a size-checked join).
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staffcast import settings as S
from staffcast.functions import rules, text
from staffcast.operators import binning, encoding, fallback, filters, profile, rates, shares, sparse
from staffcast.plans.cleaning import clean_requests, clean_salary
from staffcast.settings import Settings
from staffcast.staging import lookup_join, spread, stage

KEY = "request_code"

# Flag of each column with success rates (fixed names).
RATE_FLAGS = {
    "client_code": "FavorableClient",
    "sales_agent": "CommercialFavorable",
    "hr_manager": "ResponsibleFavorable",
}
# Source column -> {number of parts: output column} (fixed names).
BINS = {
    "RequestSalary": {4: "SalaryQuartile", 10: "SalaryDecile"},
    "ProfileAvgSalary": {4: "SalaryMedQuartile", 10: "SalaryMedDecile"},
    "ProfileAvgSalary12": {4: "SalaryMed12Quartile", 10: "SalaryMed12Decile"},
    "DesiredSalaryRatio": {4: "SalaryRatioQuartile", 10: "SalaryRatioDecile"},
    "DesiredSalaryRatio12": {4: "SalaryRatio12Quartile", 10: "SalaryRatio12Decile"},
    "ApplicantProbability": {4: "ConsolProbQuartile"},
    "TechProbability": {4: "CoverageProbQuartile"},
    "tech_hours": {4: "TechHoursQuartile"},
    "community_tech_hours": {4: "CommunityTechHoursQuartile", 10: "CommunityTechHoursDecile"},
    "applicant_tech_hours_12": {4: "ApplicantTechHours12Quartile", 10: "ApplicantTechHours12Decile"},
    "applicant_tenure": {4: "ApplicantTenureQuartile", 10: "ApplicantTenureDecile"},
    "tech_tenure": {4: "TechTenureQuartile", 10: "TechTenureDecile"},
}
# Columns that only serve to compute others (fixed names).
SPENT = (
    "minimum_requirements", "client_code", "sales_agent", "hr_manager", "languages",
    "desired_salary", "average_salary", "average_salary_12", "consolidation_probability",
    "coverage_probability", "rate_type", "region", "job_role",
    "request_creation_date", "need_date", "work_area", "community_tech_hours",
    "applicant_tech_hours_12", "applicant_tenure", "tech_tenure",
)
# Columns that are features themselves (fixed names).
DIRECT = ("required_positions", "priority", "service_type", "remote_work", "tech_hours", "request_difficulty", "job_level")
SOURCES = (*DIRECT, *SPENT, "target")
# Columns with lists of values, by the prefix of what they encode to.
LISTS = {"kw": "_keywords", "lang": "_languages"}
# Salary-dependent columns that models do not see (fixed names).
SALARY_DEPENDENT = (
    "RequestSalary", "SalaryQuartile", "SalaryDecile", "DesiredSalaryRatio", "DesiredSalaryRatio12", "neg_corr",
)


@dataclass
class FeatureModel:
    """Everything learnt from the fitting data."""

    settings: Settings
    stop_words: list[str] = field(default_factory=list)
    terms: list[str] = field(default_factory=list)
    edges: dict = field(default_factory=dict)
    frequent: dict = field(default_factory=dict)
    negative_roles: list[str] = field(default_factory=list)
    numbers: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    width: int = 0
    tables: dict[str, DataFrame] = field(default_factory=dict)

    # ---- applying ------------------------------------------------------------

    def eligible(self, cleaned: DataFrame) -> DataFrame:
        """Cleaned rows that have a client, a job level and a plausible salary."""
        rows = cleaned.select(KEY, *SOURCES).na.drop(subset=["client_code"])
        return plausible(rows)

    def fill(self, eligible: DataFrame) -> DataFrame:
        """Join the fitted tables: favourable flags, salaries and probabilities with fallback."""
        rows = rates.add_favourable_flags(eligible, self.tables["favourable"], RATE_FLAGS)
        return _derive_filled(
            rows, self.tables["salary_medians"], self.tables["consolidation_medians"], self.tables["coverage_medians"]
        )

    def describe(self, filled: DataFrame) -> DataFrame:
        """All features before encoding, keywords and languages as lists; projections only."""
        spoken = F.filter(text.split_values(F.col("languages")), lambda v: v != S.NO_LANGUAGE)
        folded = text.fold_text(F.col("minimum_requirements"))
        rows = filled.withColumns({"_keywords": encoding.merged_terms(folded, self.stop_words, self.terms), "_languages": spoken})
        rows = rows.withColumns(_row_features())
        bins = {
            name: binning.bin_index(F.col(column), self.edges[column][parts])
            for column, by_parts in BINS.items()
            for parts, name in by_parts.items()
        }
        rows = rows.withColumns(bins)
        zone = shares.group_rare(F.col("work_zone"), self.frequent["work_zone"])
        rows = rows.withColumns(
            {
                "GroupedRegion": shares.group_rare(F.col("region"), self.frequent["region"]),
                "GroupedPosition": shares.group_rare(F.col("job_role"), self.frequent["job_role"]),
                "GroupedWorkZone": F.when(zone == S.ANY_LOCATION, zone).otherwise(S.LOCALIZED),
            }
        )
        negative = F.col("GroupedPosition").isin(*self.negative_roles) if self.negative_roles else F.lit(False)
        return rows.withColumn("neg_corr", negative.cast("int")).drop("work_zone", *SPENT)

    def encode(self, described: DataFrame) -> DataFrame:
        """Cells ``request_code, target, position, value`` of number columns, keywords, languages and categories."""
        return sparse.encode(described, KEY, "target", self.numbers, sparse.value_lists(self.texts, LISTS), self.tables["columns"])

    def transform(self, cleaned: DataFrame) -> DataFrame:
        """Key, target and the vector of the model's features of cleaned rows."""
        cells = stage(self.encode(self.describe(self.fill(self.eligible(cleaned)))), "cells")
        return self.vectors(cells)

    def vectors(self, cells: DataFrame) -> DataFrame:
        return sparse.scaled_vectors(cells, KEY, "target", self.tables["columns"].filter("place IS NOT NULL"), self.width)

    def feature_names(self) -> list[str]:
        """Names of the vector's places, in order."""
        chosen = self.tables["columns"].filter("place IS NOT NULL").orderBy("place").select("source", "value").collect()
        return encoding.distinct_names([f"{r['source']}_{r['value']}" if r["source"] else r["value"] for r in chosen])

    def with_places_of(self, other: FeatureModel) -> FeatureModel:
        """This model's statistics with the other's choice and order of features."""
        places = other.tables["columns"].filter("place IS NOT NULL").select("source", "value", "place")
        columns = lookup_join(self.tables["columns"].drop("place"), places, ["source", "value"])
        return replace(self, width=other.width, tables={**self.tables, "columns": stage(columns, "columns")})

    # ---- saving --------------------------------------------------------------

    def save(self, path: str) -> None:
        spark = next(iter(self.tables.values())).sparkSession
        for name, table in self.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/tables/{name}")
        plain = {k: v for k, v in self.__dict__.items() if k not in ("tables", "settings")}
        plain["settings"] = {**asdict(self.settings), "as_of": self.settings.as_of.isoformat()}
        row = spark.createDataFrame([(json.dumps(plain, ensure_ascii=False),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FeatureModel:
        plain = json.loads(spark.read.text(f"{path}/model").first()["value"])
        settings = plain.pop("settings")
        settings["as_of"] = date.fromisoformat(settings["as_of"])
        plain["edges"] = {c: {int(n): e for n, e in by.items()} for c, by in plain["edges"].items()}
        names = ("favourable", "salary_medians", "consolidation_medians", "coverage_medians", "columns")
        tables = {n: spark.read.parquet(f"{path}/tables/{n}") for n in names}
        return FeatureModel(settings=Settings(**settings), tables=tables, **plain)


@dataclass
class Features:
    """Results of a batch run: cleaned rows, cells of the encoded rows, vectors for the model, and the fitted model."""

    initial: DataFrame
    encoded: DataFrame
    final: DataFrame
    model: FeatureModel


def fit_features(
    requests: DataFrame, salary: DataFrame, conf: Settings, stop_words: list[str] | None = None
) -> Features:
    """Fit the feature model on raw requests and salaries and compute the model input."""
    cleaned, encoded, rows, model = fit_encoding(requests, salary, conf, stop_words)
    positions, n = model.tables["columns"], len(model.numbers)
    stats = sparse.column_stats(encoded, rows, n)
    # Correlations do not change under scaling, so they are taken from the unscaled values.
    related = sparse.target_related(encoded.filter("target <> -1"), "target", n, stats, conf.target_corr_quantile)
    kept = sparse.not_redundant(encoded, KEY, related, stats, positions, n, rows, conf.redundancy_cut)
    places = sparse.numbered_in_order(kept.select("position", "strength", "name"), [F.desc("strength"), "name"], "place")
    columns = lookup_join(positions, stats.select("position", "least", "greatest"), ["position"])
    columns = lookup_join(columns, places.select("position", "strength", "place"), ["position"])
    model.tables["columns"], model.width = stage(columns, "columns"), places.count()
    return Features(cleaned, encoded, model.vectors(encoded), model)


def fit_encoding(
    requests: DataFrame, salary: DataFrame, conf: Settings, stop_words: list[str] | None = None
) -> tuple[DataFrame, DataFrame, int, FeatureModel]:
    """Cleaned rows, cells of the encoded rows, their number, and a model that knows all columns but has chosen none."""
    # All later passes cut the texts of these rows into words, in as many tasks as there are files here.
    cleaned = stage(spread(clean_requests(requests, conf), KEY), "cleaned")
    filters.assert_unique(cleaned, KEY)
    model = FeatureModel(conf)
    model.stop_words = encoding.default_stop_words() if stop_words is None else list(stop_words)
    folded = text.fold_text(F.col("minimum_requirements"))
    model.terms = encoding.fit_terms(cleaned, folded, model.stop_words, conf.min_word_share)

    with_client = cleaned.select(KEY, *SOURCES).na.drop(subset=["client_code"])
    success = rates.success_rates(with_client, list(RATE_FLAGS), "target", conf.min_group_rows)
    model.tables["favourable"] = stage(rates.favourable_values(success, conf.favourable_quantile), "favourable")

    eligible = plausible(with_client)
    model.tables["salary_medians"] = stage(salary_medians(salary), "salary_medians")
    for name, column, levels in (
        ("consolidation_medians", "consolidation_probability", S.CONSOLIDATION_LEVELS),
        ("coverage_medians", "coverage_probability", S.COVERAGE_LEVELS),
    ):
        model.tables[name] = stage(probability_medians(eligible, column, levels), name)

    filled = stage(model.fill(eligible), "filled")
    model.edges = binning.fit_edges(filled, {c: list(by) for c, by in BINS.items()})
    model.frequent = shares.frequent_values(filled, share_percents(conf))
    grouped = filled.withColumn(
        "GroupedPosition", shares.group_rare(F.col("job_role"), model.frequent["job_role"])
    )
    effect = profile.negative_salary_effect(grouped, "GroupedPosition", "RequestSalary")
    model.negative_roles = sorted(
        r["GroupedPosition"] for r in effect.filter("neg_corr = 1").select("GroupedPosition").collect()
    )

    described = stage(model.describe(filled).drop(*SALARY_DEPENDENT), "described")
    kinds = dict(described.dtypes)
    model.texts = [c for c, t in kinds.items() if t == "string" and c != KEY]
    model.numbers = [c for c in kinds if c not in (KEY, "target", *model.texts, *LISTS.values())]
    model.tables["columns"] = sparse.fit_positions(described, model.numbers, sparse.value_lists(model.texts, LISTS))
    return cleaned, stage(model.encode(described), "encoded"), described.count(), model


def salary_medians(salary: DataFrame) -> DataFrame:
    """Salary medians at all levels for both tenure bands: columns ``settled`` and ``new``."""
    cleaned = stage(clean_salary(salary), "clean_salary")
    medians = fallback.level_medians(cleaned, S.SALARY_LEVELS, "salary", by=["band"])
    return medians.groupBy("level", *S.SALARY_LEVELS[0]).agg(
        *[F.max(F.when(F.col("band") == band, F.col("median"))).alias(band) for band in ("settled", "new")]
    )


def probability_medians(rows: DataFrame, column: str, levels) -> DataFrame:
    keys = dict.fromkeys(k for level in levels for k in level)
    known = rows.select(*keys, rules.known_probability(F.col(column)).alias("_known"))
    return fallback.level_medians(stage(known, "known"), levels, "_known")


def fill_salaries(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Add ProfileAvgSalary and ProfileAvgSalary12; ``table`` is a staged ``salary_medians``."""
    return fallback.fill_by_levels(
        rows,
        table,
        S.SALARY_LEVELS,
        {
            "ProfileAvgSalary": (rules.known_positive(F.col("average_salary")), "settled"),
            "ProfileAvgSalary12": (rules.known_positive(F.col("average_salary_12")), "new"),
        },
        {"profile": F.col("job_role"), "remote": rules.request_remote_status(F.col("remote_work"))},
    )


def fill_probability(rows: DataFrame, table: DataFrame, levels, source: str, name: str) -> DataFrame:
    own = rules.known_probability(F.col(source))
    return fallback.fill_by_levels(rows, table, levels, {name: (own, "median")})


def share_percents(conf: Settings) -> dict[str, float]:
    """Least percent of the rows for a value to be kept, by column."""
    return {"region": conf.region_percent, "job_role": conf.role_percent, "work_zone": conf.zone_percent}


def plausible(with_client: DataFrame) -> DataFrame:
    """Rows with a job level and a plausible salary, added as ``RequestSalary``."""
    rows = with_client.na.drop(subset=["job_level"])
    rows = rows.withColumn("RequestSalary", rules.full_salary(F.col("desired_salary")))
    return filters.outside_band(rows, "RequestSalary", 100, 8000)


def is_plausible() -> Column:
    """Whether :func:`plausible` keeps a row: a job level, and a salary that is missing or plausible."""
    level, salary = F.col("job_level"), rules.full_salary(F.col("desired_salary"))
    return level.isNotNull() & ~F.isnan(level.try_cast("double")) & filters.is_outside_band(salary, 100, 8000)


def _derive_filled(
    rows: DataFrame, salaries: DataFrame, consolidation: DataFrame, coverage: DataFrame
) -> DataFrame:
    rows = fill_salaries(rows, salaries)
    rows = fill_probability(
        rows, consolidation, S.CONSOLIDATION_LEVELS, "consolidation_probability", "ApplicantProbability"
    )
    rows = fill_probability(rows, coverage, S.COVERAGE_LEVELS, "coverage_probability", "TechProbability")
    return rows.withColumns(
        {
            "DesiredSalaryRatio": F.try_divide("RequestSalary", "ProfileAvgSalary"),
            "DesiredSalaryRatio12": F.try_divide("RequestSalary", "ProfileAvgSalary12"),
            "SalaryGrowthFlag": rules.growth_flag(F.col("ProfileAvgSalary12"), F.col("ProfileAvgSalary")),
            "work_zone": text.work_zone(F.col("work_area")),
        }
    )


def _row_features() -> dict:
    """Features that need nothing but the row."""
    managers = F.col("hr_manager")
    return {
        "NumResponsible": text.count_values(managers),
        "MultiResponsible": text.several_values(managers),
        "NumLanguages": text.count_values(F.col("languages")),
        "JobLevelCategory": rules.job_level_band(F.col("job_level")),
        "ConsolProbCategory": rules.probability_band(F.col("ApplicantProbability")),
        "CoverageProbCategory": rules.probability_band(F.col("TechProbability")),
        "MixedProbCategory": rules.mixed_band(F.col("TechProbability"), F.col("ApplicantProbability")),
        "MultipleResources": rules.several_positions(F.col("required_positions")),
        "is_NegotiatedRate": rules.equals_flag(F.col("rate_type"), S.NEGOTIATED_RATE),
        "is_FullRemote": rules.equals_flag(F.col("remote_work"), S.FULL_REMOTE_REQUEST),
        "month_created": text.month_name(F.col("request_creation_date")),
        "EarlyRequest": text.early_flag(F.col("request_creation_date"), F.col("need_date")),
        "days_between": F.datediff("need_date", "request_creation_date"),
        "DaysDiffCategory": text.lead_sign(F.col("request_creation_date"), F.col("need_date")),
    }
