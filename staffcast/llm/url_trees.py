"""URL verdicts: host and path rules first, then gradient-boosted trees on lexical features. Native columns only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffcast.llm.common import free_name, numbered, read_table
from staffcast.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRAIN_ROWS = 20_000  # the trees are fitted on about so many labelled rows at most
TREES, DEPTH, STEP = 12, 3, 0.2
PRIOR_ROWS = 20.0  # a suffix's block rate is drawn towards the overall rate by so many rows


@dataclass(frozen=True)
class Rule:
    """``host/path``: the host and its subdomains, for paths that start so."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3)))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as text; null if none does."""
    fits = lambda r: ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
    cases = [F.when(fits(r), F.lit(r.text)) for r in sorted(rules, key=lambda r: (-len(r.text), r.text))]
    return F.coalesce(*cases, F.lit(None).cast("string"))


def verdict_of(rule: Column, rules: Sequence[Rule]) -> Column:
    return F.coalesce(*[F.when(rule == r.text, F.lit(r.verdict)) for r in rules], F.lit(None).cast("string"))


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    size = F.char_length(text)
    share = lambda c: (size - F.char_length(F.replace(text, c, F.lit("")))) / size
    terms = F.transform(F.array_distinct(F.split(text, "")), lambda c: F.when(c != "", -share(c) * F.log2(share(c))).otherwise(0.0))
    return F.when(size > 0, F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)).otherwise(0.0)


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.char_length(text), F.lit(1))


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of the spelling alone. A null url counts as the empty one."""
    url = F.coalesce(url, F.lit(""))
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    return {
        "length": F.char_length(url).cast("double"),
        "host_length": F.char_length(host).cast("double"),
        "depth": count(path, "/[^/]"),
        "labels": count(host, r"\."),
        "hyphens": count(host, "-"),
        "digit_ratio": _share(url, "[0-9]"),
        "host_digit_ratio": _share(host, "[0-9]"),
        "symbol_ratio": _share(url, "[^A-Za-z0-9/.:-]"),
        "parameters": F.when(F.instr(url, "?") > 0, count(url, "[?&][^&#]")).otherwise(0.0),
        "fragment": (F.instr(url, "#") > 0).cast("double"),
        "secure": url.startswith("https").cast("double"),
        "host_entropy": entropy(host),
        "path_entropy": entropy(path),
    }


def suffixes(host: Column) -> dict[str, Column]:
    return {"top": F.substring_index(host, ".", -1), "pair": F.substring_index(host, ".", -2), "triple": F.substring_index(host, ".", -3)}


def tree_columns(model: GBTClassificationModel, names: Sequence[str]) -> Column:
    """The boosted margin as one column expression: nested conditions, no Python and no model object."""

    def walk(node) -> Column:
        if node.getClass().getSimpleName() == "LeafNode":
            return F.lit(float(node.prediction()))
        split = node.split()
        return F.when(F.col(names[split.featureIndex()]) <= float(split.threshold()), walk(node.leftChild())).otherwise(walk(node.rightChild()))

    trees = [walk(t._java_obj.rootNode()) * float(w) for t, w in zip(model.trees, model.treeWeights, strict=True)]
    return reduce(lambda a, b: a + b, trees)


def judge(
    urls: DataFrame, url_column: str, rules: Sequence[Rule], train_rows: int = TRAIN_ROWS, keep: Sequence[str] = ()
) -> DataFrame:
    """``host, path, rule, verdict, block_score`` of each url, beside the columns named in ``keep``.

    The rules judge first and also label their urls; from these the trees learn, and judge the rest
    (block if the margin is positive). A suffix's statistics, the number of labelled urls with the same last
    one, two or three host labels and the smoothed share of blocked ones, are counted over all labelled rows;
    a training row's own label is left out of them. About ``train_rows`` labelled rows, picked by the hash of
    their row number, fit the trees.

    Null urls, or urls without ``://``, have an empty host and path. Where all labels are alike the trees give
    that verdict; without any labelled row the verdict is ``allow`` and the score null. Repeated rows are judged
    alike; other columns, however named, are ignored. An empty table gives an empty result.
    """
    mark = free_name(urls, "_row")
    url = F.col(url_column).cast("string")
    host, path = host_of(url), path_of(url)
    base = numbered(urls, mark).select(
        F.struct(F.col(mark).alias("row"), *[F.col(c).alias(f"keep_{c}") for c in keep]).alias("kept"), host.alias("host"), path.alias("path"),
        rule_of(host, path, rules).alias("rule"), *[c.alias(n) for n, c in lexical(url, host, path).items()],
        *[c.alias(f"suffix_{n}") for n, c in suffixes(host).items()],
    )
    base = base.withColumn("by_rule", verdict_of(F.col("rule"), rules))
    base = base.withColumn("label", F.when(F.col("by_rule").isNotNull(), (F.col("by_rule") == "block").cast("double")))
    base = stage(base, "urls")
    total = base.agg(F.count("label").alias("n"), F.avg("label").alias("mean")).first()
    kept = [F.col("kept")[f"keep_{c}"].alias(c) for c in keep]
    if not total["n"] or total["mean"] in (0.0, 1.0):
        score = F.lit(None if not total["n"] else 1.0 if total["mean"] else -1.0).cast("double")
    else:
        names = list(lexical(F.lit(""), F.lit(""), F.lit("")))
        for level in suffixes(F.lit("")):
            key = f"suffix_{level}"
            known = base.where("label IS NOT NULL").groupBy(key).agg(F.count("label").alias("_n"), F.sum("label").alias("_blocked"))
            base = base.join(known, key, "left")
            n = F.coalesce("_n", F.lit(0)) - F.col("label").isNotNull().cast("int")
            blocked = F.coalesce("_blocked", F.lit(0.0)) - F.coalesce("label", F.lit(0.0))
            base = base.withColumns({f"{level}_rows": F.log1p(n.cast("double")), f"{level}_rate": (blocked + PRIOR_ROWS * total["mean"]) / (n + PRIOR_ROWS)})
            base = base.drop("_n", "_blocked")
            names += [f"{level}_rows", f"{level}_rate"]
        picked = F.pmod(F.xxhash64("kept.row"), F.lit(1_000_000)) < F.lit(int(1_000_000 * min(1.0, train_rows / total["n"])))
        train = stage(base.where(F.col("label").isNotNull() & picked).select("label", *names), "labelled-urls")
        if train.select("label").distinct().count() < 2:
            score = F.lit(2 * total["mean"] - 1)
        else:
            vectors = VectorAssembler(inputCols=names, outputCol="features").transform(train)
            model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7).fit(vectors)
            score = tree_columns(model, names)
    return base.withColumn("block_score", score).select(
        *kept, "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("block_score") > 0, "block").otherwise("allow")).alias("verdict"), "block_score",
    )


# The rules of the query.
RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/"))


def op8_url_trees(spark, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, "url", RULES, keep=["page_id"]).select("page_id", "host", "path", "rule", "verdict", "block_score")
