"""Secrets in texts, and how many repositories and owners hold each. Native columns only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffcast.llm.common import free_name, numbered, read_table
from staffcast.staging import stage

# The base patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "live")

# Further candidates: unbroken runs that mix letters and digits as made keys do.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])"
LEAST_ENTROPY = 3.0  # bits a character
EXAMPLE_OWNERS = 3  # a value that so many owners hold is a copied example
SPAN = "array<struct<start:long,end:long,kind:string,value:string>>"


def spans(text: Column, pattern: str, kind: str) -> Column:
    """All matches, leftmost and not overlapping, as ``start, end, kind, value`` in code points."""
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("found"))

    def step(s: Column, x: Column) -> Column:
        begin = s["at"] + F.char_length(x["gap"])
        end = begin + F.char_length(x["value"])
        one = F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"))
        return F.when(x["value"].isNull(), s).otherwise(F.struct(end.alias("at"), F.array_append(s["found"], one).alias("found")))

    # Most texts have no match; one search tells.
    return F.when(text.rlike(pattern), F.aggregate(pairs, start, step)["found"]).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Assignments of at least 6 characters, access keys and long hexadecimal runs; ``value`` of the first is what is assigned.

    ``{16,}`` and ``{24,}`` find what filtering the unbounded patterns by length leaves: their runs are whole or fail whole.
    An assignment that is too short still uses up its text, so that one is filtered afterwards.
    """
    assigned = F.transform(spans(text, ASSIGN, "assign"), lambda s: s.withField("value", F.regexp_extract(s["value"], ASSIGN, 2)))
    assigned = F.filter(assigned, lambda s: F.char_length(s["value"]) >= 6)
    return F.concat(assigned, spans(text, ACCESS, "access"), spans(text, HEX, "hex"))


def entropy(value: Column) -> Column:
    size = F.char_length(value)
    share = lambda c: (size - F.char_length(F.replace(value, c, F.lit("")))) / size
    terms = F.transform(F.array_distinct(F.split(value, "")), lambda c: F.when(c != "", -share(c) * F.log2(share(c))).otherwise(0.0))
    return F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)


def candidates(text: Column, taken: Column) -> Column:
    """Further key-like runs of enough entropy that no base span touches."""
    free = lambda s: ~F.exists(taken, lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"]))
    return F.filter(spans(text, CANDIDATE, "live"), lambda s: free(s) & (entropy(s["value"]) >= LEAST_ENTROPY))


def find_secrets(
    docs: DataFrame, text_column: str, repository: Column, owner: Column, keep: list[str], example_owners: int = EXAMPLE_OWNERS
) -> DataFrame:
    """``kept, spans, n_live, n_example`` of each row; ``kept`` is a struct of the columns in ``keep``, at least one.

    Spans are ``start, end, kind, hash, live``: all base spans, and further key-like runs if they are live. A value is live if
    fewer than ``example_owners`` owners hold it anywhere in the table, else a widely copied example. Values are known by
    SHA-256 alone. Null repositories and owners count as one each; null and empty texts have no spans. Repeated rows each
    have a row; other columns are ignored; an empty table gives an empty result.

    One pass over the texts writes spans and no text. Owners are counted by hash, owner and repository first, so a value that a
    third of all rows hold is a few rows when its hash is grouped; joins have one unique side.
    """
    row = free_name(docs, "_row")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    nothing = F.lit("")
    found = numbered(docs, row).select(
        F.col(row).alias("row"), F.struct(*[F.col(c) for c in keep]).alias("kept"), F.coalesce(repository.cast("string"), nothing).alias("repository"),
        F.coalesce(owner.cast("string"), nothing).alias("owner"), text.alias("text"), base_spans(text).alias("base"),
    )
    all_spans = F.concat("base", candidates(F.col("text"), F.col("base")))
    hashed = F.transform(all_spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), F.sha2(s["value"], 256).alias("hash")))
    found = stage(found.select("row", "kept", "repository", "owner", hashed.alias("spans")), "secrets")
    some = found.where(F.size("spans") > 0).select("row", "repository", "owner", F.explode("spans").alias("span")).select("row", "repository", "owner", "span.*")
    held = some.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    held = held.groupBy("hash", "owner").agg(F.count("one").alias("repositories"))
    held = held.groupBy("hash").agg(F.count("owner").alias("owners"), F.sum("repositories").alias("repositories"))
    judged = some.join(held, "hash").withColumn("live", F.col("owners") < example_owners)
    judged = judged.where((F.col("kind") != "live") | F.col("live"))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    span = F.struct("start", order.alias("order"), "end", "kind", "hash", "live", "repositories", "owners")
    by_row = judged.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    out = found.select("row", "kept").join(by_row, "row", "left").drop("row")
    out = out.withColumn("spans", F.coalesce("spans", F.array().cast(by_row.schema["spans"].dataType)))
    many = lambda live: F.size(F.filter("spans", lambda s: s["live"] == live)).cast("long")
    return out.withColumns({"n_live": many(True), "n_example": many(False)})


def joined(spans_column: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans_column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_ownership(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = find_secrets(docs, "text", F.col("source"), F.substring_index("source", "/", 1), ["doc_id"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("kept.doc_id").alias("doc_id"), count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "live")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        "n_live", "n_example",
    )
