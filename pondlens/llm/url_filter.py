"""URL filter: list rules first, gradient-boosted trees for the rest.

A rule is a host, a slash and the start of a path; it fits its host and all
subdomains, if the path begins with the rule's, and the longest fitting rule
wins. The urls that rules decide are the labelled ones. Trees are fitted to at
most ``MAX_TRAIN_URLS`` of them (in expectation, chosen by a hash of the url)
and decide all urls no rule fits, from lexical features: lengths, depth, digit
ratio, entropy, parameter counts, and suffix statistics - smoothed block rates
of the host's last label, of its last two labels, and of the path's first
segment among all labelled urls, for a url to train on those of the other
``FOLDS`` parts, so that no label stands in its own features. The bound is below the size from which Spark
samples for split points, so a rerun finds the same splits.

Null urls and those without ``://`` have an empty host and path, which no rule
fits; the trees judge them by their features. If all labels agree, or there
are none, the rest gets that label, or ``allow``. Rows that repeat each get
their verdict; an empty table gives an empty result. Only the id and url
columns are read.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pondlens.llm import textops as T

# Rule -> verdict.
RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}

MAX_TRAIN_URLS = 10_000
TREES, DEPTH, STEP = 20, 4, 0.2
FOLDS = 10      # a training row's suffix statistics come from the other folds
PRIOR = 2.0     # labelled urls the overall rate counts as, in a suffix statistic
LEXICAL = ["n_url", "n_host", "n_path", "n_query", "labels", "segments", "digit_ratio", "host_digits", "entropy",
           "params", "hyphens", "longest_segment", "has_fragment", "secure", "dotted_end"]
STATISTICS = {"rate_last": "last_label", "rate_two": "last_two", "rate_segment": "first_segment"}


def parse(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, url (null: empty), host, path, query."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"))
    host = F.translate(F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return rows.select("page_id", "url", host.alias("host"), F.regexp_extract("url", r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"),
                       F.regexp_extract("url", r"(?s)^.*?://[^?#]*\?([^#]*)", 1).alias("query"))


def rule_of(rules: dict[str, str]) -> Column:
    """The longest fitting rule, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):      # a longer rule is tested before a shorter one
        host, _, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit("/" + path))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def _others(text: str, chars: str) -> Column:
    """Characters of ``text`` that are in the class ``chars``."""
    return F.char_length(F.col(text)) - F.char_length(F.regexp_replace(text, chars, ""))


def lexical(parsed: DataFrame) -> DataFrame:
    """Adds the lexical features and the keys of the suffix statistics."""
    n = F.char_length("url")
    chars = F.array_distinct(F.filter(F.split("url", ""), lambda c: c != ""))
    share = F.transform(chars, lambda c: (n - F.char_length(F.replace(F.col("url"), c, F.lit("")))) / n)
    entropy = F.when(n > 0, F.aggregate(share, F.lit(0.0), lambda s, p: s - p * F.log2(p))).otherwise(0.0)
    labels = F.split("host", r"\.")
    segments = F.array_remove(F.split("path", "/"), "")
    longest = F.coalesce(F.array_max(F.transform(segments, lambda s: F.char_length(s))), F.lit(0))
    cols = {
        "n_url": n, "n_host": F.char_length("host"), "n_path": F.char_length("path"), "n_query": F.char_length("query"),
        "labels": F.size(labels), "segments": F.size(segments), "digit_ratio": _ratio(_others("url", "[0-9]"), n),
        "host_digits": _others("host", "[0-9]"), "entropy": entropy,
        "params": F.when(F.col("query") != "", F.size(F.split("query", "&"))).otherwise(0),
        "hyphens": _others("url", "[-_]"), "longest_segment": longest,
        "has_fragment": F.contains("url", F.lit("#")).cast("int"), "secure": F.startswith("url", F.lit("https://")).cast("int"),
        "dotted_end": F.contains(F.element_at(F.concat(F.array(F.lit("")), segments), -1), F.lit(".")).cast("int")}
    out = parsed.withColumns({k: v.cast("double") for k, v in cols.items()})
    return out.withColumns({"last_label": F.element_at(labels, -1),
                            "last_two": F.array_join(F.slice(F.concat(F.array(F.lit("")), labels), -2, 2), "."),
                            "first_segment": F.coalesce(F.get(segments, 0), F.lit(""))})


def _fold() -> Column:
    """Copies of a url share a fold."""
    return F.pmod(F.xxhash64(F.lit(3), "url"), F.lit(FOLDS)).cast("int")


def suffix_statistics(labelled: DataFrame) -> tuple[dict[str, DataFrame], float]:
    """Per kind of suffix and value k: blocked and all labelled urls, in total and by fold; and the overall block rate."""
    n, blocked = labelled.agg(F.count("*"), F.sum("label")).first()
    mean = (blocked or 0.0) / n if n else 0.0
    out = {}
    for name, key in STATISTICS.items():
        folds = (labelled.groupBy(F.col(key).alias("k"), _fold().alias("fold"))
                 .agg(F.sum("label").alias("blocked"), F.count("*").alias("urls")))
        # FOLDS entries at most
        entries = F.collect_list(F.struct("fold", F.struct("blocked", "urls").alias("own")))
        out[name] = folds.groupBy("k").agg(F.sum("blocked").alias("blocked"), F.sum("urls").alias("urls"),
                                           F.map_from_entries(entries).alias("folds"))
    return out, mean


def with_statistics(rows: DataFrame, statistics: dict[str, DataFrame], mean: float, training: bool = False) -> DataFrame:
    """The smoothed block rate of each suffix. A row to train on gets that of the other folds' urls: its own label (and
    those of its copies) would stand in its features otherwise."""
    for name, key in STATISTICS.items():
        rows = rows.join(statistics[name], F.col(key) == F.col("k"), "left")
        blocked, urls = F.col("blocked"), F.col("urls")
        if training:
            own = F.element_at("folds", _fold())
            blocked, urls = blocked - F.coalesce(own["blocked"], F.lit(0.0)), urls - F.coalesce(own["urls"], F.lit(0))
        rate = (F.coalesce(blocked, F.lit(0.0)) + PRIOR * mean) / (F.coalesce(urls, F.lit(0)) + PRIOR)
        rows = rows.withColumn(name, rate).drop("k", "blocked", "urls", "folds")
    return rows


def fit(labelled: DataFrame, seed: int = 5) -> GBTClassificationModel:
    """Trees on ``label`` (1: block) and the features of every row given."""
    vector = VectorAssembler(inputCols=[*LEXICAL, *STATISTICS], outputCol="features")
    # rows in a fixed order, so that sums run alike each time
    rows = labelled.repartition(4, "url").sortWithinPartitions("url", "page_id")
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=seed, cacheNodeIds=False).fit(vector.transform(rows))


def judge(pages: DataFrame, rules: dict[str, str] | None = None, id_col: str = "page_id", url_col: str = "url",
          max_train: int = MAX_TRAIN_URLS) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score (null where a rule decides)."""
    rules = RULES if rules is None else rules
    verdicts = F.create_map(*[F.lit(x) for kv in rules.items() for x in kv]) if rules else F.create_map()
    parsed = parse(pages, id_col, url_col)
    rows = lexical(parsed.withColumn("rule", rule_of(rules)))
    rows = rows.withColumn("decided", F.element_at(verdicts.cast("map<string,string>"), F.col("rule")))
    rows = T.materialize(rows, "urls")
    labelled = rows.where("rule IS NOT NULL").withColumn("label", (F.col("decided") == "block").cast("double"))
    statistics, mean = suffix_statistics(labelled)
    n = labelled.count()
    if not 0.0 < mean < 1.0:
        rest, score = F.lit("block" if mean == 1.0 else "allow"), F.lit(mean)
        judged = rows.withColumn("block_score", F.when(F.col("rule").isNull(), score))
    else:
        statistics = {k: T.materialize(v, k) for k, v in statistics.items()}
        space = 1 << 40
        limit = space if n <= max_train else space * max_train // n
        chosen = F.pmod(F.xxhash64(F.lit(2), "url", "page_id"), F.lit(space)) < limit
        model = fit(T.materialize(with_statistics(labelled.where(chosen), statistics, mean, training=True), "labelled"))
        vector = VectorAssembler(inputCols=[*LEXICAL, *STATISTICS], outputCol="features")
        scored = model.transform(vector.transform(with_statistics(rows, statistics, mean)))
        judged = scored.withColumn("block_score", F.when(F.col("rule").isNull(), F.get(vector_to_array("probability"), 1)))
        rest = F.when(F.col("block_score") > 0.5, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("decided", rest).alias("verdict"), "block_score")
