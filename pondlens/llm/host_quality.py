"""Host-level quality rules, in DataFrame functions throughout.

Per document: counts of words, of their code points, of symbols, of lines
equal to an earlier line, and of words inside 3-word windows that occur twice
or more. A document fails the base rules with fewer than ``MIN_WORDS`` words
or with more than half of its words in repeated windows; the method's rules
add a share of symbols and a share of repeated lines.

Per host (the source): the rate of documents that fail any rule, shrunk
towards the hosts' mean by a beta prior that is fitted by the method of
moments, each host with two documents or more being one observation, whatever
its size: so the prior does not harden as hosts grow. It counts for
``MAX_STRENGTH`` documents at most, so that enough documents of its own decide
about a host. A host whose shrunk rate exceeds ``MAX_HOST_RATE`` is rejected,
and its verdict is joined back to its documents. Hosts are counted with
partial aggregates, so one that holds a third of all rows is no hot spot; the
join back is on two narrow tables, whose skewed partitions Spark splits.

Null texts count as empty (0 words: they fail). Null sources form one host, as
does the empty string. Rows that repeat count as often as they occur. Long
texts take time in proportion to n log n. An empty table gives an empty
result. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pondlens.llm import textops as T

# The base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
# The method's rules.
MAX_SYMBOLS_PER_WORD = 1.0
MAX_DUP_LINE_SHARE = 0.7
MAX_HOST_RATE = 0.8
MAX_STRENGTH = 20.0      # documents that the prior counts for, at most

WS = r"[\x20\x09-\x0D]"


def _repeat_words(windows: Column) -> Column:
    """Words covered by the windows found more than once; ``windows``: sorted (hash, start)."""
    again = F.filter(windows, lambda x, i: (F.get(windows, i - 1)["h"] == x["h"]) | (F.get(windows, i + 1)["h"] == x["h"]))
    return F.sort_array(F.transform(again, lambda x: x["p"]))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    a = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text.alias("text"))
    # a split leaves empty strings at the ends only
    a = a.withColumn("w", F.array_remove(F.split("text", WS + "+"), ""))
    a = a.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\f\r"))) > 0))
    a = a.withColumn("n", F.size("w"))
    pos = F.when(F.col("n") >= WINDOW, F.sequence(F.lit(0), F.col("n") - WINDOW)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(pos, lambda i: F.struct(
        F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]).alias("h"), i.alias("p")))
    a = a.withColumn("windows", F.sort_array(windows))
    a = a.withColumn("again", _repeat_words(F.col("windows")))
    # each repeated window adds the words up to the next one, three at most
    covered = F.aggregate(
        F.transform("again", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("again", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda x, y: x + y)
    long = "long"
    return a.select(
        "doc_id", "host", F.col("n").cast(long).alias("n_words"),
        F.char_length(F.array_join("w", "")).cast(long).alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", "#*$%&|<>", ""))).cast(long).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast(long).alias("n_dup_lines"),
        covered.cast(long).alias("n_repeat_words"), F.size("lines").cast(long).alias("n_lines"))


def rules(m: DataFrame) -> DataFrame:
    """Adds base_failed and failed (any rule)."""
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    own = ((F.col("n_symbols") > F.col("n_words") * MAX_SYMBOLS_PER_WORD)
           | (F.col("n_dup_lines") > F.col("n_lines") * MAX_DUP_LINE_SHARE))
    return m.withColumn("base_failed", base).withColumn("failed", base | own)


def host_rates(ruled: DataFrame) -> DataFrame:
    """Per host: docs, fails, rate (shrunk), rejected.

    The prior is fitted in one aggregate over the hosts, whose few sums go to
    the driver. If rates vary no more than chance, or fewer than two hosts
    have two documents, the prior has its full strength; if no host has two,
    its mean is that of all hosts.
    """
    hosts = ruled.groupBy("host").agg(F.count("*").alias("docs"), F.sum(F.col("failed").cast("long")).alias("fails"))
    rate, two = F.col("fails") / F.col("docs"), F.col("docs") > 1
    s = hosts.agg(F.avg(rate).alias("all"), F.count_if(two).alias("k"), F.sum(F.when(two, rate)).alias("sum"),
                  F.sum(F.when(two, rate * rate)).alias("square"),
                  F.sum(F.when(two, rate * (1 - rate) / (F.col("docs") - 1))).alias("chance")).first()
    k = int(s["k"])
    mean = s["sum"] / k if k else s["all"] or 0.0
    # between-host variance: the spread of rates less what chance explains
    between = (s["square"] - s["sum"] * s["sum"] / k) / (k - 1) - s["chance"] / k if k > 1 else 0.0
    strength = MAX_STRENGTH if between <= 0 else min(MAX_STRENGTH, max(1.0, mean * (1 - mean) / between - 1))
    shrunk = (F.col("fails") + F.lit(mean * strength)) / (F.col("docs") + F.lit(strength))
    return hosts.withColumn("rate", shrunk).withColumn("rejected", F.col("rate") > MAX_HOST_RATE)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per document the measures, base_failed, host_rate and kept."""
    ruled = T.materialize(rules(measures(docs, id_col, text_col, host_col)), "quality")
    hosts = host_rates(ruled).select(F.col("host").alias("h"), F.col("rate").alias("host_rate"), "rejected")
    out = ruled.join(hosts, F.col("host").eqNullSafe(F.col("h")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~(F.col("base_failed") | F.col("rejected"))).alias("kept"), "host_rate")
