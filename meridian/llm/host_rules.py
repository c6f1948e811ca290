"""Quality rules at the level of hosts.

Every document is held against plain rules. Failures are summed by host (the source column); a host's rate is
shrunk towards the mean of all hosts by a beta prior whose strength comes from the spread between hosts, so a
host of three documents is not judged by three documents. Verdicts on hosts are then joined back to documents.

Everything is a built-in function, a join or an aggregate: no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import WORD_GAP, durable, or_empty

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A host is dropped if its shrunken failure rate is over this: most of what it has is bad.
MAX_HOST_RATE = 0.5
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_GAP), "")


def _window_hashes(words: str) -> Column:
    """One hash for each window of WINDOW words; none for fewer words."""
    window = lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW)))
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    return F.when(F.size(words) >= WINDOW, F.transform(starts, window)).otherwise(F.array().cast("array<bigint>"))


def _let(value: Column, body) -> Column:
    """body(value) with value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(hashes: str) -> Column:
    """Number of words within windows that occur twice or more.

    Positions are sorted by hash, equal neighbours mark repeats, and each repeated start, in text order, covers
    as many words as lie before the next one, WINDOW at most. No window is compared with all others.
    """
    by_hash = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda p, i, x: F.coalesce(F.get(p, i)["h"] == x["h"], F.lit(False))
    repeated = lambda p: F.transform(F.filter(p, lambda x, i: same(p, i - 1, x) | same(p, i + 1, x)), lambda x: x["i"])
    covered = lambda s: F.aggregate(
        F.transform(s, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x
    )
    return _let(by_hash, lambda p: _let(F.sort_array(repeated(p)), covered))


def measured(docs: DataFrame, carry: bool = False) -> DataFrame:
    """(doc_id, or row with carry, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed) of every row.

    Words are runs of anything but ASCII white space; a null text has none and fails.
    """
    text = or_empty(F.col("text"))
    count = lambda c: c.cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    flat = docs.select(
        F.struct("*").alias("row") if carry else "doc_id",
        "source",
        words_of(text).alias("words"),
        lines.alias("lines"),
        count(F.length(F.translate(text, BLANKS, ""))).alias("word_chars"),
        count(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
    )
    hashed = flat.select("*", _window_hashes("words").alias("hashes"))
    some = F.size(F.array_distinct("hashes")) < F.size("hashes")
    out = hashed.select(
        "row" if carry else "doc_id",
        "source",
        count(F.size("words")).alias("n_words"),
        "word_chars",
        "n_symbols",
        count(F.size("lines")).alias("n_lines"),
        count(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        count(F.when(some, _repeat_words("hashes")).otherwise(0)).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return out.withColumn("base_failed", failed)


#: What hosts are held against: the base rule, then more symbols than a tenth of the characters, then more
#: than three repeated lines in ten.
RULES = {
    "base": "base_failed",
    "symbols": "n_symbols * 10 > word_chars",
    "lines": "n_dup_lines * 10 > n_lines * 3",
}


def host_rates(measures: DataFrame) -> DataFrame:
    """(source, docs, and rate_<rule> for each rule): failure rates by host, shrunk by a beta prior.

    The prior's mean is the rate over all documents; its strength follows from the overdispersion rho of host rates
    (method of moments): strength = 1 / rho - 1. Hosts that differ by chance alone get all of the prior. Null is no host.
    """
    by_host = (
        measures.filter(F.col("source").isNotNull())
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("docs"), *(F.sum(F.expr(rule).cast("long")).alias(f"failed_{k}") for k, rule in RULES.items()))
    )
    sums = [F.sum(f"failed_{k}").alias(f"sum_{k}") for k in RULES] + [F.sum(F.col(f"failed_{k}") * F.col(f"failed_{k}") / F.col("docs")).alias(f"square_{k}") for k in RULES]
    whole = by_host.agg(F.count(F.lit(1)).alias("hosts"), F.sum("docs").alias("docs"), *sums).first()
    shrunk = []
    for k in RULES:
        alpha, strength = prior(whole["hosts"], whole["docs"] or 0, whole[f"sum_{k}"] or 0, whole[f"square_{k}"] or 0.0)
        shrunk.append(((F.col(f"failed_{k}") + F.lit(alpha)) / (F.col("docs") + F.lit(strength))).alias(f"rate_{k}"))
    return by_host.select("source", "docs", *shrunk)


def prior(hosts: int, docs: int, failed: int, square: float) -> tuple[float, float]:
    """(alpha, alpha + beta) of the beta prior; square is the sum over hosts of failed * failed / docs."""
    mean = failed / docs if docs else 0.0
    if not 0 < mean < 1 or docs <= hosts:
        return mean, 1.0
    rho = ((square - mean * mean * docs) / (mean * (1 - mean)) - hosts) / (docs - hosts)
    strength = 1 / min(max(rho, 1e-6), 0.5) - 1
    return mean * strength, strength


def bad_hosts(measures: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(source, bad_host) of the hosts whose shrunken rate of any failure is over max_rate."""
    bad = F.greatest(*(F.col(f"rate_{k}") for k in RULES)) > max_rate
    return host_rates(measures).filter(bad).select("source", F.lit(True).alias("bad_host"))


def judged(docs: DataFrame, max_rate: float = MAX_HOST_RATE, carry: bool = False) -> DataFrame:
    """measured(docs) with kept: the document passes the base rule and its host passes all rules.

    docs needs doc_id, text and source; a null source is no host, so only the base rule counts there. Repeated rows
    count and are judged each by itself; an empty table gives an empty result; other columns are not looked at.
    Per document there is no shuffle; hosts are summed on the map side first, and only bad hosts are joined back, so a
    host with a third of the rows is split by the engine like any skewed join. With carry each row keeps all its columns.
    """
    measures = durable(measured(docs, carry))
    kept = ~F.col("base_failed") & F.col("bad_host").isNull()
    # stored, so that the engine knows its size and moves no text if it is small
    return measures.join(durable(bad_hosts(measures, max_rate)), "source", "left").withColumn("kept", kept)


SQL = r"""
WITH flat AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS text FROM documents
), base AS (
  SELECT row_id, doc_id, source, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols
  FROM flat
), windows AS (
  SELECT row_id, i, words[i:i + 4] AS w FROM (SELECT row_id, words, unnest(range(1, len(words) - 3)) AS i FROM base WHERE len(words) >= 5)
), again AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT row_id, sum(least(5, coalesce(following - i, 5))) AS n
  FROM (SELECT row_id, i, lead(i) OVER (PARTITION BY row_id ORDER BY i) AS following FROM again) GROUP BY row_id
), measures AS (
  SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len(words) < 10 OR 100 * coalesce(n, 0) > 20 * len(words) AS base_failed
  FROM base LEFT JOIN covered USING (row_id)
), failures AS (
  SELECT source, rule, count(*) AS docs, sum(CAST(failed AS INT)) AS failed FROM (
    SELECT source, unnest(['base', 'symbols', 'lines']) AS rule,
      unnest([base_failed, n_symbols * 10 > word_chars, n_dup_lines * 10 > n_lines * 3]) AS failed
    FROM measures WHERE source IS NOT NULL) GROUP BY source, rule
), whole AS (
  SELECT rule, count(*) AS hosts, sum(docs) AS docs, sum(failed) / sum(docs) AS mean, sum(failed * failed / docs) AS square FROM failures GROUP BY rule
), priors AS (
  SELECT rule, mean, CASE WHEN mean > 0 AND mean < 1 AND docs > hosts
    THEN 1 / least(greatest(((square - mean * mean * docs) / (mean * (1 - mean)) - hosts) / (docs - hosts), 1e-6), 0.5) - 1 ELSE 1 END AS strength FROM whole
), bad AS (
  SELECT DISTINCT source FROM failures JOIN priors USING (rule) WHERE (failed + mean * strength) / (docs + strength) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.source IS NULL AS kept
FROM measures LEFT JOIN bad ON measures.source = bad.source
"""
