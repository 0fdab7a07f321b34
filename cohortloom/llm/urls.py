"""URL filter: rules, and a ratio of character language models for urls without one.

The model reads host and path as characters. For urls that a rule allows, and
for those that a rule blocks, all runs of up to ``CONTEXT + 1`` characters are
counted. The probability of a character behind a context of k characters mixes
its count with the probability behind the last k - 1 of them:
``(n(context, char) + W * shorter) / (n(context) + W)``, down to one in
``ALPHABET``; a context never seen leaves all weight to the shorter one, so the
order varies with what was seen. A url's score is the mean over its characters
of the difference of log-likelihoods. The threshold is the one with the best
mean of both classes' accuracies on rule-decided urls that were held out of the
counts (one in five, by hash).

Counts are combined before each shuffle; they are a table that grows with the
urls and is joined, never collected. What reaches the driver is a histogram of
fixed size for the threshold.

Null urls and those without ``://`` have an empty host and path; they are scored
by the end mark alone. Repeated rows are judged alike, rows without an id are
judged too, an empty table gives no rows and further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import LOWER, UPPER, keep

CONTEXT = 4
WEIGHT = 4.0
ALPHABET = 1024
#: Histogram of scores for the threshold: half its width, and bins per unit.
SCORE_RANGE, SCORE_BINS = 8, 100
_START, _END = "\x02", "\x03"

Rule = tuple[str, str, str]


def host_and_path(url: str) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(F.col(url), F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def matching_rule(host: str, path: str, rules: Sequence[Rule]) -> Column:
    """The longest rule (verdict, host, path) that fits, as a struct of its length, text and verdict; else null."""

    def fits(rule: Rule) -> Column:
        _, rule_host, rule_path = rule
        here = (F.col(host) == rule_host) | F.col(host).endswith(f".{rule_host}")
        return here & F.col(path).startswith(rule_path)

    def value(rule: Rule) -> Column:
        verdict, name = rule[0], rule[1] + rule[2]
        return F.struct(F.lit(len(name)).alias("length"), F.lit(name).alias("rule"), F.lit(verdict).alias("verdict"))

    found = [F.when(fits(r), value(r)) for r in rules]
    return F.array_max(F.array(*found))


def _counted(grams: DataFrame, key: Column) -> DataFrame:
    return grams.groupBy(key.alias("key")).agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))


def gram_scores(grams: DataFrame) -> DataFrame:
    """``gram, score`` from ``gram, good, bad``: the difference of the last character's log-probabilities."""
    totals = grams.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    scored = grams.select("gram", F.lit(1.0 / ALPHABET).alias("p_good"), F.lit(1.0 / ALPHABET).alias("p_bad"))
    for k in range(CONTEXT + 1):
        run = F.substring("gram", CONTEXT + 1 - k, k + 1)
        seen = _counted(grams, run)
        seen = seen.withColumnsRenamed({"key": "run", "n_good": "run_good", "n_bad": "run_bad"})
        scored = scored.withColumn("run", run).join(seen, "run")
        if k:
            # Contexts are counted from the runs, which are fewer than the grams.
            context = F.substring("run", 1, k)
            runs = seen.withColumnsRenamed({"run_good": "good", "run_bad": "bad"})
            behind = _counted(runs, context)
            scored = scored.withColumn("key", context).join(behind, "key").drop("key")
        else:
            scored = scored.withColumns({f"n_{c}": F.lit(totals[c] or 0) for c in ("good", "bad")})
        mixed = {
            c: (F.col(f"run_{c}") + WEIGHT * F.col(f"p_{c}")) / (F.col(f"n_{c}") + WEIGHT) for c in ("good", "bad")
        }
        scored = scored.select("gram", *(value.alias(f"p_{c}") for c, value in mixed.items()))
    return scored.select("gram", (F.log("p_good") - F.log("p_bad")).alias("score"))


def best_threshold(scores: DataFrame) -> float:
    """Score from which held-out urls (``good`` true or false) are best told apart; 0 without both kinds."""
    edge = SCORE_RANGE * SCORE_BINS
    bin_ = F.greatest(F.lit(-edge), F.least(F.lit(edge), F.floor(F.col("score") * SCORE_BINS))).cast("int")
    table = scores.groupBy(bin_.alias("bin")).agg(
        F.count(F.when(F.col("good"), 1)).alias("good"), F.count(F.when(~F.col("good"), 1)).alias("bad")
    )
    bins = {r["bin"]: (r["good"], r["bad"]) for r in table.collect()}
    good, bad = (sum(b[i] for b in bins.values()) for i in (0, 1))
    if not good or not bad:
        return 0.0
    best, at, below_good, below_bad = -1.0, 0, 0, 0
    for cut in range(-edge, edge + 1):
        value = ((good - below_good) / good + below_bad / bad) / 2
        if value > best + 1e-12 or abs(value - best) <= 1e-12 and abs(cut) < abs(at):
            best, at = value, cut
        g, b = bins.get(cut, (0, 0))
        below_good, below_bad = below_good + g, below_bad + b
    return at / SCORE_BINS


def judge(pages: DataFrame, rules: Sequence[Rule], id_column: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: its id, ``host, path, rule, verdict, score`` (null where a rule decides)."""
    host, path = host_and_path("url")
    slim = pages.select(F.col(id_column).alias("id"), F.col(url).alias("url"))
    base = slim.select("id", host.alias("host"), path.alias("path"))
    base = base.withColumn("found", matching_rule("host", "path", rules))
    base = keep(
        base.select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            "host",
            "path",
            F.col("found.rule").alias("rule"),
            F.col("found.verdict").alias("decided"),
            (F.pmod(F.xxhash64("host", "path"), F.lit(5)) == 0).alias("held"),
        )
    )
    text = F.concat(F.lit(_START * CONTEXT), "host", "path", F.lit(_END))
    runs = F.transform(
        F.sequence(F.lit(1), F.length(text) - CONTEXT), lambda i: F.substr(text, i.cast("int"), F.lit(CONTEXT + 1))
    )
    places = base.select("row", "decided", "held", F.explode(runs).alias("gram"))
    counted = ~F.col("held") & F.col("decided").isNotNull()
    grams = keep(
        places.groupBy("gram").agg(
            F.count(F.when(counted & (F.col("decided") == "allow"), 1)).alias("good"),
            F.count(F.when(counted & (F.col("decided") == "block"), 1)).alias("bad"),
        )
    )
    needed = places.filter(F.col("decided").isNull() | F.col("held"))
    scores = needed.join(gram_scores(grams), "gram").groupBy("row").agg(F.avg("score").alias("score"))
    scores = keep(scores)
    known = base.filter("held AND decided IS NOT NULL").select("row", (F.col("decided") == "allow").alias("good"))
    threshold = best_threshold(scores.join(known, "row"))
    verdict = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return base.join(scores, "row", "left").select(
        F.col("id").alias(id_column),
        "host",
        "path",
        "rule",
        F.coalesce("decided", verdict).alias("verdict"),
        F.when(F.col("decided").isNull(), F.col("score")).alias("score"),
    )
