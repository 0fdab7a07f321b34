"""Quality classifier as a sparse rule ensemble.

Statistics of a text (lengths, shares of character kinds, repetition) feed a
small random forest. Every path from a root to a node of its trees is a rule: a
conjunction of ranges of statistics. A logistic regression with a lasso penalty
weighs the rules, most of them by zero, and the rest are compiled into one Spark
column expression, so scoring is a projection without a model or Python.

The forest and weights are fitted on at most ``sample`` labelled rows, those
with the smallest hashes of their id; statistics and scores cover all rows and
whole texts. Labels are learned only from rows whose CRC-32 of the id modulo 4
is not 2; neither labels nor id, language and source are inputs of a score.

Null texts are empty texts; empty texts have all statistics zero and a score like
any other. Rows without an id are scored and never learned from. An id with several
labels takes the least; null labels are ignored. With one class of labels, or none,
the score is that class (or one half) for all. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import keep
from cohortloom.session import shared_folder

SAMPLE_ROWS = 20_000
THRESHOLD = 0.7
SEED = 42
TREES, DEPTH = 16, 4
LASSO = 0.001
FOLDS, HELD_OUT = 4, 2
#: More of an outcome than one label in so many; bounds the score where all labels agree.
PRIOR = 0.5

_NODE = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def pieces(text: Column) -> Column:
    """The text, its words and its lines as a struct; several statistics share them."""
    value = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(value, r"[\x20\x09-\x0D]+"), "")
    lines = F.array_remove(F.split(value, "\n"), "")
    return F.struct(value.alias("value"), words.alias("words"), lines.alias("lines"))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate a value once for an expression that refers to it often, also where the optimizer moves it."""
    return F.transform(F.array(value), use)[0]


def statistics(parts: Column) -> dict[str, Column]:
    """Statistics of a text by name, from its ``pieces``; all are doubles.

    Characters are counted by patterns that seldom match.
    """
    text, words, lines = parts["value"], parts["words"], parts["lines"]
    chars, n_words, n_lines = F.length(text), F.size(words), F.size(lines)

    def share(of: Column, whole: Column) -> Column:
        return F.when(whole > 0, of.cast("double") / whole).otherwise(0.0)

    def kind(characters: str) -> Column:
        return share(F.regexp_count(text, F.lit(characters)), chars)

    return {
        "log_chars": F.log1p(chars.cast("double")),
        "log_words": F.log1p(n_words.cast("double")),
        "word_chars": share(chars, n_words),
        "line_words": share(n_words, n_lines),
        "beyond_ascii": share(F.octet_length(text) - chars, chars),
        "upper": kind("[A-Z]"),
        "digits": kind("[0-9]"),
        "stops": kind("[.,;:]"),
        "marks": kind("[!?]"),
        "symbols": kind(r"[#$%&*+/<=>@\\^_`{|}~()\[\]-]"),
        "distinct_words": share(F.size(F.array_distinct(words)), n_words),
        "distinct_lines": share(F.size(F.array_distinct(lines)), n_lines),
    }


def measured(text: Column) -> Column:
    """All statistics of a text as a struct."""
    return once(pieces(text), lambda p: F.struct(*(c.alias(n) for n, c in statistics(p).items())))


@dataclass(frozen=True)
class Rule:
    """Ranges of statistics, each above its first and up to its second number."""

    ranges: tuple[tuple[int, float, float], ...]

    def column(self, names: list[str], stats: Column) -> Column:
        """Whether the rule holds for a struct of statistics."""
        infinity = float("inf")
        whole = F.lit(True)
        for i, low, high in self.ranges:
            if low > -infinity:
                whole = whole & (stats[names[i]] > low)
            if high < infinity:
                whole = whole & (stats[names[i]] <= high)
        return whole


def tree_rules(description: str) -> list[Rule]:
    """Every path from a root to a node, read from the text form of trees."""
    found: dict[Rule, None] = {}
    path: list[tuple[int, int, str, float]] = []
    for line in description.splitlines():
        node = _NODE.match(line)
        if not node:
            continue
        depth = len(node[1])
        path = [p for p in path if p[0] < depth]
        path.append((depth, int(node[3]), node[4], float(node[5])))
        ranges: dict[int, tuple[float, float]] = {}
        for _, feature, side, value in path:
            low, high = ranges.get(feature, (float("-inf"), float("inf")))
            ranges[feature] = (low, min(high, value)) if side == "<=" else (max(low, value), high)
        found[Rule(tuple(sorted((f, *r) for f, r in ranges.items())))] = None
    return list(found)


@dataclass(frozen=True)
class RuleEnsemble:
    names: list[str]
    intercept: float
    weighted: list[tuple[Rule, float]]

    def score(self, stats: Column) -> Column:
        """Probability of label 1 from a struct of statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.weighted:
            total = total + F.when(rule.column(self.names, stats), F.lit(weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))

    def of_text(self, text: str) -> Column:
        return once(measured(F.col(text)), self.score)


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % FOLDS


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE_ROWS,
) -> RuleEnsemble:
    """Learn rules and weights from the labelled rows outside the held-out fold."""
    shared_folder(docs.sparkSession)
    usable = labels.filter(F.col(label).isNotNull() & (fold(F.col(id_column)) != HELD_OUT))
    one_each = usable.groupBy(F.col(id_column).alias("_id")).agg(F.min(label).cast("double").alias("label"))
    chosen = one_each.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    rows = texts.join(F.broadcast(chosen), "_id").select("label", measured(F.col("_text")).alias("stats"))
    rows = keep(rows.repartition(docs.sparkSession.sparkContext.defaultParallelism))
    names = rows.select("stats.*").columns
    kinds = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(kinds) < 2:
        good, n = kinds.get(1.0, 0), sum(kinds.values())
        share = (good + PRIOR) / (n + 2 * PRIOR)
        return RuleEnsemble(names, _logit(share), [])
    points = VectorAssembler(inputCols=names, outputCol="features").transform(rows.select("label", "stats.*"))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=5, seed=SEED, featureSubsetStrategy="onethird"
    ).fit(points)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        return RuleEnsemble(names, _logit(kinds.get(1.0, 0) / sum(kinds.values())), [])
    holds = (r.column(names, F.col("stats")).cast("double").alias(f"r{i}") for i, r in enumerate(rules))
    flags = rows.select("label", *holds)
    sparse = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(flags)
    sparse = keep(sparse.select("label", "features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=True).fit(sparse)
    weighted = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w]
    return RuleEnsemble(names, float(lasso.intercept), weighted)


def _logit(share: float) -> float:
    return math.log(share / (1 - share))


def quality_scores(docs: DataFrame, model: RuleEnsemble, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``held_out, score, predicted``."""
    slim = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    return slim.withColumn("score", model.of_text("text")).select(
        F.col("id").alias(id_column),
        F.coalesce(fold(F.col("id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_quality(docs: DataFrame, model: RuleEnsemble, text: str = "text") -> DataFrame:
    """Documents that the model accepts, with their columns."""
    return docs.filter(model.of_text(text) >= THRESHOLD)
