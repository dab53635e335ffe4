"""Quality classifier: a sparse rule ensemble (operator 3).

Statistics of the whole text are Spark columns. A small random forest over the statistics of
labelled documents proposes rules: each path from a root to a node is a conjunction of
threshold comparisons. A lasso logistic regression over the rules (as 0/1 columns) keeps the
few that matter, and the model is compiled into one Spark column expression, so scoring is a
projection without Python or a shuffle.

Labels are learned only from rows that ``held_out`` does not mark; the score reads nothing
but the text. Training rows are all labelled rows up to MAX_TRAINING_ROWS; beyond that, a
sample by hash of the id with that expected size.

Defined cases: a null text is an empty one and is scored; null labels and null ids are not
learned from; repeated labels of a document vote; with no labels, or one class only, the
score is the class share (0.5 without labels) for every document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlens.llm.common import SPACE_RUN, held_out, id_and_text
from assetlens.session import materialize

MAX_TRAINING_ROWS = 200_000
TREES, DEPTH, BINS, SEED = 12, 4, 64, 7
LASSO = 0.0005

Condition = tuple[str, str, float]
"""A statistic, ``<=`` or ``>``, and a threshold."""

Rule = tuple[Condition, ...]


def words_of(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(text, SPACE_RUN, " ")), " ")


def text_stats(text: Column, words: Column | None = None) -> dict[str, Column]:
    """Statistics of a non-null text, each a double; shares are of characters or words."""
    words = words_of(text) if words is None else words
    n_words = F.size(words)
    n_chars = F.greatest(F.length(text), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / n_chars

    stats = {
        "log_words": F.log(F.lit(1.0) + n_words),
        "chars_per_word": n_chars / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "upper": share(r"\p{Lu}"),
        "digits": share(r"\p{N}"),
        "stops": share(r"[.?]"),
        "pauses": share(r"[,;:]"),
        "symbols": share(r"[^\p{L}\p{N}\s.,;:?'-]"),
        "symbol_runs": share(r"[^\p{L}\p{N}\s.,;:?'-]{2,}"),
        "lines": share(r"\n"),
    }
    return {name: c.cast("double") for name, c in stats.items()}


def stats_table(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and the statistics: one narrow row per row of ``docs``."""
    d = id_and_text(docs)
    return d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                    *[c.alias(name) for name, c in text_stats(F.col("text")).items()])


def _holds(rule: Rule, stats: dict[str, Column]) -> Column:
    out = F.lit(True)
    for name, side, threshold in rule:
        out = out & (stats[name] <= threshold if side == "<=" else stats[name] > threshold)
    return out


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules; ``score`` compiles them over given statistics columns."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, stats: dict[str, Column]) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.when(_holds(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(forest, names: list[str]) -> list[Rule]:
    """Every path of the forest's trees from the root to another node, once."""
    rules: dict[Rule, None] = {}

    def walk(node, path: Rule) -> None:
        if path:
            rules[path] = None
        if node.subtreeDepth():
            split = node.split()
            name, threshold = names[split.featureIndex()], float(split.threshold())
            walk(node.leftChild(), (*path, (name, "<=", threshold)))
            walk(node.rightChild(), (*path, (name, ">", threshold)))

    for tree in forest.trees:
        walk(tree._call_java("rootNode"), ())
    return list(rules)


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality") -> RuleEnsemble:
    """Learns from the rows of ``stats`` (a written table) that are not held out and have a
    label."""
    names = [c for c in stats.columns if c not in ("doc_id", "held_out")]
    votes = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")) \
        .dropna().groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("double").alias("label"))
    train = materialize(stats.filter(~F.col("held_out")).drop("held_out").join(votes, "doc_id"), "quality-training")
    n, positive = train.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or positive in (0, n):
        share = (positive / n) if n else 0.5
        return RuleEnsemble({0.0: -20.0, 0.5: 0.0, 1.0: 20.0}[share], ())
    if n > MAX_TRAINING_ROWS:
        train = train.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < (MAX_TRAINING_ROWS << 20) // n)
    featured = train.select("label", array_to_vector(F.array(*names)).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=BINS, seed=SEED,
                                    featureSubsetStrategy="0.5", minInstancesPerNode=5).fit(featured)
    rules = tree_rules(forest, names)
    if not rules:
        return RuleEnsemble(0.0, ())
    columns = {name: F.col(name) for name in names}
    ruled = train.select("label", array_to_vector(F.array(
        *[_holds(r, columns).cast("double") for r in rules])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=80, standardization=False).fit(ruled)
    weights = [(rule, float(w)) for rule, w in zip(rules, lasso.coefficients.toArray()) if w]
    return RuleEnsemble(float(lasso.intercept), tuple(weights))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    stats = materialize(stats_table(docs), "quality-stats")
    model = fit(stats, labels)
    score = model.score({c: F.col(c) for c in stats.columns})
    return stats.select("doc_id", "held_out", score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def training_ids(labels: DataFrame, label: str = "quality") -> DataFrame:
    """The labelled ids that are not held out, about MAX_TRAINING_ROWS of them at most (by hash); a
    written table."""
    ids = labels.dropna(subset=["doc_id", label]).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    ids = materialize(ids.filter(~held_out(F.col("doc_id"))), "quality-labelled")
    n = ids.count()
    if n <= MAX_TRAINING_ROWS:
        return ids
    return ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < (MAX_TRAINING_ROWS << 20) // n)


def keep_accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns. Statistics of the
    training rows are written first; those of all rows are computed once, while they are scored."""
    # Ids of a bounded sample, 8 bytes each: this broadcast has at most some 2 MB.
    learned = id_and_text(docs).join(F.broadcast(training_ids(labels)), "doc_id", "left_semi")
    model = fit(materialize(stats_table(learned), "quality-stats"), labels)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    # The optimizer would repeat each statistic in every rule that uses it. The variable of
    # a transform is evaluated once, so words and statistics are bound as one-element arrays.
    stats = F.transform(F.array(words_of(text)), lambda words: F.struct(
        *[c.alias(name) for name, c in text_stats(text, words).items()]))
    names = list(text_stats(text))
    score = F.transform(stats, lambda s: model.score({name: s[name] for name in names}))
    return docs.filter(F.get(score, F.lit(0)) >= 0.5)
