"""Quality classifier: a sparse ensemble of rules.

Statistics of each text are Spark columns. A small forest of shallow trees is fitted on labelled rows;
every path from a root to a node is a conjunction of comparisons, i.e. a rule. A logistic
regression with a lasso penalty over all rules (and the statistics themselves) keeps a few of them.
The kept rules are compiled into one column expression, so scoring is a projection of the
statistics without a model object or Python.

Trees and regression are fitted by Spark ML over all labelled rows of the learning folds (partial
sums per partition); only rules and weights reach the driver. The lasso keeps the rows' binary rule
columns as sparse vectors.

Defined cases: null and empty texts have zero statistics and a score; rows without labels, and
labels without documents, are left out of learning; several labels of a doc_id, or several rows, each
count; a table with fewer than two classes to learn from gives every row the share of label 1 (0.5 with no
labels); an empty table gives an empty result; extra columns do not matter. Language, source,
doc_id and labels are never inputs of a score.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from flowruns.llm.common import BLANKS, staged, table

FOLDS = 5  # fold 0 is held out


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text, all numbers. ``words`` and ``rest`` are helper columns (see ``with_statistics``)."""
    n = F.greatest(F.size("words"), F.lit(1)).cast("double")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    left = lambda others: F.length(F.regexp_replace("rest", others, "")).cast("double")
    solid = F.length(F.array_join("words", "")).cast("double")
    lines = F.split(text, "\n")
    return {
        "words": F.size("words").cast("double"),
        "word_length": solid / n,
        "distinct": F.size(F.array_distinct("words")) / n,
        "follows_itself": F.size(F.filter("words", lambda w, i: w == F.get(F.col("words"), i - 1))) / n,
        "upper": left(r"\P{Lu}+") / chars,
        "digits": left(r"\P{Nd}+") / chars,
        "marks": left(r"\P{Punct}+") / chars,
        "symbols": left(r"[^#*$%&|<>]+") / chars,
        "exclaims": left(r"[^!]+") / chars,
        "ends": left(r"[^.!?]+") / n,
        "commas": left(r"[^,]+") / n,
        "line_words": n / F.size(lines),
        "dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))) / F.size(lines).cast("double"),
    }


def with_statistics(docs: DataFrame, text: str, keep: list[Column]) -> tuple[DataFrame, list[str]]:
    body = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(*keep, body.alias("body"))
    df = df.withColumn("words", F.array_remove(F.split("body", BLANKS), "")).withColumn("rest", F.regexp_replace("body", "[a-z ]+", ""))
    stats = statistics(F.col("body"))
    names = [c for c in df.columns if c not in ("body", "words", "rest")]
    return df.select(*names, *[c.cast("double").alias(f"s_{k}") for k, c in stats.items()]), [f"s_{k}" for k in stats]


def tree_rules(debug: str, names: list[str]) -> set[tuple]:
    """Rules of a tree's ``toDebugString``: for every node below the root, the comparisons on its path."""
    out, path = set(), []
    for line in debug.splitlines():
        m = re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if m:
            depth = len(m[1])
            path = [p for p in path if p[0] < depth] + [(depth, names[int(m[3])], m[4], float(m[5]))]
            out.add(tuple(sorted(p[1:] for p in path)))
    return out


def rule_sql(rule: tuple) -> str:
    return " AND ".join(f"`{name}` {op} {value!r}D" for name, op, value in rule)


class RuleModel:
    """Rules and statistics with their weights; ``score`` is a column over the statistics."""

    def __init__(self, bias: float, rules: list[tuple[tuple, float]], linear: list[tuple[str, float]]):
        self.bias, self.rules, self.linear = bias, rules, linear

    def score(self) -> Column:
        total = [repr(self.bias) + "D"]
        total += [f"CASE WHEN {rule_sql(r)} THEN {w!r}D ELSE 0D END" for r, w in self.rules]
        total += [f"{w!r}D * least(greatest(`{n}`, -1e6D), 1e6D)" for n, w in self.linear]
        return F.expr(f"1D / (1D + exp(-least(700D, greatest(-700D, {' + '.join(total)}))))")


def fit_rules(rows: DataFrame, names: list[str], label: str = "label", trees: int = 12, depth: int = 3, penalty: float = 0.001,
              seed: int = 7) -> RuleModel:
    """Learn from ``rows`` with the statistics ``names`` and a 0/1 ``label``."""
    from math import log

    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    seen = {r[0]: r[1] for r in rows.groupBy(label).agg(F.count("*")).collect()}
    if len(seen) < 2:
        p = 0.5 if not seen else min(max(float(next(iter(seen))), 0.01), 0.99)
        return RuleModel(log(p / (1 - p)), [], [])
    vectors = VectorAssembler(inputCols=names, outputCol="v").transform(rows).select("v", F.col(label).cast("double").alias("y"))
    # the seed fixes the draws from rows in the order they are read; rows in another order may give another forest
    forest = RandomForestClassifier(featuresCol="v", labelCol="y", numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.7,
                                    featureSubsetStrategy="onethird", cacheNodeIds=False).fit(vectors)
    rules = sorted(set().union(*[tree_rules(t.toDebugString, names) for t in forest.trees]))
    wide = rows.select(F.col(label).cast("double").alias("y"), *names, *[F.expr(f"CASE WHEN {rule_sql(r)} THEN 1D ELSE 0D END").alias(f"r{i}") for i, r in enumerate(rules)])
    wide = VectorAssembler(inputCols=[*names, *[f"r{i}" for i in range(len(rules))]], outputCol="v").transform(wide).select("v", "y")
    lasso = LogisticRegression(featuresCol="v", labelCol="y", elasticNetParam=1.0, regParam=penalty, maxIter=60, tol=1e-5).fit(wide)
    w = lasso.coefficients.toArray().tolist()
    return RuleModel(float(lasso.intercept), [(r, x) for r, x in zip(rules, w[len(names):]) if x], [(n, x) for n, x in zip(names, w) if x])


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
           threshold: float = 0.3, **how) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    fold = F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS
    stats, names = with_statistics(docs, text, [F.col(key).alias("doc_id"), F.coalesce(fold == 0, F.lit(False)).alias("held_out")])
    stats = staged(stats, "statistics")
    marks = labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    learn = staged(stats.where(~F.col("held_out")).join(marks, stats["doc_id"] == marks["_id"]).select(*names, "label"), "learn")
    model = fit_rules(learn, names, **how)
    out = stats.select("doc_id", "held_out", model.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op8_rule_quality(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from four fifths of the labelled ones."""
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
