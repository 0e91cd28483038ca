"""Quality score of texts by a sparse ensemble of rules.

Shallow boosted trees over statistics of a bounded sample give paths; each path is a
rule, a conjunction of thresholds.  A logistic regression with lasso penalty weighs
the rules and sets most weights to zero.  What is left is compiled into one Spark
column expression, so that scoring is a projection without Python.

Defined cases: a null text is an empty one, whose statistics are 0; without labelled
rows, or with one class only, the score is the smoothed share of good labels; labels
other than 0 and 1 are not learned from; ids may be null or repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import held_out

#: At most so many labelled rows are learned from, the first by a hash.
SAMPLE = 20_000
THRESHOLD = 0.7
TREES, DEPTH, CUTS, RATE = 24, 3, 24, 0.3
PENALTY = 2e-3


def statistics() -> dict[str, str]:
    """SQL of each statistic, over the columns ``text``, ``words`` and ``lines``."""
    chars, words = "greatest(length(text), 1)", "greatest(size(words), 1)"
    count = lambda pattern: f"regexp_count(text, '{pattern}')"
    return {
        "log_words": "ln(1 + size(words))",
        "word_length": f"length(text) / {words}",
        "longest_word": "coalesce(array_max(transform(words, x -> length(x))), 0)",
        "words_a_line": f"{words} / greatest(size(lines), 1)",
        "distinct_words": f"size(array_distinct(words)) / {words}",
        "distinct_lines": "size(array_distinct(lines)) / greatest(size(lines), 1)",
        "upper": count(r"\\p{Lu}") + f" / {chars}",
        "digits": count(r"\\p{Nd}") + f" / {chars}",
        "symbols": count(r"[^\\p{L}\\p{Nd}\\s.,;:!?()\\x27\\x22-]") + f" / {chars}",
        "stops": count(r"[.,;:?]") + f" / {words}",
        "exclamations": count("!") + f" / {words}",
        "bars": count(r"\\|") + f" / {words}",
        "line_ends": count(r"[.!?](?=\\s*(\\n|\\z))") + " / greatest(size(lines), 1)",
    }


def with_statistics(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` and the statistics of each whole text, as doubles named ``q_...``."""
    words = r"array_remove(split(text, '\\s+'), '')"
    return (
        docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("words", F.expr(words))
        .withColumn("lines", F.expr(r"array_remove(split(text, '\\n'), '')"))
        .select(
            *[c for c in _names(keep, docs)],
            *[F.expr(f"CAST({sql} AS DOUBLE)").alias(f"q_{n}") for n, sql in statistics().items()],
        )
    )


def _names(keep: list[Column], docs: DataFrame) -> list[str]:
    return docs.select(*keep).columns


@dataclass(frozen=True)
class Rule:
    """Thresholds that all have to hold: ``(statistic, above, cut)``."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        found = np.ones(len(x), dtype=bool)
        for i, above, cut in self.terms:
            found &= (x[:, i] > cut) if above else (x[:, i] <= cut)
        return found

    def column(self, names: list[str]) -> Column:
        found = F.lit(True)
        for i, above, cut in self.terms:
            value = F.col(names[i])
            found = found & ((value > F.lit(cut)) if above else (value <= F.lit(cut)))
        return found


def _grow(x, gradient, weight, cuts, features, terms, depth, rules, step) -> None:
    """One tree on the gradient: appends the path to every node and updates ``step``."""
    if terms:
        rules.append(Rule(tuple(sorted(terms))))
    rows = np.flatnonzero(Rule(tuple(terms)).holds(x))
    value = gradient[rows].sum() / (weight[rows].sum() + 1.0)
    step[rows] = value
    if depth == 0 or len(rows) < 20:
        return
    best = None
    total_g, total_w = gradient[rows].sum(), weight[rows].sum()
    for i in features:
        at = np.searchsorted(cuts[i], x[rows, i], side="left")
        g = np.cumsum(np.bincount(at, gradient[rows], len(cuts[i]) + 1))[:-1]
        w = np.cumsum(np.bincount(at, weight[rows], len(cuts[i]) + 1))[:-1]
        n = np.cumsum(np.bincount(at, minlength=len(cuts[i]) + 1))[:-1]
        gain = g**2 / (w + 1) + (total_g - g) ** 2 / (total_w - w + 1)
        gain[(n < 5) | (n > len(rows) - 5)] = -1.0
        if len(gain) and (best is None or gain.max() > best[0]):
            best = (gain.max(), i, cuts[i][gain.argmax()])
    if best is None or best[0] <= total_g**2 / (total_w + 1) + 1e-6:
        return
    for above in (False, True):
        more = [*terms, (int(best[1]), above, float(best[2]))]
        _grow(x, gradient, weight, cuts, features, more, depth - 1, rules, step)


def grow_rules(x: np.ndarray, y: np.ndarray, seed: int = 5) -> list[Rule]:
    """Paths of boosted trees, each on some of the statistics, without repetitions."""
    random = np.random.Generator(np.random.PCG64(seed))
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, CUTS + 2)[1:-1])) for column in x.T]
    base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    margin = np.full(len(y), np.log(base / (1 - base)))
    rules: list[Rule] = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(len(y))
        some = random.permutation(x.shape[1])[: max(1, (2 * x.shape[1]) // 3)]
        _grow(x, y - p, p * (1 - p), cuts, some, [], DEPTH, rules, step)
        margin += RATE * np.clip(step, -4, 4)
    return list(dict.fromkeys(rules))


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, rounds: int = 600):
    """Weights and intercept by accelerated proximal gradient steps."""
    n, k = z.shape
    means = z.mean(axis=0)
    centred = z - means
    bound = 0.25 * max(np.linalg.norm(centred.T @ centred / n, 2), 1e-6) + 0.25
    w, b = np.zeros(k), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    v, c, t = w.copy(), b, 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(centred @ v + c, -30, 30))) - y
        stepped = v - centred.T @ error / n / bound
        new_w = np.sign(stepped) * np.maximum(np.abs(stepped) - penalty / bound, 0)
        new_b = c - error.mean() / bound
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new_w + (t - 1) / new_t * (new_w - w)
        c = new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return w, b - means @ w


def fit(x: np.ndarray, y: np.ndarray) -> tuple[list[tuple[Rule, float]], float]:
    """The rules with a weight other than zero, and the intercept."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return [], float(np.log(share / (1 - share)))
    rules = grow_rules(x, y)
    if not rules:
        return [], float(np.log(y.mean() / (1 - y.mean())))
    w, b = lasso_logistic(np.stack([r.holds(x) for r in rules], axis=1).astype(float), y)
    return [(r, float(c)) for r, c in zip(rules, w) if abs(c) > 1e-6], float(b)


def compile_score(rules: list[tuple[Rule, float]], intercept: float) -> Column:
    """The score as a Spark expression over the statistics."""
    names = [f"q_{n}" for n in statistics()]
    margin = F.lit(intercept)
    for rule, weight in rules:
        margin = margin + F.when(rule.column(names), F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """Rules and intercept from the labelled rows that are not held out."""
    usable = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out())
    # The first rows by hash: a bound that holds also where rows share an id.
    first = usable.select(F.col("doc_id").alias("__llm_label_id"), "quality")
    chosen = first.orderBy(F.xxhash64("__llm_label_id"), *first.columns).limit(sample)
    known = docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("__llm_label_id"))
    found = with_statistics(known.select("text", "quality"), [F.col("quality")])
    rows = found.orderBy(F.xxhash64(*found.columns)).limit(sample).toPandas()
    names = [f"q_{n}" for n in statistics()]
    return fit(rows[names].to_numpy(float), rows["quality"].to_numpy(float))


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """A row for each document: ``(doc_id, held_out, score, predicted)``."""
    score = compile_score(*train(docs, labels, sample))
    keep = [F.col("doc_id"), held_out().alias("held_out")]
    scored = with_statistics(docs, keep).select("doc_id", "held_out", score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents, all columns, whose score reaches the threshold.

    A null text counts as an empty one and is kept if that is; rows with a null or
    repeated id are each judged by their own text; without labels the smoothed share
    of good ones decides for all alike; an empty table stays empty.
    """
    score = compile_score(*train(docs, labels, sample))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__llm_row")
    scored = with_statistics(docs.select(whole, "text"), [F.col("__llm_row")])
    # Spark pushes no filter through a projection that numbers rows.  Below it each use
    # of a statistic in a rule would compute that statistic anew.
    number = F.monotonically_increasing_id().alias("__llm_number")
    scored = scored.select("__llm_row", score.alias("__llm_score"), number)
    kept = scored.filter((F.col("__llm_score") >= THRESHOLD) & (F.col("__llm_number") >= 0))
    return kept.select(*[F.col(f"__llm_row.`{c}`").alias(c) for c in docs.columns])
