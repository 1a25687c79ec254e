"""Quality rules: statistics of a text, and a decision list over them learned from labelled documents.

Statistics are one projection per text, without a shuffle. The list is learned by sequential covering:
a rule for bad documents is grown on two thirds of the labelled rows, one threshold condition at a
time by information gain, then cut back on the other third; rows it covers are set aside and the next
rule is grown on the rest. Each step asks Spark for counts per feature and bin, so what reaches the
driver is a few hundred numbers at any size. The result is an ordered conditional expression.

Everything here is DataFrame and SQL functions. Null and empty texts have no words, and fail the base
rule. Labels without a document, null labels and null ids teach nothing; with several labels for one
document the lowest counts. Without bad labels there are no rules, and the base rule decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewrank.llm.common import kept_table, packed

MIN_WORDS = 20  # fixed value
MAX_REPEAT_PERCENT = 30  # fixed value
RUN = 8  # fixed value
CUTS = 64
MAX_RULES = 8
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9
MIN_COVERED = 5

_SPACE = "' \\t\\n\\u000b\\f\\r'"
_GAP = r"r'[\x20\x09-\x0D]+'"

# `transform(array(x), name -> ...)[0]` gives x a name, so that it is computed once.
_TEXT_STATS = f"""
transform(array(split(btrim(body, {_SPACE}), {_GAP})), w ->
  transform(array(filter(split(body, r'\\n'), line -> btrim(line, {_SPACE}) != '')), lines ->
    named_struct(
      'n_words', if(w[0] = '', 0L, cast(size(w) as bigint)),
      'word_chars', cast(length(array_join(w, '')) as bigint),
      'n_symbols', cast(regexp_count(body, r'[#*$%&|<>]') as bigint),
      'n_dup_lines', cast(size(lines) - size(array_distinct(lines)) as bigint),
      'n_lines', cast(size(lines) as bigint),
      'n_distinct_words', if(w[0] = '', 0L, cast(size(array_distinct(w)) as bigint)),
      'n_capitals', cast(regexp_count(body, r'[A-Z]') as bigint),
      'runs', if(size(w) < {RUN}, array(),
        transform(sequence(1, size(w) - {RUN - 1}), i -> xxhash64(slice(w, i, {RUN}))))
    ))[0])[0]
"""

# Places of runs that stand twice, in order; each adds the words that the one before has not covered.
_REPEAT_WORDS = f"""
if(size(runs) = size(array_distinct(runs)), 0L,
  aggregate(
    transform(array(sort_array(transform(runs, (run, i) -> struct(run, i)))), s ->
      sort_array(transform(
        filter(s, (x, k) -> coalesce(get(s, k - 1).run = x.run, false) or coalesce(get(s, k + 1).run = x.run, false)),
        x -> x.i)))[0],
    named_struct('words', 0L, 'last', -{RUN}),
    (a, i) -> named_struct('words', a.words + least({RUN}, i - a.last), 'last', i),
    a -> a.words))
"""

FEATURES = {
    "words": "cast(n_words as double)",
    "word_length": "coalesce(try_divide(word_chars, n_words), 0.0D)",
    "symbol_share": "coalesce(try_divide(n_symbols, word_chars), 0.0D)",
    "capital_share": "coalesce(try_divide(n_capitals, word_chars), 0.0D)",
    "repeat_share": "coalesce(try_divide(n_repeat_words, n_words), 0.0D)",
    "distinct_share": "coalesce(try_divide(n_distinct_words, n_words), 0.0D)",
    "dup_line_share": "coalesce(try_divide(n_dup_lines, n_lines), 0.0D)",
}


def statistics(docs: DataFrame) -> DataFrame:
    """`doc_id, text_hash` and the counts of each text."""
    texts = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("body")
    )
    counted = texts.select("doc_id", "text_hash", F.expr(_TEXT_STATS).alias("s")).select("doc_id", "text_hash", "s.*")
    return counted.withColumn("n_repeat_words", F.expr(_REPEAT_WORDS)).drop("runs")


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """feature >= threshold, or < where `above` is false. `cut` is the threshold's number."""

    feature: str
    above: bool
    cut: int
    threshold: float

    def on_bins(self) -> Column:
        bin_of = F.col(self.feature)
        return bin_of > self.cut if self.above else bin_of <= self.cut

    def on_values(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value >= self.threshold if self.above else value < self.threshold


Rule = tuple[Condition, ...]


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out


def _cuts(labelled: DataFrame) -> dict[str, list[float]]:
    """Thresholds: quantiles of each feature over the labelled rows, closer together at both ends."""
    tail = [0.001, 0.003, 0.006, 0.01]
    places = tail + [i / CUTS for i in range(1, CUTS)] + [1 - t for t in reversed(tail)]
    asked = [F.percentile_approx(F.expr(e), places, 10_000).alias(f) for f, e in FEATURES.items()]
    row = labelled.agg(*asked).first()
    return {f: sorted(set(row[f] or [])) for f in FEATURES}


def _binned(labelled: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Labelled rows with each feature as the number of thresholds it reaches."""
    bins = [
        F.expr(f"size(filter(array({', '.join(f'{c!r}D' for c in cuts[f]) or 'cast(null as double)'}), c -> c <= value_{f}))").alias(f)
        for f in FEATURES
    ]
    values = [F.expr(e).alias(f"value_{f}") for f, e in FEATURES.items()]
    grows = F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0
    return labelled.select("doc_id", "bad", *values).select(grows.alias("grows"), "bad", *bins)


def _counts(rows: DataFrame) -> dict[str, dict[int, tuple[int, int]]]:
    """Feature -> bin -> rows that are bad, rows that are good."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES)))
    counted = (
        rows.select("bad", each.alias("x"))
        .groupBy("x.feature", "x.bin")
        .agg(F.sum(F.col("bad").cast("long")).alias("bad"), F.sum((~F.col("bad")).cast("long")).alias("good"))
        .collect()  # features x bins
    )
    out: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in FEATURES}
    for row in counted:
        out[row["feature"]][row["bin"]] = (row["bad"], row["good"])
    return out


def _best(counts: dict[str, dict[int, tuple[int, int]]], cuts: dict[str, list[float]]) -> tuple[Condition, int, int] | None:
    """The condition with the largest information gain, and the rows it leaves; ties go to the first."""
    best, best_gain = None, 1e-9
    for feature, bins in counts.items():
        bad, good = (sum(b[i] for b in bins.values()) for i in (0, 1))
        if not bad:
            return None
        before = math.log2(bad / (bad + good))
        below = [0, 0]
        for cut in range(len(cuts[feature])):
            b, g = bins.get(cut, (0, 0))
            below = [below[0] + b, below[1] + g]
            for above, (p, n) in ((False, below), (True, (bad - below[0], good - below[1]))):
                if p >= MIN_COVERED and (gain := p * (math.log2(p / (p + n)) - before)) > best_gain:
                    best, best_gain = (Condition(feature, above, cut, cuts[feature][cut]), p, n), gain
    return best


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        found = _best(_counts(rows.filter(_all([c.on_bins() for c in rule]))), cuts)
        if found is None:
            break
        rule.append(found[0])
        if found[2] == 0:
            break
    return tuple(rule)


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, float]:
    """The rule's best beginning on rows it was not grown on, and its precision there."""
    asked = []
    for i in range(1, len(rule) + 1):
        covered = _all([c.on_bins() for c in rule[:i]])
        asked += [F.count_if(covered & F.col("bad")).alias(f"bad{i}"), F.count_if(covered & ~F.col("bad")).alias(f"good{i}")]
    row = rows.agg(*asked).first()
    found = [(row[f"bad{i}"], row[f"good{i}"], i) for i in range(1, len(rule) + 1)]
    worth = [((p - n) / (p + n) if p + n else -1.0, p, i) for p, n, i in found]
    _, _, length = max(worth, key=lambda x: (x[0], x[1], -x[2]))
    p, n, _ = found[length - 1]
    return rule[:length], p / (p + n) if p >= 2 else 0.0


def learn(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """Rules for bad documents, in the order they were found. `labels`: `doc_id, quality` (0: bad)."""
    told = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        (F.min("quality") <= 0).alias("bad")
    )
    labelled = stats.join(told, "doc_id")
    cuts = _cuts(labelled)
    rows = kept_table(_binned(labelled, cuts), "labelled")
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        left = rows.filter(~_any(rules, Condition.on_bins))
        rule = _grow(left.filter("grows"), cuts)
        if not rule:
            break
        rule, precision = _prune(left.filter("not grows"), rule)
        if precision < MIN_PRECISION:
            break
        rules.append(rule)
    return rules


def _any(rules: list[Rule], form) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | _all([form(c) for c in rule])
    return out


def decision_list(rules: list[Rule]) -> Column:
    """True for documents to keep: the first rule that applies decides."""
    out = F.when(F.lit(False), False)
    for rule in rules:
        out = out.when(_all([c.on_values() for c in rule]), False)
    return out.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id, text_hash`, the statistics, `base_failed` and `kept`, one row per document."""
    stats = kept_table(statistics(docs), "statistics")
    verdict = decision_list(learn(stats, labels))
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, columns unchanged."""
    kept = judge(docs, labels).filter("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")
    )
    kept = kept.distinct()  # repeated rows of one document
    own = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash"))
    return packed(docs).join(kept, own, "left_semi").select("row.*")
