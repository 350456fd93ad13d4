"""Quality by weak supervision: rules vote or abstain, EM weighs them.

Every rule looks at one document and votes good, bad or nothing. Documents are
counted by their pattern of votes, of which there are at most 3 ** rules, and
expectation-maximisation over those counts estimates how often each rule is right.
A document's posterior probability of being good follows from its votes. Features,
votes and posterior are native columns; a text is read once.

NULL texts count as empty. Rows are kept apart even if their ids are equal or NULL.
An empty table gives an empty result. Columns other than id and text are not used,
so their names cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.tables import let, small_batches
from starloom.operators.joins import fits_broadcast
from starloom.session import stage

SPACE = r"[\x09-\x0D\x20]+"
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = r"[^#*$%&|<>]+"
GOOD, ABSTAIN, BAD = 1, 0, -1
MIN_WORDS = 50
#: EM: pseudo-counts, the share of good documents and the accuracies at the start, rounds.
SMOOTHING, START, ROUNDS = 1.0, 0.9, 50
#: What EM may find: accuracy of a rule, share of good documents. Two rules of the least
#: accuracy that agree outweigh the largest share; one of them alone does not.
ACCURACY, PRIOR = (0.85, 0.999), (0.5, 0.95)


def _dup_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    return let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept)))


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that the text holds twice or more.

    Windows are compared by a 64-bit hash. Sorted by hash, equal windows are
    neighbours; sorted by position, each adds the words its predecessor left out.
    """

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(
                F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("at")
            ),
        )

    def repeated(s: Column) -> Column:
        twin = lambda x, i: F.get(s, i)["h"] == x["h"]
        either = lambda x, i: F.coalesce(twin(x, i - 1), F.lit(False)) | F.coalesce(
            twin(x, i + 1), F.lit(False)
        )
        return F.transform(F.filter(s, either), lambda x: x["at"])

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    found = let(let(words, windows), lambda x: let(F.array_sort(x), repeated))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(F.array_sort(found), covered))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts that the rules and the base filter read, one row per document."""
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split(text, SPACE), ""))
    words = F.col("words")
    counted = rows.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
        _dup_lines(text).cast("long").alias("n_dup_lines"),
        _repeat_words(words).cast("long").alias("n_repeat_words"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]+", "")).cast("long").alias("n_alnum"),
        F.length(F.regexp_replace(text, r"[^!?]+", "")).cast("long").alias("n_marks"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


@dataclass(frozen=True)
class Rule:
    """``bad`` and ``good`` are SQL conditions over the features; neither: it abstains."""

    name: str
    bad: str
    good: str = "false"

    def vote(self) -> Column:
        return F.expr(f"CASE WHEN {self.bad} THEN {BAD} WHEN {self.good} THEN {GOOD} ELSE {ABSTAIN} END")


#: The rules of the registered query. Shares are of words or characters of the whole text.
#: Each kind of fault is seen by two rules or more: EM trusts rules that agree with others.
RULES = (
    Rule("symbols", "n_symbols > 0.10 * n_words"),
    Rule("letters", "n_alnum < 0.90 * word_chars"),
    Rule("shouting", "n_upper > 0.20 * n_alnum"),
    Rule("marks", "n_marks > 0.10 * n_words"),
    Rule("repeats", "n_repeat_words > 0.30 * n_words"),
    # the words of a text grow like a power of its length, so its share of distinct ones falls
    Rule("variety", "n_distinct < 0.8 * power(n_words, 0.75)"),
    Rule("lines", "n_dup_lines >= 3"),
    Rule("word_length", "word_chars < 2.0 * n_words OR word_chars > 20.0 * n_words"),
    Rule(
        "clean",
        "false",
        "n_symbols <= 0.03 * n_words AND n_alnum >= 0.93 * word_chars AND n_marks <= 0.02 * n_words"
        " AND n_repeat_words <= 0.10 * n_words AND n_upper <= 0.10 * n_alnum",
    ),
)


@dataclass(frozen=True)
class Model:
    """Share of good documents, and of each rule the share of its votes that are right."""

    prior: float
    accuracy: dict[str, float]

    def weight(self, rule: str) -> float:
        return math.log(self.accuracy[rule]) - math.log(1 - self.accuracy[rule])

    def log_odds(self, votes: dict[str, int]) -> float:
        odds = math.log(self.prior) - math.log(1 - self.prior)
        return odds + sum(v * self.weight(rule) for rule, v in votes.items())


def _posterior(log_odds: float) -> float:
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, log_odds))))


def _within(value: float, bounds: tuple[float, float]) -> float:
    return max(bounds[0], min(bounds[1], value))


def fit(patterns: list[tuple[dict[str, int], int]], names: list[str], rounds: int = ROUNDS) -> Model:
    """EM over counted vote patterns, accuracies and prior kept within their bounds."""
    model = Model(START, {name: START for name in names})
    for _ in range(rounds):
        belief = [_posterior(model.log_odds(votes)) for votes, _ in patterns]
        rows = sum(n for _, n in patterns)
        good = sum(n * p for (_, n), p in zip(patterns, belief))
        accuracy = {}
        for name in names:
            said = [(n, p if x[name] == GOOD else 1 - p) for (x, n), p in zip(patterns, belief) if x[name] != ABSTAIN]
            right = sum(n * p for n, p in said) + START * SMOOTHING
            accuracy[name] = _within(right / (sum(n for n, _ in said) + SMOOTHING), ACCURACY)
        model = Model(_within((good + START * SMOOTHING) / (rows + SMOOTHING), PRIOR), accuracy)
    return model


def _vote_column(rule: str) -> str:
    return f"vote_{rule}"


def learn(rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> Model:
    """EM over the vote patterns of ``rows``. Those that reach the driver are bounded by
    the number of rules, whatever the number of documents."""
    names = [r.name for r in rules]
    counted = rows.groupBy(*map(_vote_column, names)).count().collect()
    patterns = [({n: r[_vote_column(n)] for n in names}, r["count"]) for r in counted]
    return fit(sorted(patterns, key=lambda x: tuple(x[0].values())), names)


def verdict(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with the posterior of their votes and whether they are kept."""
    votes = [F.col(_vote_column(n)) * model.weight(n) for n in model.accuracy]
    odds = reduce(lambda a, b: a + b, votes, F.lit(model.log_odds({})))
    posterior = 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), odds))))
    return rows.withColumn("posterior", posterior).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)
    )


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Features, votes, posterior and verdict of every document. The features are written once."""
    votes = {_vote_column(r.name): r.vote() for r in rules}
    rows = stage(features(docs, id_col, text_col).withColumns(votes), "quality")
    return verdict(rows, learn(rows, rules))


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` without the rejected ones: their ids, not their texts, are joined.

    Rows that share an id are judged together: they stay if all of them are kept.
    Rows without an id are judged by their text's digest.
    """
    small_batches(docs.sparkSession)
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(F.col(text_col).cast("binary"))), F.lit("none"))
    judged = judge(docs.withColumn("__key", key), "__key", text_col, rules)
    out = stage(judged.where(~F.col("kept")).select(F.col("doc_id").alias("__key")).distinct(), "rejected")
    out = F.broadcast(out) if fits_broadcast(out) else out
    return docs.withColumn("__key", key).join(out, "__key", "left_anti").select(*docs.columns)
