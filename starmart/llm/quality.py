"""Quality rules as weak supervision.

Each rule votes good, votes bad or abstains on a document. How far a rule can be trusted is
not set by hand: expectation-maximisation takes the true quality as hidden and estimates, for
either quality, how often each rule votes what. A document stays if its posterior
probability of being good reaches ``keep_from``; no single rule can sink it.

All that the estimation needs is how often each pattern of votes occurs, at most three to
the power of the number of rules, counted over all documents in one aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.columns import quoted
from starmart.llm.common import BLANKS, BLANK_CLASS, other_columns, staged, whole_text

SYMBOLS = "#*$%&|<>"
GOOD, BAD, ABSTAIN = 1, 2, 0


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: Column
    good: Column

    def vote(self) -> Column:
        # A comparison with a null measure abstains.
        return F.when(self.bad, BAD).when(self.good, GOOD).otherwise(ABSTAIN)


def per_word(measure: str) -> Column:
    return F.try_divide(measure, "n_words")  # null without words


def default_rules() -> list[Rule]:
    n_words, length = F.col("n_words"), per_word("word_chars")
    symbols, repeats = per_word("n_symbols"), per_word("n_repeat_words")
    share = F.try_divide("n_symbols", "word_chars")
    dup_lines = F.try_divide("n_dup_lines", "n_word_lines")
    return [
        Rule("length", n_words < 50, n_words >= 100),
        Rule("word_length", (length < 2.5) | (length > 12), length.between(3.5, 9)),
        # Three looks at the same defect: one rule alone cannot outvote the others.
        Rule("symbols", symbols > 0.1, symbols < 0.02),
        Rule("many_symbols", symbols > 0.3, symbols < 0.05),
        Rule("symbol_share", share > 0.05, share < 0.01),
        Rule("lines", dup_lines > 0.3, dup_lines < 0.1),
        Rule("repeats", repeats > 0.5, repeats < 0.2),
        Rule("capitals", per_word("n_capitals") > 2, per_word("n_capitals") < 0.7),
        Rule("digits", per_word("n_digits") > 1, per_word("n_digits") < 0.1),
    ]


def measures(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The input without its text, and the measures of :func:`default_rules` as longs.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_word_lines`` and
    ``n_dup_lines`` (lines with a word; those equal to an earlier one), ``n_repeat_words`` (words
    in three-word windows that the text holds twice or more, the first included),
    ``n_capitals`` and ``n_digits`` (A-Z, 0-9).
    """
    names = [c for c in other_columns(docs, MEASURES) if c != text]
    whole = F.col("_llm_text")
    without = lambda chars: F.length(F.translate(whole, chars, ""))
    hashes = F.transform(
        F.filter(F.split(whole, BLANK_CLASS + "+"), lambda w: w != ""), lambda w: F.xxhash64(w)
    )
    # Every step on arrays is a column of its own, so that no lambda computes an array again.
    df = docs.select(*(quoted(c) for c in names), whole_text(text).alias("_llm_text"))
    df = df.select(
        *(quoted(c) for c in names),
        hashes.alias("_llm_words"),
        without(BLANKS).cast("long").alias("word_chars"),
        (F.length(whole) - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length(whole) - without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("n_capitals"),
        (F.length(whole) - without("0123456789")).cast("long").alias("n_digits"),
        F.filter(F.split(whole, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("_llm_lines"),
    )
    kept = [*names, "word_chars", "n_symbols", "n_capitals", "n_digits"]
    n = F.size("_llm_words")
    windows = F.zip_with(
        F.slice("_llm_words", 1, F.greatest(n - 2, F.lit(0))),
        F.zip_with(
            F.slice("_llm_words", 2, F.greatest(n - 2, F.lit(0))),
            F.slice("_llm_words", 3, F.greatest(n - 2, F.lit(0))),
            lambda b, c: F.xxhash64(b, c),
        ),
        lambda a, bc: F.xxhash64(a, bc),
    )
    df = df.select(
        *(quoted(c) for c in kept),
        n.cast("long").alias("n_words"),
        F.size("_llm_lines").cast("long").alias("n_word_lines"),
        (F.size("_llm_lines") - F.size(F.array_distinct("_llm_lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("_llm_windows"),
    )
    kept += ["n_words", "n_word_lines", "n_dup_lines"]
    return words_repeated(df, "_llm_windows", kept, "n_repeat_words")


def words_repeated(df: DataFrame, windows: str, kept: Sequence[str], name: str) -> DataFrame:
    """Words covered by three-word windows that are there twice or more.

    ``windows`` holds a 64-bit hash a window. Sorted, equal ones are neighbours; to keep their
    places, the low bits of each are overwritten by its place, just as many as the text's
    length needs. Neighbours alike in the high bits are then compared in full. Different hashes
    alike in the high bits may stand between equal ones; such places (``mixed``, next to
    none) are compared among themselves, so nothing is missed.
    """
    columns = [quoted(c) for c in kept]
    bits = F.length(F.bin(F.size(windows).cast("long")))
    df = df.select(
        *columns,
        windows,
        bits.alias("_llm_bits"),
        F.sort_array(
            F.transform(
                windows,
                lambda h, i: F.call_function("shiftleft", F.call_function("shiftright", h, bits), bits).bitwiseOR(
                    i.cast("long")
                ),
            )
        ).alias("_llm_sorted"),
    )
    at = lambda i: F.get("_llm_sorted", i)
    m = F.size("_llm_sorted")
    df = df.select(
        *columns,
        windows,
        F.when(
            m >= 2,
            F.transform(
                F.filter(
                    F.sequence(F.lit(0), m - 2),
                    lambda i: F.call_function("shiftright", at(i).bitwiseXOR(at(i + 1)), F.col("_llm_bits")) == 0,
                ),
                lambda i: F.struct(
                    place(at(i), F.col("_llm_bits")).alias("a"), place(at(i + 1), F.col("_llm_bits")).alias("b")
                ),
            ),
        )
        .otherwise(F.array().cast("array<struct<a:int,b:int>>"))
        .alias("_llm_pairs"),
    )
    same = lambda p: F.get(windows, p["a"]) == F.get(windows, p["b"])
    both = lambda pairs: F.concat(F.transform(pairs, lambda p: p["a"]), F.transform(pairs, lambda p: p["b"]))
    df = df.select(
        *columns,
        windows,
        both(F.filter("_llm_pairs", same)).alias("_llm_same"),
        both(F.filter("_llm_pairs", lambda p: ~same(p))).alias("_llm_mixed"),
    )
    again = F.filter(
        "_llm_mixed",
        lambda p: F.exists("_llm_mixed", lambda q: (q != p) & (F.get(windows, q) == F.get(windows, p))),
    )
    df = df.select(*columns, F.sort_array(F.array_distinct(F.concat("_llm_same", again))).alias("_llm_places"))
    covered = F.transform(
        "_llm_places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_llm_places", i + 1) - p, F.lit(3)))
    )
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return df.select(*columns, total.cast("long").alias(name))


def place(packed: Column, bits: Column) -> Column:
    """The low bits of a packed hash."""
    return packed.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int")


MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_word_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_digits",
]


@dataclass(frozen=True)
class LabelModel:
    """``prior`` is the share of good documents; ``rates[rule][vote]`` how often it casts it on (bad, good) ones."""

    prior: float
    rates: list[dict[int, tuple[float, float]]]

    def log_odds(self, votes: Sequence[int]) -> float:
        return math.log(self.prior / (1 - self.prior)) + sum(
            math.log(rate[v][1] / rate[v][0]) for rate, v in zip(self.rates, votes, strict=True)
        )

    def accuracy(self, rule: int) -> float:
        """How often the rule is right when it votes."""
        bad, good, p = self.rates[rule][BAD], self.rates[rule][GOOD], self.prior
        right, wrong = (1 - p) * bad[0] + p * good[1], (1 - p) * good[0] + p * bad[1]
        return right / (right + wrong)


def fit_votes(
    patterns: dict[tuple[int, ...], int], rules: int, *, rounds: int = 50, smoothing: float = 1.0
) -> LabelModel:
    """Expectation-maximisation over the counts of vote patterns.

    Starts from the majority of the votes, so that ``good`` keeps its meaning. Without any
    document the model is undecided: prior one half, all rates alike.
    """
    order = sorted(patterns)
    good = {v: (1 + 2 * v.count(GOOD)) / (2 + 2 * v.count(GOOD) + 4 * v.count(BAD)) for v in order}
    model = LabelModel(0.5, [{v: (1 / 3, 1 / 3) for v in (ABSTAIN, GOOD, BAD)} for _ in range(rules)])
    for _ in range(rounds if order else 0):
        total_good = sum(patterns[v] * good[v] for v in order)
        total_bad = sum(patterns[v] * (1 - good[v]) for v in order)
        rates = []
        for r in range(rules):
            counts = {v: [smoothing, smoothing] for v in (ABSTAIN, GOOD, BAD)}
            for votes in order:
                counts[votes[r]][0] += patterns[votes] * (1 - good[votes])
                counts[votes[r]][1] += patterns[votes] * good[votes]
            rates.append(
                {v: (b / (total_bad + 3 * smoothing), g / (total_good + 3 * smoothing)) for v, (b, g) in counts.items()}
            )
        model = LabelModel((total_good + smoothing) / (total_good + total_bad + 2 * smoothing), rates)
        good = {v: 1 / (1 + math.exp(-max(-60.0, min(60.0, model.log_odds(v))))) for v in order}
    return model


def judge_quality(
    docs: DataFrame, *, text: str = "text", rules: Sequence[Rule] | None = None, keep_from: float = 0.5
) -> DataFrame:
    """Judge every document by rules of estimated accuracy.

    Result: the input without its text, the measures of :func:`measures`, ``votes`` (a map from a rule's
    name to 0 abstains, 1 good, 2 bad), ``quality`` (posterior probability) and ``kept``.

    * A null or empty text has no words; its ratios are unknown, so most rules abstain.
    * Equal rows are judged alike, each counting for the estimation. An empty table gives an empty one.
    * Input columns named like a result, in any case, are replaced.
    """
    rules = list(rules or default_rules())
    measured = staged(measures(docs, text=text), "quality-measures")
    votes = [f"_llm_vote_{i}" for i in range(len(rules))]
    voted = measured.withColumns({v: rule.vote() for v, rule in zip(votes, rules, strict=True)})
    patterns = voted.groupBy(*votes).count().collect()  # three to the power of the rules at most
    model = fit_votes({tuple(r[v] for v in votes): r["count"] for r in patterns}, len(rules))
    odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for v, rate in zip(votes, model.rates, strict=True):
        weight = {k: math.log(good / bad) for k, (bad, good) in rate.items()}
        odds = odds + F.when(F.col(v) == GOOD, weight[GOOD]).when(F.col(v) == BAD, weight[BAD]).otherwise(
            weight[ABSTAIN]
        )
    quality = 1 / (1 + F.exp(-odds))
    named = F.create_map(*(x for v, rule in zip(votes, rules, strict=True) for x in (F.lit(rule.name), F.col(v))))
    names = other_columns(measured, ("votes", "quality", "kept"))
    return voted.select(
        *(quoted(c) for c in names),
        named.alias("votes"),
        quality.alias("quality"),
        (quality >= keep_from).alias("kept"),
    )
