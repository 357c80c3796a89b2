"""Quality rules combined by weak supervision (DataFrame operations only).

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation
over the counts of vote patterns estimates, without labels, how each rule
votes on good and on bad documents; a document is kept if its posterior
probability of being good is at least one half.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import let
from .common import materialize

WORD = r"[^\x20\x09-\x0D]+"
_BETWEEN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: A word of letters, with an apostrophe or hyphen inside and a mark behind it at most.
PLAIN = r"(?<![^\x20\x09-\x0D])\p{L}++(?:['’-]\p{L}++)*+[.,;:!?]?(?![^\x20\x09-\x0D])"

#: (name, measure, side, good limit, bad limit): good up to (at_most) or from (at_least) the good limit, bad beyond
#: the bad one, else abstaining. Without a good limit a rule only warns: it votes bad or abstains.
RULES = (
    ("plain", "plain_share", "at_least", 0.9, 0.7),
    ("short_words", "short_share", "at_least", 0.1, 0.02),
    ("word_chars", "mean_chars", "at_most", None, 12.0),
    ("symbols", "symbol_share", "at_most", None, 0.1),
    ("line_copies", "dup_line_share", "at_most", None, 0.2),
    ("repeats", "repeat_share", "at_most", None, 0.3),
    ("capitals", "capital_share", "at_most", None, 0.4),
    ("shouts", "shout_share", "at_most", None, 0.3),
)
EM_ROUNDS = 50
#: Before any evidence: share of good documents, and how votes (bad, abstaining, good) fall on bad and on good ones,
#: for rules that may vote good and for those that only warn.
PRIOR_GOOD = 0.8
PRIOR_VOTES = ((0.5, 0.3, 0.2), (0.01, 0.1, 0.89))
PRIOR_WARNINGS = ((0.4, 0.59, 0.01), (0.01, 0.98, 0.01))
#: Weight of these beliefs, as a share of the documents.
PRIOR_STRENGTH = 0.02


def split_words(text: Column) -> Column:
    """The words of a text in order (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _BETWEEN, -1), lambda w: w != "")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def repeated_words(words: Column) -> Column:
    """Words that stand in some three-word window that the text has twice or more.

    Windows are compared by 64-bit hashes. Of a text that has repeated ones,
    hashes are sorted with their places; those equal to a neighbour are the
    repeated ones. No step takes more than n log n, so very long texts are fine.
    """
    n = F.size(words)
    grams = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n < 3, F.lit(0).cast("long")).otherwise(let(grams, _covered))


def _covered(grams: Column) -> Column:
    def marked(s: Column) -> Column:
        again = F.filter(s, lambda x, k: (x["h"] == F.get(s, k + 1)["h"]) | (x["h"] == F.get(s, k - 1)["h"]))
        return let(F.sort_array(F.transform(again, lambda x: x["i"])), covered)

    def covered(places: Column) -> Column:
        # a window adds its three words, less those that the window before has added
        new = F.transform(places, lambda p, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), p - F.get(places, k - 1))))
        return F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x)

    placed = F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(let(F.sort_array(placed), marked))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda l: F.regexp_like(l, F.lit(WORD)))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each row's whole text: the base counts and what the rules need. No shuffle."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    words = docs.select(F.col(id_col), t.alias("text"), split_words(t).alias("words"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return words.select(
        F.col(id_col),
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - _without(F.col("text"), " \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        _without(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        _without(F.col("text"), upper).cast("long").alias("n_upper"),
        _without(F.col("text"), "!?").cast("long").alias("n_shouts"),
        _count(F.col("text"), PLAIN).alias("n_plain"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("long").alias("n_breaks"),
        F.size(F.filter("words", lambda w: F.length(w) <= 3)).cast("long").alias("n_short"),
    )


def votes(measured: DataFrame) -> DataFrame:
    """``measured`` with a column v_<rule> for each rule; of an empty text all rules abstain but the one on lines."""
    n, chars = F.nullif(F.col("n_words"), F.lit(0)), F.nullif(F.col("word_chars"), F.lit(0))
    shares = {
        "plain_share": F.col("n_plain") / n,
        "short_share": F.col("n_short") / n,
        "mean_chars": F.col("word_chars") / n,
        "symbol_share": F.col("n_symbols") / n,
        "dup_line_share": F.col("n_dup_lines") / (F.col("n_breaks") + 1),
        "repeat_share": F.col("n_repeat_words") / n,
        "capital_share": F.col("n_upper") / chars,
        "shout_share": F.col("n_shouts") / n,
    }
    out = {}
    for name, what, side, good, bad in RULES:
        x = shares[what]
        no = x > bad if side == "at_most" else x < bad
        yes = F.lit(False) if good is None else x <= good if side == "at_most" else x >= good
        out[f"v_{name}"] = F.when(yes, 1).when(no, -1).otherwise(0)
    return measured.withColumns(out)


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = EM_ROUNDS) -> tuple[float, list[dict[int, float]]]:
    """EM over (votes, count): prior log-odds of good, and for each rule the log-odds that each vote adds.

    The model: given the class, rules vote independently, each with its own
    chances of -1, 0 and 1 (so its accuracy on good and on bad documents, and
    what its abstaining means). The beliefs above are the start and count as
    pseudo-documents; they also name the two classes.
    """
    total = sum(c for _, c in patterns)
    if not total:
        return 0.0, []
    extra = total * PRIOR_STRENGTH
    good = PRIOR_GOOD
    beliefs = [PRIOR_VOTES if r[3] is not None else PRIOR_WARNINGS for r in RULES]
    chances = [[list(x) for x in b] for b in beliefs]
    for _ in range(rounds):
        post = [_sigmoid(_log_odds(v, good, chances)) for v, _ in patterns]
        mass = [sum((1 - p) * c for p, (_, c) in zip(post, patterns, strict=True)), sum(p * c for p, (_, c) in zip(post, patterns, strict=True))]
        good = (mass[1] + extra * PRIOR_GOOD) / (total + extra)
        for j, own in enumerate(chances):
            for side, belief in enumerate(beliefs[j]):
                for k, vote in enumerate((-1, 0, 1)):
                    seen = sum((p if side else 1 - p) * c for p, (v, c) in zip(post, patterns, strict=True) if v[j] == vote)
                    own[side][k] = (seen + extra * belief[k]) / (mass[side] + extra)
    weights = [{v: math.log(own[1][v + 1] / own[0][v + 1]) for v in (-1, 0, 1)} for own in chances]
    return math.log(good / (1 - good)), weights


def _log_odds(pattern: tuple[int, ...], good: float, chances: list[list[list[float]]]) -> float:
    return math.log(good / (1 - good)) + sum(math.log(own[1][v + 1] / own[0][v + 1]) for v, own in zip(pattern, chances, strict=True))


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, base counts, base_failed, posterior, kept.

    The counts of vote patterns, at most 3**rules of them, are all that the
    driver gets. A null or empty text has no words and fails the base rules;
    an empty table gives no rows; other columns are not read.
    """
    voted = materialize(votes(measure(docs, id_col, text_col)), "votes")
    names = [f"v_{r[0]}" for r in RULES]
    found = voted.groupBy(*names).agg(F.count("*").alias("n")).collect()
    patterns = sorted((tuple(r[x] for x in names), r["n"]) for r in found)
    prior, weights = fit(patterns) if patterns else (0.0, [])
    odds = F.lit(prior)
    for name, w in zip(names, weights, strict=False):
        odds = odds + F.when(F.col(name) == 1, w[1]).when(F.col(name) == -1, w[-1]).otherwise(w[0])
    posterior = 1 / (1 + F.exp(-odds))
    base_failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return voted.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), posterior.alias("posterior"), (~base_failed & (posterior >= 0.5)).alias("kept"),
    )
