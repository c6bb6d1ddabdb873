"""Lexicon sentiment as one expression."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from agorastat.functions.text import WORD, as_column, words

# The word lists of the default lexicon.
POSITIVE = """
solved works working fixed solution helpful thanks thank perfect great excellent awesome
correct right best better good nice clean elegant efficient fast simple easy clear
useful amazing brilliant love recommend
""".split()
NEGATIVE = """
error bug broken wrong bad fail failed issue problem crash crashes slow complex
confusing confused difficult hard stuck help frustrating annoying terrible horrible worst
deprecated outdated useless hate ugly messy
""".split()
INTENSIFIERS = {
    "very": 1.5, "really": 1.5, "extremely": 2.0, "absolutely": 2.0,
    "totally": 1.5, "completely": 1.5, "highly": 1.5, "super": 1.5,
}
NEGATORS = """
not no never neither nobody nothing don't doesn't didn't won't wouldn't
can't cannot couldn't shouldn't
""".split()


@dataclass(frozen=True)
class Lexicon:
    """Words that count +1 or -1 and words that scale or flip the next one."""

    positive: frozenset[str] = frozenset(POSITIVE)
    negative: frozenset[str] = frozenset(NEGATIVE)
    intensifiers: Mapping[str, float] = field(default_factory=lambda: dict(INTENSIFIERS))
    negators: frozenset[str] = frozenset(NEGATORS)


def _listed(word: Column, entries) -> Column:
    return word.isin(sorted(entries)) if entries else F.lit(False)


def _scale(previous: Column, lexicon: Lexicon) -> Column:
    by_weight: dict[float, list[str]] = defaultdict(list)
    for word, weight in lexicon.intensifiers.items():
        by_weight[float(weight)].append(word)
    strength = F.lit(1.0)
    for weight, entries in sorted(by_weight.items()):
        strength = F.when(_listed(previous, entries), F.lit(weight)).otherwise(strength)
    return strength * F.when(_listed(previous, lexicon.negators), F.lit(-1.0)).otherwise(F.lit(1.0))


def lexicon_score(text: Column | str, lexicon: Lexicon, strip_punct: bool = False) -> Column:
    """Mean of the word hits, each scaled by the word before it, within [-1, 1].

    Text without a hit and null give 0. ``strip_punct`` also drops punctuation
    around a word before the look-up.
    """
    tokens = words(F.lower(as_column(text)))
    if strip_punct:
        tokens = F.transform(
            tokens, lambda w: F.regexp_replace(w, f"^[^{WORD}]+|[^{WORD}]+$", "")
        )
    start = F.struct(
        F.lit(0.0).alias("total"), F.lit(0).alias("hits"), F.lit("").alias("previous")
    )

    def step(acc: Column, word: Column) -> Column:
        sign = (
            F.when(_listed(word, lexicon.positive), F.lit(1.0))
            .when(_listed(word, lexicon.negative), F.lit(-1.0))
            .otherwise(F.lit(0.0))
        )
        return F.struct(
            (acc["total"] + F.when(sign != 0, sign * _scale(acc["previous"], lexicon)).otherwise(F.lit(0.0))).alias("total"),
            (acc["hits"] + F.when(sign != 0, 1).otherwise(0)).alias("hits"),
            word.alias("previous"),
        )

    def finish(acc: Column) -> Column:
        mean = F.coalesce(F.try_divide(acc["total"], acc["hits"]), F.lit(0.0))
        return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), mean))

    return F.aggregate(tokens, start, step, finish)


def score_label(score: Column | str, cut: float = 0.1, inclusive: bool = False) -> Column:
    """positive, negative or neutral; null is neutral.

    ``inclusive`` also labels a score exactly at the cut.
    """
    c = as_column(score)
    high, low = (c >= cut, c <= -cut) if inclusive else (c > cut, c < -cut)
    return F.when(high, "positive").when(low, "negative").otherwise("neutral")
