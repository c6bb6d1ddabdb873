"""Token pipelines."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorastat.functions import text as tx

# Words without information in technical questions.
DOMAIN_STOP_WORDS = """
use using used want need try trying get getting make making work working
code error problem issue question answer help please thank thanks anyone someone
way thing something anything nothing would could should might must like
know think look see seem find give
""".split()


def stop_words(extra: Iterable[str] = DOMAIN_STOP_WORDS) -> list[str]:
    """X-04: English stop words and the domain words."""
    return StopWordsRemover.loadDefaultStopWords("english") + list(extra)


def preprocess(
    df: DataFrame,
    text: str = "Body",
    output: str = "ProcessedText",
    remove_stop_words: bool = True,
    extra_stop_words: Iterable[str] = DOMAIN_STOP_WORDS,
    min_length: int | None = None,
    max_length: int | None = None,
) -> DataFrame:
    """X-02: cleaned, lower-cased tokens without stop words, optionally within a length."""
    tokens = F.split(tx.clean_text(text), " ")  # already squeezed: single blanks only
    if remove_stop_words:
        tokens = tx.remove_words(tokens, stop_words(extra_stop_words))
    if min_length is not None or max_length is not None:
        tokens = tx.filter_tokens(tokens, min_length or 0, max_length or 2**31 - 1)
    return df.withColumn(output, tokens)


def preprocess_title(df: DataFrame, title: str = "Title", output: str = "ProcessedTitle") -> DataFrame:
    """X-03."""
    return preprocess(df, title, output)


def add_ngrams(df: DataFrame, tokens: str = "ProcessedText", n: int = 2) -> DataFrame:
    """X-06: ``{tokens}_{n}grams``."""
    return df.withColumn(f"{tokens}_{n}grams", tx.word_ngrams(tokens, n))


def add_code_snippets(df: DataFrame, body: str = "Body") -> DataFrame:
    """P-08."""
    return df.withColumn("CodeSnippets", tx.code_snippets(body))


def token_statistics(df: DataFrame, tokens: str = "ProcessedText") -> DataFrame:
    """P-17, T-05: token count, mean length and share of distinct tokens."""
    count = F.size(tokens)
    letters = F.aggregate(tokens, F.lit(0), lambda acc, t: acc + F.length(t))
    return df.withColumns(
        {
            "NumTokens": count,
            "AvgTokenLength": letters / F.greatest(count, F.lit(1)),
            "UniqueTokenRatio": F.size(F.array_distinct(tokens)) / F.greatest(count, F.lit(1)),
        }
    )


def combine_text(
    df: DataFrame, columns: Sequence[str], output: str = "CombinedText", separator: str = " "
) -> DataFrame:
    """P-18, P-19: text columns joined, nulls skipped."""
    return df.withColumn(output, tx.join_text(columns, separator))


def word_tokens(
    df: DataFrame,
    text: str,
    output: str,
    lemmas: Mapping[str, str] | DataFrame | None = None,
    key: str = "Id",
    min_length: int = 3,
) -> DataFrame:
    """X-08: letter-only tokens without stop words, each replaced by its lemma.

    The dictionary is a table with columns ``token`` and ``lemma``, or a mapping that becomes one. Only
    the distinct tokens of a row meet it; what is found returns as one small map per
    row. Without a lemma a token stays as it is. ``key`` must identify a row.
    """
    tokens = tx.letter_tokens(text, stop_words(()), min_length)
    if lemmas is None:
        return df.withColumn(output, tokens)
    if not isinstance(lemmas, DataFrame):
        lemmas = df.sparkSession.createDataFrame(list(lemmas.items()), "token string, lemma string")
    single = df.select(key, F.explode(F.array_distinct(tokens)).alias("token"))
    found = single.join(lemmas.select("token", "lemma"), "token")  # a frequent token is split by adaptive execution
    maps = found.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("token", "lemma"))).alias("_lemmas"))
    known = F.transform(tokens, lambda t: F.coalesce(F.try_element_at("_lemmas", t), t))
    return df.join(maps, key, "left").withColumn(output, F.when(F.col("_lemmas").isNull(), tokens).otherwise(known)).drop("_lemmas")


def join_tokens(df: DataFrame, columns: Sequence[str], output: str = "all_tokens") -> DataFrame:
    """X-09: token arrays one after the other."""
    return df.withColumn(output, F.concat(*columns))
