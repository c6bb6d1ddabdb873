"""Text expressions: tags, HTML, code, cleaning, tokens and n-grams.

Character classes are spelled out instead of using ``\\s`` and ``\\w`` so that a
no-break space separates words and accented letters are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"\t\n\x0b\f\r\x1c-\x1f \x85\p{Z}"
WORD = r"\p{L}\p{N}_"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def no_strings() -> Column:
    return F.array().cast("array<string>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``.

    A lambda that mentions a column expression evaluates that expression for
    each element; a bound lambda variable is evaluated only once per row.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- tags (P-04, P-20) -----------------------------------------------------

def parse_tags(packed: Column | str) -> Column:
    """``<a><b>`` to ``[a, b]``; null and '' give an empty array."""
    found = F.regexp_extract_all(as_column(packed), F.lit("<([^>]+)>"), F.lit(1))
    return F.coalesce(found, no_strings())


def pack_tags(tags: Column | str) -> Column:
    """``[a, b]`` to ``<a><b>``; null and empty give ''."""
    c = as_column(tags)
    packed = F.concat(F.lit("<"), F.array_join(c, "><"), F.lit(">"))
    return F.when(F.size(c) > 0, packed).otherwise(F.lit(""))


# --- HTML and code (P-06, P-07, P-08, P-23) --------------------------------

def squeeze(c: Column | str) -> Column:
    """Collapse runs of white space to one blank and trim."""
    return F.trim(F.regexp_replace(as_column(c), f"[{SPACE}]+", " "))


def strip_html(c: Column | str) -> Column:
    """Replace every tag by a blank and squeeze; null gives ''."""
    return squeeze(F.regexp_replace(F.coalesce(as_column(c), F.lit("")), "<[^>]+>", " "))


def drop_html(c: Column | str) -> Column:
    """Delete every tag without leaving a blank and trim; null gives ''."""
    bare = F.regexp_replace(F.coalesce(as_column(c), F.lit("")), "<[^>]+>", "")
    return F.regexp_replace(bare, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def code_blocks(c: Column | str) -> Column:
    found = F.regexp_extract_all(as_column(c), F.lit("(?s)<code>(.*?)</code>"), F.lit(1))
    return F.coalesce(found, no_strings())


def code_text(c: Column | str) -> Column:
    """Contents of all ``<code>`` elements, one per line; null gives ''."""
    return F.array_join(code_blocks(c), "\n")


def code_snippets(c: Column | str) -> Column:
    """``<code>`` contents followed by the contents of ``` fences, as an array."""
    fenced = F.regexp_extract_all(
        as_column(c), F.lit(rf"(?s)```[{WORD}]*\n?(.*?)```"), F.lit(1)
    )
    return F.concat(code_blocks(c), F.coalesce(fenced, no_strings()))


# --- words (P-05, X-01, X-05, X-08, X-10) ----------------------------------

def exploded(tokens: Column | str) -> Column:
    """One row per token.

    Of a plain column, the optimiser would first filter on the size, below the expressions that make the tokens, and so make them twice.
    """
    return F.explode(F.concat(as_column(tokens)))


def word_count(c: Column | str) -> Column:
    """Number of words between white space; null gives 0."""
    return F.coalesce(F.regexp_count(as_column(c), F.lit(f"[^{SPACE}]+")), F.lit(0))


def words(c: Column | str) -> Column:
    """Words between white space, without empty ones; null gives []."""
    found = F.regexp_extract_all(as_column(c), F.lit(f"[^{SPACE}]+"), F.lit(0))
    return F.coalesce(found, no_strings())


def clean_text(c: Column | str) -> Column:
    """Drop HTML, code, URLs, punctuation and digits; squeeze and lower-case.

    Punctuation, digits and white space all end as one blank, so one pass
    replaces every run of them.
    """
    text = F.coalesce(as_column(c), F.lit(""))
    for pattern in ("<[^>]+>", "(?s)```.*?```", "`[^`]+`", f"https?://[^{SPACE}]+", r"[^\p{L}\p{Nl}\p{No}_]+"):
        text = F.regexp_replace(text, pattern, " ")
    return F.lower(F.trim(text))


def split_tokens(c: Column | str) -> Column:
    """Lower-case and split at each single white-space character.

    Inner and leading empty tokens stay, trailing ones go.
    """
    text = F.lower(as_column(c))
    split = F.split(F.regexp_replace(text, r"\s+$", ""), r"\s")
    return F.when(text.rlike(r"^\s+$"), no_strings()).otherwise(split)


def filter_tokens(tokens: Column | str, min_length: int = 2, max_length: int = 30) -> Column:
    """Tokens of a length within the bounds; null gives []."""
    kept = F.filter(as_column(tokens), lambda x: F.length(x).between(min_length, max_length))
    return F.coalesce(kept, no_strings())


def bounded_tokens(c: Column | str, min_length: int = 2, max_length: int = 50) -> Column:
    """Lower-cased words of a length within the bounds."""
    return filter_tokens(words(F.lower(as_column(c))), min_length, max_length)


def remove_words(tokens: Column | str, stop_words: Iterable[str]) -> Column:
    listed = sorted({w.lower() for w in stop_words})
    if not listed:
        return as_column(tokens)
    return F.filter(as_column(tokens), lambda x: ~F.lower(x).isin(listed))


# Words that the common treebank tokeniser writes as two.
TWO_PART_WORDS = (("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na"))


def letter_tokens(c: Column | str, stop_words: Iterable[str], min_length: int = 3) -> Column:
    """Lower-case words made of ASCII letters only, without stop words and short ones."""
    letters = F.regexp_replace(F.lower(as_column(c)), f"[^a-z{SPACE}]+", "")
    seams = "|".join(f"{a}(?={b}\\b)" for a, b in TWO_PART_WORDS)
    found = F.regexp_extract_all(F.regexp_replace(letters, rf"\b({seams})", "$1 "), F.lit("[a-z]+"), F.lit(0))
    kept = remove_words(F.coalesce(found, no_strings()), stop_words)
    return F.filter(kept, lambda x: F.length(x) >= min_length)


# --- n-grams (X-06, X-07) --------------------------------------------------

def _runs(items: Column, n: int, glue: str) -> Column:
    def grams(v: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(v) - n + 1)
        return F.when(
            F.size(v) >= n, F.transform(starts, lambda i: F.array_join(F.slice(v, i, n), glue))
        ).otherwise(no_strings())

    return let(items, grams)


def word_ngrams(tokens: Column | str, n: int = 2) -> Column:
    """Runs of ``n`` tokens joined by a blank; shorter input gives []."""
    return _runs(as_column(tokens), n, " ")


def char_ngrams(c: Column | str, n: int = 3) -> Column:
    """Lower-cased runs of ``n`` characters; null and shorter text give []."""
    characters = F.split(F.lower(as_column(c)), "")
    long_enough = F.length(as_column(c)) >= n
    return F.when(long_enough, _runs(characters, n, "")).otherwise(no_strings())


# --- other string helpers (P-18, P-19, P-22) -------------------------------

def join_text(columns: Iterable[Column | str], separator: str = " ") -> Column:
    """Join text columns; nulls are skipped."""
    return F.concat_ws(separator, *[as_column(c) for c in columns])


def preview(c: Column | str, max_length: int = 100, suffix: str = "...") -> Column:
    """Text cut to ``max_length`` characters including the suffix."""
    text = as_column(c)
    cut = F.concat(F.substring(text, 1, max(max_length - len(suffix), 0)), F.lit(suffix))
    return F.when(F.length(text) > max_length, cut).otherwise(text)


_BREAKS = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))


def escaped_breaks(c: Column | str) -> Column:
    """The text on one line: every backslash is followed by s, n or r, for a backslash and the two breaks; an
    empty text is a backslash with e, so that formats which write null as nothing keep both apart."""
    out = as_column(c)
    for raw, written in _BREAKS:
        out = F.replace(out, F.lit(raw), F.lit(written))
    return F.when(out == "", F.lit("\\e")).otherwise(out)


def unescaped_breaks(c: Column | str) -> Column:
    """The inverse of ``escaped_breaks``: breaks first, for a written backslash never stands before n or r."""
    out = F.replace(as_column(c), F.lit("\\e"), F.lit(""))
    for raw, written in reversed(_BREAKS):
        out = F.replace(out, F.lit(written), F.lit(raw))
    return out
