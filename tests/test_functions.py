import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agorastat.functions import scalar, text as tx, vectors as vec
from agorastat.functions.sentiment import Lexicon, lexicon_score, score_label
from agorastat.operators import text as ops

QUICK = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TEXTS = st.lists(
    st.one_of(
        st.none(),
        st.text(
            alphabet=st.one_of(
                st.sampled_from("aZ9é_?!.<>`/: \t\n  \x1f"),
                st.characters(min_codepoint=32, max_codepoint=0x2FF),
            ),
            max_size=40,
        ),
    ),
    min_size=1,
    max_size=60,
)


def evaluate(spark, expression, values):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "i int, c string").select("i", expression.alias("r"))
    return [r["r"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def test_tags(one):
    assert one(tx.parse_tags("c"), "<python><pandas><dataframe>") == ["python", "pandas", "dataframe"]
    assert one(tx.parse_tags("c"), "") == []
    assert one(tx.parse_tags("c"), None) == []
    assert one(tx.pack_tags("c"), ["a", "b"], "array<string>") == "<a><b>"
    assert one(tx.pack_tags("c"), [], "array<string>") == ""
    assert one(tx.pack_tags("c"), None, "array<string>") == ""


def test_html(one):
    assert one(tx.strip_html("c"), "<p>Hello <b>World</b></p>") == "Hello World"
    assert one(tx.strip_html("c"), None) == "" == one(tx.strip_html("c"), "")
    assert one(tx.drop_html("c"), "\n<p>a</p><p>b</p> ") == "ab"


def test_code(one):
    body = "x<code>a\nb</code>y<code>c</code>```py\nd\n```"
    assert one(tx.code_text("c"), body) == "a\nb\nc"
    assert one(tx.code_snippets("c"), body) == ["a\nb", "c", "d\n"]
    assert one(tx.code_snippets("c"), None) == [] and one(tx.code_text("c"), None) == ""


def test_clean_text_example(one):
    dirty = "<p>Café au lait</p> Some text ```python\nprint('hello')\n``` more `x` http://a.b/c 42 end!"
    assert one(tx.clean_text("c"), dirty) == "café au lait some text more end"
    assert one(tx.clean_text("c"), None) == ""


def python_clean(text):
    for pattern in (r"<[^>]+>", r"```[\s\S]*?```", r"`[^`]+`", r"https?://\S+", r"[^\w\s]", r"\d+", r"\s+"):
        text = re.sub(pattern, " ", text or "")
    return text.strip().lower()


@QUICK
@given(values=TEXTS)
def test_clean_text_equals_stepwise_cleaning(spark, values):
    assert evaluate(spark, tx.clean_text("c"), values) == [python_clean(v) for v in values]


@QUICK
@given(values=TEXTS)
def test_words_equal_whitespace_split(spark, values):
    assert evaluate(spark, tx.words("c"), values) == [(v or "").split() for v in values]
    assert evaluate(spark, tx.word_count("c"), values) == [len((v or "").split()) for v in values]


@QUICK
@given(values=TEXTS, n=st.integers(1, 4))
def test_char_ngrams(spark, values, n):
    lower = [(v or "").lower() for v in values]
    expected = [[v[i : i + n] for i in range(len(v) - n + 1)] for v in lower]
    assert evaluate(spark, tx.char_ngrams("c", n), values) == expected


def test_tokens(one, spark):
    assert one(tx.bounded_tokens("c"), "A to  Python") == ["to", "python"]
    assert one(tx.filter_tokens("c"), None, "array<string>") == []
    assert one(tx.split_tokens("c"), " A  b ") == ["", "a", "", "b"]
    assert one(tx.split_tokens("c"), "") == [""]
    assert one(tx.split_tokens("c"), "  ") == []
    assert one(tx.word_ngrams("c", 2), ["a", "b", "c"], "array<string>") == ["a b", "b c"]
    assert one(tx.word_ngrams("c", 2), ["a"], "array<string>") == []
    assert one(tx.letter_tokens("c", ["the"]), "The cannot gonna go-now x1y2z") == ["can", "not", "gon", "gonow", "xyz"]


def test_split_tokens_equals_the_library_tokenizer(spark):
    from pyspark.ml.feature import Tokenizer

    df = spark.createDataFrame([(t,) for t in ["", " ", "a", " a b  c ", "A\tB\n", "x y z"]], "c string")
    both = Tokenizer(inputCol="c", outputCol="t").transform(df).select("t", tx.split_tokens("c").alias("u"))
    assert all(r["t"] == r["u"] for r in both.collect())


def test_preview_and_ratios(one):
    shown = one(tx.preview("c", 20), "This is a very long text that needs to be truncated")
    assert len(shown) == 20 and shown.endswith("...")
    assert one(tx.preview("c", 20), "short") == "short" and one(tx.preview("c", 20), None) is None

    def ratio(f, a, b, *extra):
        return one(f(F.lit(float(a)), F.lit(float(b)), *extra), "")

    assert ratio(scalar.percentage, 25, 100) == 25.0
    assert ratio(scalar.percentage, 1, 3, 1) == 33.3
    assert ratio(scalar.percentage, 0, 0) == 0.0
    assert ratio(scalar.safe_divide, 10, 2) == 5.0
    assert ratio(scalar.safe_divide, 10, 0) == 0.0
    assert ratio(scalar.safe_divide, 10, 0, -1) == -1.0
    assert ratio(scalar.growth, 150, 100) == 50.0 and ratio(scalar.growth, 80, 100) == -20.0


def test_period_rejects_unknown():
    with pytest.raises(ValueError):
        scalar.period("c", "hour")
    with pytest.raises(ValueError):
        scalar.quality_label("other")


def test_vectors(one):
    triple = F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0))
    zero = F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0))
    assert math.isclose(one(vec.cosine(triple, triple), ""), 1.0, abs_tol=1e-9)
    assert one(vec.cosine(triple, zero), "") == 0.0
    assert one(vec.argmax("c"), [1.0, 5.0, 5.0], "array<double>") == 1
    assert one(vec.argmax("c"), None, "array<double>") == -1
    sets = [F.array(*map(F.lit, names)) for names in (["python", "pandas", "data"], ["python", "numpy", "data"])]
    assert one(vec.jaccard(*sets), "") == 0.5


def python_sentiment(text, lex):
    score, hits, previous = 0.0, 0, ""
    for word in (text or "").lower().split():
        factor = lex.intensifiers.get(previous, 1.0) * (-1.0 if previous in lex.negators else 1.0)
        sign = 1.0 if word in lex.positive else -1.0 if word in lex.negative else 0.0
        score, hits, previous = score + sign * factor, hits + bool(sign), word
    return max(-1.0, min(1.0, score / hits if hits else 0.0))


LEX = Lexicon()
SENTENCES = st.lists(
    st.lists(st.sampled_from(["great", "bad", "not", "very", "extremely", "x", "never", "good", "help", "Great!", "no"]), max_size=9).map(" ".join),
    min_size=1,
    max_size=60,
)


@QUICK
@given(values=SENTENCES)
def test_sentiment_equals_a_plain_fold(spark, values):
    got = evaluate(spark, lexicon_score("c", LEX), values)
    assert got == pytest.approx([python_sentiment(v, LEX) for v in values])


def test_sentiment_cases(one):
    score = lexicon_score("c", LEX)
    assert one(score, None) == 0.0 == one(score, "")
    assert one(score, "not good") == -1.0
    assert one(score, "extremely bad") == -1.0
    assert one(score, "this works great!") == 1.0
    assert one(score, "great!") == 0.0
    assert one(lexicon_score("c", LEX, strip_punct=True), "great!") == 1.0
    assert one(score_label("c"), 0.1, "double") == "neutral"
    assert one(score_label("c", 0.1, True), 0.1, "double") == "positive"
    assert one(score_label("c"), None, "double") == "neutral"


def test_a_lexicon_of_any_size_counts_every_word(one):
    lexicon = Lexicon(positive=frozenset(f"w{i}" for i in range(30_000)))
    assert one(lexicon_score("c", lexicon), "w29999 and w0") == 1.0


def test_letter_tokens_cut_two_part_words_only_where_they_end(one):
    text = "cannot Cannots xcannot can-not lemme-gimme gotta wanna\u00a0gonna cannotcan"
    assert one(tx.letter_tokens("c", [], 1), text) == "can not cannots xcannot can not lemmegimme got ta wan na gon na cannotcan".split()


def test_word_tokens_with_dictionary_and_table(spark):
    df = spark.createDataFrame([(1, "Cats running the cats"), (2, None), (3, "of 12")], "Id int, t string")
    lemmas = {"cats": "cat", "running": "run"}
    table = spark.createDataFrame(list(lemmas.items()), "token string, lemma string")
    expected = {1: ["cat", "run", "cat"], 2: [], 3: []}
    for source in (lemmas, table):
        got = ops.word_tokens(df, "t", "w", source).collect()
        assert {r["Id"]: r["w"] for r in got} == expected
    plain = ops.word_tokens(df, "t", "w", {}).collect()
    assert {r["Id"]: r["w"] for r in plain} == {1: ["cats", "running", "cats"], 2: [], 3: []}


def test_preprocess_drops_listed_words(spark):
    df = spark.createDataFrame([("The <b>python</b> code is a programming language 7",), (None,)], "Body string")
    assert [r[0] for r in ops.preprocess(df).select("ProcessedText").collect()] == [["python", "programming", "language"], [""]]
    kept = ops.preprocess(df, remove_stop_words=False).first()["ProcessedText"]
    assert kept == ["the", "python", "code", "is", "a", "programming", "language"]
