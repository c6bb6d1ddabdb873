"""Tokens, sentiment and features."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from agorastat.functions import text as tx, vectors as vec
from agorastat.functions.sentiment import INTENSIFIERS, NEGATIVE, NEGATORS, POSITIVE, Lexicon
from agorastat.operators import aggregates as agg, cooccurrence as co, features as ft, sentiment as se, text
from agorastat.sources.storage import materialize, scratch_path
from bindings.registry import SPACE, query, raw_questions, sql_clean, sql_list, sql_words, table, tidy


def _documents(spark, d):
    return table(spark, d, "documents")


def _tokens(spark, d, column="ProcessedText"):
    return text.preprocess(_documents(spark, d), "text", column).select("doc_id", "lang", "source", column)


# The English stop words of Spark's own list.
ENGLISH = """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over under again further
then once here there when where why how all any both each few more most other some such no nor not only own same so
than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd
i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't
don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought
that's there's what's when's where's who's why's would""".split()
STOP = ENGLISH + text.DOMAIN_STOP_WORDS


def sql_tokens(column: str, stop=STOP) -> str:
    return f"list_filter(string_split({sql_clean(column)}, ' '), lambda x: NOT list_contains({sql_list(stop)}, x))"


TOKENS = f"tok AS (SELECT doc_id, lang, source, {sql_tokens('text')} AS t FROM documents)"


def _hashed(df, column, key="doc_id"):
    return tidy(df.select(key, F.size(column).alias("n"), F.md5(F.array_join(column, " ")).alias("h")))


def sql_hashed(column: str, key: str = "doc_id") -> str:
    return f"{key}, len({column}) AS n, md5(array_to_string({column}, ' ')) AS h"


@query("x01_clean_text", f"SELECT doc_id, md5({sql_clean('text')}) AS h, length({sql_clean('text')}) AS n FROM documents")
def clean_text(spark, d):
    cleaned = _documents(spark, d).select("doc_id", tx.clean_text("text").alias("c"))
    return tidy(cleaned.select("doc_id", F.md5("c").alias("h"), F.length("c").alias("n")))


@query("x01_clean_html", f"SELECT page_id, md5({sql_clean('html')}) AS h, length({sql_clean('html')}) AS n FROM pages")
def clean_html(spark, d):
    cleaned = table(spark, d, "pages").select("page_id", tx.clean_text("html").alias("c"))
    return tidy(cleaned.select("page_id", F.md5("c").alias("h"), F.length("c").alias("n")))


@query("x02_preprocess", f"WITH {TOKENS} SELECT {sql_hashed('t')} FROM tok")
def preprocess(spark, d):
    return _hashed(_tokens(spark, d), "ProcessedText")


@query("x03_preprocess_title", f"""WITH p AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS Title FROM pages),
t AS (SELECT page_id, {sql_tokens('Title')} AS t FROM p) SELECT {sql_hashed('t', 'page_id')} FROM t""")
def preprocess_title(spark, d):
    titles = table(spark, d, "pages").withColumn("Title", F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    return _hashed(text.preprocess_title(titles), "ProcessedTitle", "page_id")


@query("x04_stop_word_hits", f"""SELECT w AS word, COUNT(*) AS Count FROM (
  SELECT unnest({sql_words(sql_clean('text'))}) AS w FROM documents) WHERE w IN {tuple(sorted(set(STOP)))!r} GROUP BY w""".replace('"', "$$"))
def stop_word_hits(spark, d):
    listed = text.stop_words()
    found = _documents(spark, d).select(F.explode(tx.words(tx.clean_text("text"))).alias("word"))
    return found.filter(F.col("word").isin(listed)).groupBy("word").agg(F.count(F.lit(1)).alias("Count"))


@query("x05_bounded_tokens", f"""WITH t AS (SELECT doc_id, list_filter({sql_words('lower(text)')}, lambda x: length(x) BETWEEN 2 AND 50) AS t FROM documents)
SELECT {sql_hashed('t')} FROM t""")
def bounded_tokens(spark, d):
    return _hashed(_documents(spark, d).select("doc_id", tx.bounded_tokens("text").alias("t")), "t")


@query("x05_filtered_tokens", f"WITH {TOKENS}, f AS (SELECT doc_id, list_filter(t, lambda x: length(x) BETWEEN 2 AND 30) AS t FROM tok) SELECT {sql_hashed('t')} FROM f")
def filtered_tokens(spark, d):
    return _hashed(text.preprocess(_documents(spark, d), "text", "t", min_length=2, max_length=30), "t")


@query("x06_ngrams", f"""WITH {TOKENS}, g AS (SELECT doc_id, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) AS g FROM tok)
SELECT {sql_hashed('g')} FROM g""")
def ngrams(spark, d):
    return _hashed(text.add_ngrams(_tokens(spark, d)), "ProcessedText_2grams")


@query("x06_ngram_counts", f"""WITH {TOKENS}, g AS (SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS Word FROM tok)
SELECT Word, COUNT(*) AS Count FROM g GROUP BY Word ORDER BY Count DESC, Word LIMIT 100""")
def ngram_counts(spark, d):
    return agg.word_frequency(text.add_ngrams(_tokens(spark, d)), "ProcessedText_2grams")


@query("x07_char_ngrams", """WITH g AS (SELECT page_id, list_transform(range(1, length(u) - 1), lambda i: substr(u, i, 3)) AS g FROM (
  SELECT page_id, lower(url) AS u FROM pages)) SELECT page_id, len(g) AS n, md5(array_to_string(g, ' ')) AS h FROM g""")
def char_ngrams(spark, d):
    return _hashed(table(spark, d, "pages").select("page_id", tx.char_ngrams("url").alias("g")), "g", "page_id")


LETTERS = f"""letters AS (SELECT doc_id, list_filter({sql_words(f"regexp_replace(lower(text), '[^a-z{SPACE}]', '', 'g')")},
  lambda x: length(x) > 2 AND NOT list_contains({sql_list(ENGLISH)}, x)) AS t FROM documents)"""


@query("x08_word_tokens", f"WITH {LETTERS} SELECT {sql_hashed('t')} FROM letters")
def word_tokens(spark, d):
    return _hashed(text.word_tokens(_documents(spark, d), "text", "t", key="doc_id"), "t")


@query("x08_lemma_table", f"""WITH {LETTERS}, l AS (SELECT doc_id, list_transform(t, lambda x: CASE WHEN x LIKE '%s' THEN left(x, length(x) - 1) ELSE x END) AS t FROM letters)
SELECT {sql_hashed('t')} FROM l""")
def lemma_table(spark, d):
    docs = _documents(spark, d).select("doc_id", "text")
    tokens = text.word_tokens(docs, "text", "t", key="doc_id").select(tx.exploded("t").alias("token")).distinct()
    plural = tokens.filter(F.col("token").endswith("s"))
    lemmas = plural.select("token", F.expr("left(token, length(token) - 1)").alias("lemma"))
    return _hashed(text.word_tokens(docs, "text", "t", lemmas, key="doc_id"), "t")


@query("x09_joined_tokens", f"""WITH c AS (SELECT page_id, list_concat({sql_words('lower(url)')}, {sql_words('lower(html)')}) AS t FROM pages)
SELECT {sql_hashed('t', 'page_id')} FROM c""")
def joined_tokens(spark, d):
    pages = table(spark, d, "pages").select(
        "page_id", tx.words(F.lower("url")).alias("a"), tx.words(F.lower("html")).alias("b")
    )
    return _hashed(text.join_tokens(pages, ["a", "b"]), "all_tokens", "page_id")


@query("x10_split_tokens", r"""WITH t AS (SELECT doc_id, regexp_split_to_array(regexp_replace(lower(text), '[ \t\n\x0b\f\r]+$', ''), '[ \t\n\x0b\f\r]') AS t FROM documents)
SELECT doc_id, len(t) AS n, md5(array_to_string(t, ' ')) AS h FROM t""")
def split_tokens(spark, d):
    return _hashed(_documents(spark, d).select("doc_id", tx.split_tokens("text").alias("t")), "t")


@query("p17_token_statistics", f"""WITH {TOKENS} SELECT doc_id, len(t) AS NumTokens,
  ROUND(length(array_to_string(t, '')) / greatest(len(t), 1), 6) AS AvgTokenLength,
  ROUND(len(list_distinct(t)) / greatest(len(t), 1), 6) AS UniqueTokenRatio FROM tok""")
def token_statistics(spark, d):
    stats = text.token_statistics(_tokens(spark, d))
    return tidy(stats.select("doc_id", "NumTokens", "AvgTokenLength", "UniqueTokenRatio"))


@query("t05_distinct_tokens", f"WITH {TOKENS}, u AS (SELECT doc_id, list_sort(list_distinct(t)) AS t FROM tok) SELECT {sql_hashed('t')} FROM u")
def distinct_tokens(spark, d):
    return _hashed(_tokens(spark, d).withColumn("u", F.array_sort(F.array_distinct("ProcessedText"))), "u")


# --- sentiment --------------------------------------------------------------

# Words that occur in the test texts.
LEXICON = Lexicon(
    positive=frozenset(["the", "les", "und", "que", "por"]),
    negative=frozenset(["of", "de", "der", "los", "idiot", "clown", "loser", "worthless", "stupid"]),
    intensifiers={"and": 1.5, "et": 2.0, "die": 1.5},
    negators=frozenset(["in", "la", "den"]),
)


def sql_sentiment(source: str, keep: str) -> str:
    """CTE ``scored``: kept columns with score and label of the column ``text``."""
    strong = {w for w, x in LEXICON.intensifiers.items() if x == 2.0}
    mild = set(LEXICON.intensifiers) - strong
    return f"""
    words AS (SELECT {keep}, {sql_words('lower(text)')} AS w FROM {source}),
    hits AS (SELECT {keep}, list_filter(list_transform(w, lambda x, i:
        CASE WHEN list_contains({sql_list(LEXICON.positive)}, x) THEN 1.0::DOUBLE WHEN list_contains({sql_list(LEXICON.negative)}, x) THEN -1.0::DOUBLE END
        * CASE WHEN i > 1 AND list_contains({sql_list(strong)}, w[i - 1]) THEN 2.0::DOUBLE
               WHEN i > 1 AND list_contains({sql_list(mild)}, w[i - 1]) THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END
        * CASE WHEN i > 1 AND list_contains({sql_list(LEXICON.negators)}, w[i - 1]) THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END),
        lambda x: x IS NOT NULL) AS h FROM words),
    scores AS (SELECT {keep}, greatest(-1.0::DOUBLE, least(1.0::DOUBLE, coalesce(list_sum(h) / nullif(len(h), 0), 0.0::DOUBLE))) AS SentimentScore FROM hits),
    scored AS (SELECT *, CASE WHEN SentimentScore > 0.1 THEN 'positive' WHEN SentimentScore < -0.1 THEN 'negative' ELSE 'neutral' END AS SentimentScoreLabel FROM scores)
    """


DOC_SCORES = "WITH " + sql_sentiment("documents", "doc_id, lang, source")
TURN_SCORES = "WITH " + sql_sentiment("conversations", "conv_id, turn, role")


def scored_documents(spark, d):
    scored = se.analyze(_documents(spark, d), "text", lexicon=LEXICON)
    return scored.select("doc_id", "lang", "source", "SentimentScore", "SentimentScoreLabel")


def scored_turns(spark, d):
    turns = table(spark, d, "conversations").withColumnRenamed("text", "TextClean")
    return se.analyze_comments(turns, lexicon=LEXICON)


@query("n01_lexicon_score", f"{DOC_SCORES} SELECT doc_id, ROUND(SentimentScore, 6) AS SentimentScore FROM scored")
def lexicon_score(spark, d):
    return tidy(scored_documents(spark, d).select("doc_id", "SentimentScore"))


@query("n03_labels", f"{DOC_SCORES} SELECT doc_id, SentimentScoreLabel FROM scored")
def labels(spark, d):
    return scored_documents(spark, d).select("doc_id", "SentimentScoreLabel")


@query("n04_analyze", f"{DOC_SCORES} SELECT doc_id, lang, ROUND(SentimentScore, 6) AS SentimentScore, SentimentScoreLabel FROM scored")
def analyze(spark, d):
    return tidy(scored_documents(spark, d).select("doc_id", "lang", "SentimentScore", "SentimentScoreLabel"))


_LISTS = {
    "positive": POSITIVE,
    "negative": NEGATIVE,
    "intensifiers": list(INTENSIFIERS),
    "negators": NEGATORS,
}
_LISTED_SQL = ", ".join(
    f"len(list_filter({sql_words('lower(text)')}, lambda x: list_contains({sql_list(words)}, x))) AS {name}" for name, words in _LISTS.items()
)


@query("n02_default_lexicon", f"SELECT doc_id, {_LISTED_SQL} FROM documents")
def default_lexicon(spark, d):
    default = Lexicon()
    tokens = tx.words(F.lower("text"))
    listed = {name: sorted(getattr(default, name)) for name in _LISTS}
    counts = [F.size(F.filter(tokens, lambda w: w.isin(words))).alias(name) for name, words in listed.items()]
    return tidy(_documents(spark, d).select("doc_id", *counts))


@query("n05_analyze_comments", f"{TURN_SCORES} SELECT conv_id, turn, ROUND(SentimentScore, 6) AS SentimentScore, SentimentScoreLabel FROM scored")
def analyze_comments(spark, d):
    return tidy(scored_turns(spark, d).select("conv_id", "turn", "SentimentScore", "SentimentScoreLabel"))


@query("n07_inclusive_labels", f"""{DOC_SCORES} SELECT doc_id, CASE WHEN SentimentScore >= 0.05 THEN 'positive' WHEN SentimentScore <= -0.05 THEN 'negative' ELSE 'neutral' END AS label FROM scored""")
def inclusive_labels(spark, d):
    scored = se.analyze(_documents(spark, d), "text", "score", LEXICON, cut=0.05, inclusive=True)
    return scored.select("doc_id", F.col("scoreLabel").alias("label"))


SUMMARY = """COUNT(*) AS TotalCount, ROUND(AVG(SentimentScore), 6) AS AvgSentiment, ROUND(STDDEV(SentimentScore), 6) AS StdSentiment,
  ROUND(MIN(SentimentScore), 6) AS MinSentiment, ROUND(MAX(SentimentScore), 6) AS MaxSentiment, """ + ", ".join(
    f"COUNT(*) FILTER (SentimentScoreLabel = '{n.lower()}') AS {n}Count, "
    f"ROUND(COUNT(*) FILTER (SentimentScoreLabel = '{n.lower()}') / COUNT(*) * 100, 6) AS {n}Percent"
    for n in ("Positive", "Negative", "Neutral"))


@query("a09_sentiment_summary", f"{DOC_SCORES} SELECT {SUMMARY} FROM scored")
def sentiment_summary(spark, d):
    return tidy(se.summarize(scored_documents(spark, d)))


@query("a09_sentiment_by_source", f"{DOC_SCORES} SELECT source, {SUMMARY} FROM scored GROUP BY source")
def sentiment_by_source(spark, d):
    return tidy(se.summarize(scored_documents(spark, d), "source"))


@query("a10_sentiment_by_tag", f"""{TURN_SCORES}, j AS (SELECT SentimentScore, unnest([lang, source]) AS Tag FROM scored JOIN documents ON conv_id = doc_id)
SELECT Tag, COUNT(*) AS CommentCount, ROUND(AVG(SentimentScore), 6) AS AvgSentiment, ROUND(STDDEV(SentimentScore), 6) AS StdSentiment FROM j GROUP BY Tag""")
def sentiment_by_tag(spark, d):
    posts = _documents(spark, d).select(F.col("doc_id").alias("Id"), F.array("lang", "source").alias("TagsList"))
    comments = scored_turns(spark, d).withColumnRenamed("conv_id", "PostId")
    return tidy(se.by_tag(posts, comments, salt_by=["turn"]))


@query("j01_comments_with_posts", """SELECT conv_id AS PostId, turn, role, lang, source FROM conversations JOIN documents ON conv_id = doc_id""")
def comments_with_posts(spark, d):
    from agorastat.operators.joins import lookup_join

    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("PostId"), "turn", "role")
    posts = _documents(spark, d).select(F.col("doc_id").alias("PostId"), "lang", "source")
    return lookup_join(turns, posts, ["PostId"], salt_by=["turn"])


@query("a11_sentiment_by_day", f"""{DOC_SCORES} SELECT strftime(ts, '%Y-%m-%d') AS Period, COUNT(*) AS Count, ROUND(AVG(SentimentScore), 6) AS AvgSentiment
FROM scored JOIN events ON doc_id = event_id GROUP BY 1""")
def sentiment_by_day(spark, d):
    events = table(spark, d, "events").select(F.col("event_id").alias("doc_id"), "ts")
    return tidy(se.over_time(scored_documents(spark, d).join(events, "doc_id"), "ts", "day"))


@query("a12_label_counts", f"{DOC_SCORES} SELECT SentimentScoreLabel, COUNT(*) AS Count FROM scored GROUP BY ALL")
def label_counts(spark, d):
    return agg.distribution(scored_documents(spark, d), "SentimentScoreLabel")


@query("f05_toxic", f"{DOC_SCORES} SELECT doc_id, ROUND(SentimentScore, 6) AS SentimentScore FROM scored WHERE SentimentScore < -0.5")
def toxic(spark, d):
    return tidy(se.toxic(scored_documents(spark, d)).select("doc_id", "SentimentScore"))


# --- features ---------------------------------------------------------------

@query("v01_tfidf_table", f"""WITH {TOKENS}, u AS (SELECT doc_id, unnest(t) AS Token FROM tok), c AS (SELECT doc_id, Token, COUNT(*) AS Tf FROM u GROUP BY ALL),
f AS (SELECT Token, COUNT(*) AS Df FROM c GROUP BY Token)
SELECT doc_id, Token, Tf, Df, ROUND(CASE WHEN Df >= 5 THEN Tf * ln(((SELECT COUNT(*) FROM tok) + 1) / (Df + 1)) ELSE 0 END, 6) AS TfIdf FROM c JOIN f USING (Token)""")
def tfidf_table(spark, d):
    return tidy(ft.tfidf_table(_tokens(spark, d), key="doc_id", min_doc_freq=5))


def _vector(df, column, key="doc_id"):
    values = vector_to_array(column)
    return tidy(
        df.select(key, F.size(values).alias("size"), F.aggregate(values, F.lit(0.0), lambda a, x: a + x).alias("total")), 4
    )


@query("v01_tfidf_vectors")
def tfidf_vectors(spark, d):
    vectors, _ = ft.tfidf(_tokens(spark, d))
    return _vector(vectors, "TfidfFeatures")


@query("v02_count_vectors", f"""WITH {TOKENS}, u AS (SELECT doc_id, unnest(t) AS Token FROM tok),
f AS (SELECT Token, COUNT(DISTINCT doc_id) AS Df FROM u GROUP BY Token HAVING Df >= 5 AND Df <= 0.95 * (SELECT COUNT(*) FROM documents)),
c AS (SELECT doc_id, COUNT(*) AS n FROM u SEMI JOIN f USING (Token) GROUP BY doc_id)
SELECT doc_id, (SELECT COUNT(*) FROM f) AS size, CAST(coalesce(n, 0) AS DOUBLE) AS total FROM documents LEFT JOIN c USING (doc_id)""")
def count_vectors(spark, d):
    tokens = _tokens(spark, d).select("doc_id", "ProcessedText")
    counts, words = ft.count_table(tokens, key="doc_id")
    totals = tokens.select("doc_id").join(counts.groupBy("doc_id").agg(F.sum("Tf").alias("n")), "doc_id", "left")
    size = words.agg(F.count(F.lit(1))).scalar()
    return tidy(totals.select("doc_id", size.alias("size"), F.coalesce("n", F.lit(0)).cast("double").alias("total")), 4)


@query("v02_vocabulary", f"""WITH {TOKENS}, u AS (SELECT doc_id, unnest(t) AS Token FROM tok),
f AS (SELECT Token, COUNT(DISTINCT doc_id) AS Df FROM u GROUP BY Token HAVING Df >= 5 AND Df <= 0.95 * (SELECT COUNT(*) FROM documents)),
n AS (SELECT Token, Df, row_number() OVER (ORDER BY Df DESC, encode(Token)) - 1 AS Index FROM f),
o AS (SELECT Token, COUNT(*) AS n FROM u GROUP BY Token)
SELECT Token, Df, Index, CAST(o.n AS BIGINT) AS occurrences FROM n JOIN o USING (Token)""")
def vocabulary(spark, d):
    """Every kept token with its number, and its occurrences summed from the counts that carry the number."""
    counts, words = ft.count_table(_tokens(spark, d).select("doc_id", "ProcessedText"), key="doc_id")
    return tidy(words.join(counts.groupBy("Index").agg(F.sum("Tf").alias("occurrences")), "Index"))


@query("v03_word_vectors", "SELECT COUNT(*) AS rows, 100 AS size, 0 AS unlike, 0 AS unlike_stored FROM documents")
def word_vectors(spark, d):
    """Each vector is the mean of its words' vectors, and a stored model gives the same ones."""
    tokens = materialize(_tokens(spark, d).select("doc_id", "ProcessedText"), "tokens")
    vectors, model = ft.word_vectors(tokens)
    path = scratch_path(spark, "word-vectors")
    ft.save_vectors(model, path)
    stored = ft.load_vectors(path).transform(tokens).select("doc_id", vector_to_array("Word2VecFeatures").alias("stored"))
    words = materialize(model.getVectors().select(F.col("word").alias("Word"), vector_to_array("vector").alias("Vector")), "vectors")
    summed = co.mean_vectors(tokens, words, key="doc_id").select("doc_id", F.transform("Vector", lambda x: x * F.col("Words")).alias("sum"))
    given = vectors.select("doc_id", F.size("ProcessedText").alias("n"), vector_to_array("Word2VecFeatures").alias("v"))
    away = F.filter("v", lambda x, i: F.abs(x - F.coalesce(F.get("sum", i) / F.col("n"), F.lit(0.0))) > 1e-4)
    unlike = given.join(summed, "doc_id", "left").agg(F.sum(F.size(away))).scalar()
    both = given.join(stored, "doc_id")
    return tidy(
        both.agg(
            F.count(F.lit(1)).alias("rows"),
            F.max(F.size("v")).alias("size"),
            unlike.alias("unlike"),
            F.count_if(F.col("v") != F.col("stored")).alias("unlike_stored"),
        )
    )


PPMI = f"""WITH {TOKENS}, w AS (SELECT doc_id, unnest(t) AS Word, unnest(range(len(t))) AS i FROM tok),
kept AS (SELECT Word FROM w GROUP BY Word HAVING COUNT(*) >= 5),
near AS (SELECT a.Word, b.Word AS Context, COUNT(*) AS N FROM w a JOIN (SELECT doc_id, Word, i, unnest(range(-5, 6)) AS d FROM w) b
  ON a.doc_id = b.doc_id AND a.i = b.i + b.d AND b.d <> 0 WHERE a.Word IN (FROM kept) AND b.Word IN (FROM kept) GROUP BY ALL),
sums AS (SELECT Word, CAST(SUM(N) AS DOUBLE) AS total FROM near GROUP BY Word),
ppmi AS (SELECT near.Word, Context, N, ln(N * (SELECT SUM(total) FROM sums) / (s.total * c.total)) AS p FROM near JOIN sums s ON near.Word = s.Word JOIN sums c ON Context = c.Word)"""


@query("v03_ppmi", f"{PPMI} SELECT Word, Context, N, ROUND(p, 6) AS Ppmi FROM ppmi WHERE p > 1e-9")
def ppmi_table(spark, d):
    """Weights that differ from 0 by rounding only are left out on both sides."""
    return tidy(co.ppmi(_tokens(spark, d)).filter("Ppmi > 1e-9"))


def _ppmi_vectors(spark, d):
    tokens = _tokens(spark, d).select("doc_id", "ProcessedText")
    return tokens, co.ppmi_vectors(tokens)


@query("v03_ppmi_vectors", f"""{PPMI} SELECT i, (SELECT COUNT(DISTINCT Word) FROM ppmi WHERE p > 0) AS words, 0 AS unlike, 0 AS beside
FROM (SELECT unnest(range(100)) AS i)""")
def ppmi_vectors(spark, d):
    """Per place of the vectors: the table of weights, applied to the column, gives the eigenvalue times its square length; and
    it is at right angles to the next column."""
    _, model = _ppmi_vectors(spark, d)
    places = range(len(model.values))
    at = lambda i: F.get("Vector", F.lit(i))
    sums = [F.sum(at(i) * at(i)) for i in places], [F.coalesce(F.sum(at(i) * at(i + 1)), F.lit(0.0)) for i in places]
    form = F.array(*[F.lit(q) for q in model.forms()])
    each = model.vectors.agg(F.count(F.lit(1)).alias("words"), *[F.array(*s).cast("array<double>").alias(n) for n, s in zip(("l", "across"), sums)])
    cells = each.select("words", F.posexplode(F.arrays_zip("l", "across", form.cast("array<double>").alias("q"))).alias("i", "c")).select("words", "i", "c.*")
    off = F.abs(F.abs("q") - F.col("l") * F.col("l")) > 1e-6 * F.col("l") * F.col("l")
    return tidy(cells.select("i", "words", off.cast("int").alias("unlike"), (F.abs("across") > 1e-6 * F.col("l")).cast("int").alias("beside")))


@query("a48_mean_vectors", f"""{PPMI}, has AS (SELECT DISTINCT Word FROM ppmi WHERE p > 0)
SELECT doc_id, COUNT(*) AS Words, 100 AS size, 0 AS unlike FROM w WHERE Word IN (FROM has) GROUP BY doc_id""")
def mean_vectors(spark, d):
    """Counted words per text, and whether the sum over the vector is the mean of its words' sums."""
    tokens, model = _ppmi_vectors(spark, d)
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
    means = co.mean_vectors(tokens, model.vectors, key="doc_id")
    said = ft.token_counts(tokens, key="doc_id").join(model.vectors.select(F.col("Word").alias("Token"), total("Vector").alias("s")), "Token")
    own = said.groupBy("doc_id").agg((F.sum(F.col("Tf") * F.col("s")) / F.sum("Tf")).alias("own"))
    both = means.join(own, "doc_id", "left")
    unlike = F.coalesce((F.abs(total("Vector") - F.col("own")) > 1e-9).cast("int"), F.lit(1))
    return tidy(both.select("doc_id", "Words", F.size("Vector").alias("size"), unlike.alias("unlike")))


@query("v04_similar_words", "SELECT 10 AS words, 0 AS unlike, 0 AS closer_left_out, 0 AS itself FROM documents LIMIT 1")
def similar_words(spark, d):
    """Ten other words with the cosine of the two vectors; no word that is left out is closer."""
    tokens = materialize(text.word_tokens(_documents(spark, d), "text", "ProcessedText", key="doc_id").select("doc_id", "ProcessedText"), "tokens")
    _, model = ft.word_vectors(tokens)
    word = agg.word_frequency(tokens, k=1).first()["Word"]
    near = materialize(ft.similar_words(model, word), "near")
    vectors = materialize(model.getVectors().select("word", vector_to_array("vector").alias("v")), "vectors")
    asked = vectors.filter(F.col("word") == word).select("v").scalar()
    beside = vectors.withColumn("asked", asked)
    scored = beside.select("word", vec.cosine("v", "asked").alias("own")).join(near, "word", "left")
    least = near.agg(F.min("similarity")).scalar()
    return tidy(scored.agg(
        F.count("similarity").alias("words"), F.count_if(F.abs(F.col("own") - F.col("similarity")) > 1e-4).alias("unlike"),
        F.count_if(F.col("similarity").isNull() & (F.col("word") != word) & (F.col("own") > least + 1e-4)).alias("closer_left_out"),
        F.count_if((F.col("word") == word) & F.col("similarity").isNotNull()).alias("itself"),
    ))


LINE = ["l_quantity", "l_extendedprice", "l_discount"]
LINE_KEYS = "l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber"


def _lines(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LINE)


def _cells(df, column):
    v = vector_to_array(column)
    keys = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return tidy(df.select(*keys, *[v[i].alias(f"v{i}") for i in range(len(LINE))]), 5)


@query("v05_numeric_vector", f"SELECT {LINE_KEYS}, " + ", ".join(f"ROUND({c}, 5) AS v{i}" for i, c in enumerate(LINE))
       + " FROM lineitem WHERE l_quantity <> 7")
def numeric_vector(spark, d):
    gaps = _lines(spark, d).withColumn("l_quantity", F.when(F.col("l_quantity") != 7, F.col("l_quantity")))
    return _cells(ft.numeric_vector(gaps, LINE), "NumericFeatures")


@query("v06_standard_scale", "WITH s AS (SELECT " + ", ".join(f"AVG({c}) AS m{i}, STDDEV({c}) AS s{i}" for i, c in enumerate(LINE))
       + f" FROM lineitem) SELECT {LINE_KEYS}, " + ", ".join(f"ROUND(({c} - m{i}) / s{i}, 5) AS v{i}" for i, c in enumerate(LINE)) + " FROM lineitem, s")
def standard_scale(spark, d):
    scaled, _ = ft.scale(ft.numeric_vector(_lines(spark, d), LINE, "x"), "x")
    return _cells(scaled, "x_scaled")


@query("v06_minmax_scale", "WITH s AS (SELECT " + ", ".join(f"MIN({c}) AS m{i}, MAX({c}) AS s{i}" for i, c in enumerate(LINE))
       + f" FROM lineitem) SELECT {LINE_KEYS}, " + ", ".join(f"ROUND(({c} - m{i}) / (s{i} - m{i}), 5) AS v{i}" for i, c in enumerate(LINE)) + " FROM lineitem, s")
def minmax_scale(spark, d):
    scaled, _ = ft.scale(ft.numeric_vector(_lines(spark, d), LINE, "x"), "x", method="minmax")
    return _cells(scaled, "x_scaled")


@query("v07_combined_vectors", "SELECT COUNT(*) AS rows, 1001 AS size, 0 AS unlike FROM documents")
def combined_vectors(spark, d):
    """The numeric column stands behind the thousand slots of the text."""
    vectors, _ = ft.tfidf(_tokens(spark, d), num_features=1000)
    sized = vectors.withColumn("n", F.size("ProcessedText").cast("double"))
    cells = ft.combine_vectors(sized, "TfidfFeatures", ["n"]).select("n", vector_to_array("CombinedFeatures").alias("v"))
    return tidy(
        cells.agg(
            F.count(F.lit(1)).alias("rows"),
            F.max(F.size("v")).alias("size"),
            F.count_if(F.element_at("v", -1) != F.col("n")).alias("unlike"),
        )
    )


@query("v08_question_vectors", """SELECT COUNT(*) AS rows, 1003 AS size, 0 AS unlike, 0 AS negative
FROM orders""")
def question_vectors(spark, d):
    """A thousand weights, none negative, then views, answers and tags as they are."""
    shaped = raw_questions(spark, d).withColumn("tag_count", F.size("tags"))
    vectors, _ = ft.question_vectors(shaped)
    cells = vectors.select(vector_to_array("features").alias("v"), F.array("view_count", "answer_count", "tag_count").cast("array<double>").alias("own"))
    return tidy(cells.agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.size("v")).alias("size"), F.count_if(F.slice("v", 1001, 3) != F.col("own")).alias("unlike"),
        F.count_if(F.exists("v", lambda x: x < 0)).alias("negative"),
    ))
