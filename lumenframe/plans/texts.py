"""Text and topic queries over the documents, their labels and the raw pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions import columns as fx
from lumenframe.functions import text as tx
from lumenframe.functions.stopwords import ENGLISH
from lumenframe.operators import stats, texts, topics
from lumenframe.plans.listings import histogram_sql, shown
from lumenframe.plans.registry import query
from lumenframe.plans.sales import rounded
from lumenframe.plans.views import REVIEWS, reviews, split_key_sql
from lumenframe.session import checkpoint
from lumenframe.sources.readers import read_table, spread

STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH) + "]"


def cleaned_sql(text: str) -> str:
    """List of cleaned words in SQL."""
    return (
        "list_filter(string_split_regex(regexp_replace(regexp_replace(lower(regexp_replace("
        f"{text}, '<[^>]+>', ' ', 'g')), '[\\p{{Z}}\\x09-\\x0D\\x1C-\\x1F\\x{{85}}]+', ' ', 'g'), "
        f"'[^a-z ]', '', 'g'), ' +'), lambda t: len(t) > 2 AND NOT list_contains({STOP}, t))"
    )


def words_sql(text: str) -> str:
    return (
        f"list_filter(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}'), "
        f"lambda t: NOT list_contains({STOP}, t))"
    )


def documents(spark, sf):
    return spread(read_table(spark, sf, "documents"))


@query("x1t_clean_text", f"SELECT doc_id, array_to_string({cleaned_sql('text')}, ' ') AS cleaned FROM documents")
def x1t_clean_text(spark, sf):
    return documents(spark, sf).select("doc_id", tx.cleaned("text", stem=False).alias("cleaned"))


@query("x1t_clean_pages", f"SELECT page_id, array_to_string({cleaned_sql('html')}, ' ') AS cleaned FROM pages")
def x1t_clean_pages(spark, sf):
    return read_table(spark, sf, "pages").select("page_id", tx.cleaned("html", stem=False).alias("cleaned"))


@query("x2t_stem_corpus")
def x2t_stem_corpus(spark, sf):
    return documents(spark, sf).select("doc_id", tx.cleaned("text").alias("stemmed"))


@query(
    "x3t_word_frequencies",
    f"""WITH {REVIEWS}, t AS (SELECT label, unnest({cleaned_sql('text')}) AS term FROM reviews),
      c AS (SELECT label, term, count(*) AS count FROM t GROUP BY ALL)
    SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY count DESC, term) AS INTEGER) AS rank
    FROM c QUALIFY rank <= 100""",
)
def x3t_word_frequencies(spark, sf):
    return texts.word_frequencies(reviews(spark, sf), "label", tx.cleaned_tokens("text"))


@query(
    "x4t_tokens",
    f"""WITH t AS (SELECT doc_id, {words_sql('text')} AS tokens FROM documents)
    SELECT doc_id, len(tokens) AS n_tokens, len(list_distinct(tokens)) AS n_distinct,
      tokens[1] AS first_token, tokens[len(tokens)] AS last_token FROM t""",
)
def x4t_tokens(spark, sf):
    df = documents(spark, sf).select("doc_id", tx.word_tokens("text", ENGLISH).alias("t"))
    size = F.size("t")
    return df.select(
        "doc_id",
        size.cast("long").alias("n_tokens"),
        F.size(F.array_distinct("t")).cast("long").alias("n_distinct"),
        F.try_element_at("t", F.lit(1)).alias("first_token"),
        F.when(size > 0, F.try_element_at("t", F.greatest(size, F.lit(1)))).alias("last_token"),
    )


COUNTS = f"""tok AS (SELECT doc_id, lang, {words_sql('text')} AS t FROM documents),
  counts AS (SELECT doc_id, lang, term, count(*) AS tf FROM (
    SELECT doc_id, lang, unnest(t) AS term FROM tok) GROUP BY ALL)"""


def counts(spark, sf):
    """Term counts, written once: the vocabulary and the weights both read them."""
    return checkpoint(texts.term_counts(documents(spark, sf), "doc_id", tx.word_tokens("text"), ["lang"], ENGLISH))


@query(
    "x5t_ngrams",
    f"""WITH tok AS (SELECT doc_id, {words_sql('text')} AS t FROM documents),
    g AS (SELECT unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM tok)
    SELECT term, count(*) AS count FROM g GROUP BY term""",
)
def x5t_ngrams(spark, sf):
    df = documents(spark, sf).select(tx.word_tokens("text", ENGLISH).alias("t"))
    return (
        df.select(F.explode(tx.one_and_two_grams(F.col("t"))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("count"))
    )


VOCAB = f"""{COUNTS}, vocab AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM counts GROUP BY term
  HAVING count(*) >= 5 AND count(*) <= 0.8 * (SELECT count(*) FROM documents) ORDER BY cf DESC, term LIMIT 2000)"""


def vocab(spark, sf, df):
    return texts.vocabulary(df, read_table(spark, sf, "documents"), 2000, 5, 0.8)


@query("x6t_vocabulary", f"WITH {VOCAB} SELECT * FROM vocab")
def x6t_vocabulary(spark, sf):
    return vocab(spark, sf, counts(spark, sf))


def tfidf_sql(tf: str) -> str:
    return f"""{VOCAB}, raw AS (SELECT doc_id, lang, term, tf, {tf} * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS r
      FROM counts JOIN vocab USING (term)),
    weights AS (SELECT doc_id, lang, term, tf, r / sqrt(sum(r * r) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


def weights(spark, sf, sublinear=False):
    df = counts(spark, sf)
    return texts.tfidf(df, vocab(spark, sf, df), read_table(spark, sf, "documents"), sublinear=sublinear)


@query("x7t_tfidf", f"WITH {tfidf_sql('tf')} SELECT doc_id, term, round(weight, 6) AS weight FROM weights")
def x7t_tfidf(spark, sf):
    return rounded(weights(spark, sf).select("doc_id", "term", "weight"), 6, "weight")


@query("x8t_sublinear", f"WITH {tfidf_sql('(1 + ln(tf))')} SELECT doc_id, term, round(weight, 6) AS weight FROM weights")
def x8t_sublinear(spark, sf):
    return rounded(weights(spark, sf, sublinear=True).select("doc_id", "term", "weight"), 6, "weight")


@query(
    "x9t_length_by_class",
    f"""WITH {REVIEWS}, r AS (SELECT label, length(text) AS n FROM reviews),
    q AS (SELECT label, quantile_cont(n, 0.25) AS q1, median(n) AS med, quantile_cont(n, 0.75) AS q3 FROM r GROUP BY label),
    w AS (SELECT r.label, n, q1, med, q3, n BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM r JOIN q ON r.label = q.label)
    SELECT label, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
      CAST(min(n) FILTER (inside) AS DOUBLE) AS whisker_low, CAST(max(n) FILTER (inside) AS DOUBLE) AS whisker_high,
      count(*) FILTER (NOT inside) AS outliers FROM w GROUP BY ALL""",
)
def x9t_length_by_class(spark, sf):
    df = reviews(spark, sf).select("label", F.length("text").alias("n"))
    return rounded(stats.box_stats(df, "n", ["label"]), 6, "q1", "median", "q3")


@query(
    "e6_text_length_range",
    f"""WITH {REVIEWS} SELECT min(length(text)) AS min, max(length(text)) AS max, round(avg(length(text)), 4) AS mean,
      round(median(length(text)), 4) AS median FROM reviews""",
)
def e6_text_length_range(spark, sf):
    df = reviews(spark, sf).select(F.length("text").cast("long").alias("n"))
    return rounded(stats.range_summary(df, "n"), 4, "mean", "median")


@query("e17_text_length_histogram", f"WITH r AS (SELECT CAST(length(text) AS DOUBLE) AS size FROM documents), {histogram_sql('r', 'size', 50)}")
def e17_text_length_histogram(spark, sf):
    return shown(stats.histogram(documents(spark, sf).select(F.length("text").cast("double").alias("size")), "size", 50))


@query("c13_length_prefix", f"WITH {REVIEWS} SELECT doc_id, CAST(length(text) AS INTEGER) AS size, text[:200] || '…' AS short FROM reviews")
def c13_length_prefix(spark, sf):
    return reviews(spark, sf).select("doc_id", F.length("text").alias("size"), fx.shortened("text").alias("short"))


@query("d5_text_search", "SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '(?i)copyright|licen[cs]e')")
def d5_text_search(spark, sf):
    return documents(spark, sf).filter(fx.matches("text", "copyright|licen[cs]e")).select("doc_id", "lang")


@query("d5_literal_search", "SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'the ')")
def d5_literal_search(spark, sf):
    return documents(spark, sf).filter(fx.contains_text("text", "THE ")).select("doc_id", "lang")


PREDICTED = f"{REVIEWS}, predicted AS (SELECT *, CAST(length(text) >= 1000 AS INTEGER) AS prediction FROM reviews)"


def predicted(spark, sf):
    return reviews(spark, sf).withColumn("prediction", (F.length("text") >= 1000).cast("int"))


@query(
    "d4_prediction_filter",
    f"""WITH {PREDICTED} SELECT doc_id, 'correct' AS kind FROM predicted WHERE label = prediction
    UNION ALL SELECT doc_id, 'wrong' FROM predicted WHERE label <> prediction""",
)
def d4_prediction_filter(spark, sf):
    df = predicted(spark, sf)
    right = df.filter("label = prediction").select("doc_id", F.lit("correct").alias("kind"))
    wrong = df.filter("label <> prediction").select("doc_id", F.lit("wrong").alias("kind"))
    return right.unionByName(wrong)


# --- naive Bayes ------------------------------------------------------------------------

NB = f"""{tfidf_sql('tf')}, {REVIEWS},
  lw AS (SELECT w.doc_id, term, weight, label FROM weights w JOIN reviews USING (doc_id)),
  ms AS (SELECT label, sum(weight) AS mass FROM lw GROUP BY label),
  cls AS (SELECT r.label, count(*) AS docs, coalesce(any_value(mass), 0) AS mass FROM reviews r
    LEFT JOIN ms ON ms.label = r.label GROUP BY r.label),
  sz AS (SELECT (SELECT count(DISTINCT term) FROM lw) AS v, count(*) AS n FROM reviews),
  grid AS (SELECT cls.label, term, docs, mass FROM cls, (SELECT DISTINCT term FROM lw)),
  lp AS (SELECT g.label, g.term, ln((coalesce(sum(weight), 0) + 1) / (any_value(mass) + (SELECT v FROM sz))) AS log_p
    FROM grid g LEFT JOIN lw ON lw.label = g.label AND lw.term = g.term GROUP BY ALL)"""


def labelled_weights(spark, sf):
    """Term weights with the label, and the labelled documents."""
    labels = reviews(spark, sf).select("doc_id", "label")
    return checkpoint(weights(spark, sf).select("doc_id", "term", "weight").join(labels, "doc_id")), labels


@query(
    "m11_naive_bayes_terms",
    f"""WITH {NB} SELECT label AS class, term, round(log_p, 6) AS log_p FROM lp
    WHERE EXISTS (SELECT 1 FROM lw WHERE lw.label = lp.label AND lw.term = lp.term)""",
)
def m11_naive_bayes_terms(spark, sf):
    df, labels = labelled_weights(spark, sf)
    terms, _ = texts.naive_bayes_fit(df, "label", labels)
    return rounded(terms, 6, "log_p")


@query(
    "m11_naive_bayes_predict",
    f"""WITH {NB}, lk AS (SELECT doc_id, lp.label, sum(weight * log_p) AS s FROM lw JOIN lp ON lw.term = lp.term GROUP BY ALL),
    rc AS (SELECT doc_id, cls.label, docs FROM reviews, cls),
    sc AS (SELECT rc.doc_id, rc.label AS class, ln(docs / (SELECT n FROM sz)) + coalesce(s, 0) AS score
      FROM rc LEFT JOIN lk ON lk.doc_id = rc.doc_id AND lk.label = rc.label)
    SELECT doc_id, class AS prediction, round(score, 6) AS score FROM sc
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, class) = 1""",
)
def m11_naive_bayes_predict(spark, sf):
    df, labels = labelled_weights(spark, sf)
    terms, classes = texts.naive_bayes_fit(df, "label", labels)
    return rounded(texts.naive_bayes_predict(df, terms, classes, labels), 6, "score")


# --- topics -----------------------------------------------------------------------------

TOPIC_WEIGHTS = f"""{COUNTS}, langs AS (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS topic
    FROM (SELECT DISTINCT lang FROM documents)),
  tw AS MATERIALIZED (SELECT topic, term, CAST(sum(tf) AS DOUBLE) AS weight FROM counts JOIN langs USING (lang) GROUP BY ALL)"""


def language_codes(spark, sf):
    """Documents with the number of their language among the sorted languages."""
    from lumenframe.operators.features import label_codes

    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "source")
    return label_codes(docs, "lang", "topic").withColumn("topic", F.col("topic").cast("int"))


def topic_weights(spark, sf, per_doc=None):
    """Topic-term weights with one topic per language: the summed term counts."""
    from lumenframe.operators.features import label_codes

    per_doc = counts(spark, sf) if per_doc is None else per_doc
    per_language = per_doc.groupBy("lang", "term").agg(F.sum("tf").cast("double").alias("weight"))
    coded = label_codes(per_language, "lang", "topic")
    return checkpoint(coded.select(F.col("topic").cast("int").alias("topic"), "term", "weight"))


TOP = """top AS MATERIALIZED (SELECT topic, term, weight,
  CAST(row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS INTEGER) AS rank FROM tw QUALIFY rank <= {n})"""


@query("t4_top_words", f"WITH {TOPIC_WEIGHTS}, {TOP.format(n=15)} SELECT * FROM top")
def t4_top_words(spark, sf):
    return topics.top_words(topic_weights(spark, sf), 15)


LETTERS = "aeinst"
DIST = ", ".join(f"length(text) - length(replace(text, '{c}', ''))" for c in LETTERS)
DOMINANT = f"""dist AS (SELECT doc_id, lang, source, [{DIST}] AS d FROM documents),
  dom AS (SELECT doc_id, lang, source, CAST(list_max(d) / greatest(list_sum(d), 1) AS DOUBLE) AS confidence,
    CAST(list_position(d, list_max(d)) - 1 AS INTEGER) AS topic FROM dist)"""


def assigned(spark, sf):
    """Documents with a topic distribution: the shares of six letters."""
    counts = [F.length("text") - F.length(F.replace("text", F.lit(c), F.lit(""))) for c in LETTERS]
    df = documents(spark, sf).select("doc_id", "lang", "source", F.array(*counts).alias("d"))
    total = F.greatest(F.aggregate("d", F.lit(0), lambda a, x: a + x), F.lit(1))
    share = F.transform("d", lambda x: x / total)
    return topics.dominant_topic(df.withColumn("distribution", share), "distribution").drop("d", "distribution")


@query("t5_dominant_topic", f"WITH {DOMINANT} SELECT doc_id, topic, round(confidence, 6) AS confidence FROM dom")
def t5_dominant_topic(spark, sf):
    return rounded(assigned(spark, sf).select("doc_id", "topic", "confidence"), 6, "confidence")


COHERENCE = f"""{TOPIC_WEIGHTS}, {TOP.format(n=10)},
  h AS (SELECT DISTINCT doc_id, t.topic, rank FROM counts JOIN top t USING (term)),
  s AS (SELECT topic, rank AS i, count(*) AS docs FROM h GROUP BY ALL),
  p AS (SELECT x.topic, x.rank AS i, y.rank AS j, count(*) AS n_both FROM h x JOIN h y
    ON x.doc_id = y.doc_id AND x.topic = y.topic AND x.rank < y.rank GROUP BY ALL),
  w AS (SELECT x.topic, x.rank AS i, y.rank AS j FROM top x JOIN top y ON x.topic = y.topic AND x.rank < y.rank),
  coh AS (SELECT w.topic, avg(coalesce(n_both, 0) / docs) AS coherence FROM w JOIN s ON s.topic = w.topic AND s.i = w.i
    LEFT JOIN p ON p.topic = w.topic AND p.i = w.i AND p.j = w.j GROUP BY w.topic)"""


@query("t6_coherence", f"WITH {COHERENCE} SELECT topic, round(coherence, 6) AS coherence FROM coh")
def t6_coherence(spark, sf):
    per_doc = counts(spark, sf)
    return rounded(topics.coherence(topic_weights(spark, sf, per_doc), per_doc), 6, "coherence")


PAIR_WORDS = ("the", "an", "of", "und", "la", "le", "en", "re", "in")


@query(
    "j8_cooccurrence",
    f"""WITH tok AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS t FROM documents),
    d AS (SELECT doc_id, unnest(t) AS term FROM tok),
    f AS (SELECT * FROM d WHERE term IN {PAIR_WORDS})
    SELECT x.term AS "left", y.term AS "right", count(*) AS docs FROM f x JOIN f y
    ON x.doc_id = y.doc_id AND x.term < y.term GROUP BY ALL""",
)
def j8_cooccurrence(spark, sf):
    doc_terms = documents(spark, sf).select("doc_id", F.explode(tx.word_tokens("text")).alias("term"))
    return topics.cooccurrence(doc_terms, PAIR_WORDS)


KEY = split_key_sql("doc_id")


def share_sql(source: str, row: str) -> str:
    return (
        f"SELECT {row}, "
        + ", ".join(f"round(count(*) FILTER (topic = {i}) / count(*), 6) AS topic_{i}" for i in range(len(LETTERS)))
        + f" FROM {source} GROUP BY {row}"
    )


@query("e20_crosstab_share", f"WITH {DOMINANT} {share_sql('dom', 'lang')}")
def e20_crosstab_share(spark, sf):
    df = stats.crosstab_share(assigned(spark, sf), "lang", "topic", range(len(LETTERS)))
    return rounded(df, 6, *[c for c in df.columns if c != "lang"])


@query(
    "t7_topic_alignment",
    f"WITH {DOMINANT} {share_sql('dom', 'source')}",
)
def t7_topic_alignment(spark, sf):
    df = topics.topic_alignment(assigned(spark, sf), "source", range(len(LETTERS)))
    return rounded(df, 6, *[c for c in df.columns if c != "source"])


@query(
    "e21_dominant_category",
    f"""WITH {DOMINANT} SELECT * FROM (SELECT topic, source, count(*) AS count FROM dom GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY topic ORDER BY count DESC, source) = 1""",
)
def e21_dominant_category(spark, sf):
    return stats.dominant_category(assigned(spark, sf), "topic", "source")


@query(
    "r4_distinct_in_order",
    f"""WITH {TOPIC_WEIGHTS}, {TOP.format(n=12)}, f AS (SELECT term, min(topic * 1000 + rank) AS pos FROM top GROUP BY term)
    SELECT term, CAST(row_number() OVER (ORDER BY pos) AS INTEGER) AS place FROM f""",
)
def r4_distinct_in_order(spark, sf):
    from lumenframe.operators.ordered import with_position

    top = topics.top_words(topic_weights(spark, sf), 12)
    seen = topics.first_seen(top, "term", F.col("topic") * 1000 + F.col("rank"))
    return with_position(seen, ["position"], name="_p").select("term", (F.col("_p") + 1).cast("int").alias("place"))


@query(
    "t8_topic_term_table",
    f"""WITH {TOPIC_WEIGHTS}, {TOP.format(n=12)}, f AS (SELECT term, min(topic * 1000 + rank) AS pos FROM top GROUP BY term),
    g AS (SELECT f.term, f.pos, l.topic FROM f CROSS JOIN langs l)
    SELECT g.topic, g.term, CAST(pos // 1000 AS INTEGER) AS first_topic, CAST(pos % 1000 AS INTEGER) AS first_rank,
      coalesce(tw.weight, 0) AS weight FROM g LEFT JOIN tw ON tw.topic = g.topic AND tw.term = g.term""",
)
def t8_topic_term_table(spark, sf):
    return topics.topic_term_table(topic_weights(spark, sf), 12)


@query(
    "t9_topic_summary",
    f"""WITH {TOPIC_WEIGHTS}, {TOP.format(n=15)},
    words AS (SELECT topic, string_agg(term, ' ' ORDER BY rank) AS top_words FROM top GROUP BY topic),
    dom AS (SELECT * FROM (SELECT topic, source, count(*) AS n FROM documents JOIN langs USING (lang) GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY topic ORDER BY n DESC, source) = 1)
    SELECT topic, top_words, source FROM words JOIN dom USING (topic)""",
)
def t9_topic_summary(spark, sf):
    docs = language_codes(spark, sf).select("topic", "source")
    return topics.topic_summary(topic_weights(spark, sf), docs, "source")
