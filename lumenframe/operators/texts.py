"""Corpus operators over long ``(doc, term, tf)`` tables, and the text model pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.text import cleaned_tokens, one_and_two_grams
from lumenframe.functions.stemming import stemmed


def term_counts(
    df: DataFrame, doc: str, tokens: Column, keep: Sequence[str] = (), stopwords: Sequence[str] = ()
) -> DataFrame:
    """One row per (doc, term) with its count; a task counts its own documents before the shuffle."""
    terms = df.select(doc, *keep, F.explode(tokens).alias("term"))
    if stopwords:
        terms = terms.filter(~F.col("term").isin(*stopwords))
    return terms.groupBy(doc, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(
    counts: DataFrame, documents: DataFrame, max_features: int = 5000, min_df: int = 1, max_df: float = 1.0
) -> DataFrame:
    """The most frequent terms within the document-frequency limits; ties by term.

    ``min_df`` is a number of documents, ``max_df`` a share of ``documents``.
    """
    total = documents.agg(F.count(F.lit(1))).scalar()
    terms = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    allowed = terms.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * total))
    return allowed.orderBy(F.desc("cf"), "term").limit(max_features)


def tfidf(
    counts: DataFrame, words: DataFrame, documents: DataFrame, doc: str = "doc_id", sublinear: bool = False
) -> DataFrame:
    """Smoothed TF-IDF, rows scaled to unit length: ``doc, term, weight``.

    idf = ln((1 + n) / (1 + df)) + 1. The vocabulary has at most ``max_features``
    rows, which bounds the broadcast and the rows of one document.
    """
    total = documents.agg(F.count(F.lit(1))).scalar()
    tf = (1 + F.log("tf")) if sublinear else F.col("tf").cast("double")
    idf = F.log((1 + total) / (1 + F.col("df"))) + 1
    raw = counts.join(F.broadcast(words.select("term", "df")), "term").withColumn("_raw", tf * idf)
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(doc)))
    return raw.withColumn("weight", F.col("_raw") / norm).drop("_raw", "df")


def word_frequencies(df: DataFrame, label: str, tokens: Column, n: int = 100) -> DataFrame:
    """The ``n`` most frequent words of each class."""
    counts = (
        df.select(label, F.explode(tokens).alias("term")).groupBy(label, "term").agg(F.count(F.lit(1)).alias("count"))
    )
    first = Window.partitionBy(label).orderBy(F.desc("count"), "term")
    return counts.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= n)


def naive_bayes_fit(
    weights: DataFrame, label: str, documents: DataFrame, smoothing: float = 1.0
) -> tuple[DataFrame, DataFrame]:
    """Multinomial naive Bayes on term weights: (class, term, log_p) and (class, log_prior, log_rest).

    Class priors are plain shares of ``documents``, with those that have no known term. ``log_rest`` is the
    log probability of a vocabulary term that never occurs with the class.
    """
    sizes = documents.groupBy(label).agg(F.count(F.lit(1)).alias("docs"))
    masses = weights.groupBy(label).agg(F.sum("weight").alias("mass"))
    docs = sizes.join(masses, label, "left").withColumn("mass", F.coalesce("mass", F.lit(0.0)))
    size = weights.select("term").distinct().agg(F.count(F.lit(1))).scalar()
    total = sizes.agg(F.sum("docs")).scalar()
    classes = docs.select(
        F.col(label).alias("class"),
        F.log(F.col("docs") / total).alias("log_prior"),
        F.log(F.lit(smoothing) / (F.col("mass") + smoothing * size)).alias("log_rest"),
        (F.col("mass") + smoothing * size).alias("_mass"),
    )
    terms = weights.groupBy(F.col(label).alias("class"), "term").agg(F.sum("weight").alias("_w"))
    terms = terms.join(classes.select("class", "_mass"), "class").select(
        "class", "term", F.log((F.col("_w") + smoothing) / F.col("_mass")).alias("log_p")
    )
    return terms, classes.drop("_mass")


def naive_bayes_predict(
    weights: DataFrame, terms: DataFrame, classes: DataFrame, documents: DataFrame, doc: str = "doc_id"
) -> DataFrame:
    """Class with the highest joint log likelihood of each of ``documents``; the lower class wins a tie.

    score(class) = log_prior + sum(weight x log_p): first every term counts with
    ``log_rest``, then terms seen with the class add their difference. A document
    without a known term gets the class with the highest prior.
    """
    model = terms.join(classes.select("class", "log_rest"), "class").select(
        "class", "term", (F.col("log_p") - F.col("log_rest")).alias("_gain")
    )
    masses = weights.groupBy(doc).agg(F.sum("weight").alias("_mass"))
    mass = documents.select(doc).join(masses, doc, "left").withColumn("_mass", F.coalesce("_mass", F.lit(0.0)))
    gains = (
        weights.select(doc, "term", "weight")
        .join(model, "term")
        .groupBy(doc, "class")
        .agg(F.sum(F.col("weight") * F.col("_gain")).alias("_gain"))
    )
    listed = classes.agg(F.collect_list(F.struct("class", "log_prior", "log_rest"))).scalar()
    scores = (
        mass.select(doc, "_mass", F.explode(listed).alias("c"))
        .select(doc, "c.class", (F.col("c.log_prior") + F.col("_mass") * F.col("c.log_rest")).alias("_base"))
        .join(gains, [doc, "class"], "left")
        .withColumn("score", F.col("_base") + F.coalesce("_gain", F.lit(0.0)))
    )
    best = scores.groupBy(doc).agg(
        F.max_by("class", F.struct(F.round("score", 9), -F.col("class"))).alias("prediction"),
        F.max("score").alias("score"),
    )
    return best


def model_tokens(text: str | Column, stem: bool = True) -> Column:
    """Cleaned, stemmed words followed by their bigrams: the input of the text model."""
    tokens = cleaned_tokens(text)
    return stemmed(tokens) if stem else tokens


def prepared(df: DataFrame, text: str = "text", stem: bool = True) -> DataFrame:
    """Adds ``cleaned`` and the ``terms`` (one- and two-grams) the vectorizer reads."""
    with_tokens = df.withColumn("_tokens", model_tokens(text, stem))
    return with_tokens.withColumns(
        {"cleaned": F.array_join("_tokens", " "), "terms": one_and_two_grams(F.col("_tokens"))}
    ).drop("_tokens")


def counting_vectorizer(
    train: DataFrame, terms: str, output: str, max_features: int, min_df: float, max_df: float
) -> CountVectorizer:
    """Term counts with the document limits, shares of ``train`` if below 1.0, as numbers of documents.

    For a share Spark keeps the terms of all documents as objects in storage, just to count the documents.
    """
    counting = CountVectorizer(inputCol=terms, outputCol=output, vocabSize=max_features)
    total = train.agg(F.count(F.lit(1))).first()[0] if min(min_df, max_df) < 1.0 else 0
    counting = counting.setMinDF(min_df if min_df >= 1.0 else max(1.0, min_df * total))
    if max_df >= 1.0:  # Spark reads 1.0 and more as a number of documents
        return counting
    return counting.setMaxDF(max_df * total if max_df * total >= 1.0 else max_df)


def fit_vectorizer(
    train: DataFrame, max_features: int = 5000, min_df: float = 5.0, max_df: float = 0.8, output: str = "features"
) -> PipelineModel:
    """Counts, smoothed idf + 1, unit rows; all stages JVM side, saved and loaded as one pipeline.

    Spark's idf is ln((n + 1) / (df + 1)); adding 1 turns the scaling into an
    element-wise product with a fixed vector of at most ``max_features`` numbers.
    """
    counter = counting_vectorizer(train, "terms", "_tf", max_features, min_df, max_df).fit(train)
    counted = counter.transform(train)
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(counted).idf
    scale = ElementwiseProduct(inputCol="_tf", outputCol="_scaled", scalingVec=Vectors.dense(idf.toArray() + 1.0))
    unit = Normalizer(inputCol="_scaled", outputCol=output, p=2.0)
    return Pipeline(stages=[counter, scale, unit]).fit(train)
