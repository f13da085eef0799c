"""The registered queries of the text operators and, where SQL can say the same, their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm import best_fit, decontaminate, infill, matrices, merkle, packing, pitman_yor, secrets, simhash
from lumenframe.llm import sketches, toxicity, wordpiece, wrappers
from lumenframe.llm.common import crc_of, documents
from lumenframe.llm.sql import DECONTAMINATION_SQL, INFILL_SQL, MERKLE_SQL, SECRETS_SQL


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf).select("doc_id", "text"))
    base = F.col("base_spans")

    def count(kind: str):
        rank = secrets.KINDS.index(kind)
        return F.size(F.filter(base, lambda s: s["rank"] == rank)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in ("assign", "access", "hex")],
        F.sha2(secrets.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.span_text("secret_spans").alias("spans"),
    )


def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    matched, name = decontaminate.find_matches(documents(spark, sf).select("doc_id", "text"), items)
    return matched.select("doc_id", *[c.alias(n) for n, c in decontaminate.measured(matched, name).items()])


def op3_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return pitman_yor.score_documents(documents(spark, sf))


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf).select("doc_id", "text"))
    return found.select("doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id")


def op5_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(documents(spark, sf), with_ids=False).drop("ids")


def op6_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return wrappers.extract_text(spark.read.parquet(f"{sf}/pages.parquet"))


def op7_token_matrices(spark: SparkSession, sf: str) -> DataFrame:
    packed = matrices.pack_matrices(documents(spark, sf))
    return packed.select(
        "sequence_id",
        "n_tokens",
        "doc_ids",
        "starts",
        "cu_seqlens",
        F.crc32("ids").alias("ids_crc32"),
        F.crc32("positions").alias("positions_crc32"),
    )


def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored, name = toxicity.score_toxicity(documents(spark, sf).select("doc_id", "text"), labels)
    score = F.col(name)["score"]
    return scored.select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        score.alias("score"),
        F.when(score >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def op9_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return sketches.fingerprint_edits(documents(spark, sf))


def op10_piece_counts(spark: SparkSession, sf: str) -> DataFrame:
    return wordpiece.piece_counts(documents(spark, sf))


def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    fields = {c: F.col(c) for c in merkle.FIELDS} | {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    changed = merkle.digest(merkle.joined_fields(list(fields.values())))
    rows = merkle.manifest(documents(spark, sf), changed=F.when(crc_of("doc_id") % 2 == 0, changed))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.digest(merkle.proof_text("path")).alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op12_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    cut, name = infill.fill_in_middle(documents(spark, sf).select("doc_id", "text"))
    made = {n: F.col(name)[n] for n in infill.RESULT.names}
    return cut.select(
        "doc_id",
        *[made[n].alias(n) for n in ("n", "form", "prefix_chars", "middle_chars")],
        merkle.digest(made["output"]).alias("output_sha256"),
        merkle.digest(infill.restored(made["output"], made["form"])).alias("restored_sha256"),
    )


def op13_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return best_fit.pack_best_fit(documents(spark, sf), with_ids=False).drop("ids")


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_decontamination,
        op3_lm_scores,
        op4_simhash,
        op5_packing,
        op6_html_text,
        op7_token_matrices,
        op8_toxicity,
        op9_fingerprints,
        op10_piece_counts,
        op11_merkle_manifest,
        op12_fill_in_middle,
        op13_best_fit_packing,
    )
}

ORACLES = {
    "op1_secret_scan": SECRETS_SQL,
    "op2_decontamination": DECONTAMINATION_SQL,
    "op11_merkle_manifest": MERKLE_SQL,
    "op12_fill_in_middle": INFILL_SQL,
}
