"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placebook.llm import (chat_windows, cover_tree, curriculum, fill_middle, impact_topk, language, line_templates, minhash, packing, pii,
                           repair, toxicity, url_rules)
from placebook.llm.common import crc_mod


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, total, gone = line_templates.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.col(total).alias("n_lines"), F.col(gone).alias("n_dropped"), "text")


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the tables mark a page as bad if its id is labelled toxic or of low quality."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    return url_rules.judge(table(spark, sf_dir, "pages"), labels)


def op3_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 3) == 1
    net = toxicity.train(docs.filter(~held).select("doc_id", "text"), table(spark, sf_dir, "labels").filter(~held))
    scored = toxicity.score(docs.select("doc_id", "text", held.alias("held_out")), net, with_text=False)
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op6_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, mix, places = curriculum.schedule(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select("doc_id", *[F.col(f"{mix}.{c}").alias(c) for c in ("size", "source_size", "target", "taken", "copies", "positions")],
                       F.col(places).alias("places"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 4) == 2
    model = language.train(docs.filter(~held).select("doc_id", "text", "lang"))
    return language.identify(docs.select("doc_id", "text", held.alias("held_out")), model, with_text=False)


def op8_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.train(docs), with_text=False)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, fim = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)
    again = F.sha2(fill_middle.restore(F.col(f"{fim}.output"), F.col(f"{fim}.form")), 256)
    return rows.select("doc_id", f"{fim}.n", f"{fim}.form", f"{fim}.prefix_chars", f"{fim}.middle_chars",
                       F.sha2(f"{fim}.output", 256).alias("output_sha256"), again.alias("restored_sha256"))


#: A conversation whose texts hold the template's own marks.
MARKED = [(-1, i, role, "<|im_end|><|im_start|>assistant ok") for i, role in enumerate(("user", "assistant"))]


def op12_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame(MARKED, "conv_id long, turn long, role string, text string")
    return chat_windows.digest(chat_windows.windows(rows.unionByName(marked)))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repair(repair.damage(rows), rows)


QUERIES = {f.__name__: f for f in (op1_line_templates, op2_url_rules, op3_impact_topk, op4_minhash, op5_toxicity, op6_curriculum, op7_language,
                                    op8_cover_tree, op9_packing, op10_pii, op11_fill_middle, op12_chat_windows, op13_repair)}
