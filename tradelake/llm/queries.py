"""The queries of this package: each applies an operator to its whole table and returns the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import public_tokenizers
from tradelake.llm import alignment, chat, extraction, langid, neardup, packing, pieces, quality, repair, repeats, sharding, tokenfiles, winnowing
from tradelake.llm.common import table
from tradelake.session import scratch_path

SHARDS = 24


def _vocabulary(name: str) -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def word_tokenizer() -> str:
    return _vocabulary("word_bpe_49k.json")


def byte_tokenizer() -> str:
    return _vocabulary("byte_bpe_50k.json")


def op1_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edit_and_compare(table(spark, sf_dir, "documents"))


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), SHARDS, scratch_path(spark, "slot-map"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"),
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    found, name = pieces.digests(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return found.select("doc_id", f"{name}.*")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    found, name = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), f"{name}.lang_pred", f"{name}.score")


def op6_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Likeness(words=3, percent=85, trees=24))


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, name = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), keep=["doc_id", "source"])
    return found.select("doc_id", "source", f"{name}.*").withColumn("host_rate", F.round("host_rate", 8))


def op8_boosted_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = extraction.extract(pages, extraction.fit(pages))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, name = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), replace=False)
    return found.select("doc_id", f"{name}.*")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row of `conversations` is one event that brings a whole message."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(
        "SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    events = rows.unionByName(extra).withColumn("seq", F.row_number().over(in_order))
    log = events.select("conv_id", "seq", F.col("seq").alias("message"), F.lit("delta").alias("kind"), "role", "text")
    return chat.summarize(chat.render(chat.fold(log)))


def op11_four_russians(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.repair(rows, repair.damage(rows))


def op12_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), byte_tokenizer(), model)


def op13_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-ids")
    files = tokenfiles.write(table(spark, sf_dir, "documents"), byte_tokenizer(), folder)
    return tokenfiles.read(files, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in (
        op1_hilbert_packing, op2_winnowing, op3_virtual_slots, op4_sentencepiece, op5_langid, op6_lsh_forest, op7_host_rules, op8_boosted_dom, op9_repeats, op10_chat,
        op11_four_russians, op12_pair_counts, op13_elias_fano,
    )}

