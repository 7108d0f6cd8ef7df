"""One query for each operator, over the whole of its table, and the corpus pipeline's query.

The queries are thin: they call the operator and derive the columns of their
contract from its output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, chat, collocations, langid, linejoin, mixing, ngram_quality, packing, prefix_trie, quality, simhash,
               token_store, warcindex)
from .common import stage, table


def op1_elias_fano_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_store.write_token_store(table(spark, sf_dir, "documents"))
    return token_store.read_token_store(spark, manifest).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), "id % 20 = 0")


def op3_line_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linejoin.judge_lines(table(spark, sf_dir, "documents")).drop("h")


def op4_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(mixing.sized(table(spark, sf_dir, "documents"), ["doc_id"]), "sizes")
    q = mixing.quotas(rows)
    if not q.shards:
        return spark.createDataFrame([], "doc_id long, size long, source_size long, target double, taken long")
    return mixing.placed(rows, q).selectExpr("doc_id", "__lw_size size", "__lw_source_size source_size",
                                             "__lw_target target", "__lw_taken taken")


def op5_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                           staged=lambda df: stage(df, "counts"))
    return judged.selectExpr("doc_id", "__lw_n_words n_words", "__lw_word_chars word_chars", "__lw_n_symbols n_symbols",
                             "__lw_n_dup_lines n_dup_lines", "__lw_n_repeat_words n_repeat_words", "base_failed", "kept")


def op6_hierarchical_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn(
        "held_out", F.expr("coalesce(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, false)"))
    model = langid.fit(docs.where("NOT held_out"))
    return langid.predict(docs, model, ["doc_id", "held_out"])


def op7_differencing_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_simhash_vp_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents")).select(
        "doc_id", F.expr("lower(lpad(hex(fp), 16, '0'))").alias("fingerprint"), "component_id")


def op9_two_level_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    index = warcindex.write_archives(pages)
    captures = warcindex.lookup(warcindex.url_keys(pages), index)
    return warcindex.read_records(captures).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def conversation_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record): a JSON record for each conversation, in a layout that suits its shape.

    user, assistant: prompt and response; system, user, assistant: the
    instruction layout; conversations that a user opens: from/value; others: messages.
    """
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(     # one conversation is one record
        "turn", F.expr("coalesce(role, '')").alias("role"), F.expr("coalesce(text, '')").alias("text")))).alias("t"))
    roles = "transform(t, x -> x.role)"
    record = f"""CASE
        WHEN {roles} = array('user', 'assistant') THEN to_json(named_struct('prompt', t[0].text, 'response', t[1].text))
        WHEN {roles} = array('system', 'user', 'assistant') THEN
          to_json(named_struct('system', t[0].text, 'instruction', t[1].text, 'output', t[2].text))
        WHEN t[0].role = 'user' AND forall(t, x -> x.role NOT IN ('human', 'gpt')) THEN to_json(named_struct('conversations',
          transform(t, x -> named_struct('from', CASE x.role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE x.role END,
                                         'value', x.text))))
        ELSE to_json(named_struct('messages', transform(t, x -> named_struct('role', x.role, 'content', x.text)))) END"""
    return turns.select("conv_id", F.expr(record).alias("record"))


def op10_schema_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
                                "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").selectExpr(
        "CAST(conv_id AS LONG) conv_id", "CAST(turn AS LONG) turn", "role", "text").unionAll(own)
    written = stage(chat.format_turns(chat.canonical_turns(conversation_records(rows)))
                    .select("conv_id", "formatted", "loss_spans"), "chat")
    back = written.withColumn("turns", chat.read_turns()).withColumn("loss", chat.read_loss())
    digest = "sha2(array_join(transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')), ''), 256)"
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.expr(digest).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.with_openings(table(spark, sf_dir, "conversations")))


def op12_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.expr("coalesce(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, false)")
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held)
    labels = table(spark, sf_dir, "labels").where(~held)
    return ngram_quality.score(docs, ngram_quality.fit(docs.where("NOT held_out"), labels), ["doc_id", "held_out"])


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_elias_fano_tokens, op2_hash_prefix_forest, op3_line_similarity_join, op4_sainte_lague_mix,
    op5_risk_controlled_quality, op6_hierarchical_language_id, op7_differencing_pack, op8_simhash_vp_dedup,
    op9_two_level_warc_index, op10_schema_chat_format, op11_prefix_trie, op12_ngram_quality,
    op13_phrase_collocations)}
