"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    alignment,
    bpe,
    chat,
    embeddings,
    fingerprints,
    html,
    jaccard,
    langid,
    lines,
    packing,
    quality,
    repair,
    substrings,
)
from tallyhouse.llm.common import table, tokenizer


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = quality.held_out(F.col("doc_id"))
    weights = quality.train(docs, labels.where(~held_out), "quality")
    return quality.score(docs, weights).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, tokenizer("word_bpe_49k.json"), window=2048, end_id=1, keep=["lang"])
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "lang",
    )


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.join(docs, threshold=0.8).select("doc_id", "class_id", "n_links", "kept")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = quality.held_out(F.col("doc_id"))
    model = langid.train(docs.where(~held_out))
    return langid.predict(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


ANSWER_TOOL = {
    "type": "object",
    "required": ["prompt", "words"],
    "additionalProperties": False,
    "properties": {
        "prompt": {"type": "string", "minLength": 1, "maxLength": 2000},
        "words": {"type": "integer", "minimum": 1, "maximum": 40},
        "after": {"type": "object"},
    },
}


def tool_messages(turns: DataFrame) -> DataFrame:
    """Turns as tool traffic: a user turn calls the tool ``answer`` and waits for the result of the call
    two turns before, if that was a user turn; an assistant turn is the result of the turn before it.
    Results of odd length are logged two turns early, before their calls."""
    ids = F.concat(F.lit("t"), F.col("turn").cast("string"))
    before = turns.where("role = 'user'").select(
        F.col("conv_id"), (F.col("turn") + 2).alias("turn"), F.lit(True).alias("follows")
    )
    words = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1
    after = F.struct(
        F.concat(F.lit("t"), (F.col("turn") - 2).cast("string")).alias("$result")
    )
    arguments = F.to_json(
        F.struct(
            F.col("text").alias("prompt"),
            words.alias("words"),
            F.when(F.col("follows"), after).alias("after"),
        )
    )
    call = F.array(
        F.struct(ids.alias("id"), F.lit("answer").alias("name"), arguments.alias("arguments"))
    )
    user = F.col("role") == "user"
    early = (F.col("role") == "assistant") & (F.length("text") % 2 == 1)
    return turns.join(before.distinct(), ["conv_id", "turn"], "left").select(
        "conv_id",
        F.when(early, F.col("turn") - 2).otherwise(F.col("turn")).alias("turn"),
        "role",
        F.when(~user, F.col("text")).alias("content"),
        F.when(user, call).alias("calls"),
        F.when(
            F.col("role") == "assistant",
            F.concat(F.lit("t"), (F.col("turn") - 1).cast("string")),
        ).alias("call_id"),
    )


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = tool_messages(table(spark, sf_dir, "conversations"))
    return chat.link(messages, {"answer": ANSWER_TOOL}).select(
        "conv_id",
        "turn",
        "call_id",
        F.col("at").alias("order_turn"),
        F.col("depth").cast("long").alias("order_depth"),
        "state",
        "valid",
        F.array_join("faults", "; ").alias("faults"),
        "json",
    )


# DuckDB. Only a result that was logged before its call has to move, to the call's turn.
OP5_SQL = r"""
WITH k AS (
  SELECT DISTINCT conv_id, turn, role FROM conversations
), m AS (
  SELECT t.*, p.role AS before_role, q.turn IS NOT NULL AS follows,
         n.turn IS NOT NULL AS answered, r.turn IS NOT NULL AS has_result,
         t.role = 'assistant' AND length(t.text) % 2 = 1 AS early,
         length(t.text) - length(replace(t.text, ' ', '')) + 1 AS words
  FROM conversations t
  LEFT JOIN k p ON p.conv_id = t.conv_id AND p.turn = t.turn - 1 AND p.role = 'user'
  LEFT JOIN k q ON q.conv_id = t.conv_id AND q.turn = t.turn - 2 AND q.role = 'user'
  LEFT JOIN k n ON n.conv_id = t.conv_id AND n.turn = t.turn + 1 AND n.role = 'assistant'
  LEFT JOIN k r ON r.conv_id = t.conv_id AND r.turn = t.turn - 1 AND r.role = 'assistant'
), f AS (
  SELECT *, list_filter([
      CASE WHEN length(text) < 1 THEN '$.prompt: below minLength' END,
      CASE WHEN length(text) > 2000 THEN '$.prompt: above maxLength' END,
      CASE WHEN words > 40 THEN '$.words: above maximum' END,
      CASE WHEN follows AND NOT has_result
           THEN 'no result t' || (turn - 2) END], lambda x: x IS NOT NULL AND role = 'user') AS wrong
  FROM m
)
SELECT f.conv_id, CASE WHEN early THEN f.turn - 2 ELSE f.turn END AS turn,
       CASE WHEN role = 'assistant' THEN 't' || (f.turn - 1) END AS call_id,
       CASE WHEN early AND before_role = 'user' THEN f.turn - 1
            WHEN early THEN f.turn - 2 ELSE f.turn END AS order_turn,
       CASE WHEN early AND before_role = 'user' THEN 1 ELSE 0 END::BIGINT AS order_depth,
       CASE WHEN role = 'user' AND answered THEN 'call' WHEN role = 'user' THEN 'unanswered'
            WHEN role <> 'assistant' THEN 'plain'
            WHEN before_role = 'user' THEN 'result' ELSE 'orphan' END AS state,
       len(wrong) = 0 AS valid, array_to_string(wrong, '; ') AS faults,
       CASE WHEN role = 'user' THEN '{"calls":[{"arguments":{'
              || CASE WHEN follows THEN '"after":{"$result":"t' || (f.turn - 2) || '"},' ELSE '' END
              || '"prompt":' || to_json(text)::VARCHAR || ',"words":' || words
              || '},"id":"t' || f.turn || '","name":"answer"}],"content":null,"role":"user"}'
            ELSE '{' || CASE WHEN role = 'assistant'
                             THEN '"call_id":"t' || (f.turn - 1) || '",' ELSE '' END
              || '"content":' || to_json(text)::VARCHAR || ',"role":' || to_json(role)::VARCHAR
              || '}' END AS json
FROM f
"""


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs, window=35).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.remove_common_lines(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.with_next(fingerprints.fingerprints(table(spark, sf_dir, "documents")))
    n_chars = F.length("text").cast("long")
    edit = F.floor(n_chars / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - edit),
        F.substring("next.text", F.lit(1), edit),
    )
    rows = fingerprints.with_sketch(
        found.withColumn("edited", edited), "edited", "edited_sketch"
    )
    return rows.select(
        "doc_id",
        n_chars.alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text("sketch").alias("fingerprint"),
        fingerprints.as_text("edited_sketch").alias("edited_fingerprint"),
        fingerprints.resemblance("sketch", "edited_sketch").alias("near_edited"),
        fingerprints.resemblance("sketch", "next.sketch").alias("near_next"),
        fingerprints.distinct_shingles("sketch").alias("n_shingles"),
        fingerprints.containment("sketch", "edited_sketch").alias("contained"),
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(docs, tokenizer("byte_bpe_50k.json"))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with planted faults, and how often each stands in its place: by the checksum of conversation and
    turn modulo 20 a row is dropped, emptied, loses its ends of sentences, is repeated or becomes the user's."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(damaged(table(spark, sf_dir, "conversations")), copies="copies")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.linked(
        table(spark, sf_dir, "documents"),
        tokenizer("byte_bpe_50k.json"),
        tokenizer("piece_bpe_32k.model"),
        hashed=True,
    )
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, html.train(pages)).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


QUERIES = {
    "op1_quality": op1_quality,
    "op2_packing": op2_packing,
    "op3_jaccard": op3_jaccard,
    "op4_langid": op4_langid,
    "op5_chat": op5_chat,
    "op6_embeddings": op6_embeddings,
    "op7_substrings": op7_substrings,
    "op8_lines": op8_lines,
    "op9_fingerprints": op9_fingerprints,
    "op10_bpe": op10_bpe,
    "op11_repair": op11_repair,
    "op12_alignment": op12_alignment,
    "op13_html": op13_html,
}

ORACLE = {"op5_chat": OP5_SQL}
