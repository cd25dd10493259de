"""The queries opN_<name> over the synthetic tables, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, circulant, exact_dedup, mixing, near_duplicates, neighbours, packing, passages, runs, sharding, tokens, toxicity, whitening

LIMIT = 2048


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary(), LIMIT)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


def op4_weighted_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.schedule(table(spark, sf_dir, "documents"), weights=(5, 2, 1))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "finish")


def op5_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), 8)
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], rows.schema)
    return chat.digests(chat.format_conversations(rows.unionByName(extra)))


def _escaped_length(column: str) -> str:
    """DuckDB SQL for the length of an escaped string: a character more for each backslash and each control string."""
    found = [f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in ("\\", *chat.CONTROL)]
    return f"length({column}) + {' + '.join(found)}"


OP6_SQL = f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = '{chat.LOSS_ROLE}' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = '{chat.LOSS_ROLE}'), '')) AS loss_sha256,
       CAST(sum({len(chat.TURN + chat.TEXT + chat.END)} + {_escaped_length("role")} + {_escaped_length("text")}) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    scored = toxicity.score(docs, toxicity.fit(docs, labels, ~held)).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = passages.repeats(table(spark, sf_dir, "documents"))
    return spans.select(F.col("id").alias("doc_id"), F.col("start").alias("start_word"), F.col("end").alias("end_word"), "removed", F.col("cluster").alias("cluster_id"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return verdict.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


OP9_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), vocabulary(), limit=LIMIT).withColumnRenamed("id", "doc_id")


def looped(text: Column, doc_id: Column) -> Column:
    """The words of every tenth document, by the hash of its id, with a tail that repeats itself; other texts as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g, n = F.floor(h / 10), F.size(words)
    start = g % F.greatest(n, F.lit(1))
    period = 1 + F.floor((n - start) / (3 + g % 8))
    tail = F.flatten(F.array_repeat(F.slice(words, (start + 1).cast("int"), period.cast("int")), (1 + F.floor((n - start) / period)).cast("int")))
    loop = F.slice(F.concat(F.slice(words, F.lit(1), start.cast("int")), tail), F.lit(1), F.greatest(n, F.lit(1)))
    return F.when((h % 10 == 0) & (F.coalesce(text, F.lit("")) != ""), F.array_join(loop, " ")).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.periodic_runs(docs.withColumn("text", looped(F.col("text"), F.col("doc_id"))))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.select("id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    longest = (F.negate("best.start").alias("start"), F.col("best.length").alias("length"), F.negate("best.period").alias("period"))
    found = found.select(F.col("id").alias("doc_id"), "n_runs", *longest, "runs_sha256", "collapsed_sha256")
    milli = F.expr("1000 * length div period").alias("exponent_milli")
    return found.select("doc_id", "n_runs", "start", "length", "period", milli, "runs_sha256", "collapsed_sha256")


def op12_circulant_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = circulant.circulant_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.transform(vectors, whitening.fit(vectors)).withColumnRenamed("id", "vec_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op6_chat_formatting": OP6_SQL, "op9_exact_dedup": OP9_SQL}
