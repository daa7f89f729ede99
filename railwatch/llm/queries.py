"""The operators as named queries over whole tables, with the parameters of production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def vocabulary() -> str:
    """The byte-level BPE file; the package that holds it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_wrapper_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from railwatch.llm.html import extract

    found = extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from railwatch.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op3_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from railwatch.llm.topk import top_k

    whole = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = table(spark, sf_dir, "embeddings").where(finite).select("vec_id", whole.alias("embedding"))
    found = top_k(rows, rows.where(F.col("vec_id") % 50 == 0), 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from railwatch.llm.tokens import token_counts

    counted = token_counts(table(spark, sf_dir, "documents"), vocabulary())
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op5_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from railwatch.llm.sharding import shard

    return shard(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from railwatch.llm.quality import held_out, scores, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return scores(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op7_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from railwatch.llm.urls import judge

    return judge(table(spark, sf_dir, "pages"))


def op8_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from railwatch.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary()).withColumnRenamed("check", "ids_crc32")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from railwatch.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
    )


def op10_pstable_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from railwatch.llm.vectors import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


def op11_branching_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from railwatch.llm.runs import periodic_runs, with_periods

    found = periodic_runs(with_periods(table(spark, sf_dir, "documents").select("doc_id", "text")), least_length=6, times=4)
    best = F.reduce(
        "runs", F.get("runs", F.lit(0)),
        lambda a, r: F.when(r.length * a.period > a.length * r.period, r).otherwise(a),
    )
    rows = F.array_join(F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n"))), "")
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(rows.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_cuckoo_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from railwatch.llm.lines import LineState, without_frequent_lines

    docs = table(spark, sf_dir, "documents")
    kept = without_frequent_lines(LineState(least_documents=10, least_points=1).insert(docs), docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from railwatch.llm.repair import damaged, repair_summary

    return repair_summary(damaged(table(spark, sf_dir, "conversations")), F.col("present"))


QUERIES = {
    f.__name__: f for f in (
        op1_wrapper_main_text, op2_minmax_near_dedup, op3_ball_tree_top_k, op4_token_counts, op5_feistel_shards, op6_line_crf_quality, op7_path_templates,
        op8_pack_sequences, op9_mix_sources,
        op10_pstable_near_dedup, op11_branching_runs, op12_cuckoo_line_dedup, op13_conversation_repair,
    )
}
