"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.llm import (
    chat,
    decontaminate,
    line_dedup,
    near_duplicates,
    packing,
    quality,
    spelling,
    stages,
    suffix_tree_lm,
    suffixes,
    toxicity,
    turn_repair,
    two_fit,
    vectors,
)

Query = Callable[[SparkSession, str], DataFrame]


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        _documents(spark, sf_dir),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
    )
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        decontaminate.words_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
        F.size(F.array_except("near", "items")).cast("long").alias("n_near_only"),
    )


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _held_out(folds: int):
    return (quality.fold(F.col("doc_id"), folds) == 0).alias("held_out")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.graded(docs, model).select(
        "doc_id",
        _held_out(toxicity.FOLDS),
        "severity",
        "grade",
        "toxic_chance",
        (F.col("toxic_chance") >= toxicity.THRESHOLD).cast("int").alias("toxic"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return line_dedup.line_classes(docs, least=line_dedup.EVERY_LINE, in_characters=True).select(
        F.col("place.id").alias("doc_id"),
        F.col("place.line_no").alias("line_no"),
        "n_bytes",
        "n_copies",
        "n_links",
        F.col("class_place.id").alias("class_doc_id"),
        F.col("class_place.line_no").alias("class_line_no"),
    )


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(_documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"),
        "class_id",
        (F.col("id") == F.col("class_id")).alias("kept"),
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    def covered(spans: str) -> Column:
        return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])

    return suffixes.repeated_bytes(_documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        covered("spans").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        (F.size("spans") > 0).alias("has_repeats"),
        covered("passages").alias("n_passage_bytes"),
        (F.size("passages") > 0).alias("has_passages"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs, model).select(
        "doc_id",
        _held_out(quality.FOLDS),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.scored(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.linked_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        "component_id",
        (F.col("id") == F.col("component_id")).alias("kept"),
        "audited_recall",
    )


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns = turns.select("conv_id", "turn", "role", "text")
    tricky = F.lit("\\### Assistant: </turn> ok")
    roles = F.array(F.lit("user"), F.lit("assistant"))
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        roles[F.col("id").cast("int")].alias("role"),
        tricky.alias("text"),
    )
    text, turn = F.col("formatted"), F.col("turns")
    lines = F.transform(turn, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        chat.formatted(turns.unionByName(planted))
        .withColumn("turns", chat.read_turns(text))
        .withColumn("learned", chat.masked_text(text, F.col("loss_mask")))
        .select(
            F.col("id").alias("conv_id"),
            F.size(turn).cast("long").alias("n_turns"),
            F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
            F.length("learned").cast("long").alias("loss_chars"),
            F.sha2("learned", 256).alias("loss_sha256"),
            F.length(text).cast("long").alias("formatted_chars"),
        )
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _documents(spark, sf_dir)
    return packing.pack_documents(docs, public_tokenizers.path(packing.TOKENIZER))


def damaged_turns(turns: DataFrame) -> DataFrame:
    """Turns with one of five faults each, or none, by the checksum of their number."""

    def told(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat_ws(":", told("conv_id"), told("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(told("text"), "[.!?]", ""))
    return turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(told("role")).alias("role"),
        text.otherwise(told("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"),
    )


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = damaged_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return turn_repair.repaired(damaged, copies=F.col("times")).select(
        F.col("id").alias("conv_id"),
        "gaps",
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        "cost",
        "audit",
        F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"),
    )


def op12_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _documents(spark, sf_dir)
    return two_fit.pack_documents(docs, public_tokenizers.path(two_fit.TOKENIZER))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_documents(spark, sf_dir)).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )


_QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": op2_line_dedup,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality": op5_quality,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_vectors": op7_vectors,
    "op8_chat_formatting": op8_chat_formatting,
    "op10_packing": op10_packing,
    "op9_decontamination": op9_decontamination,
    "op11_turn_repair": op11_turn_repair,
    "op12_two_fit": op12_two_fit,
    "op13_spelling": op13_spelling,
}

#: What SQL can express: the digests of the turns and of the learned text, and the length that
#: the template gives. Marks of a block take 12 characters besides the role, a join takes 3.
_CHAT_SQL = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL
    SELECT -7, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok'
    FROM range(2) AS r(n)
),
e AS (
    SELECT *, length(replace(replace(replace(text, '\', '\b'), '<', '\l'), '|', '\p')) AS n_text,
           length(replace(replace(replace(role, '\', '\b'), '<', '\l'), '|', '\p')) AS n_role,
           lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
               IS DISTINCT FROM role AS opens
    FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
                         ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (sum(n_text) + sum(CASE WHEN opens THEN 12 + n_role ELSE 3 END))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

ORACLE_SQL: dict[str, str] = {"op8_chat_formatting": _CHAT_SQL}


def _on_workers(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stages.reach_workers(spark)
        return query(spark, sf_dir.rstrip("/"))

    return run


QUERIES: dict[str, Query] = {name: _on_workers(query) for name, query in _QUERIES.items()}
