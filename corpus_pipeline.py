"""A corpus pipeline: five stages from raw documents to packed sequences.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all its
predecessor kept. All but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.llm import decontaminate, line_dedup, near_duplicates, packing, quality
from playtrail.llm.stages import keep_table, reach_workers


#: Characters of a line for each edit that makes a near copy of it; two edits at most.
CHARACTERS_PER_EDIT = 16


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """Documents with a number for each row, as ids may be missing or shared.

    Numbers come from the scan, so ``docs`` has to be a table that reads the same way twice,
    as the written tables between stages are.
    """
    name = "row_of_stage"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, F.monotonically_increasing_id()), name


def _without(docs: DataFrame, name: str, gone: DataFrame) -> DataFrame:
    """Numbered documents but for those whose number is in ``gone`` (one column).

    Both follow the corpus in number, so they meet by a shuffle at every size.
    """
    gone = gone.toDF("gone_row").hint("merge")
    return docs.join(gone, docs[name] == gone["gone_row"], "left_anti").drop(name)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality model accepts."""
    reach_workers(spark)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = "score_of_quality"
    scored = quality.with_score(docs, model, score)
    return scored.filter(F.col(score) >= quality.THRESHOLD).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; of each class of near-equal lines the first one stays.

    Exact copies of lines go at every length. How many edits make a near copy grows with
    the line, so that short lines which only look alike stay.
    """
    reach_workers(spark)
    out = line_dedup.without_repeated_lines(
        docs,
        least=line_dedup.EVERY_LINE,
        in_characters=True,
        symbols_per_edit=CHARACTERS_PER_EDIT,
    )
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near duplicates the document with the smallest id, one row of it.

    Documents without an id come last among those of their class.
    """
    reach_workers(spark)
    numbered, name = _numbered(docs)
    found = near_duplicates.classes(numbered, id_col=name)
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", F.col(name).alias("row"))
    members = found.join(numbered.select(name, rank.alias("rank")), F.col("id") == F.col(name))
    members = keep_table(members.select("id", "class_id", "rank"), "members")
    kept = members.groupBy("class_id").agg(F.min("rank").alias("first"))
    gone = members.join(kept, "class_id").filter(F.col("rank") != F.col("first")).select("id")
    return _without(numbered, name, gone)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage to speak of."""
    reach_workers(spark)
    numbered, name = _numbered(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(numbered, items, id_col=name)
    return _without(numbered, name, found.filter(decontaminate.contaminated()).select("id"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 2048."""
    import public_tokenizers

    reach_workers(spark)
    return packing.pack_documents(docs, public_tokenizers.path(packing.TOKENIZER))


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Similarity, boosting and best-fit packing have no SQL; a test holds the stages against plain
#: versions of them on planted documents.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = keep_table(stage(spark, docs, sf_dir.rstrip("/")), f"stage-{name}")
    return docs
