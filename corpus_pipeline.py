"""The corpus pipeline: STAGES in order, each written as Parquet and read again for the next.

Every stage works on all that its predecessor kept. All but the last return the columns of
``documents``: rejected documents are gone, repeated passages are cut from the texts. Rows with a null id are
judged by their text where a stage can, and are otherwise kept. Columns besides the id and the text are carried through each
operator as one value, so that their names may be any; an empty table gives empty stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docket.llm import decontaminate, near_dup, packing, phrases, toxicity
from docket.llm.queries import PACK_TOKENIZER, tokenizer_path
from docket.session import staged


def column(name: str) -> Column:
    """A top-level column of any name."""
    return F.col("`" + name.replace("`", "``") + "`")


def carried(docs: DataFrame) -> DataFrame:
    """The id, the text, and all other columns as one, whose names then clash with none of an operator's."""
    others = [column(c) for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", *([F.struct(*others).alias("__rest")] if others else []))


def restored(rows: DataFrame, docs: DataFrame, **new: Column) -> DataFrame:
    """The columns of ``docs`` from rows that carry them; ``new`` replaces some if they are there."""
    own = {c: F.col(c) if c in ("doc_id", "text") else F.col("__rest").getField(c) for c in docs.columns}
    own |= {c: v.cast(docs.schema[c].dataType) for c, v in new.items() if c in own}
    return rows.select(*[v.alias(c) for c, v in own.items()])


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labels of these documents, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs.select("doc_id", "text"), labels, toxicity.in_fold(F.col("doc_id"), 4, 2))
    return restored(toxicity.score(carried(docs), model).where("predicted = 0"), docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class."""
    rest = near_dup.classes(docs.select("doc_id", "text")).where("class_id <> doc_id").select("doc_id").distinct()
    return docs.join(rest, "doc_id", "left_anti").select(*map(column, docs.columns))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 13 words and more that an earlier document has."""
    kept = phrases.remove_repeats(carried(docs), tidy=False)
    if "n_chars" not in docs.columns:
        return restored(kept, docs)
    length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("__rest").getField("n_chars"))
    return restored(kept, docs, n_chars=length)


def not_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.leaks(docs.select("doc_id", "text"), benchmark).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*map(column, docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, in windows of 2048 ids."""
    return packing.pack(docs.select("doc_id", "text"), tokenizer_path(PACK_TOKENIZER), end_id=1)


STAGES = [
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each),
    ("repeated_phrases", without_repeats),
    ("decontamination", not_leaked),
    ("packing", packed),
]
# Character lattices and weighted samples have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
