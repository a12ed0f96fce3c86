"""From raw documents to encoded training rows, in stages that call the operators of lakemill.llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import exact_dedup, language_id, mixing, near_dedup, pieces
from lakemill.llm.common import cut, table, text_or_empty
from lakemill.llm.queries import piece_model


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in whose text a language is recognised; those that are `und` go: null and empty texts, and texts
    without a letter. Every row is judged by its text alone, so null or repeated ids and repeated rows do not matter."""
    network = language_id.fit(docs)
    found = docs.withColumn("__language", language_id.predicted(network, docs))
    return found.where("__language.lang_pred <> 'und'").select(*docs.columns)


def keep_one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id; null texts count as empty, a null id is the smallest. Rows that
    agree in id and text carry one decision, as nothing tells them apart. Long texts move once, for the join."""
    # An id alone does not name a row: null and repeated ids stand for several texts, each with its own decision.
    kept = exact_dedup.exact_groups(docs).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__kept")).distinct()
    same = docs.doc_id.eqNullSafe(F.col("__id")) & (F.sha2(text_or_empty(docs.text), 256) == F.col("__kept"))
    return docs.join(kept, same, "left_semi")


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, similarity 0.8 or more) the document with the smallest id. Documents without
    words and rows with a null id are kept; rows that repeat an id are one document and share its decision."""
    kept = near_dedup.near_groups(docs).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(kept, docs.doc_id.eqNullSafe(F.col("__id")), "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, which is not at all, once or twice.

    Rows with null or repeated ids are documents of their own and are joined to their decision by all that tells them
    apart; documents without words are never taken; a null source is a source; an empty table stays empty.
    """
    copies = mixing.mix(docs, keyed=True).where("copies > 0").select(*mixing.KEY, F.col("copies").alias("__copies"))
    rows = mixing.numbered(docs, prefix="__")
    taken = rows.join(copies, mixing.same_row(rows, copies, prefix="__")).select(*[rows[c] for c in docs.columns], "__copies")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids; a null text has null ids, an empty one none. All rows and columns stay."""
    return pieces.encode(docs, piece_model(spark)).withColumn("n_ids", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_languages),
    ("exact_dedup", keep_one_of_equal),
    ("near_dedup", keep_one_of_near),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: SQL expresses neither the byte network nor the balanced sample; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what one keeps is written to the shared checkpoint folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
