"""From raw documents to packed sequences: rules, classifier, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terralot.llm.common import staged, table
from terralot.llm.jaccard_join import jaccard_join
from terralot.llm.packing import pack
from terralot.llm.quality_crf import fit_quality, score_quality
from terralot.llm.quality_rules import quality_rules


def carried(judged: DataFrame, columns: list[str]) -> DataFrame:
    return judged.select(*[F.col("_" + c).alias(c) for c in columns])


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, their hosts' too.

    Null and empty texts have no words and go. A null source is no host. Null and repeated ids and repeated
    rows are judged row by row, long texts whole. No rows give none; further columns, whatever their names,
    are kept.
    """
    return carried(quality_rules(docs, carry=docs.columns).filter("kept"), docs.columns)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field over their lines calls good; it is fitted to labelled ones among them.

    Null texts count as empty, an empty text as one line without words. Null and repeated ids and repeated
    rows are judged row by row, long texts whole; rows of equal text have equal scores. Without labels every
    score is a half, so nothing is kept. No rows give none; further columns, whatever their names, are kept.
    """
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return carried(score_quality(docs, model, carry=docs.columns).filter("predicted = 1"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5-word shingles, 80 %): that of the least id, of
    several texts of that id the one of the least hash.

    Groups go by links between texts, so texts of one id that are not alike both stay. Of rows equal in id
    and text one stays. Rows without id, and texts without words, belong to no group and stay. Texts of any
    length are compared whole. No rows give none; further columns, whatever their names, are kept.
    """
    groups = staged(jaccard_join(docs).select("doc_id", "text_hash", "group_id").filter("doc_id IS NOT NULL"), "groups")
    row = F.struct("doc_id", "text_hash")
    least = groups.filter("group_id IS NOT NULL").groupBy("group_id").agg(F.min(row).alias("kept"), F.max(row).alias("last")).filter("kept <> last").select("group_id", "kept")
    least = staged(least, "first-of-groups")  # of known size, and a join whose large groups Spark can split
    dropped = groups.join(least, "group_id").filter(row != F.col("kept")).select("doc_id", "text_hash").distinct()
    again = groups.groupBy("doc_id", "text_hash").count().filter("count > 1").select("doc_id", "text_hash")
    mark = lambda df, what: staged(df, what).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    dropped, again = mark(dropped, "near-duplicates"), mark(again, "repeated-rows")
    own = lambda other: (docs["doc_id"].cast("long") == other["_id"]) & (F.xxhash64(docs["text"]) == other["_hash"])
    kept = docs.join(dropped, own(dropped), "left_anti")
    if again.isEmpty():
        return kept
    return kept.join(again, own(again), "left_anti").unionByName(kept.join(again, own(again), "left_semi").dropDuplicates(["doc_id", "text"]))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, in windows of the mixture of their sources.

    Null and empty texts have their end id only. A null source is a queue of its own. Null and repeated ids
    and repeated rows are packed row by row, long texts cut where windows end. No rows give no pieces;
    further columns are ignored.
    """
    return pack(docs)


STAGES = [("quality_rules", rules), ("quality_classifier", classifier), ("near_duplicates", near_duplicates), ("packing", packing)]
#: The classifier's stage has no SQL; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
