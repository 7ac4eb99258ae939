"""A training corpus from the table documents: five stages, each on all that the one before kept.

language ID drops documents in no learned language; of each group of near-copies one stays;
passages that an earlier document has are cut; secrets are masked; the rest is packed into
sequences of tokens.  Every stage but the last returns the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddsflow.llm import fm_dedup, langid, packing, partenum, secrets
from oddsflow.llm.queries import documents
from oddsflow.llm.staging import Stage
from oddsflow.session import reach_workers


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, `lang` set to it; rejected ones go, among them null and
    empty texts and those without a letter.  Texts are read whole; rows are judged one by one,
    so repeated rows and ids stay as they are; an empty table stays empty."""
    reach_workers(spark)
    judged = langid.predict(docs, langid.fit(docs)).where("not rejected")
    found = {"text": F.col("text"), "lang": F.col("lang_pred")}
    return judged.select(*(found.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each component of near-copies (five words, 0.8).

    Rows are compared, not ids: where ids repeat or are null, each row gets a number of its own,
    so that no row goes because another text has its id, and copies without an id go as well.
    Of equal ids in a component one row stays, and a null id stays only if there is no other.
    Null, empty and wordless texts have no shingles: they are like no other and stay.  Very long
    texts are compared whole; an empty table stays empty; columns of any name are kept."""
    join = lambda rows, key: partenum.jaccard_components(rows, n=5, num=80, den=100, cover=3.0, id_col=key)
    if docs.where("doc_id is null").isEmpty() and docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        kept = join(docs, "doc_id").where("doc_id = component_id").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    node = next(c for c in (f"node{k}" for k in range(len(docs.columns) + 1)) if c not in docs.columns)
    stage = Stage(spark, "nodes")
    rows = stage(docs.withColumn(node, F.monotonically_increasing_id()))
    found = join(rows, node).select(F.col("doc_id").alias(node), "component_id")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", node)).alias("best")
    kept = rows.select("doc_id", node).join(found, node).groupBy("component_id").agg(best).select(F.col(f"best.{node}").alias(node))
    return rows.join(kept, node, "left_semi").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 13-word windows that a document with a smaller id has.  Null
    and empty texts stay; rows that share an id cut nothing from each other; a row with a null
    id neither cuts nor is cut; long texts are read whole; an empty table stays empty."""
    return _counted(fm_dedup.remove_repeats(docs, window=13))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret masked; null and empty texts stay as they are, every row is
    scanned whole and for itself, and an empty table stays empty."""
    return _counted(secrets.redact(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their ids, packed into sequences of 4096 tokens at most
    (packing.sequences joins the ids of a sequence).  A null text is empty and has its end token;
    rows that repeat, share an id or have none are packed each for itself; an empty table gives
    no pieces."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), limit=4096, control=True)
    return packing.pack(pieces, tokens=4096, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None  # no stage of models, components or tokenizers is expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written as Parquet and read again, and
    emptied once the next stage's rows are written."""
    stage, docs = Stage(spark, "corpus"), documents(spark, sf_dir)
    for k, (_, step) in enumerate(STAGES[:-1]):
        before, docs = docs, stage(step(spark, docs, sf_dir))
        if k:
            stage.release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
