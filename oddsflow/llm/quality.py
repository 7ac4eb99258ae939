r"""Quality rules: base counts of every document, and a hashed n-gram likelihood ratio.

Words are maximal runs of characters other than space and \t \n \v \f \r, unchanged.
Features are words and word pairs, hashed into a fixed number of buckets.  Two
multinomials over the buckets, one of the trusted documents and one of the whole corpus
(both counted over all documents, add-one smoothed), give each bucket a log-likelihood
ratio; a document scores the mean over its features and is kept from `threshold` on.
Counts are whole numbers and each document is summed in its own order, so verdicts do
not depend on partitioning.

Null text is empty: no words, so the base rules fail it.  Rows with null or repeated ids
are judged each by its own text; a document is trusted if any row of labels says so.
Other columns are ignored.  With no trusted document every ratio comes from smoothing
alone.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddsflow.llm.staging import Stage

BUCKETS = 1 << 16           # also the size bound of the broadcast weights
BROADCAST_IDS = 1_000_000   # trusted ids (16 MB) up to which marking documents needs no shuffle
THRESHOLD = -0.15
SEPARATORS = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def _bind(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more.

    Each window is one long: the upper bits of its hash, its place in as many lower bits
    as places need.  Sorted, windows of equal bits are neighbours; only those are compared
    word by word, so that the count is exact however long the text is."""
    count = F.size(words) - 2
    low = F.pow(F.lit(2.0), F.length(F.bin(F.size(words)))).cast("long") - 1
    codes = _bind(low, lambda m: F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(F.bitwise_not(m)).bitwiseOR(i.cast("long"))))

    def alike(codes: Column, mask: Column) -> Column:
        upper = lambda x: x.bitwiseAND(F.bitwise_not(mask))
        same = lambda x, other: F.coalesce(upper(other) == upper(x), F.lit(False))
        twice = F.filter(codes, lambda x, j: same(x, F.get(codes, j - 1)) | same(x, F.get(codes, j + 1)))
        return F.transform(twice, lambda x: x.bitwiseAND(mask).cast("int"))

    def equal(windows: Column) -> Column:
        same = lambda x, other: F.coalesce(other["w"] == x["w"], F.lit(False))
        twice = F.filter(windows, lambda x, j: same(x, F.get(windows, j - 1)) | same(x, F.get(windows, j + 1)))
        return F.sort_array(F.transform(twice, lambda x: x["p"].cast("long")))

    window = lambda p: F.struct(F.struct(F.get(words, p), F.get(words, p + 1), F.get(words, p + 2)).alias("w"), p.alias("p"))
    found = _bind(F.sort_array(codes), lambda c: _bind(low, lambda m: alike(c, m)))
    found = _bind(F.sort_array(F.transform(found, window)), equal)
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    total = F.aggregate(found, start, lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n"), (p + 3).alias("end")), lambda a: a["n"])
    return F.when(count > 1, total).otherwise(F.lit(0).cast("long"))


def base_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("words", words_of(F.col("text"))).withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    base = base.select(
        "doc_id", "words", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), _repeat_words(F.col("words")).alias("n_repeat_words"))
    return base.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))


def features(words: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the words and of the pairs of neighbours."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    two = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.pmod(F.xxhash64(F.get(words, i), F.get(words, i + 1)), F.lit(buckets)).cast("int"))
    return F.when(F.size(words) > 1, F.concat(one, two)).otherwise(one)


def ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, ratio): smoothed log ratio of the trusted (ids in column doc_id) to the raw multinomial."""
    stage = Stage(docs.sparkSession, "quality")
    ids = stage(trusted.select("doc_id").where("doc_id is not null").distinct().withColumn("trusted", F.lit(1)))
    marked = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    marked = marked.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left")
    counts = marked.select("trusted", F.explode(features(F.col("words"), buckets)).alias("bucket"))
    counts = stage(counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("target")))
    raw, target = counts.agg(F.sum("raw"), F.sum("target")).first()
    return counts.select("bucket", (F.log((F.col("target") + 1) / F.lit(float((target or 0) + buckets))) - F.log((F.col("raw") + 1) / F.lit(float((raw or 0) + buckets)))).alias("ratio"))


def judge(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept) for every row."""
    weights = ratios(docs, trusted, buckets, id_col, text_col)
    counted = base_rules(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    each = counted.select("row", *columns, F.explode_outer(features(F.col("words"), buckets)).alias("bucket"))
    each = each.join(F.broadcast(weights), "bucket", "left")  # at most `buckets` rows
    scored = each.groupBy("row", *columns).agg(F.sum("ratio").alias("total"), F.count("bucket").alias("n"))
    score = F.when(F.col("n") > 0, F.col("total") / F.col("n"))
    return scored.select(*columns, score.alias("score"), (~F.col("base_failed") & F.coalesce(score >= threshold, F.lit(False))).alias("kept"))
