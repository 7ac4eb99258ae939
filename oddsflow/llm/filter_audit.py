"""Audit of how text filters interact, over every order in which they can be applied.

Each document is judged once by every filter; what it fails is one mask of bits.  Documents
are counted in cells (part, mask), at most 2^n a part, in one pass over the texts and
aggregations of digests; that table is written, and all orders are worked out from it.

The orders come from a recursive query: a level extends each prefix of letters by every
letter not in it, carries the applied bits along and joins the mask cells to each new
prefix, which gives that step's outcome for every mask.  The walk holds prefixes x masks
rows (325 x 32 at most for five filters), whatever the data; counts by part join afterwards.

The duplicate filter compares whole texts with those of smaller ids in all of the table,
whatever other filters remove.  Copies are found by SHA-256 of the text: rows are combined
where they are read, so that a text with very many copies reaches its group as a few rows.

Null text is empty.  A null lang is the part ''.  Rows that share an id are documents of
their own: a copy under the same id is no copy of a smaller one.  A null id is neither
smaller nor larger than another, so its row never fails the duplicate filter and makes no
other fail it; it has no labels.  Several labels of one id count as set if any is.  Very
long texts are read whole; other columns, whatever their names, are not read.  An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddsflow.llm.staging import Stage

SEPARATORS = r"[\x20\x09-\x0D]+"
LETTERS = "ABCDE"
COPIES = "E"  # the filter that compares documents; the others look at one text each


def text_filters(text: Column) -> dict[str, Column]:
    """Letter -> whether a (not null) text fails the filter."""
    words = F.array_remove(F.split(text, SEPARATORS), "")
    n = F.size(words)
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 200,
        "B": F.size(F.array_distinct(words)) * 100 < n * 50,
        "C": upper.cast("long") * 100 > F.length(text).cast("long") * 3,
        "D": text.rlike("[#$%&*|]"),
    }


def _bits(fails: dict[str, Column], letters: str) -> Column:
    terms = [F.when(fails[c], 1 << letters.index(c)).otherwise(0) for c in fails]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def mask_cells(docs: DataFrame, labels: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters they fail."""
    read = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    judged = read.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), _bits(text_filters(F.col("text")), letters).alias("own"))
    rows = judged.groupBy("doc_id", "part", "digest", "own").agg(F.count(F.lit(1)).alias("n"))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    marked = rows.where("doc_id is not null").join(known, "doc_id", "left").select(*rows.columns, *flags)
    marked = marked.unionByName(rows.where("doc_id is null").select("*", F.lit(False).alias("good"), F.lit(False).alias("toxic")))
    # per text: the rows of its smallest id are no copies; all others (null ids apart) are
    cell = ["part", "own", "good", "toxic"]
    groups = marked.groupBy("digest", *cell).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("loose"),
        F.max_by("n", -F.col("doc_id")).alias("n_first"))
    each = groups.withColumn("smallest", F.min("first").over(Window.partitionBy("digest")))  # a row a part and label: few
    clear = F.col("loose") + F.when(F.col("first") == F.col("smallest"), F.col("n_first")).otherwise(0)
    bit = 1 << letters.index(COPIES)
    split = each.select(*cell, F.explode(F.array(F.struct(F.lit(0).alias("copy"), clear.alias("n")), F.struct(F.lit(bit).alias("copy"), (F.col("n") - clear).alias("n")))).alias("s"))
    counted = split.where("s.n > 0").groupBy("part", (F.col("own") + F.col("s.copy")).alias("mask")).agg(
        F.sum("s.n").alias("n"), *[F.sum(F.when(F.col(c), F.col("s.n")).otherwise(0)).alias(c) for c in ("good", "toxic")])
    return counted


WALK = """
WITH RECURSIVE masks AS (SELECT DISTINCT mask FROM {cells}),
walk (prefix, applied, bit, mask, step) AS (
  SELECT '', 0, 0, mask, 0 FROM masks
  UNION ALL
  SELECT concat(w.prefix, substr('{letters}', w.pos, 1)), w.applied | shiftleft(1, w.pos - 1), shiftleft(1, w.pos - 1), m.mask, w.step + 1
  FROM (SELECT *, explode(sequence(1, {size})) AS pos FROM walk) w JOIN masks m ON m.mask = w.mask
  WHERE w.applied & shiftleft(1, w.pos - 1) = 0)
SELECT prefix, step, mask,
       (mask & applied) = 0 AS kept,
       (mask & bit) <> 0 AND (mask & (applied - bit)) = 0 AS removed,
       (mask & bit) <> 0 AND (mask & (applied - bit)) <> 0 AS redundant,
       mask = bit AS alone
FROM walk WHERE step > 0
"""


def enumerate_steps(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(prefix, step, mask, kept, removed, redundant, alone): the outcome of the last filter
    of every prefix of every order, for each mask that some document has."""
    spark = cells.sparkSession
    return spark.sql(WALK.format(letters=letters, size=len(letters), cells="{cells}"), cells=cells)


def audit(docs: DataFrame, labels: DataFrame, letters: str = LETTERS) -> DataFrame:
    """A row a (part, order, step): what the step's filter keeps, removes, finds already removed,
    removes alone, what it costs in labelled documents, and its removals over all orders."""
    stage = Stage(docs.sparkSession, "audit")
    cells = stage(mask_cells(docs, labels, letters))
    steps = stage(enumerate_steps(cells, letters))
    count = lambda n, flag: F.sum(F.when(F.col(flag), F.col(n)).otherwise(0)).cast("long")
    met = cells.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "step").agg(
        count("n", "kept").alias("kept"), count("n", "removed").alias("removed"), count("n", "redundant").alias("redundant"),
        count("n", "alone").alias("unique_fails"), count("good", "removed").alias("good_lost"), count("toxic", "removed").alias("toxic_lost"))
    met = stage(met.withColumn("letter", F.substring("prefix", -1, 1)))
    size = len(letters)
    orders_with = F.factorial(F.lit(size) - F.col("step"))  # orders that begin with a prefix
    shapley = met.groupBy("part", "letter").agg(F.sum(F.col("removed") * orders_with).alias("shapley"))
    orders = steps.where(F.col("step") == size).select(F.col("prefix").alias("filter_order")).distinct()
    places = orders.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("step"))
    places = places.withColumn("prefix", F.expr("substr(filter_order, 1, step)"))
    out = met.join(F.broadcast(places), ["prefix", "step"]).join(shapley, ["part", "letter"])
    return out.select("part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
                      F.col("shapley").cast("long").alias("shapley"))


def oracle_sql(letters: Sequence[str] = LETTERS) -> str:
    """The audit over documents and labels in DuckDB: every order spelled out by joins of letters."""
    picks = ", ".join(f"f{k}" for k in range(1, len(letters) + 1))
    joins = "letters l1" + "".join(f" JOIN letters l{k} ON l{k}.letter NOT IN ({', '.join(f'l{j}.letter' for j in range(1, k))})" for k in range(2, len(letters) + 1))
    chosen = ", ".join(f"l{k}.letter AS f{k}" for k in range(1, len(letters) + 1))
    before = " + ".join(f"CASE WHEN step > {k} THEN (1 << (position(f{k} IN '{letters}') - 1)) ELSE 0 END" for k in range(1, len(letters) + 1))
    return rf"""
WITH base AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS smallest FROM base),
judged AS (
  SELECT doc_id, part,
    (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN smallest < doc_id THEN 16 ELSE 0 END) AS mask
  FROM split),
flags AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM judged LEFT JOIN flags USING (doc_id) GROUP BY part, mask),
letters AS (SELECT unnest([{', '.join(f"'{c}'" for c in letters)}]) AS letter),
orders AS (SELECT {chosen} FROM {joins}),
steps AS (
  SELECT *, concat({picks}) AS filter_order, substr(concat({picks}), step, 1) AS letter
  FROM orders, (SELECT unnest(generate_series(1, {len(letters)})) AS step)),
placed AS (
  SELECT filter_order, step, letter, 1 << (position(letter IN '{letters}') - 1) AS bit, {before} AS done FROM steps),
met AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER ((mask & (done | bit)) = 0), 0) AS kept,
    coalesce(sum(n) FILTER ((mask & bit) <> 0 AND (mask & done) = 0), 0) AS removed,
    coalesce(sum(n) FILTER ((mask & bit) <> 0 AND (mask & done) <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER ((mask & bit) <> 0 AND (mask & done) = 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER ((mask & bit) <> 0 AND (mask & done) = 0), 0) AS toxic_lost
  FROM placed, cells GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM met
"""
