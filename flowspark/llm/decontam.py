"""Benchmark decontamination: which documents hold a test item.

A test item is in a document if at least ``THRESHOLD`` of the item's distinct
five-word shingles stand in it.  Items are short and documents long, so the
search is by containment.  Items are partitioned by size (powers of two of
their shingle count).  In each partition an item keeps as MinHash sketch its
smallest shingle hashes, as many as the partition's largest item may lack and
one more: a document that holds the item shares at least one of them, so none
is missed.  Documents look up their shingles in the sketches; every pair
found is verified by counting the shingles it really shares.

Words are runs of letters and digits in lower case.  A text of fewer than
five words has one shingle, all of its words; a text without words has none
and matches nothing.  Null texts count as empty; items or documents with a
null id are left out of the pairs.  Rows that repeat an id count as one text
with the shingles of all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm.common import small_side, staged, table, text_or_empty

WORDS = 5
THRESHOLD = 0.8
# sketch rows that may be broadcast (16 bytes each); more are joined by shuffle
BROADCAST_ROWS = 1_000_000


def words(text: str) -> Column:
    return F.filter(F.split(F.lower(text_or_empty(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(w: Column, n: int = WORDS) -> Column:
    """Distinct hashes of all runs of ``n`` words."""
    runs = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1),
                       lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(n)]))
    return (F.when(F.size(w) >= n, F.array_distinct(runs))
            .when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " "))))
            .otherwise(F.array().cast("array<bigint>")))


def _shingles(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, h): every distinct shingle hash of every row."""
    return (rows.where(F.col(key).isNotNull())
            .select(F.col(key).alias("_key"), words(text).alias("_w"))
            .select("_key", F.explode(shingle_hashes(F.col("_w"))).alias("h")))


def item_sketches(items: DataFrame, threshold: float) -> DataFrame:
    """(item_id, size, h, sketched) of every item shingle."""
    by_hash = F.array_sort(F.collect_set("h"))
    sized = (items.groupBy("_key").agg(by_hash.alias("hs"))
             .withColumn("size", F.size("hs"))
             .withColumn("largest", (2 * F.pow(F.lit(2.0), F.floor(F.log2("size"))) - 1).cast("int"))
             # an item may lack size - ceil(threshold * size) shingles
             .withColumn("k", F.col("largest") - F.ceil(F.lit(threshold) * F.col("largest") - 1e-9).cast("int") + 1))
    return (sized.select(F.col("_key").alias("item_id"), "size", "k", F.posexplode("hs").alias("place", "h"))
            .select("item_id", "size", "h", (F.col("place") < F.col("k")).alias("sketched")))


def _looked_up(shingles: DataFrame, index: DataFrame, n_index: int) -> DataFrame:
    return shingles.join(F.broadcast(index) if n_index <= BROADCAST_ROWS else index, "h")


def contained_items(spark: SparkSession, docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                    doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of every document
    that holds at least ``threshold`` of an item's shingles."""
    index = staged(spark, item_sketches(_shingles(items, item_id, text), threshold), "bench-index")
    n_index = index.count()
    sketch = index.where("sketched").select("h", "item_id", "size")
    candidates = staged(spark, _looked_up(_shingles(docs, doc_id, text), sketch, n_index)
                        .select("_key", "item_id").distinct(), "bench-pairs")
    # verification: only candidate documents are read again
    ids = staged(spark, candidates.select(F.col("_key").alias("_id")).distinct(), "bench-docs")
    near = docs.join(small_side(ids), docs[doc_id] == ids["_id"], "left_semi")
    shared = (_looked_up(_shingles(near, doc_id, text), index.select("h", "item_id", "size"), n_index)
              .groupBy("_key", "item_id", "size").agg(F.count_distinct("h").alias("n_shared")))
    return (shared.join(candidates, ["_key", "item_id"], "left_semi")
            .where(F.col("n_shared") >= F.ceil(F.lit(threshold) * F.col("size") - 1e-9))
            .select(F.col("_key").alias("doc_id"), "item_id", F.col("n_shared").cast("long"),
                    F.col("size").cast("long").alias("n_item"),
                    (F.col("n_shared") / F.col("size")).alias("containment")))


def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that hold no item, with their columns."""
    bad = staged(spark, contained_items(spark, docs, items).select(F.col("doc_id").alias("_bad")).distinct(), "leaking")
    return docs.join(small_side(bad), docs["doc_id"] == bad["_bad"], "left_anti")


LEAKS_SQL = r"""
WITH w AS (
  SELECT 0 AS side, doc_id AS id, [x FOR x IN string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') IF x <> ''] AS ws FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT 1, item_id, [x FOR x IN string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') IF x <> ''] FROM benchmark WHERE item_id IS NOT NULL
), s AS (
  SELECT DISTINCT side, id, unnest(CASE WHEN len(ws) >= 5
    THEN [array_to_string(list_slice(ws, i, i + 4), ' ') FOR i IN range(1, len(ws) - 3)]
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w
), items AS (SELECT id, sh, count(*) OVER (PARTITION BY id) AS n FROM s WHERE side = 1)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, max(i.n) AS n_item,
       count(*)::DOUBLE / max(i.n) AS containment
FROM s d JOIN items i USING (sh) WHERE d.side = 0
GROUP BY 1, 2 HAVING count(*) >= ceil(0.8 * max(i.n) - 1e-9)
"""
