"""Exact dedup over an extendible-hash index on shared files, in DataFrame code only.

The directory maps the top bits of a text's hash to a bucket. Splitting begins
with one bucket: each that holds more than `capacity` rows is split by one more
bit, the directory doubling when that bit is new to it. A bucket is a range of
hashes, so its owner task processes a key range. Within a bucket, texts of one
hash form a chain and are told apart by their bytes.

A null text counts as empty. Texts are equal if they are identical without
blanks. Rows that repeat a doc_id with equal texts stay or go together. A null
doc_id comes last among rows of one length.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import GAP, literal_array, stored, whole_text

CAPACITY = 4096
MOST_BITS = 16


def directory(counts: dict[int, int], bits: int, capacity: int) -> tuple[int, list[int]]:
    """Global depth and the bucket of each slot, buckets numbered in hash order.

    `counts` has the rows of each prefix of `bits` bits, so its size is bounded
    by 2 ** bits. Rows of one prefix, copies above all, cannot be split further:
    they overflow the bucket, which the combining of copies before the shuffle
    makes up for.
    """
    sums = [dict(counts)]
    for _ in range(bits):
        level: dict[int, int] = {}
        for prefix, n in sums[-1].items():
            level[prefix >> 1] = level.get(prefix >> 1, 0) + n
        sums.append(level)
    sums.reverse()
    depth, buckets = 0, [(0, 0)]
    while True:
        over = {b for b in buckets if b[0] < bits and sums[b[0]].get(b[1], 0) > capacity}
        if not over:
            break
        buckets = [x for b in buckets for x in (((b[0] + 1, 2 * b[1]), (b[0] + 1, 2 * b[1] + 1)) if b in over else (b,))]
        depth = max(depth, *(b[0] for b in buckets))
    slots = [number for number, (d, _) in enumerate(buckets) for _ in range(1 << (depth - d))]
    return depth, slots


def _hashed(docs: DataFrame) -> DataFrame:
    text = whole_text()
    return (docs.select("doc_id", F.length(text).alias("n"), F.regexp_replace(text, GAP, "").alias("norm"))
            .withColumn("h", F.xxhash64("norm")))


def build_index(docs: DataFrame, capacity: int = CAPACITY, bits: int = MOST_BITS) -> DataFrame:
    """The index: a row per distinct text, with the row that stays and the size of its group.

    Copies are combined before they are shuffled, so a group of any size sends
    one row per task.
    """
    rows = _hashed(docs)
    prefix = F.shiftrightunsigned("h", 64 - bits).cast("int")
    counts = {r[0]: r[1] for r in rows.groupBy(prefix.alias("p")).count().collect()}
    depth, slots = directory(counts, bits, capacity)
    slot = F.shiftrightunsigned("h", 64 - depth).cast("int") if depth else F.lit(0)
    rows = rows.withColumn("bucket", F.element_at(literal_array(slots), slot + 1))
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    texts = (rows.groupBy("bucket", "h", "norm").agg(best.alias("best"), F.count("*").alias("group_size"))
             .select("bucket", "h", F.col("best.doc_id").alias("keep_id"), "group_size",
                     F.sha2("norm", 256).alias("text_sha256")))
    chain = Window.partitionBy("bucket", "h").orderBy("text_sha256")
    owned = texts.withColumn("chain", F.row_number().over(chain)).repartitionByRange("bucket", "h")
    return stored(owned.sortWithinPartitions("bucket", "h", "chain"), "hash-index")


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY, bits: int = MOST_BITS) -> DataFrame:
    """One row per document: which row stays, and whether this one does."""
    index = build_index(docs, capacity, bits)
    rows = _hashed(docs).select("doc_id", "h", F.sha2("norm", 256).alias("text_sha256"))
    found = rows.join(index.select("h", "text_sha256", "keep_id", "group_size"), ["h", "text_sha256"])
    return found.select("doc_id", "keep_id", "group_size",
                        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


ORACLE = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
     r AS (SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
                  first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r
"""
