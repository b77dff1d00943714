"""SimHash near-duplicates, searched with pivot distance tables.

The distances of each fingerprint to many reference fingerprints are computed
once, one byte each. Two fingerprints within `RADIUS` bits have no two of these
distances further apart than `RADIUS`, so a pair whose largest difference is
greater is discarded before it is verified.

Pairs come from blocks: of `blocks` blocks of bits, fingerprints within RADIUS
bits agree in `blocks - RADIUS` at least; each such choice of blocks is a join
key, and a pair is made under the first choice on which it agrees. More blocks
give more selective keys, for more documents. Copies share a fingerprint and
are one node, so a group of them makes no pairs.

Null texts count as empty. Texts without words have fingerprint zero. A null
doc_id is never the smallest of its component unless there is no other.
"""

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import components, stored, whole_text

SHINGLE, RADIUS, BLOCKS, PIVOTS = 3, 3, 5, 16
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str, words: int = SHINGLE) -> np.ndarray:
    from itertools import repeat

    from xxhash import xxh64_intdigest

    parts = text.encode().lower().split()  # bytes: A-Z and the six blanks only
    if len(parts) >= words:
        runs = map(b" ".join, zip(*(parts[k:] for k in range(words))))
        return np.fromiter(map(xxh64_intdigest, runs, repeat(42)), np.uint64, len(parts) - words + 1)
    return np.array([xxh64_intdigest(b" ".join(parts), 42)] if parts else [], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes. Eight bit counts share a word, 255 hashes at a time."""
    if not len(hashes):
        return 0
    cuts = np.arange(0, len(hashes), 255)
    bits = 0
    for k in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, cuts)
        counts = sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
        for byte in np.flatnonzero(2 * counts > len(hashes)):
            bits |= 1 << (8 * int(byte) + k)
    return bits


def fingerprint(text: Column) -> Column:
    """The fingerprint as a signed long."""
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        values = np.fromiter((majority(shingle_hashes(t)) for t in texts), np.uint64, len(texts))
        return pd.Series(values.view(np.int64))

    return prints(text)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints, spread by a multiplicative rule."""
    return [(k * 0x9E3779B97F4A7C15 ^ (k * 0xC2B2AE3D27D4EB4F) >> 7) & (1 << 64) - 1 for k in range(1, n + 1)]


def pivot_table(fp: Column, n: int = PIVOTS) -> list[Column]:
    """Distances to the references, eight to a long."""
    words = []
    for k in range(0, n, 8):
        word = F.lit(0).cast("long")
        for at, p in enumerate(pivots(n)[k:k + 8]):
            word = word.bitwiseOR(F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))).cast("long"), 8 * at))
        words.append(word)
    return words


def _far(a: Column, b: Column) -> Column:
    """The largest difference of eight distances."""
    return F.greatest(*(F.abs(F.shiftright(a, 8 * k).bitwiseAND(F.lit(255)) -
                              F.shiftright(b, 8 * k).bitwiseAND(F.lit(255))) for k in range(8)))


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """The bits of each choice of blocks that a pair may agree in."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(masks, blocks - radius)]


def near_pairs(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, n_pivots: int = PIVOTS) -> DataFrame:
    """(a, b) for each two of the distinct fingerprints `fp` that differ in 1 to `radius` bits."""
    masks = block_masks(blocks, radius)
    keys = F.array(*(F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits"))
                     for k, m in enumerate(masks)))
    tables = [w.alias(f"d{k}") for k, w in enumerate(pivot_table(F.col("fp"), n_pivots))]
    rows = prints.select("fp", *tables, F.explode(keys).alias("key")).select("fp", *[f"d{k}" for k in range(len(tables))],
                                                                           "key.*")
    a, b = rows.alias("a"), rows.alias("b")
    differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    first = F.lit(len(masks))
    for k in reversed(range(len(masks))):
        first = F.when(differ.bitwiseAND(F.lit(_signed(masks[k]))) == 0, k).otherwise(first)
    near = F.greatest(F.lit(0), *(_far(F.col(f"a.d{k}"), F.col(f"b.d{k}")) for k in range(len(tables)))) <= radius
    match = ((F.col("a.choice") == F.col("b.choice")) & (F.col("a.bits") == F.col("b.bits"))
             & (F.col("a.fp") < F.col("b.fp")) & near & (F.bit_count(differ) <= radius)
             & (first == F.col("a.choice")))
    return a.join(b, match).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def _with_roots(distinct: DataFrame, radius: int, blocks: int) -> DataFrame:
    """Add root, the least fingerprint of those reachable over links, to distinct fingerprints."""
    roots = components(near_pairs(distinct.select("fp"), radius, blocks))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id of those reachable over links."""
    prints = stored(docs.select("doc_id", fingerprint(whole_text()).alias("fp")), "simhash")
    placed = _with_roots(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), radius, blocks)
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = placed.join(least, "root").select("fp", "component_id")
    return prints.join(groups, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """One row per component: that of the least doc_id, null last, then of the least hash of the row."""
    row = F.xxhash64(*docs.columns, *(F.col(c).isNull() for c in docs.columns))  # a null alone leaves no trace in a hash
    marked = docs.withColumn("_llm_row", row)
    prints = stored(marked.select("doc_id", "_llm_row", fingerprint(whole_text()).alias("fp")), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("_llm_row").alias("row"))
    placed = _with_roots(prints.groupBy("fp").agg(F.min(order).alias("least")), radius, blocks)
    stay = placed.groupBy("root").agg(F.min("least").alias("least")).select(
        F.col("least.id").alias("_llm_id"), F.col("least.row").alias("_llm_stays"))
    found = marked.join(stay, marked["doc_id"].eqNullSafe(stay["_llm_id"]) & (marked["_llm_row"] == stay["_llm_stays"]),
                        "left_semi")
    return found.dropDuplicates(["doc_id", "_llm_row"]).select(*docs.columns)


def simhash_digest(docs: DataFrame) -> DataFrame:
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_duplicates(docs).select("doc_id", hexed.alias("fingerprint"), "component_id")
