"""How five filters interact: what each removes in every order, behind a counting-Bloom duplicate prepass.

Four filters look at a text alone and give one mask per document. The fifth asks
whether an earlier document has the same text. Its prepass hashes texts into
counting sketches: each task counts the cells its texts touch, sketches of a
slice of the hash range are merged, and a text with a cell that was touched once
is unique for certain. Only the other texts, possible repeats, are shuffled
whole; they are grouped by their full text, copies combined before the shuffle,
for the least doc_id of each. The flag joins the masks, and since all counts of
an order and a step are sums over masks, one count per part and mask serves all
600 of them.

A slice has a fixed number of cells, and slices follow the number of documents,
so the share of unique texts that passes for possible repeats does not grow with
the corpus. The merged sketches are broadcast to the second scan and hold
`SLICE_BITS` bits per `SLICE_TEXTS` documents, at most `MOST_SLICES` slices
(256 MB, 134 million documents at full strength). Beyond that they clear fewer
texts and the exact grouping does more; the result is the same.

Null texts count as empty, a null source as the part "". A document without
doc_id is never a repeat and makes no other one. Rows that repeat a doc_id count
each, those with equal texts do not repeat one another. A document is good
(toxic) if any of its label rows says so. No rows of documents give no rows.
"""

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import stored, whole_text

FILTERS = "ABCDE"
# Fixed values of the filters.
FEWEST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, MARKS = 50, 65, 5, b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SLICE_BITS, SLICE_TEXTS, PROBES, MOST_SLICES = 1 << 15, 2048, 3, 1 << 16


def text_mask(text: str) -> int:
    """Bits 0 to 3: whether the text fails filter A, B, C, D."""
    raw = text.encode()
    words = raw.split()
    n, distinct = len(words), len(set(words))
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    marked = len(raw.translate(None, MARKS)) < len(raw)
    return ((n < FEWEST_WORDS) + 2 * (100 * distinct < LEAST_DISTINCT * n)
            + 4 * (100 * capitals > MOST_CAPITALS * len(text)) + 8 * marked)


# --- the prepass ----------------------------------------------------------------------------

def _slice(h: Column, slices: int) -> Column:
    return F.pmod(h, F.lit(slices)).cast("int")


def _cells(h: Column) -> list[Column]:
    """`PROBES` cells of a slice, 15 bits each of a second hash."""
    again = F.xxhash64(h, F.lit(11))
    return [F.shiftrightunsigned(again, 16 * k).bitwiseAND(SLICE_BITS - 1).cast("int") for k in range(PROBES)]


def sketches(hashes: DataFrame, slices: int) -> DataFrame:
    """(slice, seen_twice): of each slice the bitmap of the cells that were counted twice or more.

    A task's sketch lists its touched cells, one that it counted twice or more
    twice, so its size follows its documents and counters need not go beyond 2.
    """
    def counted(batches):
        for batch in batches:
            cells = batch[[f"c{k}" for k in range(PROBES)]].to_numpy(np.int64)
            flat = (batch["slice"].to_numpy(np.int64)[:, None] * SLICE_BITS + cells).ravel()
            cell, times = np.unique(flat, return_counts=True)
            cell = np.repeat(cell, np.minimum(times, 2))
            at, first = np.unique(cell // SLICE_BITS, return_index=True)
            parts = np.split((cell % SLICE_BITS).astype("<u2"), first[1:])
            yield pd.DataFrame({"slice": at.astype(np.int32), "cells": [p.tobytes() for p in parts]})

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        cells = np.frombuffer(b"".join(group["cells"]), "<u2")
        twice = np.bincount(cells, minlength=SLICE_BITS) >= 2
        return pd.DataFrame({"slice": group["slice"].iloc[:1], "seen_twice": [np.packbits(twice, bitorder="little").tobytes()]})

    names = {f"c{k}": cell for k, cell in enumerate(_cells(F.col("h")))}
    touched = hashes.select(_slice(F.col("h"), slices).alias("slice"), *[cell.alias(name) for name, cell in names.items()])
    partial = touched.mapInPandas(counted, "slice int, cells binary")
    return partial.groupBy("slice").applyInPandas(merged, "slice int, seen_twice binary")


def _touched_twice(h: Column, bitmap: Column) -> Column:
    """Whether each of the cells was counted twice: bit `cell % 8` of byte `cell / 8`."""
    def bit(cell: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(cell, 3) + 1, F.lit(1))), 16, 10).cast("int")
        return byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), F.pmod(cell, F.lit(8)) + 1)) != 0

    found = bit(_cells(h)[0])
    for cell in _cells(h)[1:]:
        found = found & bit(cell)
    return found


def possible_repeats(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """(doc_id, h, text) of the documents whose text the sketches cannot clear; `hashes` has the h of every document."""
    slices, wanted = 1, hashes.count() // SLICE_TEXTS
    while slices < min(wanted, MOST_SLICES):
        slices *= 2
    bitmaps = stored(sketches(hashes, slices), "bloom")
    text = whole_text()
    rows = docs.select("doc_id", F.xxhash64(text).alias("h"), text.alias("text"))
    rows = rows.withColumn("slice", _slice(F.col("h"), slices))
    return rows.join(F.broadcast(bitmaps), "slice").filter(_touched_twice(F.col("h"), F.col("seen_twice"))).select(
        "doc_id", "h", "text")


def first_ids(repeats: DataFrame) -> DataFrame:
    """(text_sha256, first_id) of the texts that two or more documents share, grouped by the text itself."""
    groups = repeats.filter("doc_id is not null").groupBy("h", "text").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    return groups.filter("n > 1").select(F.sha2("text", 256).alias("text_sha256"), "first_id")


def flagged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask): which filters each document fails, as bits in the order of `FILTERS`."""
    @F.pandas_udf("int")
    def mask_of(texts: pd.Series) -> pd.Series:
        return texts.map(text_mask).astype("int32")

    text = whole_text()
    rows = stored(docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.xxhash64(text).alias("h"),
                              F.sha2(text, 256).alias("text_sha256"), mask_of(text).alias("mask")), "masks")
    firsts = stored(first_ids(possible_repeats(docs, rows.select("h"))), "first-ids")
    repeated = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return rows.join(firsts, "text_sha256", "left").select(
        "doc_id", "part", (F.col("mask") + F.when(repeated, 16).otherwise(0)).alias("mask"))


# --- counts by mask, then by order and step ---------------------------------------------------

def mask_counts(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, n, good, toxic): three arrays of 32 counts, by mask."""
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    joined = flags.join(known, "doc_id", "left")
    counts = joined.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    per_part = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(  # at most 32 masks
        "mask", F.struct("n", "good", "toxic")))).alias("by_mask"))

    def counts_of(name: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(31)),
                           lambda mask: F.coalesce(F.col("by_mask")[mask][name], F.lit(0).cast("long"))).alias(name)

    return per_part.select("part", counts_of("n"), counts_of("good"), counts_of("toxic"))


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, bits of the earlier filters, bit of this one) of all orders."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            out.append(("".join(order), step, before, bit))
            before |= bit
    return out


def interactions(counts: DataFrame) -> DataFrame:
    """The 600 rows of each part, from its 32 counts."""
    text = ";".join(",".join(map(str, step)) for step in _steps())
    steps = F.from_csv(F.col("line"), "filter_order string, step int, before int, bit int")
    rows = (counts.select("*", F.explode(F.split(F.lit(text), ";")).alias("line"))
            .select("part", "n", "good", "toxic", steps.alias("s")).select("*", "s.*").drop("s"))
    before, bit = F.col("before"), F.col("bit")

    def total(name: str, chosen) -> Column:
        picked = F.transform(F.col(name), lambda count, mask: F.when(chosen(mask), count).otherwise(F.lit(0).cast("long")))
        return F.aggregate(picked, F.lit(0).cast("long"), lambda a, b: a + b)

    def fails(mask: Column) -> Column:
        return mask.bitwiseAND(bit) != 0

    def survived(mask: Column) -> Column:
        return mask.bitwiseAND(before) == 0

    # Of the orders of a mask's k filters this one comes first in every k-th: it removes 120 / k.
    shares = F.transform("n", lambda count, mask: F.when(fails(mask), count * F.floor(F.lit(120) / F.bit_count(mask)))
                         .otherwise(F.lit(0).cast("long")))
    return rows.select(
        "part", "filter_order", "step",
        total("n", lambda m: m.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total("n", lambda m: fails(m) & survived(m)).alias("removed"),
        total("n", lambda m: fails(m) & ~survived(m)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", lambda m: fails(m) & survived(m)).alias("good_lost"),
        total("toxic", lambda m: fails(m) & survived(m)).alias("toxic_lost"),
        F.aggregate(shares, F.lit(0).cast("long"), lambda a, b: a + b).alias("shapley"))


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return interactions(mask_counts(flagged(docs), labels))


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x FROM documents),
     w AS (SELECT *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY x) AS first_id FROM t),
     c AS (SELECT *, len(ws) AS n, list_unique(ws) AS d, len(regexp_replace(x, '[^A-Z]', '', 'g')) AS caps FROM w),
     known AS (SELECT doc_id, max(cast(quality = 1 AS int)) AS good, max(cast(toxic = 1 AS int)) AS toxic
               FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
     f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                  cast(n < 50 AS int) + 2 * cast(100 * d < 65 * n AS int) + 4 * cast(100 * caps > 5 * len(x) AS int)
                  + 8 * cast(regexp_matches(x, '[#$%&*|]') AS int) + 16 * cast(coalesce(c.doc_id > first_id, false) AS int) AS mask
           FROM c LEFT JOIN known ON c.doc_id = known.doc_id),
     m AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
     l(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
     o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
                  [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
           FROM l a, l b, l c, l d, l e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
             AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
     s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::int AS before
           FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) AS five),
     r AS (SELECT part, filter_order, step, bit,
                  sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::bigint AS kept,
                  sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END)::bigint AS removed,
                  sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::bigint AS redundant,
                  sum(CASE WHEN mask = bit THEN n ELSE 0 END)::bigint AS unique_fails,
                  sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END)::bigint AS good_lost,
                  sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END)::bigint AS toxic_lost
           FROM m, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::bigint AS shapley FROM r
"""
