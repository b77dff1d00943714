"""Packing by shortest pack first over the length histogram.

Documents are cut into pieces of `LIMIT` ids and a rest. Only the histogram of
piece lengths, at most LIMIT numbers, comes to the driver. Lengths are placed
longest first, each into the pack with the most space left, many equal packs at
a time; a pack pattern and its count describe them all. A length adds at most
one fresh and one split pattern, so there are at most 2 * LIMIT patterns. The
patterns are joined back by rank: the k-th piece of a length gets the k-th place
made for that length.

Null texts count as empty; a null doc_id is carried along. Repeated rows are
packed as often as they come. An id lies in exactly one piece.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import stored, whole_text
from granary.llm.tokens import lots, worker_encoder

LIMIT = 2048
PIECES = ("doc_id string, start long, length int, doc_tokens long, part int, at long, ids binary")


def cut_documents(docs: DataFrame, vocabulary: str, end_id: int = 1, limit: int = LIMIT) -> DataFrame:
    """Pieces with their ids, stored; `at` counts the pieces of a length within an input partition."""
    # Ids pass Python as text: beside a null pandas would make them doubles.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text().alias("text"),
                       F.spark_partition_id().alias("part"))

    def pieces(batches):
        encoder, seen = worker_encoder(vocabulary), np.zeros(limit + 1, np.int64)
        for batch in batches:
            texts = batch["text"].tolist()
            for first, last in lots(texts):
                some = batch.iloc[first:last]
                flat, sizes = encoder.encode(texts[first:last])
                full = sizes + 1  # with the end id
                flat = np.insert(flat, np.cumsum(sizes), np.uint32(end_id)).astype("<u4")
                number = -(-full // limit)
                owner = np.repeat(np.arange(len(full)), number)
                start = (np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)) * limit
                length = np.minimum(limit, full[owner] - start)
                begin = (np.cumsum(full) - full)[owner] + start
                # The rank of a piece among those of its length: in this lot, after those seen before.
                order = np.argsort(length, kind="stable")
                counts = np.bincount(length, minlength=limit + 1)
                at = np.empty(len(length), np.int64)
                at[order] = np.arange(len(length)) - np.repeat(np.cumsum(counts) - counts, counts)
                at += seen[length]
                seen += counts
                yield pd.DataFrame({
                    "doc_id": some["doc_id"].to_numpy()[owner], "start": start, "length": length.astype(np.int32),
                    "doc_tokens": full[owner], "part": some["part"].to_numpy()[owner], "at": at,
                    "ids": [flat[k:k + n].tobytes() for k, n in zip(begin.tolist(), length.tolist())]})

    return stored(rows.mapInPandas(pieces, PIECES).withColumn("doc_id", F.col("doc_id").cast("long")), "pieces")


def shortest_pack_first(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of the packs."""
    packs: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            space = max(packs, default=-1)
            if space < length:
                packs.setdefault(limit - length, []).append((n, (length,)))
                break
            count, lengths = packs[space].pop()
            used = min(n, count)
            if used < count:
                packs[space].append((count - used, lengths))
            if not packs[space]:
                del packs[space]
            packs.setdefault(space - length, []).append((used, (*lengths, length)))
            n -= used
    return [pack for space in sorted(packs) for pack in packs[space]]


def places(packs: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, sequence of the first, offset) of each place of each pattern."""
    rows, ranks, sequence = [], {}, 0
    for count, lengths in packs:
        offset = 0
        for length in lengths:
            rank = ranks.get(length, 0)
            rows.append((length, rank, rank + count, sequence, offset))
            ranks[length], offset = rank + count, offset + length
        sequence += count
    return rows


def place_pieces(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Add sequence_id and offset to pieces with length, part and at."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = spark.createDataFrame(places(shortest_pack_first(histogram, limit)),
                                  "_length int, _from long, _to long, _sequence long, offset long")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("_n"))
    starts = counts.select("part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = pieces.join(starts, ["part", "length"]).withColumn("_rank", F.col("at") + F.col("_before"))
    fits = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    placed = ranked.join(F.broadcast(table), fits)
    return placed.withColumn("sequence_id", F.col("_sequence") + F.col("_rank") - F.col("_from")).drop(
        "part", "at", "_n", "_before", "_rank", "_length", "_from", "_to", "_sequence")


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, limit: int = LIMIT) -> DataFrame:
    """Pieces with their ids and their place: doc_id, start, length, doc_tokens, ids, sequence_id, offset."""
    return place_pieces(cut_documents(docs, vocabulary, end_id, limit), limit)


def pack_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    pieces = cut_documents(docs, vocabulary)
    slim = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place_pieces(slim).select("doc_id", "start", F.col("length").cast("long"), "ids_crc32", "doc_tokens",
                                     "sequence_id", "offset")
