"""Token-ID files: patched frame-of-reference blocks.

A file row is a segment: whole documents, their ids cut into blocks of `BLOCK`
ids. Of each block the minimum is subtracted; the rest is packed at the width
that holds `PERCENTILE` of its values; the few that need more bits keep their
low bits there and their high bits in an exception list. `block_starts` indexes
the blocks' bytes, `doc_ids` and `doc_sizes` the documents, so a segment, and
within it a block, is read without its neighbours.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import whole_text
from granary.llm.tokens import lots, worker_encoder
from granary.session import scratch_dir

BLOCK = 2048
PERCENTILE = 0.9
SEGMENT_IDS = 1 << 17
_HEAD = np.dtype([("low", "<u4"), ("size", "<u2"), ("width", "u1"), ("odd", "<u2")])

SEGMENTS = ("shard int, segment int, first_id long, n_tokens long, doc_ids array<long>, doc_sizes array<long>, "
            "block_starts array<int>, payload binary")


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bits of each value, lowest first."""
    kind = np.dtype("<u2" if width <= 16 else "<u4")
    raw = values.astype(kind).view(np.uint8).reshape(-1, kind.itemsize)
    return np.unpackbits(raw, axis=1, bitorder="little")[:, :width]


def pack_blocks(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> tuple[bytes, list[int]]:
    """The bytes of all blocks and where each starts."""
    out, starts, at = [], [], 0
    for k in range(0, len(ids), block):
        part = ids[k:k + block].astype(np.uint32)
        low = int(part.min())
        rest = part - np.uint32(low)
        common = min(int(percentile * len(rest)), len(rest) - 1)
        width = int(np.partition(rest, common)[common]).bit_length()
        odd = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
        head = np.array([(low, len(part), width, len(odd))], _HEAD).tobytes()
        packed = np.packbits(_bits(rest, width).ravel(), bitorder="little").tobytes()
        high = (rest[odd] >> np.uint32(width)).astype("<u4").tobytes() if len(odd) else b""
        piece = head + packed + odd.astype("<u2").tobytes() + high
        starts.append(at)
        out.append(piece)
        at += len(piece)
    return b"".join(out), starts


def unpack_blocks(payload: bytes, starts: list[int]) -> np.ndarray:
    """The ids of the blocks that begin at `starts`."""
    out = []
    for at in starts:
        low, size, width, odd = np.frombuffer(payload, _HEAD, 1, at)[0].tolist()
        at += _HEAD.itemsize
        n_bytes = (size * width + 7) // 8
        bits = np.unpackbits(np.frombuffer(payload, np.uint8, n_bytes, at), count=size * width, bitorder="little")
        kind = np.dtype("<u2" if width <= 16 else "<u4")
        full = np.zeros((size, 8 * kind.itemsize), np.uint8)
        full[:, :width] = bits.reshape(size, width)
        rest = np.packbits(full, axis=1, bitorder="little").view(kind).ravel().astype(np.uint32)
        at += n_bytes
        if odd:
            where = np.frombuffer(payload, "<u2", odd, at)
            rest[where] += np.frombuffer(payload, "<u4", odd, at + 2 * odd) << np.uint32(width)
        out.append(rest + np.uint32(low))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2,
                      segment_ids: int = SEGMENT_IDS) -> None:
    """Encode `text` and write the segments in ascending (doc_id, text) order.

    Null texts count as empty, a null doc_id comes last, repeated rows are
    written as often as they come. The order is that of shard, then segment;
    a shard is a range of doc_ids.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    rows = docs.select("doc_id", whole_text().alias("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    # Ids pass Python as text: beside a null pandas would make them doubles.
    rows = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.spark_partition_id().alias("shard"))

    def segments(batches):
        encoder, number, before, held, size, shard = worker_encoder(vocabulary), 0, 0, [], 0, 0

        def segment():
            ids = np.concatenate([x for _, x in held])
            payload, starts = pack_blocks(ids)
            return pd.DataFrame({"shard": [shard], "segment": [number], "first_id": [before], "n_tokens": [len(ids)],
                                 "doc_ids": [[d for d, _ in held]], "doc_sizes": [[len(x) for _, x in held]],
                                 "block_starts": [starts], "payload": [payload]})

        for batch in batches:
            texts = batch["text"].tolist()
            for first, last in lots(texts):
                part = batch.iloc[first:last]
                flat, sizes = encoder.encode(texts[first:last])
                shard = int(part["shard"].iloc[0])
                ends = np.cumsum(sizes)
                for doc_id, a, b in zip(part["doc_id"], ends - sizes, ends):
                    held.append((None if pd.isna(doc_id) else int(doc_id),
                                 np.append(flat[a:b], np.uint32(end_id)).astype(np.uint32)))
                    size += len(held[-1][1])
                    if size >= segment_ids:
                        yield segment()
                        number, before, held, size = number + 1, before + size, [], 0
        if held:
            yield segment()

    rows.mapInPandas(segments, SEGMENTS).write.option("compression", "zstd").parquet(path)


def read_token_files(files: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens and ids as little-endian 32-bit bytes.

    Only the ids per shard, one number each, meet in one place.
    """
    per_shard = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_shard.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))

    def documents(batches):
        for batch in batches:
            for row in batch.itertuples():
                ids = unpack_blocks(row.payload, list(row.block_starts)).astype("<u4")
                sizes = np.asarray(row.doc_sizes, np.int64)
                ends = np.cumsum(sizes)
                yield pd.DataFrame({"doc_id": list(row.doc_ids),
                                    "start": row.first_id + row.shard_start + ends - sizes, "n_tokens": sizes,
                                    "ids": [ids[a:b].tobytes() for a, b in zip(ends - sizes, ends)]})

    joined = files.join(F.broadcast(starts), "shard")
    found = joined.select("first_id", "shard_start", F.col("doc_ids").cast("array<string>").alias("doc_ids"), "doc_sizes",
                          "block_starts", "payload").mapInPandas(documents, "doc_id string, start long, n_tokens long, ids binary")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def token_file_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the files, read them back, and describe each document."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "llm-token-files")
    write_token_files(docs, path, vocabulary)
    back = read_token_files(spark.read.schema(SEGMENTS).parquet(path))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
