"""Document fingerprints by MinHash.

Words are hashed once, runs of five words are combined to shingle hashes, and
`PERMUTATIONS` multiply-add-shift hashes run over all shingles of many documents
at a time in numpy; each keeps its minimum per document. The share of equal
minima estimates the Jaccard similarity of the shingle sets. `near_duplicates`
joins bands of the signature in Spark for candidates and verifies these on the
sets; the registered query gives the fingerprints only and does not call it.

Null texts count as empty. A text of fewer than five words is one shingle, one
without words has the fingerprint of the empty set. Order is descending doc_id,
null last, rows of one doc_id by the hash of their text; the document after the
last is the first.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import components, stored, whole_text

SHINGLE, PERMUTATIONS, KEPT_BITS = 5, 128, 16
REMEMBERED = 400_000


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxh64_intdigest(word)
        return value


def permutations(n: int = PERMUTATIONS) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_017)
    return (draw.integers(1 << 62, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            draw.integers(1 << 62, size=n, dtype=np.uint64))


class Signer:
    def __init__(self, n: int = PERMUTATIONS, words: int = SHINGLE):
        self.a, self.b = permutations(n)
        self.words, self.known = words, _Words()

    def shingles(self, text: str) -> np.ndarray:
        """One hash for each run of words."""
        parts = text.encode().split()
        hashes = np.fromiter(map(self.known.__getitem__, parts), np.uint64, len(parts))
        if not len(hashes):
            return hashes
        run = min(self.words, len(hashes))
        out = np.zeros(len(hashes) - run + 1, np.uint64)
        for k in range(run):
            out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(hashes) - run + 1 + k]
        return out ^ (out >> np.uint64(29))

    def sign(self, texts: list[str]) -> np.ndarray:
        """A row of minima for each text, KEPT_BITS of each."""
        sets = [self.shingles(t) for t in texts]
        out = np.full((len(texts), len(self.a)), (1 << KEPT_BITS) - 1, np.uint16)
        full = np.array([k for k, s in enumerate(sets) if len(s)], np.int64)
        at = 0
        while at < len(full):  # some texts at a time, so that the arrays stay in the cache
            size, end = 0, at
            while end < len(full) and (end == at or size + len(sets[full[end]]) < 65_536):
                size, end = size + len(sets[full[end]]), end + 1
            lot = [sets[k] for k in full[at:end]]
            values, starts = np.concatenate(lot), np.cumsum([0, *map(len, lot[:-1])])
            for j in range(len(self.a)):
                hashed = (values * self.a[j] + self.b[j]) >> np.uint64(32)
                out[full[at:end], j] = np.minimum.reduceat(hashed, starts) & np.uint64((1 << KEPT_BITS) - 1)
            at = end
        return out


def edited(text: str, after: str) -> str:
    """The last half of the text replaced by as much of the next one's beginning."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def _in_order(docs: DataFrame) -> DataFrame:
    """Documents dealt by ranges of doc_id in one shuffle, each range followed by the first row of the next.

    Range ends are values of doc_id: quantiles, which are computed in doubles and
    need not be, only deal ids into groups, and the greatest id of each group is
    an end. So the row that begins a range is known before the shuffle and can be
    sent to the range before, too. Rows of one doc_id, and those without, share a
    range.
    """
    spark = docs.sparkSession
    pieces = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = [k / pieces for k in range(1, pieces)]
    row = docs.agg(F.max("doc_id").alias("top"), F.percentile_approx("doc_id", marks, 100 * pieces).alias("ends")).first()
    top, near = row["top"], np.unique(np.array(row["ends"] or [], np.int64))

    def dealt_by(bounds: np.ndarray):
        @F.pandas_udf("int")
        def range_of(ids: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(bounds, ids.to_numpy(), side="left").astype(np.int32))

        return range_of

    groups = docs.filter("doc_id is not null").select("doc_id", dealt_by(near)("doc_id").alias("_group"))
    ends = np.sort(np.array([r[0] for r in groups.groupBy("_group").agg(F.max("doc_id")).select("max(doc_id)").collect()], np.int64))
    range_of = dealt_by(ends)

    @F.pandas_udf("boolean")
    def begins(ids: pd.Series) -> pd.Series:
        return pd.Series(np.isin(ids.to_numpy(), ends))

    known = F.coalesce("doc_id", F.lit(-1 << 63))  # null comes last, so it is in the lowest range
    rows = docs.select("doc_id", whole_text().alias("text")).withColumns({
        "_range": F.when(F.col("doc_id").isNull(), 0).otherwise(range_of(known)), "_begins": begins(known)})
    own = F.struct(F.col("_range").alias("range"), F.lit(False).alias("guest"))
    before = F.when(F.col("_begins") & F.col("doc_id").isNotNull(),
                    F.struct((F.col("_range") + 1).alias("range"), F.lit(True).alias("guest")))
    first = F.when(F.col("doc_id").eqNullSafe(F.lit(top)), F.struct(F.lit(0).alias("range"), F.lit(True).alias("guest")))
    rows = rows.select("doc_id", "text", F.explode(F.array_compact(F.array(own, before, first))).alias("_p"))
    rows = rows.select("doc_id", "text", "_p.*").repartition("range")
    ordered = rows.sortWithinPartitions("range", "guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    # Ids pass Python as text: beside a null pandas would make them doubles.
    return ordered.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "range", "guest")


DIGEST = ("doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def fingerprint_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness, also to the next document's."""
    def pairs(batches):
        signer, last = Signer(), None
        for batch in batches:
            for k in range(0, len(batch), 256):
                some = batch.iloc[k:k + 256]
                rows = list(zip(some["doc_id"], some["text"], some["range"], some["guest"]))
                signs = list(signer.sign([r[1] for r in rows]))
                if last is not None:
                    rows, signs = [last[0], *rows], [last[1], *signs]
                last = (rows[-1], signs[-1])
                here = [i for i in range(len(rows) - 1) if not rows[i][3] and rows[i][2] == rows[i + 1][2]]
                texts = [edited(rows[i][1], rows[i + 1][1]) for i in here]
                new = signer.sign(texts)
                yield pd.DataFrame({
                    "doc_id": [rows[i][0] for i in here],
                    "n_chars": np.array([len(rows[i][1]) for i in here], np.int64),
                    "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in texts],
                    "fingerprint": [signs[i].tobytes().hex() for i in here],
                    "edited_fingerprint": [s.tobytes().hex() for s in new],
                    "near_edited": [float(np.mean(signs[i] == s)) for i, s in zip(here, new)],
                    "near_next": [float(np.mean(signs[i] == signs[i + 1])) for i in here]})

    return _in_order(docs).mapInPandas(pairs, DIGEST).withColumn("doc_id", F.col("doc_id").cast("long"))


def near_duplicates(docs: DataFrame, similarity: float = 0.8, bands: int = 32) -> DataFrame:
    """doc_id, class_id: the smallest doc_id that is reachable over pairs of Jaccard `similarity` or more.

    Equal shingle sets are one class at once, so copies make no pairs. Classes
    that share a band are candidates, each pair under its first shared band, and
    are verified on their shingle sets.
    """
    size = PERMUTATIONS // bands

    @F.pandas_udf("shingles array<long>, bands array<long>")
    def signed(texts: pd.Series) -> pd.DataFrame:
        from xxhash import xxh64_intdigest

        signer, out = Signer(), []
        for text, sign in zip(texts, signer.sign(texts.tolist())):
            sets = np.unique(signer.shingles(text)).view(np.int64)
            out.append((sets, [xxh64_intdigest(sign[k * size:(k + 1) * size].tobytes()) - (1 << 63)
                               for k in range(bands)]))
        return pd.DataFrame(out, columns=["shingles", "bands"])

    rows = stored(docs.select("doc_id", signed(whole_text()).alias("x")).select(
        "doc_id", "x.*", F.xxhash64("x.shingles").alias("node")), "minhash")
    classes = rows.groupBy("node").agg(F.any_value("shingles").alias("shingles"), F.any_value("bands").alias("bands"))
    classes = stored(classes, "minhash-classes")
    keys = classes.select("node", "bands", F.posexplode("bands").alias("band", "key"))
    a, b = keys.alias("a"), keys.alias("b")
    earlier = F.exists(F.slice(F.arrays_zip(F.col("a.bands").alias("x"), F.col("b.bands").alias("y")), 1, F.col("a.band")),
                       lambda z: z["x"] == z["y"])
    pairs = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.key") == F.col("b.key"))
                   & (F.col("a.node") < F.col("b.node")) & ~earlier).select(
        F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    left = classes.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = classes.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("x", "y"))
    alike = both.filter(common >= similarity * (F.size("x") + F.size("y") - common)).select("a", "b")
    roots = components(alike)
    placed = rows.select("doc_id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return placed.join(least, "root").select("doc_id", "class_id")
