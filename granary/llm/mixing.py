"""Mixing sources to target weights by pivotal rounding, in DataFrame code only.

Each source gets a share of the mix by its weight, up to `most` times its size.
A document is wanted target / source_size times: the whole part is taken for
certain, the fraction is a probability. Fractions are rounded together: two
documents pass words of probability to one another, in a direction drawn so
that expectations hold, until one of the two is taken or left for certain. The
words of a source stay the same in every step. Blocks of documents do this in
parallel, and their last undecided documents meet again in the next level of a
tree; one document of a source remains, which is rounded to the nearer end.

Draws are hashes of the documents, so a rerun agrees. Null texts have no words;
documents without words are never taken. A null source is a source, the last.
Rows alike in doc_id, source and size are decided together.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import ordinals, stored, unit, whole_text, word_count

WEIGHTS = (3, 1, 2)
SHARE, MOST, BLOCK = 1.5, 2.0, 64
_UNIT = "struct<doc_id: bigint, w: bigint, n: bigint, a: double>"
_DONE = "struct<doc_id: bigint, w: bigint, n: bigint, take: int>"


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, s, n_docs, source_size, target): weights by code point order, the excess reshared by weight.

    The level that targets share rises until no source is newly above its limit;
    each step is one sum over the sources.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranked = ordinals(per_source, [F.col("source").isNull(), F.col("source")], "s")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("s") % len(weights) + 1).cast("int"))
    ranked = stored(ranked.withColumn("weight", weight.cast("double")), "sources")
    limit, level, capped = most * F.col("source_size"), 0.0, -1
    while True:
        full = F.col("weight") * level >= limit
        row = ranked.agg(F.sum("source_size").alias("all"), F.sum(F.when(full, limit)).alias("cap"),
                         F.sum(F.when(~full, F.col("weight"))).alias("free"), F.count_if(full).alias("n")).first()
        if not row["free"] or row["n"] == capped:
            break
        capped, level = row["n"], (share * row["all"] - (row["cap"] or 0.0)) / row["free"]
    return ranked.withColumn("target", F.least(F.col("weight") * level, limit))


def _settle(units):
    """Pass words along one block, most words first: who is decided, and who is left."""
    empty = F.lit(None).cast(_UNIT)

    def pair(state, x):
        cur = state["cur"]
        up = F.least(cur["w"] - cur["a"], x["a"])
        down = F.least(cur["a"], x["w"] - x["a"])
        rise = unit(F.lit(x_seed), cur["doc_id"], cur["n"], x["doc_id"], x["n"]) * (up + down) < down
        # cur gains: it is full, or x is empty; cur loses: it is empty, or x is full
        cur_full, cur_empty = cur["w"] - cur["a"] <= x["a"], cur["a"] <= x["w"] - x["a"]
        ends = F.when(rise, cur_full).otherwise(cur_empty)
        take = F.when(rise, F.when(cur_full, 1).otherwise(0)).otherwise(F.when(cur_empty, 0).otherwise(1))
        stays = F.when(ends, x["doc_id"]).otherwise(cur["doc_id"])
        left = F.struct(stays.alias("doc_id"), F.when(ends, x["w"]).otherwise(cur["w"]).alias("w"),
                        F.when(ends, x["n"]).otherwise(cur["n"]).alias("n"),
                        F.when(rise & cur_full, x["a"] - up).when(rise, cur["a"] + up)
                        .when(cur_empty, x["a"] + down).otherwise(cur["a"] - down).alias("a"))
        out = F.struct(F.when(ends, cur["doc_id"]).otherwise(x["doc_id"]).alias("doc_id"),
                       F.when(ends, cur["w"]).otherwise(x["w"]).alias("w"),
                       F.when(ends, cur["n"]).otherwise(x["n"]).alias("n"), take.cast("int").alias("take"))
        return F.struct(left.cast(_UNIT).alias("cur"),
                        F.concat(state["done"], F.array(out.cast(_DONE))).alias("done"))

    x_seed = 20_011
    start = F.struct(empty.alias("cur"), F.array().cast(f"array<{_DONE}>").alias("done"))
    return F.aggregate(units, start, lambda state, x: F.when(
        state["cur"].isNull(), F.struct(x.cast(_UNIT).alias("cur"), state["done"].alias("done"))).otherwise(
        pair(state, x)))


def pivotal_round(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """(s, doc_id, n, take) for units (s, n_docs, doc_id, n, w, a) with 0 < a < w.

    s is the source, n the size of a document, w its weight in words, a the
    words it is wanted for. Blocks are hash groups of about `block` units.
    """
    most = units.agg(F.max("n_docs")).first()[0] or 0
    decided, level = [], units
    blocks = F.ceil(F.col("n_docs") / block)
    level = level.withColumn("block", F.pmod(F.xxhash64("doc_id", "n"), blocks))
    while True:
        grouped = level.groupBy("s", "n_docs", "block").agg(F.sort_array(F.collect_list(
            F.struct((-F.col("w")).alias("heavy"), "doc_id", "n", "w", "a"))).alias("units"))
        unit_only = F.transform("units", lambda u: F.struct(u["doc_id"], u["w"], u["n"], u["a"]).cast(_UNIT))
        settled = stored(grouped.select("s", "n_docs", "block", _settle(unit_only).alias("state")), "pivotal")
        decided.append(settled.select("s", F.explode("state.done").alias("d"))
                       .select("s", "d.doc_id", "d.n", "d.take"))
        left = settled.select("s", "n_docs", "block", "state.cur.*")
        most = -(-most // block)
        if most <= 1:
            break
        level = left.withColumn("block", F.floor(F.col("block") / block))
    decided.append(left.select("s", "doc_id", "n", F.when(F.col("a") * 2 >= F.col("w"), 1).otherwise(0).alias("take")))
    out = decided[0]
    for more in decided[1:]:
        out = out.union(more)
    return out


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target and `copies`, the times the mix takes the document."""
    sized = stored(docs.select("doc_id", "source", word_count(whole_text()).alias("size")), "sizes")
    targets = source_targets(sized, weights, share, most)
    wanted = F.coalesce(F.try_divide("target", F.col("source_size")), F.lit(0.0))
    facts = targets.select(F.col("source").alias("_source"), "s", "n_docs", "source_size", "target",
                           wanted.alias("wanted"))
    placed = sized.join(facts, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    part = F.col("wanted") - F.floor("wanted")
    same = placed.filter((part > 0) & (F.col("size") > 0)).groupBy(
        "s", "n_docs", "doc_id", F.col("size").alias("n"), part.alias("part")).agg(F.count("*").alias("rows"))
    units = same.withColumn("w", F.col("rows") * F.col("n")).withColumn("a", F.col("part") * F.col("w")).filter("a < w")
    takes = pivotal_round(units.drop("rows", "part"), block).select(
        F.col("s").alias("_s"), F.col("doc_id").alias("_id"), F.col("n").alias("_n"), "take")
    joined = placed.join(takes, (F.col("s") == F.col("_s")) & F.col("doc_id").eqNullSafe(F.col("_id"))
                         & (F.col("size") == F.col("_n")), "left")
    copies = F.when(F.col("size") > 0, F.floor("wanted") + F.coalesce("take", F.lit(0))).otherwise(0)
    return joined.select("doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"))


def mix_digest(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
