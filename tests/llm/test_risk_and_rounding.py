"""The risk over all rows against finite differences and a plain minimiser, rounding against one that goes row by row."""

import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from granary.llm import line_join, mixing, quality_pu
from granary.llm.common import table


def _layer(spark, hidden, parts):
    rows = [(k, h.astype(np.float32).tobytes()) for k, h in enumerate(hidden)]
    return spark.createDataFrame(rows, "doc_id long, hidden binary").repartition(parts)


def test_sums_are_the_slope_and_curvature_of_the_loss():
    draw = np.random.default_rng(1)
    hidden, weights = np.tanh(draw.normal(size=(50, 4))), draw.normal(size=5)
    sums, size, eps = quality_pu.negative_sums(hidden, weights), 5, 1e-5
    ends = [(quality_pu.negative_sums(hidden, weights + eps * e), quality_pu.negative_sums(hidden, weights - eps * e))
            for e in np.eye(size)]
    assert np.allclose(sums[2:2 + size], [(a[1] - b[1]) / (2 * eps) for a, b in ends], atol=1e-5)
    bend = [(a[2:2 + size] - b[2:2 + size]) / (2 * eps) for a, b in ends]
    assert np.allclose(sums[2 + size:].reshape(size, size), bend, atol=1e-5)


def _network(draw, size=6):
    first = draw.normal(size=(size, quality_pu.HIDDEN))
    return quality_pu.Network(np.zeros(size), np.ones(size), first, np.zeros(quality_pu.HIDDEN),
                              draw.normal(size=quality_pu.HIDDEN), 0.0)


def test_the_risk_is_that_of_all_rows(spark):
    draw = np.random.default_rng(2)
    good, bad = draw.normal(0.7, 1, (600, 6)), draw.normal(-0.7, 1, (600, 6))
    x, prior = np.concatenate([good, bad]), 0.4  # with a prior below the true share the bound does not bind

    def risk(net, prior=prior):
        mean = np.logaddexp(0, net.margin(x)).mean()
        return (mean - prior * net.margin(good[:200]).mean()
                + quality_pu.RIDGE / 2 * (np.square(net.second).sum() + net.second_bias ** 2),
                mean - prior * np.logaddexp(0, net.margin(good[:200])).mean())

    found = []
    for parts in (1, 5):
        net = _network(np.random.default_rng(3))
        rows = _layer(spark, net.hidden(x), parts)
        assert quality_pu._summed(rows, np.zeros(quality_pu.HIDDEN + 1))[0] == len(x)
        quality_pu.refit(net, good[:200], rows, prior)
        found.append(net)
    assert np.allclose(found[0].second, found[1].second, atol=1e-4)
    lowest, rest = risk(found[0])
    assert rest >= -quality_pu.SLACK - 1e-4
    for k in range(quality_pu.HIDDEN):  # no weight can be moved to a lower risk
        for step in (-0.05, 0.05):
            other = _network(np.random.default_rng(3))
            other.second, other.second_bias = found[0].second.copy(), found[0].second_bias
            other.second[k] += step
            assert risk(other)[0] > lowest - 1e-6
    chosen = np.quantile(found[0].margin(x), 0.5)
    assert np.mean(found[0].margin(good) > chosen) > 0.8 and np.mean(found[0].margin(bad) < chosen) > 0.8
    net = _network(np.random.default_rng(3))
    quality_pu.refit(net, good[:200], _layer(spark, net.hidden(x), 2), 0.9)  # too high a prior: the bound binds
    assert risk(net, 0.9)[1] >= -quality_pu.SLACK - 1e-4


def test_labels_that_repeat_count_once(spark):
    docs = spark.createDataFrame([(k, f"text {k} " * (k + 1)) for k in range(40)] + [(3, "another text")] * 5,
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    twice = labels.union(labels.filter("doc_id = 3")).union(labels.filter("doc_id = 3").selectExpr("doc_id", "1 - quality"))
    less = labels.withColumn("quality", F.when(F.col("doc_id") == 3, 0).otherwise(F.col("quality")))
    score = lambda given: [r.score for r in quality_pu.quality_digest(docs, given).orderBy("doc_id", "score").collect()]
    assert np.allclose(score(twice), score(less), atol=1e-6)
    assert len(score(twice)) == 45


# --- 9: pivotal rounding, one unit after the other ------------------------------------------

def _spark_hash(*values):
    """Spark's xxhash64: each value is hashed with the hash before as seed; int is 4 bytes, long 8."""
    seed = 42
    for kind, v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<" + kind, v), seed)
    return seed


def _draw(a, b):
    bits = _spark_hash(("i", 20_011), ("q", a["doc_id"]), ("q", a["n"]), ("q", b["doc_id"]), ("q", b["n"]))
    return ((bits >> 11) + 0.5) / (1 << 53)


def _in_turn(units, taken):
    """Decide the units of one block in order; what is left is one undecided unit."""
    cur = dict(units[0])
    for nxt in map(dict, units[1:]):
        up, down = min(cur["w"] - cur["a"], nxt["a"]), min(cur["a"], nxt["w"] - nxt["a"])
        move = up if _draw(cur, nxt) * (up + down) < down else -down
        room, full = cur["w"] - cur["a"], cur["a"]
        if move > 0 and room <= nxt["a"] or move <= 0 and full <= nxt["w"] - nxt["a"]:
            taken[cur["doc_id"], cur["n"]] = int(move > 0)
            nxt["a"] -= move
            cur = nxt
        else:
            taken[nxt["doc_id"], nxt["n"]] = int(move <= 0)
            cur["a"] += move
    return cur


def _rounded(units, block):
    taken, left = {}, []
    most = max(u["n_docs"] for u in units)
    groups = {}
    for u in units:
        h = _spark_hash(("q", u["doc_id"]), ("q", u["n"]))
        h -= (h >> 63) << 64
        groups.setdefault((u["s"], h % -(-u["n_docs"] // block)), []).append(u)
    while True:
        left = []
        for (s, b), some in groups.items():
            some.sort(key=lambda u: (-u["w"], u["doc_id"], u["n"]))
            left.append((s, b, _in_turn(some, taken)))
        most = -(-most // block)
        if most <= 1:
            break
        groups = {}
        for s, b, u in left:
            groups.setdefault((s, b // block), []).append(u)
    for s, _, u in left:
        taken[u["doc_id"], u["n"]] = int(2 * u["a"] >= u["w"])
    return taken


@pytest.mark.parametrize("block", [4, 64])
def test_rounding_equals_one_unit_after_the_other(spark, block):
    draw = np.random.default_rng(5)
    rows = [{"s": int(k % 3), "n_docs": 200, "doc_id": k - 50, "n": int(n), "w": int(n), "a": float(n) * float(p)}
            for k, (n, p) in enumerate(zip(draw.integers(1, 40, 600), draw.uniform(0.05, 0.95, 600)))]
    units = spark.createDataFrame([tuple(r.values()) for r in rows], "s long, n_docs long, doc_id long, n long, w long, a double")
    found = {(r.doc_id, r.n): r["take"] for r in mixing.pivotal_round(units, block).collect()}
    assert found == _rounded(rows, block)


def test_line_dedup_sql_has_the_rows_of_the_query(spark):
    import duckdb

    from granary.llm.registry import ORACLES, QUERIES

    folder = "/root/testdata/sf0.01"
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
        expected = con.execute(ORACLES["op7_line_join"]).fetchall()
    got = QUERIES["op7_line_join"](spark, folder).select("doc_id", "n_lines", "n_near", "kept_lines").collect()
    assert table(spark, folder, "documents").count() == len(got)
    assert sorted(map(tuple, got)) == sorted(expected)


def test_first_lines_from_whole_texts(spark):
    """Words are counted in the texts as they are, not line by line; each flips one bit, the rarest come first."""
    texts = ["alpha\nalpha beta\tgamma\n\n \nbeta beta", "alpha delta\r\nalpha", None]
    keyed = line_join._keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    plan = spark.range(1).select(line_join.rarities(keyed))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1
    lines = {(r.id, r.line_no): r for r in line_join.first_lines(keyed, 0.8).collect()}
    assert {place: r.n for place, r in lines.items()} == {(0, 0): 1, (0, 1): 3, (0, 4): 1, (1, 0): 2}
    for r in lines.values():
        bits = sum((r[name] & (1 << 64) - 1).bit_count() for name in line_join.PARITIES)
        assert bits <= r.n and (r.n - bits) % 2 == 0
        assert r.prefix == sorted(r.prefix) and len(r.prefix) == 1
    alpha, delta = (spark.sql(f"select shiftrightunsigned(xxhash64('{word}'), 8)").first()[0] for word in ("alpha", "delta"))
    low = (1 << 56) - 1
    assert (lines[0, 0].prefix[0] & low, lines[1, 0].prefix[0] & low) == (alpha, delta)


def test_line_searches_shuffle_prefix_rows_once(spark):
    """Both sides of each search read one shuffle; only lines that may be closed are joined with the closed ones."""
    base = " ".join(f"w{k}" for k in range(30))
    texts = ["\n".join([base.replace("w3 ", f"x{k}\t\x0b "), f"only {k}  here\f", base.replace("w5", "y\r")]) for k in range(4)]
    keyed = line_join._keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    firsts = line_join.first_lines(keyed, 0.8)
    assert {(r.id, r.line_no): r.n for r in firsts.collect()} == {
        (0, 2): 30, **{(k, 0): 30 for k in range(4)}, **{(k, 1): 3 for k in range(4)}}
    place = ["id", "line_no", "line_hash"]
    closed = firsts.filter("id in (1, 2) and line_no = 0").select(*place)
    assert line_join._seen(firsts, closed, *place).filter("seen").count() == 2
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for found in (line_join.earliest_candidates(firsts, 0.8), line_join.open_candidates(firsts, closed, 0.8)):
            assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
        assert {(r.id2, r.line_no2) for r in line_join.open_candidates(firsts, closed, 0.8).collect()} == {(3, 0), (0, 2)}
        assert {(r.id2, r.line_no2) for r in line_join.open_candidates(firsts, closed.limit(0), 0.8).collect()} == {
            (1, 0), (2, 0), (3, 0), (0, 2)}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
