"""The training-data operators against brute force, on given rows and on awkward ones."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from granary.llm import (common, hash_index, html_tree, line_join, minhash, mixing, packing, quality_pu, simhash, token_blocks,
                         toxic_crf)
from granary.llm.registry import vocabulary
from granary.llm.tokens import Encoder

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, h long, bucket int, size int, "
          "part int, fp long, range int, words string, line string, id long, node long")


def _docs(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    full = [(i, t, "en", s, len(t or ""), 0.1, 1, 2, 3, 4, 5, 6, "w", "l", 9, 10) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


LONG = " ".join(f"word{k % 997}x" for k in range(60_000))
ODD = [(1, "the cat sat on the mat", "a"), (2, "the cat  sat on\nthe mat", "a"), (2, "the cat sat on the mat", "a"),
       (3, None, None), (4, "", "b"), (5, " \n\t", "b"), (None, "the cat sat on the mat", None), (None, None, "c"),
       (7, LONG, "c"), (8, LONG, "c"), (8, LONG, "c"), (9, "é ü x <|endoftext|> 'll don't\n\n\n y ", None),
       (10, "one", "a"), (11, "THE CAT sat on the mat!", "a")]


@pytest.fixture(scope="module")
def odd(spark):
    return _docs(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def given(spark, folder):
    return common.table(spark, folder, "documents")


@pytest.fixture(scope="module")
def labels(spark, folder):
    return common.table(spark, folder, "labels")


def _rows(df):
    return [tuple(r) for r in df.collect()]


def _texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def _crc(ids, end):
    return zlib.crc32(np.array([*ids, end], "<u4").tobytes())


# --- 1 and 4: tokens ------------------------------------------------------------------------

def test_pieces_encode_like_whole_texts():
    encoder = Encoder(vocabulary())
    texts = [t or "" for _, t, _ in ODD] + ["a  b", "\n", " a", "a\r\nb", "x\x00y z", "tab\tbed", "a \n b"]
    flat, sizes = encoder.encode(texts)
    whole = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == list(map(len, whole)) and flat.tolist() == [i for ids in whole for i in ids]


@pytest.mark.parametrize("texts", [["x \x00abc y"], ["x \x00 y"], ["x \x00", "a b"], [" \x00abc x \x00abc"],
                                   ["\x00 \x00\x00 \x00a\n\x00b \x00", "x\x00 y \x00\n \x00"]])
def test_words_that_begin_with_nul_keep_blank_and_nul(texts):
    encoder = Encoder(vocabulary())
    whole = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        flat, sizes = encoder.encode(texts)
        assert sizes.tolist() == list(map(len, whole)) and flat.tolist() == [i for ids in whole for i in ids]


@pytest.mark.parametrize("values", [[7], [0] * 5000, list(range(5000)), [3] * 2000 + [2 ** 32 - 1] * 9, [2 ** 32 - 1, 0]])
def test_blocks_round_trip(values):
    ids = np.array(values, np.uint32)
    payload, starts = token_blocks.pack_blocks(ids)
    assert (token_blocks.unpack_blocks(payload, starts) == ids).all()
    assert (token_blocks.unpack_blocks(payload, starts[-1:]) == ids[token_blocks.BLOCK * (len(starts) - 1):]).all()


def test_common_values_are_packed_narrow():
    ids = np.array([5, 6, 7, 4] * 500 + [40_000] * 40, np.uint32)
    assert len(token_blocks.pack_blocks(ids)[0]) < len(ids)


@pytest.mark.parametrize("which", ["odd", "given"])
def test_token_files(request, which):
    docs = request.getfixturevalue(which)
    found = sorted(_rows(token_blocks.token_file_digest(docs, vocabulary())), key=lambda r: r[1])
    plain = Encoder(vocabulary()).tokenizer
    expected = {(d, _crc(plain.encode(t, add_special_tokens=False).ids, 2)) for d, t in _texts(docs)}
    assert {(r[0], r[3]) for r in found} == expected and len(found) == docs.count()
    ids = [r[0] if r[0] is not None else float("inf") for r in found]
    assert ids == sorted(ids)
    assert [r[1] for r in found] == np.cumsum([0, *[r[2] for r in found[:-1]]]).tolist()


@pytest.mark.parametrize("which", ["odd", "given"])
def test_packing(request, which):
    docs = request.getfixturevalue(which)
    rows = packing.pack(docs, vocabulary()).collect()
    plain = Encoder(vocabulary()).tokenizer
    wanted = sorted((str(d), n) for d, t in _texts(docs) for n in [len(plain.encode(t, add_special_tokens=False).ids) + 1])
    firsts = sorted((str(r.doc_id), r.doc_tokens) for r in rows if r.start == 0)
    assert firsts == wanted and sum(r.length for r in rows) == sum(n for _, n in wanted)
    assert all(len(r.ids) == 4 * r.length for r in rows)
    sequences = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert max(sequences.values()) <= packing.LIMIT


def test_shortest_pack_first_places_every_length():
    draw = random.Random(1)
    histogram = {draw.randint(1, 2048): draw.randint(1, 10 ** 9) for _ in range(800)}
    packs = packing.shortest_pack_first(histogram)
    placed = {}
    for count, lengths in packs:
        assert sum(lengths) <= 2048
        for length in lengths:
            placed[length] = placed.get(length, 0) + count
    assert placed == histogram and len(packs) <= 2 * 2048
    assert packing.shortest_pack_first({}) == []


# --- 2 and 5: classifiers -------------------------------------------------------------------

def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = common.table(spark, folder, "labels")
    rows = quality_pu.quality_digest(common.table(spark, folder, "documents"), labels).join(labels, "doc_id").filter(
        "held_out").select("quality", "predicted").collect()
    assert np.mean([r.quality == r.predicted for r in rows]) > 0.95


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = common.table(spark, folder, "labels")
    rows = toxic_crf.toxicity_digest(common.table(spark, folder, "documents"), labels).join(labels, "doc_id").filter(
        "held_out").select("toxic", "predicted").collect()
    assert all(r.toxic for r in rows if r.predicted) and sum(r.predicted for r in rows) > 0.5 * sum(r.toxic for r in rows)


def test_classifiers_on_awkward_rows(spark, odd, none, labels):
    for digest in (quality_pu.quality_digest, toxic_crf.toxicity_digest):
        rows = digest(odd, labels).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
        assert digest(none, labels).count() == 0
        no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
        assert {r.score for r in digest(odd, no_labels).collect()} in ({0.5}, {0.0})
    assert quality_pu.keep_good(odd, labels).columns == odd.columns


def test_marginals_equal_the_sum_over_all_paths():
    model = toxic_crf.Field({}, -1.0, 0.7, -0.4, 1.1)
    odds = np.array([0.3, -1.2, 2.0, 0.1, -0.5, 0.9])
    edge = {(0, 0): 0.0, (0, 1): model.enter, (1, 0): model.leave, (1, 1): model.stay}

    def brute(x):
        paths = [[(k >> i) & 1 for i in range(len(x))] for k in range(1 << len(x))]
        weight = [np.exp(sum(o * s for o, s in zip(x, p)) + sum(edge[a, b] for a, b in zip(p, p[1:]))) for p in paths]
        return [sum(w for w, p in zip(weight, paths) if p[i]) / sum(weight) for i in range(len(x))]

    found = toxic_crf.marginals(odds, np.array([4, 2]), model)
    assert np.allclose(found, brute(odds[:4]) + brute(odds[4:]))


def test_the_field_learns_from_every_sign_of_a_document():
    import pandas as pd

    texts = [" ".join("bad" if k % 40 == 0 else "w" for k in range(800))]
    batch = pd.DataFrame({"text": texts + ["good words only"], "toxic": [1, 0]})
    found = pd.concat(toxic_crf.learnt_windows([batch], {"bad": 0}))
    assert sum(n * sum(ys) for ys, n in zip(found["tags"], found["n"])) == 20
    assert sorted(found["n"]) == [1, 1, 19]


def test_spans_are_offsets_of_the_text():
    model = toxic_crf.Field({"bad": 9.0}, -4.0)
    score, spans = toxic_crf.tag(["é so bad, very bad."], model)[0]
    assert [(a, b) for a, b, _ in spans] == [(5, 8), (15, 18)] and score > 0.9
    assert toxic_crf.tag([""], model) == [(0.0, [])]


def test_network_steps_do_not_see_bad_labels():
    draw = np.random.default_rng(3)
    good, bad = draw.normal(2, 1, (400, 5)), draw.normal(-2, 1, (100, 5))
    net = quality_pu.fit(good[:200], np.concatenate([good[200:], bad]), 2 / 3)
    assert net.probability(good).mean() > 0.9 and net.probability(bad).mean() < 0.2


# --- 3, 7, 8, 10: copies --------------------------------------------------------------------

@pytest.mark.parametrize("capacity, bits", [(hash_index.CAPACITY, hash_index.MOST_BITS), (1, 6)])
def test_exact_dedup(odd, capacity, bits):
    found = hash_index.exact_dedup(odd, capacity, bits).collect()
    groups = {}
    for d, t in _texts(odd):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), d is None, d))
    expected = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        expected += [(m[2], keep, len(members), m[2] == keep, hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_directory_splits_what_is_overfull():
    counts = {0: 5, 1: 5, 2: 100, 3: 1, 4: 1, 5: 0, 6: 2, 7: 2}
    depth, slots = hash_index.directory(counts, 3, 6)
    assert depth == 3 and slots == [0, 1, 2, 3, 4, 4, 4, 4]
    assert hash_index.directory({}, 3, 6) == (0, [0])


def _kept_lines(docs, similarity=0.8):
    kept, seen, words = {}, set(), []
    for d, t in sorted(docs, key=lambda x: (x[0] is None, x[0] or 0)):
        out = kept.setdefault(d, [])
        for k, line in enumerate(t.split("\n")):
            w = frozenset(re.findall(r"[^\x20\x09-\x0D]+", line))
            if w and line in seen:
                continue
            near = any(len(w & v) >= similarity * len(w | v) - 1e-9 for v in words)
            if w:
                seen.add(line)
                words.append(w)
            if not w or not near:
                out.append(k)
    return kept


def test_line_dedup(spark, given):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(k, "\n".join([base.replace(f"w{k} ", "changed "), "", f"only here {k}", "shared words", base[: 40 + k]]), "a")
            for k in range(12)]
    made = _docs(spark, [*rows, (99, None, "a"), (None, base, None)])
    for docs in (made, given):
        found = {r.doc_id: r.kept_lines for r in line_join.line_digest(docs).collect()}
        assert found == _kept_lines(_texts(docs))
    left = {r.doc_id: r.text for r in line_join.without_repeated_lines(made).collect()}
    assert left[3].split("\n") == [rows[3][1].split("\n")[k] for k in _kept_lines(_texts(made))[3]]


def test_line_dedup_on_awkward_rows(odd, none):
    assert line_join.line_digest(odd).count() == len(ODD)
    assert line_join.line_digest(none).count() == 0
    assert line_join.without_repeated_lines(odd).columns == odd.columns


def _fingerprint(text):
    words = text.encode().lower().split()
    runs = [b" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def _components(nodes, linked):
    parent = list(range(len(nodes)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(nodes)):
        for j in range(i):
            if linked(nodes[i], nodes[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(k) for k in range(len(nodes))]


@pytest.mark.parametrize("which", ["odd", "given"])
def test_simhash(request, which):
    docs = request.getfixturevalue(which)
    texts = sorted(_texts(docs), key=lambda x: (x[0] is None, x[0] or 0))
    prints = [_fingerprint(t) for _, t in texts]
    roots = _components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    expected = sorted((str(d), f"{p:016x}", texts[r][0]) for (d, _), p, r in zip(texts, prints, roots))
    assert sorted((str(a), b, c) for a, b, c in _rows(simhash.simhash_digest(docs))) == expected


def test_near_pairs_find_every_link(spark):
    draw = random.Random(5)
    prints = {draw.getrandbits(64) for _ in range(300)}
    for p in list(prints):
        for bits in range(1, 6):
            prints.add(p ^ sum(1 << b for b in draw.sample(range(64), bits)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = {frozenset(r) for r in _rows(simhash.near_pairs(spark.createDataFrame([(p,) for p in signed], "fp long")))}
    expected = {frozenset((a, b)) for k, a in enumerate(signed) for b in signed[:k] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert found == expected


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 200) if k != 120], "a long, b long")
    assert {r.node: r.root for r in common.components(edges).collect()} == {k: 0 if k <= 120 else 121 for k in range(201)}


@pytest.mark.parametrize("which", ["odd", "given"])
def test_minhash_of_neighbours(request, which):
    docs = request.getfixturevalue(which)
    found = {r.edited_sha256: r for r in minhash.fingerprint_neighbours(docs).collect()}
    signer = minhash.Signer()
    if which == "given":
        texts = [t for _, t in sorted(_texts(docs), key=lambda x: -x[0])]
        for text, after in zip(texts, [*texts[1:], texts[0]]):
            other = minhash.edited(text, after)
            row = found[hashlib.sha256(other.encode()).hexdigest()]
            a, b, c = signer.sign([text, other, after])
            assert row.fingerprint == a.tobytes().hex() and row.edited_fingerprint == b.tobytes().hex()
            assert row.near_edited == np.mean(a == b) and row.near_next == np.mean(a == c)
    assert minhash.fingerprint_neighbours(docs).count() == docs.count()


def test_minhash_classes(spark):
    words = [f"w{k}" for k in range(300)]
    rows = [(1, " ".join(words), "a"), (2, " ".join(words[:295]), "a"), (3, " ".join(words), "a"), (4, None, "a"),
            (5, " ".join(words[150:] + words[:50]), "a"), (6, "", "a"), (7, "quite another text", "a")]
    found = dict(_rows(minhash.near_duplicates(_docs(spark, rows))))
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 4, 7: 7}


def test_minhash_classes_equal_brute_force(spark):
    texts, signer = [], minhash.Signer()
    for k in range(150):  # pairs of 100 shingles each; 89 in common are a Jaccard of 0.802, 88 one of 0.786
        words, kept = [f"p{k}w{i}" for i in range(104)], 92 if k % 15 == 0 else 93
        texts += [" ".join(words), " ".join([*words[:kept], *(f"q{k}w{i}" for i in range(104 - kept))])]
    sets = [set(signer.shingles(t).tolist()) for t in texts]
    expected = {i: min(j for j, b in enumerate(sets) if len(a & b) >= 0.8 * len(a | b)) for i, a in enumerate(sets)}
    assert dict(_rows(minhash.near_duplicates(_docs(spark, [(i, t, "a") for i, t in enumerate(texts)])))) == expected


def test_empty_tables(none):
    for operator in (hash_index.exact_dedup, simhash.simhash_digest, minhash.fingerprint_neighbours, mixing.mix_digest):
        assert operator(none).count() == 0
    assert packing.pack(none, vocabulary()).count() == token_blocks.token_file_digest(none, vocabulary()).count() == 0


# --- 6: pages -------------------------------------------------------------------------------

def test_main_text(spark, folder):
    page = ("<html><head><title>T</title><style>p{}</style></head><body><header>Top</header><nav><ul><li><a href=/>Menu</a></ul></nav>"
            "<div class='cookie notice'>We use cookies.</div><article><h1>A &amp; B</h1><p>One <b>bold</b>\n word.<p>Two&nbsp;words,"
            " and <a href=x>a link</a>.<script>var a='<p>no</p>'</script><form><input><button>Send</button></form>"
            "<div class=comments><p>First!</p></div></article><aside>More</aside><!-- <p>gone</p> --><footer>&copy; me</footer>")
    model = html_tree.train(common.table(spark, folder, "pages"))
    assert html_tree.extract([page, "", "plain text, no tags at all", "<p"], model)[0] == "A & B\nOne bold word.\nTwo words, and a link."
    bare = ("<body><div id=top><a href=1>Home</a> <a href=2>News</a></div><div><h1>Title</h1><p>A long sentence, with marks, that"
            " goes on for quite a while.</p></div><div class='footer'>Imprint</div></body>")
    assert html_tree.extract([bare], model) == ["Title\nA long sentence, with marks, that goes on for quite a while."]
    rows = spark.createDataFrame([(1, "u", page, "x"), (2, None, None, "y"), (None, "u", "<div", "z"), (4, "u", "", "z")],
                                 "page_id long, url string, html string, text string")
    assert {r.page_id: r.n_chars for r in html_tree.main_texts(rows).collect()}[2] == 0
    assert html_tree.main_texts(rows.limit(0)).count() == 0


def test_articles_of_the_given_pages(spark, folder):
    for r in html_tree.main_texts(common.table(spark, folder, "pages")).join(
            common.table(spark, folder, "pages").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        inner = re.sub(r"</?(b|i|a|em|strong|br)\b[^>]*>", lambda m: " " if m[1] == "br" else "", inner)
        import html
        blocks = (" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]*>", inner))
        assert r.text == "\n".join(b for b in blocks if b)


def test_tree_marginals_equal_the_sum_over_all_labels():
    draw = np.random.default_rng(4)
    page = html_tree.parse("<div><p>one</p><ul><li>two</li></ul></div>")
    x, parent, depth, _ = html_tree.feature_rows([page])
    model = html_tree.Model(draw.normal(size=len(html_tree.NAMES)), draw.normal(size=(2 * len(html_tree.KINDS), 2, 2)))
    kind, n = html_tree.edge_kinds(x, parent), len(parent)
    weights = []
    for k in range(1 << n):
        s = [(k >> i) & 1 for i in range(n)]
        weights.append(np.exp(sum((x[i] @ model.weights) * s[i] for i in range(n))
                              + sum(model.edges[kind[i], s[i], s[parent[i]]] for i in range(n) if parent[i] >= 0)))
    expected = [sum(w for k, w in enumerate(weights) if k >> i & 1) / sum(weights) for i in range(n)]
    assert np.allclose(html_tree.marginals(model, x, parent, depth)[0], expected)


# --- 9: mixing ------------------------------------------------------------------------------

def test_mix(spark):
    draw = random.Random(2)
    rows = [(k, " ".join(["w"] * draw.randint(1, 60)), draw.choice("abcdé")) for k in range(900)]
    docs = _docs(spark, [*rows, (1000, None, "a"), (1001, "x y", None), (None, " ", None)])
    found = mixing.mix(docs, block=8).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(5), block=8).collect()), key=str)
    sizes, targets, taken = {}, {}, {}
    for r in found:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        targets[r.source] = r.target
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
        assert r.copies <= 2 and (r.size or not r.copies)
    assert all(r.source_size == sizes[r.source] for r in found)
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(targets[s] <= 2 * sizes[s] + 1e-6 for s in sizes)
    weights = dict(zip([*sorted(s for s in sizes if s is not None), None], [3, 1, 2, 3, 1, 2]))
    free = {s: targets[s] / weights[s] for s in sizes if targets[s] < 2 * sizes[s] - 1e-6}
    assert max(free.values()) == pytest.approx(min(free.values()))
    assert all(abs(taken[s] - targets[s]) <= 60 for s in sizes)


def test_rounding_hits_its_expectation(spark):
    units = spark.range(20_000).select(F.lit(0).cast("long").alias("s"), F.lit(20_000).cast("long").alias("n_docs"),
                                       F.col("id").alias("doc_id"), (F.col("id") % 50 + 1).alias("n"),
                                       (F.col("id") % 50 + 1).alias("w"), ((F.col("id") % 50 + 1) * 0.3).alias("a"))
    rows = mixing.pivotal_round(units).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == 20_000
    assert abs(sum(r.take * r.n for r in rows) - 0.3 * sum(r.n for r in rows)) <= 50
    for size in (1, 25, 50):
        assert np.mean([r.take for r in rows if r.n == size]) == pytest.approx(0.3, abs=0.12)


# --- the pipeline ---------------------------------------------------------------------------

def test_pipeline_stages(spark, folder, given):
    import corpus_pipeline as pipeline

    docs, names = given, given.columns
    for name, stage in pipeline.STAGES[:-1]:
        before, docs = docs, common.stored(stage(spark, docs, folder), "test")
        assert docs.columns == names and 0 < docs.count()
        if name == "near duplicates":
            stays = {r.component_id for r in simhash.near_duplicates(before).collect()}
            assert sorted(r.doc_id for r in docs.collect()) == sorted(stays)
    assert pipeline.STAGES[-1][1](spark, docs, folder).count() >= docs.count()


def test_pipeline_stages_on_awkward_rows(spark, folder, odd):
    import corpus_pipeline as pipeline

    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, odd, folder).columns == odd.columns
        assert stage(spark, odd.limit(0), folder).count() == 0


def test_one_row_of_each_group_of_near_duplicates_stays(spark, folder):
    import corpus_pipeline as pipeline

    a, b, c, d = (" ".join(f"{name}{k}" for k in range(40)) for name in "abcd")
    docs = _docs(spark, [(None, a, "x"), (None, a, "x"), (5, a, "x"), (9, a, "y"), (7, b, "x"), (7, c, "x"), (7, b, "x"),
                         (3, c, "x"), (None, d, "x"), (None, d, None), (None, "", "x"), (8, None, "x")])
    found = sorted(((r.text or "", r.doc_id) for r in pipeline.near_duplicates(spark, docs, folder).collect()), key=str)
    assert found == [("", 8), (a, 5), (b, 7), (c, 3), (d, None)]
