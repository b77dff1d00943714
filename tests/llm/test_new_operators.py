"""The filter audit, personal data and periodic runs against brute force, on given rows and on awkward ones."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
import regex

from granary.llm import common, filter_audit, periodic_runs, pii

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, h long, slice int, row long, part string, "
          "mask int, spans string, term string, c long, n long, start long, period long")
BIG = (1 << 53) + 1


def _docs(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, 2, 3, "p", 4, "s", "t", 5, 6, 7, 8) for i, t, s in rows], SCHEMA)


LONG = " ".join(f"word{k % 997}x" for k in range(60_000))
ODD = [(BIG, "the cat sat on the mat", "a"), (BIG + 1, "the cat sat on the mat", None), (BIG + 1, "the cat sat on the mat", "a"),
       (-3, None, None), (4, "", "b"), (5, " \n\t", "b"), (None, "the cat sat on the mat", None), (None, None, "c"),
       (7, LONG, "c"), (8, LONG, "c"), (8, LONG, "c"), (9, "é ü x <|end|>  don't\n\n\n y $ ", ""),
       (10, "one", "a"), (11, "THE CAT sat on the mat!", "a"), (12, "a b " * 300, "d")]


@pytest.fixture(scope="module")
def odd(spark):
    return _docs(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def given(spark, folder):
    return common.table(spark, folder, "documents")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- 11: filter interactions ----------------------------------------------------------------

def _audit(docs, labels):
    first, good, toxic = {}, defaultdict(int), defaultdict(int)
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, quality, is_toxic in labels:
        good[i], toxic[i] = max(good[i], int(quality == 1)), max(toxic[i], int(is_toxic == 1))
    counts = defaultdict(Counter)
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = [name for name, bad in (
            ("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)), ("D", re.search(r"[#$%&*|]", text)),
            ("E", i is not None and i > first[text])) if bad]
        for order in permutations("ABCDE"):
            gone = False
            for step, name in enumerate(order, 1):
                key, row = (source or "", "".join(order), step), counts[source or "", "".join(order), step]
                here = name in fails and not gone
                row["redundant"] += name in fails and gone
                row["unique_fails"] += fails == [name]
                gone |= here
                row["removed"] += here
                row["kept"] += not gone
                if i is not None:
                    row["good_lost"] += here and good[i]
                    row["toxic_lost"] += here and toxic[i]
                counts[key[0], name]["shapley"] += here
    return sorted((part, order, step, *(counts[part, order, step][k] for k in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")), counts[part, order[step - 1]]["shapley"])
        for part, order, step in [k for k in counts if len(k) == 3])


def test_filter_audit_on_awkward_rows(spark, odd, none):
    labels = [(7, 1, 0), (8, 0, 1), (8, 1, 1), (None, 1, 1), (BIG + 1, 1, 0), (99, 1, 1), (12, None, None)]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert [tuple(r) for r in filter_audit.filter_interactions(odd, labelled).orderBy("part", "filter_order", "step").collect()] \
        == _audit(ODD, [x for x in labels if x[0] is not None])
    assert filter_audit.filter_interactions(none, labelled).count() == 0


def test_filter_audit_without_labels(spark, odd):
    labelled = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [tuple(r) for r in filter_audit.filter_interactions(odd, labelled).orderBy("part", "filter_order", "step").collect()] \
        == _audit(ODD, [])


def test_sketches_clear_unique_texts_only(spark):
    texts = [f"text number {k}" for k in range(5000)]
    rows = [(k, t, "a") for k, t in enumerate(texts)] + [(9000 + k, t, "a") for k, t in enumerate(texts[:300])] * 2
    docs = _docs(spark, rows).repartition(7)
    suspects = filter_audit.possible_repeats(docs, docs.selectExpr("xxhash64(text) as h"))
    found = Counter(r.text for r in suspects.select("text").collect())
    assert all(found[t] == 3 for t in texts[:300])  # nothing that repeats is cleared
    assert len(found) - 300 < 0.06 * 4700  # and few of the others stay
    firsts = filter_audit.first_ids(suspects).collect()
    assert sorted(r.first_id for r in firsts) == list(range(300))


# --- 12: personal data ----------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
KINDS, TERM = list(PATTERNS), regex.compile(r"[\p{L}\p{N}]+")


def _digits(text):
    return re.sub("[^0-9]", "", text)


def _is(kind, match):
    digits = _digits(match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def _spans(text):
    out = []
    for number, kind in enumerate(KINDS):
        found = list(re.finditer(PATTERNS[kind], text))
        ends = [0, *(m.end() for m in found)]
        begins = [*(m.start() for m in found[1:]), len(text)]
        out += [(m.start(), number, m.end(), m.group(), text[a:m.start()][-61:], text[m.end():b][:61])
                for m, a, b in zip(found, ends, begins) if _is(kind, m.group())]
    return sorted(out)


def _sanitised(texts):
    """Spans of each text, disclosing terms included."""
    near, base, holders, df = [], [_spans(t) for t in texts], defaultdict(set), Counter()
    for row, spans in enumerate(base):
        reach = 0
        for k, (start, kind, end, value, before, after) in enumerate(spans):
            room = max(spans[k + 1][0] - end, 0) if k + 1 < len(spans) else 61
            before = before[len(before) - min(len(before), max(start - reach, 0)):]
            after = "" if reach > end else after[:room]
            entity = (kind, value.lower() if kind == 0 else value if kind == 1 else _digits(value))
            holders[entity].add(row)
            left = before if len(before) <= 60 else regex.sub(r"^[\p{L}\p{N}]+", "", before)
            right = after if len(after) <= 60 else regex.sub(r"[\p{L}\p{N}]+$", "", after)
            for at, side in ((start - len(left), left), (end, right)):
                near += [(row, entity, (before, after), at + m.start(), at + m.end(), m.group()) for m in TERM.finditer(side)]
            reach = max(reach, end)
    for text in texts:
        df.update(set(TERM.findall(text)))
    rows, around = defaultdict(set), defaultdict(set)
    for row, entity, surroundings, _, _, term in near:
        rows[entity, term].add(row)
        around[entity, term].add(surroundings)
    extra = [{} for _ in texts]
    for row, entity, _, start, end, term in near:
        both, n = len(rows[entity, term]), len(texts)
        if both >= 3 and len(around[entity, term]) >= 3 and len(holders[entity]) < n:
            told = math.log2(n * both / (len(holders[entity]) * df[term])) / math.log2(n / len(holders[entity]))
            if told >= 0.5:
                extra[row][start, end] = min(4 if told >= 0.8 else 5, extra[row].get((start, end), 9))
    names = [*KINDS, "revealing", "indicative"]

    def text_of(spans):
        return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(spans))

    slim = [[(a, k, b) for a, k, b, *_ in spans] for spans in base]
    return [(*(sum(k == x[1] for x in s) for k in range(4)), hashlib.sha256(text_of(s).encode()).hexdigest(),
             text_of(s + [(a, k, b) for (a, b), k in e.items()])) for s, e in zip(slim, extra)]


PERSONAL = [
    "a.b@c.de_x@y.z foo@bar foo@bar.baz. x@-.- ümlaut@x.de 1.2.3.4.5.6.7.8 256.1.1.1 0001.02.003.0255 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 41111111111111111111111 5 5 5 49927398716",
    "+1 (017) 555-7713 +1 555 +12345678901234567890 +49 171 1234567. +4 . 12345678 +1.2.3.4.5.6.7.8.9",
    "+1 10.0.0.1 192.168.0.1@host.org a@10.0.0.1 10.0.0.1", "x" * 2_000 + " " + "7" * 1_500 + "@", "1." * 300 + "1-" * 300,
    "\U0001f600 é mail an zoë@example.com \U0001f600\U0001f600 10.1.2.3 İstanbul", None, "", " \n", "a@b.co " * 60]


def _disclosing():
    """A name and an office that stand with one address only, among words that stand everywhere."""
    draw = random.Random(4)
    common_words = [f"w{k}" for k in range(30)]
    texts = []
    for k in range(60):
        words = [draw.choice(common_words) for _ in range(25)]
        if k < 8:
            words[10:10] = ["Quimby", "mayor@springfield.example" if k % 2 else "Mayor@Springfield.example", "office17"]
            words[draw.randrange(4):1] = ["Quimby"] * (k % 3 == 0)
        elif k < 12:
            words[5:5] = ["office17", "office17"]
        elif k < 30:
            words[5:5] = ["call", "+1 555 010 9999" if k % 2 else "+1 (555) 010-9999", "now"]
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("texts", [PERSONAL, _disclosing(), PERSONAL + _disclosing() * 2])
def test_pii_against_brute_force(spark, texts):
    docs = _docs(spark, [(BIG + k if k % 5 else None, t, "a") for k, t in enumerate(texts)]).repartition(3)
    found = Counter(tuple(r)[1:] for r in pii.pii_digest(docs).collect())
    assert found == Counter(_sanitised([t or "" for t in texts]))


def test_pii_ids_and_odd_rows(spark, odd, none, given):
    assert sorted((r.doc_id for r in pii.pii_digest(odd).collect()), key=repr) == sorted((r[0] for r in ODD), key=repr)
    assert pii.pii_digest(none).count() == 0
    texts = {r.doc_id: r.text or "" for r in given.select("doc_id", "text").collect()}
    found = {r.doc_id: tuple(r)[1:] for r in pii.pii_digest(given).collect()}
    assert found == dict(zip(texts, _sanitised(list(texts.values()))))


def test_sanitised_text(spark, none):
    docs = _docs(spark, [(k, t, "a") for k, t in enumerate(_disclosing())] + [(None, None, "b")])
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert pii.sanitise(docs).columns == docs.columns and pii.sanitise(none).count() == 0
    assert clean[None] is None and all("@" not in t and "555" not in t for t in clean.values() if t)
    assert "Quimby" not in " ".join(clean[k] for k in range(8)) and "[REMOVED]" in clean[1] and "[EMAIL]" in clean[1]
    assert "office17" in clean[9] and "office17" not in clean[1] and "[PHONE]" in clean[20]


# --- 13: periodic runs ----------------------------------------------------------------------

def _runs(words):
    numbers, found = np.unique(words, return_inverse=True)[1] if words else np.empty(0, int), {}
    for q in range(1, len(words) // 3 + 1):
        same = np.diff(np.concatenate([[0], (numbers[:-q] == numbers[q:]).astype(int), [0]]))
        for a, b in zip(np.flatnonzero(same == 1).tolist(), np.flatnonzero(same == -1).tolist()):
            if b - a + q >= max(24, 3 * q):
                found.setdefault((a, b - a + q), q)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def _periodic(draw):
    words = []
    for _ in range(draw.randrange(1, 6)):
        letters = draw.choice([1, 2, 3, 50])
        part = [b"%d" % draw.randrange(letters) for _ in range(draw.randrange(1, 50))]
        part = part * draw.randrange(1, 4) + part[:draw.randrange(3)]
        words += part * draw.choice([1, 1, 3, 4, 8]) + part[:draw.randrange(len(part))]
    if draw.random() < 0.25:
        a, b = [b"0"], [b"0", b"1"]
        for _ in range(draw.randrange(5, 10)):
            a, b = b, b + a
        words += b * draw.choice([1, 3])
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_brute_force(seed):
    draw = random.Random(seed)
    texts = [_periodic(draw) for _ in range(60)] + [[], [b"x"], [b"x"] * 23, [b"x"] * 24, [b"a", b"b"] * 12, [b"a", b"b"] * 11]
    draw.shuffle(texts)
    for text, found in zip(texts, periodic_runs.runs_of(texts)):
        assert [tuple(r) for r in found.tolist()] == _runs(text)


def test_range_successors():
    draw = np.random.default_rng(3)
    values = draw.permutation(500)
    index = periodic_runs.Wavelet(values, 501)
    lo = draw.integers(0, 400, 200)
    hi, bound = lo + draw.integers(1, 100, 200), draw.integers(0, 500, 200)
    below = index.below(lo, hi, bound)
    assert below.tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(lo, hi, bound)]
    some = below < hi - lo
    assert index.smallest(lo[some], hi[some], below[some]).tolist() == [
        min(v for v in values[a:b] if v >= x) for a, b, x in zip(lo[some], hi[some], bound[some])]


def _described(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    import zlib
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = _runs(words)
    dropped = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    text = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())


def test_run_digest(spark, given, none):
    rows = [r for r in ODD if r[1] != LONG] + [(k, "x y z " * 20, "a") for k in range(40)]
    assert _rows(periodic_runs.run_digest(_docs(spark, rows))) == sorted((_described(i, t) for i, t, _ in rows), key=repr)
    texts = [(r.doc_id, r.text) for r in given.select("doc_id", "text").collect() if len((r.text or "").split()) < 3000]
    found = {r.doc_id: tuple(r) for r in periodic_runs.run_digest(given).collect()}
    assert [found[i] for i, _ in texts] == [_described(i, t) for i, t in texts]
    assert periodic_runs.run_digest(none).count() == 0
