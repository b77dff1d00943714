"""Personal data and the terms that give it away, in DataFrame code only.

Patterns find e-mail addresses, IP addresses, card and phone numbers. Each value
found is a protected entity. A term, a run of letters and digits, is near an
entity if it lies whole within `NEAR` characters before or after it. Over the
corpus a document holds an entity or a term or it does not; of N documents df(c)
hold entity c, df(t) term t, and df(c, t) hold t near c. The entity's information is
IC(c) = log2(N / df(c)), what t tells of c is PMI(c; t) = log2(N df(c, t) / (df(c) df(t))),
and t discloses PMI / IC of c: 1 if t never occurs without c. A term beyond `REMOVE`
is removed near that entity, one beyond `GENERALISE` is replaced by its class.
Only pairs seen in `SUPPORT` documents and as many different surroundings count,
so that copies of a document prove nothing.

Nothing is gathered but the spans of a document: terms of the corpus are counted
with partial sums in each task, entities and pairs likewise.

Positions count code points, ends are exclusive. Null texts count as empty; a
null doc_id is carried along; repeated rows give equal rows and count as
documents. The surroundings of a value end at the next match of its kind, valid
or not, and at any other span; a span that overlaps a later one has no words
after it, one that overlaps an earlier one none before it.
"""

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import stored, whole_text

KINDS = ("email", "ip", "card", "phone")
REVEALING, INDICATIVE = "revealing", "indicative"
NAMES = (*KINDS, REVEALING, INDICATIVE)
NEAR, SUPPORT, REMOVE, GENERALISE = 60, 3, 0.8, 0.5
CHUNK = 256

# The contract's patterns, with possessive quantifiers where nothing is given back, and without starts inside a run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SIGNS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_BYTE = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)"
TERM, BETWEEN = r"[\p{L}\p{N}]++", r"[^\p{L}\p{N}]++"
_SPAN = "struct<start: int, end: int, kind: int, value: string, before: string, after: string>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit fits: from the right, every second digit is doubled and cast out by nines."""
    back = F.split(F.reverse(digits), "")
    values = F.transform(back, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """Whether a match is one of its kind."""
    size = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.when(size.between(12, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return size.between(9, 15)
    return F.lit(True)


def _located(text: Column, pattern: str, kind: int, valid: Callable[[Column], Column]) -> Column:
    """The valid matches of a pattern in order, each with its place and the text up to its neighbours.

    Places are running sums over all matches, `CHUNK` matches at a time, so that
    no long array is copied once per match.
    """
    none = F.array().cast(f"array<{_SPAN}>")

    def step(done: Column, match: Column) -> Column:
        start = done["at"] + F.length(match["before"])
        end = start + F.length(match["value"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), match["value"].alias("value"),
                        F.right(match["before"], F.lit(NEAR + 1)).alias("before"),
                        F.left(match["after"], F.lit(NEAR + 1)).alias("after"))
        return F.struct(end.alias("at"), F.when(valid(match["value"]), F.concat(done["out"], F.array(span)))
                        .otherwise(done["out"]).alias("out"))

    def chunk(done: Column, number: Column, matches: Column) -> Column:
        return F.aggregate(F.slice(matches, number * CHUNK + 1, F.lit(CHUNK)),
                           F.struct(done["at"].alias("at"), none.alias("out")), step,
                           lambda part: F.struct(part["at"].alias("at"), F.concat(done["out"], part["out"]).alias("out")))

    def walked(matches: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor(F.size(matches) / CHUNK).cast("int"))
        return F.aggregate(chunks, F.struct(F.lit(0).alias("at"), none.alias("out")),
                           lambda done, number: chunk(done, number, matches), lambda done: done["out"])

    def zipped(parts: Column) -> Column:
        gaps, found = parts["gaps"], parts["found"]
        return F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("before"), found.alias("value"),
                            F.slice(gaps, 2, F.size(found)).alias("after"))

    # A lambda's variable is computed once, an expression within a lambda each time.
    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    matches = F.transform(F.array(parts), zipped)
    return F.element_at(F.transform(matches, walked), 1)


def base_spans(text: Column) -> Column:
    """The protected spans of a text by start, then kind."""
    parts = []
    for number, kind in enumerate(KINDS):
        spans = _located(text, PATTERNS[kind], number, partial(_holds, kind))
        likely = F.contains(text, F.lit(SIGNS[kind])) if SIGNS[kind] else F.lit(True)
        parts.append(F.when(likely & text.rlike(PATTERNS[kind]), spans).otherwise(F.array().cast(f"array<{_SPAN}>")))
    ordered = F.transform(F.concat(*parts), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"),
        s["before"].alias("before"), s["after"].alias("after")))
    return F.array_sort(ordered)


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, NAMES))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def scanned(docs: DataFrame, *kept: Column) -> DataFrame:
    """(row, doc_id, spans) of every document, stored, and the columns `kept`; `row` numbers the stored rows."""
    return stored(docs.select("doc_id", base_spans(whole_text()).alias("spans"), *kept)
                  .withColumn("row", F.monotonically_increasing_id()), "pii")


def _near(side: Column, start: Column, from_left: bool) -> Column:
    """Places of the terms of a side; a term that the window's far edge cuts is left out."""
    whole = F.length(side) <= NEAR
    inner = F.when(whole, side).otherwise(F.regexp_replace(side, rf"^{TERM}" if from_left else rf"{TERM}$", ""))
    first = F.when(F.lit(from_left), start - F.length(inner)).otherwise(start)
    return F.transform(_located(inner, TERM, 0, lambda term: F.lit(True)), lambda t: F.struct(
        (first + t["start"]).alias("start"), (first + t["end"]).alias("end"), t["value"].alias("term")))


def near_terms(found: DataFrame) -> DataFrame:
    """(row, c, surroundings, start, end, term): one row per protected value and term near it, or with nulls if none is."""
    spans = found.select("row", F.inline("spans"))
    earlier = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    following = Window.partitionBy("row").orderBy("start", "kind")
    spans = spans.withColumns({"reach": F.coalesce(F.max("end").over(earlier), F.lit(0)),
                               "next": F.lead("start").over(following)})
    # What lies beyond the neighbouring spans is cut off, from the far end of each side.
    room_before = F.greatest(F.col("start") - F.col("reach"), F.lit(0))
    room_after = F.greatest(F.coalesce(F.col("next") - F.col("end"), F.lit(NEAR + 1)), F.lit(0))
    room_after = F.when(F.col("reach") > F.col("end"), 0).otherwise(room_after)
    named = F.when(F.col("kind") == KINDS.index("email"), F.lower("value")).when(
        F.col("kind") == KINDS.index("ip"), F.col("value")).otherwise(_digits(F.col("value")))
    sides = spans.select("row", "start", "end", F.xxhash64("kind", named).alias("c"),
                         F.right("before", room_before).alias("before"), F.left("after", room_after).alias("after"))
    terms = F.concat(_near(F.col("before"), F.col("start"), True), _near(F.col("after"), F.col("end"), False))
    return sides.select("row", "c", F.xxhash64("before", "after").alias("surroundings"), F.inline_outer(terms))


def disclosures(docs: DataFrame, near: DataFrame) -> DataFrame:
    """(c, term, kind): the terms that disclose more of an entity than the thresholds allow."""
    number = docs.agg(F.count("*")).first()[0]
    pairs = near.filter("term is not null").groupBy("c", "term").agg(F.countDistinct("row").alias("df_ct"), F.countDistinct("surroundings").alias("seen"))
    pairs = pairs.filter((F.col("df_ct") >= SUPPORT) & (F.col("seen") >= SUPPORT))
    entities = near.groupBy("c").agg(F.countDistinct("row").alias("df_c"))
    words = F.array_distinct(F.split(whole_text(), BETWEEN))
    terms = docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("df_t"))
    joined = pairs.join(entities, "c").join(terms, "term")
    n = F.lit(float(number))
    told = F.log2(n * F.col("df_ct") / (F.col("df_c") * F.col("df_t"))) / F.log2(n / F.col("df_c"))
    told = F.when(F.col("df_c") < number, told).otherwise(0.0)  # what every document holds needs no disclosing
    return joined.select("c", "term", F.when(told >= REMOVE, NAMES.index(REVEALING)).when(
        told >= GENERALISE, NAMES.index(INDICATIVE)).alias("kind")).filter("kind is not null")


def with_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """`found` with `all_spans`: the protected spans and those of disclosing terms, by start."""
    near = stored(near_terms(found), "pii-terms")
    told = stored(disclosures(docs, near), "pii-disclosures")
    placed = near.join(told, ["c", "term"]).groupBy("row", "start", "end").agg(F.min("kind").alias("kind"))
    per_row = placed.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("terms"))
    slim = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return found.join(per_row, "row", "left").withColumn("all_spans", F.when(
        F.col("terms").isNull(), slim).otherwise(F.array_sort(F.concat(slim, "terms"))))


def pii_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts of each kind, a hash of the protected spans, and all spans as text."""
    found = scanned(docs)
    counts = [_count(number).alias(f"n_{kind}") for number, kind in enumerate(KINDS)]
    return with_terms(docs, found).select("doc_id", *counts, F.sha2(spans_text(F.col("spans")), 256).alias("base_sha256"),
                                          spans_text(F.col("all_spans")).alias("spans"))


def _count(kind: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with protected values and revealing terms replaced by marks, indicative terms by their class."""
    found = with_terms(docs, scanned(docs, F.struct(*docs.columns).alias("whole")))
    text = F.coalesce(F.col("whole.text"), F.lit(""))
    marks = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS], F.lit("[REMOVED]"))

    def step(done: Column, span: Column) -> Column:
        old = F.substring(text, span["start"] + 1, span["end"] - span["start"])
        kind = F.when(old.rlike(r"^\p{N}+$"), "[NUMBER]").when(old.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
        mark = F.when(span["kind"] < len(NAMES) - 1, F.try_element_at(marks, span["kind"] + 1)).otherwise(kind)
        fresh = span["start"] >= done["at"]
        added = F.concat(done["out"], F.substring(text, done["at"] + 1, span["start"] - done["at"]), mark)
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"),
                        F.when(fresh, added).otherwise(done["out"]).alias("out"))

    none = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("all_spans", none, step, lambda done: F.concat(
        done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    clean = F.when(F.size("all_spans") == 0, F.col("whole.text")).otherwise(clean)
    return found.select(F.col("whole").alias("whole"), clean.alias("clean")).select(
        *[F.col("clean").alias("text") if name == "text" else F.col("whole")[name].alias(name) for name in docs.columns])
