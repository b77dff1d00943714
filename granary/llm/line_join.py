"""Line dedup by an exact set-similarity join, in DataFrame code only.

A line is the set of its words (runs of characters other than blanks). A line
is removed if an earlier line, by doc_id and then by place in the document, has
Jaccard similarity `SIMILARITY` or more with it; whether that earlier line was
itself removed makes no difference. Lines without words are always kept.

Equal lines are combined first, so copies make no pairs. The words of each
distinct line are put in order of rarity; two similar lines share a word of
their prefixes, which is the join key. Pairs must then pass the length filter,
the positional filter and a comparison of parity signatures (each word flips
one of 128 bits, so signatures differ in no more bits than lines in words), all
exact, before Jaccard is verified on the words.

One similar earlier line decides a line. So each is first compared with the
earliest line of each of its key groups, which is a row per key and grows with
the input; that settles most of a large group of near copies. Only what stays
open is then joined with all earlier lines.

Rarity is a count per hash bucket over all lines, so its table has a fixed
size; any fixed order gives the same result, rarity only keeps groups small.

A null text counts as empty. A null doc_id comes after all others. Rows that
share a doc_id count as one document: equal lines at the same place stay in each.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import stored, whole_text

SIMILARITY = 0.8
RARITY_BUCKETS = 1 << 18
FILTER_WORDS = 1 << 16
LAST = (1 << 63) - 1
PARITIES = ("parity", "parity2")
WORD = "[^\\x20\\x09-\\x0D]"
ODD_BLANKS = "\t\n\x0b\x0c\r"


def _pieces(line: Column) -> Column:
    """The words with their repeats, and empty strings where blanks meet; a split at one character needs no regex.

    Few lines hold other blanks than spaces, and to look for them costs less than to replace them.
    """
    odd = reduce(Column.__or__, [F.contains(line, F.lit(blank)) for blank in ODD_BLANKS])
    return F.split(F.when(odd, F.regexp_replace(line, f"[{ODD_BLANKS}]", " ")).otherwise(line), " ")


def words_of(line: Column) -> Column:
    return F.array_distinct(F.array_remove(_pieces(line), ""))


def _one(number: Column) -> Column:
    """The bit that the low six bits of a number name."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int"))


def _marks(upper: bool) -> Column:
    """For each number of seven bits: the bit that its low six name if the seventh is as said, else 0."""
    bits = [1 << (number & 63) if (number >= 64) == upper else 0 for number in range(128)]
    return F.array(*[F.lit(bit - (bit >> 63 << 64)).cast("long") for bit in bits])


def _parity(hashes: str, marks: Column) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"),
                       lambda seen, h: seen.bitwiseXOR(F.get(marks, h.bitwiseAND(F.lit(127)).cast("int"))))


def _dense(counts: DataFrame, size: int, value: Column, kind: str) -> Column:
    """A constant array of `size` entries from (slot, ...) rows; slots without a row are zero."""
    slots = counts.sparkSession.range(size).withColumnRenamed("id", "slot")
    full = slots.join(counts, "slot", "left").select("slot", F.coalesce(value, F.lit(0)).cast(kind).alias("v"))
    return full.agg(F.transform(F.sort_array(F.collect_list(F.struct("slot", "v"))), lambda x: x["v"])).scalar()


def _keyed(docs: DataFrame) -> DataFrame:
    """id (doc_id, null as the largest) and the whole text."""
    return docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("id"), whole_text().alias("text"))


def _lines(keyed: DataFrame) -> DataFrame:
    """All lines with words: id, line_no, line."""
    rows = keyed.select("id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return rows.filter(F.regexp_like("line", F.lit(WORD)))


def rarities(keyed: DataFrame) -> Column:
    """A constant array with the level of rarity of each bucket of words, 0 to 127, in the highest byte.

    Words are counted in the whole texts, which need not be cut into lines for that.
    """
    texts = keyed.select(F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"))
    words = texts.select(F.explode(_pieces(F.col("text"))).alias("w"))
    counts = words.groupBy(F.xxhash64("w").bitwiseAND(F.lit(RARITY_BUCKETS - 1)).alias("slot")).agg(F.count("*").alias("n"))
    level = F.least(F.lit(127), F.floor(5 * F.log2(F.col("n") + 1))).cast("long")
    return _dense(counts, RARITY_BUCKETS, F.shiftleft(level, 56), "long")


def first_lines(keyed: DataFrame, similarity: float) -> DataFrame:
    """Each distinct line at its first place, stored: id, line_no, line_hash, n words, the parities, prefix.

    What a join needs is worked out before lines are combined, so no text is shuffled. Here words are told apart by
    64-bit hashes.
    """
    def ordered(h: Column) -> Column:
        # The coalesce never applies; it tells that there are no nulls, so that the words are sorted as plain numbers.
        rank = F.coalesce(F.get(F.col("rarity"), h.bitwiseAND(F.lit(RARITY_BUCKETS - 1)).cast("int")), F.lit(0).cast("long"))
        return rank.bitwiseOR(F.shiftrightunsigned(h, 8))

    hashes = F.array_remove(F.array_distinct(F.transform(_pieces(F.col("line")), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))
    # The parities come between, so that the last step takes the table of rarities as it is instead of a copy per row.
    sets = _lines(keyed).select("id", "line_no", "line", hashes.alias("hashes")).select(
        "*", _parity("hashes", _marks(False)).alias("parity"), _parity("hashes", _marks(True)).alias("parity2"),
        rarities(keyed).alias("rarity"))
    words = F.sort_array(F.transform("hashes", ordered))
    n = F.size("hashes")
    kept = n - F.ceil(n * similarity - 1e-9).cast("int") + 1
    place = F.struct("id", "line_no", F.xxhash64("line").alias("line_hash"), n.alias("n"), *PARITIES,
                     F.slice(words, F.lit(1), kept).alias("prefix"))
    rows = sets.select(F.unhex(F.md5("line")).alias("text_key"), place.alias("place"))
    return stored(rows.groupBy("text_key").agg(F.min("place").alias("place")).select("place.*"), "first-lines")


def _reach(n: Column, at: Column) -> Column:
    """How many words there are from this one on, the most that two lines can share if it is their first in common."""
    return n - at


def _alike(similarity: float) -> Column:
    """What two rows a and b of one key have to pass: a is earlier, and no filter rules out that they are similar."""
    both = F.col("a.n") + F.col("b.n")
    least = F.ceil(both * (similarity / (1 + similarity)) - 1e-9)
    apart = sum(F.bit_count(F.col(f"a.{name}").bitwiseXOR(F.col(f"b.{name}"))) for name in PARITIES)
    before = (F.col("a.id") < F.col("b.id")) | (F.col("a.id") == F.col("b.id")) & (F.col("a.line_no") < F.col("b.line_no"))
    return ((F.col("a.key") == F.col("b.key")) & before
            & (F.least(F.col("a.n"), F.col("b.n")) >= F.greatest(F.col("a.n"), F.col("b.n")) * similarity - 1e-9)
            & (F.least(F.abs(F.col("a.reach")), F.col("b.reach")) >= least) & (apart <= both - 2 * least))


def _places(joined: DataFrame) -> DataFrame:
    return joined.select("a.id", "a.line_no", F.col("b.id").alias("id2"), F.col("b.line_no").alias("line_no2")).distinct()


def earliest_candidates(firsts: DataFrame, similarity: float) -> DataFrame:
    """Places (id, line_no, id2, line_no2) of lines and the earliest line of one of their key groups, if it may be similar.

    The prefix that lines of one length need is enough here. Rows are shuffled once, for the groups and for the join,
    which hashes the groups: one row per key, and none for keys of one row.
    """
    needed = F.col("n") - F.ceil(F.col("n") * (2 * similarity / (1 + similarity)) - 1e-9).cast("int") + 1
    # None of these is null. The join would ask for that on its side only, and the rows would be shuffled twice.
    present = reduce(Column.__and__, [F.col(name).isNotNull() for name in ("n", *PARITIES)])
    rows = firsts.filter(present).withColumn("prefix", F.slice("prefix", F.lit(1), needed)).select(
        "id", "line_no", "n", *PARITIES, F.posexplode("prefix").alias("at", "key")).select(
        "key", *PARITIES, "id", "line_no", "n", _reach(F.col("n"), F.col("at")).alias("reach")).repartition("key")
    groups = rows.groupBy("key").agg(F.min(F.struct("id", "line_no", "n", *PARITIES, "reach")).alias("p"),
                                     F.count("*").alias("rows")).filter("rows > 1").select("key", "p.*")
    return _places(groups.hint("shuffle_hash").alias("a").join(rows.alias("b"), _alike(similarity)))


def _seen(rows: DataFrame, wanted: DataFrame, *key: str) -> DataFrame:
    """The rows with `seen`: whether their key occurs in `wanted`, true for a few others; a bit table of fixed size tells."""
    slot = F.pmod(F.xxhash64(*key), F.lit(FILTER_WORDS * 64))
    word = F.shiftright(slot, 6)
    marks = wanted.groupBy(word.alias("slot")).agg(F.bit_or(_one(slot)).alias("bits"))
    seen = F.element_at(F.col("table"), (word + 1).cast("int")).bitwiseAND(_one(slot)) != 0
    return rows.withColumn("table", _dense(marks, FILTER_WORDS, F.col("bits"), "long")).withColumn("seen", seen).drop("table")


def _sifted(rows: DataFrame, wanted: DataFrame, *key: str) -> DataFrame:
    """The rows whose key occurs in `wanted`, and a few others."""
    return _seen(rows, wanted, *key).filter("seen").drop("seen")


def open_candidates(firsts: DataFrame, closed: DataFrame, similarity: float) -> DataFrame:
    """Places (id, line_no, id2, line_no2) of each line that is not closed and all earlier ones that may be similar.

    The reach of closed lines is negative, so they are found but do not search;
    both sides of the join stay the same rows, which are shuffled once. Most lines are not closed, and a bit table says
    so for nearly all of them; only the others are shuffled with their prefixes to be joined with the closed ones.
    """
    place = ["id", "line_no", "line_hash"]
    marked = _seen(firsts, closed, *place)
    found = marked.filter("seen").join(closed.withColumn("closed", F.lit(True)), place, "left")
    flagged = marked.filter("not seen").withColumn("closed", F.lit(None).cast("boolean")).unionByName(found)
    rows = flagged.select("id", "line_no", "n", *PARITIES, "closed", F.posexplode("prefix").alias("at", "key"))
    reach = _reach(F.col("n"), F.col("at"))
    rows = rows.select("key", *PARITIES, "id", "line_no", "n",
                       F.when(F.col("closed"), -reach).otherwise(reach).alias("reach"))
    return _places(rows.alias("a").join(rows.alias("b"), _alike(similarity)))


def verified(pairs: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """(id, line_no, line_hash) of the later lines of pairs whose words are similar, stored.

    Only documents that occur in a pair are cut into lines, and only the text of lines that do is stored, for both
    sides of the pairs. What sifts them may let others pass; the joins then decide exactly.
    """
    places = pairs.select("id", "line_no").union(pairs.select("id2", "line_no2"))
    texts = _sifted(_lines(_sifted(_keyed(docs), places, "id")), places, "id", "line_no")
    sized = stored(texts.withColumn("n", F.size(words_of(F.col("line")))), "line-texts")
    other = sized.toDF("id2", "line_no2", "line2", "n2")
    both = pairs.join(sized, ["id", "line_no"]).select("id2", "line_no2", "line", "n").join(other, ["id2", "line_no2"])
    common = F.size(F.array_intersect(F.array_remove(_pieces(F.col("line")), ""), _pieces(F.col("line2"))))
    alike = both.filter(common >= F.ceil((F.col("n") + F.col("n2")) * (similarity / (1 + similarity)) - 1e-9))
    return stored(alike.select(F.col("id2").alias("id"), F.col("line_no2").alias("line_no"),
                               F.xxhash64("line2").alias("line_hash")).distinct(), "line-links")


def resembling_lines(docs: DataFrame, firsts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(id, line_no, line_hash) of first occurrences that resemble an earlier line."""
    closed = verified(stored(earliest_candidates(firsts, similarity), "line-pairs"), docs, similarity)
    return closed.union(verified(stored(open_candidates(firsts, closed, similarity), "line-pairs-open"), docs, similarity))


def kept_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Per id: kept and near, the numbers of lines that stay and of first occurrences that go as near matches.

    Lines without words are not listed, they always stay. What repeats an
    earlier line is in neither list.
    """
    firsts = first_lines(_keyed(docs), similarity)
    near = resembling_lines(docs, firsts, similarity).withColumn("near", F.lit(True))
    marked = firsts.select("id", "line_no", "line_hash").join(near, ["id", "line_no", "line_hash"], "left")
    numbers = lambda keep: F.sort_array(F.collect_list(F.when(keep, F.struct("line_no", "line_hash"))))
    return marked.groupBy("id").agg(numbers(F.col("near").isNull()).alias("kept"),
                                    numbers(F.col("near").isNotNull()).alias("near"))


def line_digest(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Per document: n_lines, n_near and the numbers of the lines that stay, from 0."""
    text = F.split(whole_text(), "\n", -1)
    blank = F.array_compact(F.transform(text, lambda x, i: F.when(~F.regexp_like(x, F.lit(WORD)), i)))
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("id"), F.size(text).cast("long").alias("n_lines"),
                       blank.alias("blank"))
    found = kept_lines(docs, similarity)
    numbers = F.transform(F.coalesce("kept", F.array().cast("array<struct<line_no:int,line_hash:bigint>>")),
                          lambda x: x["line_no"])
    return rows.join(found, "id", "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("near"), F.lit(0)).cast("long").alias("n_near"),
        F.sort_array(F.array_distinct(F.concat("blank", numbers))).alias("kept_lines"))


def without_repeated_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents, all columns, with what is left of their text and its n_chars."""
    found = kept_lines(docs, similarity).select(F.col("id").alias("_llm_id"), F.col("kept").alias("_llm_kept"))
    keyed = docs.withColumn("_llm_key", F.coalesce("doc_id", F.lit(LAST)))
    both = keyed.join(found, F.col("_llm_key") == F.col("_llm_id"), "left")
    lines = F.transform(F.split(whole_text(), "\n", -1),
                        lambda x, i: F.struct(x.alias("line"), i.alias("line_no"), F.xxhash64(x).alias("line_hash")))
    stays = F.array_join(F.transform(F.filter(lines, lambda x: ~F.regexp_like(x["line"], F.lit(WORD)) | F.coalesce(
        F.array_contains("_llm_kept", F.struct(x["line_no"].alias("line_no"), x["line_hash"].alias("line_hash"))),
        F.lit(False))), lambda x: x["line"]), "\n")
    out = both.withColumn("_llm_text", stays)
    return out.withColumns({"text": F.col("_llm_text"), "n_chars": F.length("_llm_text").cast("long")}).select(*docs.columns)


ORACLE = r"""
WITH cut AS (SELECT coalesce(doc_id, 9223372036854775807) AS id, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts
             FROM documents),
     l AS (SELECT id, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS line_no FROM cut),
     w AS (SELECT id, line_no, line, list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
           FROM l),
     f AS (SELECT row_number() OVER (ORDER BY id, line_no) AS r, * FROM (
               SELECT arg_min(id, (id, line_no)) AS id, arg_min(line_no, (id, line_no)) AS line_no, line,
                      any_value(words) AS words, len(any_value(words)) AS n
               FROM w WHERE len(words) > 0 GROUP BY line)),
     x AS (SELECT r, n, unnest(words) AS word FROM f),
     c AS (SELECT word, count(*) AS often FROM x GROUP BY word),
     o AS (SELECT r, n, word, row_number() OVER (PARTITION BY r ORDER BY often, word) AS place FROM x JOIN c USING (word)),
     p AS (SELECT r, n, word FROM o WHERE place <= n - ceil(0.8 * n - 1e-9) + 1),
     pairs AS (SELECT DISTINCT a.r AS r, b.r AS later FROM p a JOIN p b ON a.word = b.word AND a.r < b.r
               AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
     near AS (SELECT DISTINCT later AS r FROM pairs JOIN f a USING (r) JOIN f b ON b.r = later
              WHERE len(list_intersect(a.words, b.words)) >= 0.8 / 1.8 * (a.n + b.n) - 1e-9),
     m AS (SELECT id, line_no, near.r IS NOT NULL AS gone FROM f LEFT JOIN near USING (r)),
     kept AS (SELECT DISTINCT id, line_no FROM m WHERE NOT gone
              UNION SELECT id, line_no FROM w WHERE len(words) = 0),
     k AS (SELECT id, string_agg(line_no, ',' ORDER BY line_no) AS kept_lines FROM kept GROUP BY id),
     g AS (SELECT id, count(*) AS n_near FROM m WHERE gone GROUP BY id)
SELECT doc_id, len(parts) AS n_lines, coalesce(n_near, 0) AS n_near, coalesce(kept_lines, '') AS kept_lines
FROM cut LEFT JOIN k USING (id) LEFT JOIN g USING (id)
"""
