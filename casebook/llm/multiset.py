"""Document fingerprints as a homomorphic multiset hash (operator 5; DataFrame functions only).

A document is the multiset of its paragraphs (lines). Each paragraph hashes to one wide vector and
the document's fingerprint is the sum of the vectors of its paragraphs, lane by lane modulo a power
of two. Order of paragraphs is irrelevant; a paragraph is inserted or deleted by adding or
subtracting its vector (``combine``), without the rest of the text. A vector has

* ``EQUALITY_LANES`` lanes modulo 2**32, the words of the paragraph's SHA-256: equal sums mean
  equal multisets, up to collisions of a 256-bit hash;
* ``LIKENESS_LANES`` lanes modulo 2**16: every word begins a run of up to ``RUN_WORDS`` words of its
  paragraph (runs overlap), and each run adds +1 or -1 to one lane, which a hash of its words' CRC-32 picks. As
  the lanes add up over shared runs and cancel over others, the cosine of two fingerprints estimates the share
  of runs that two documents have in common (standard error about 1 / sqrt(LIKENESS_LANES)). A word put in or
  taken out touches only the runs that hold it.

Nulls: a null text is the empty document (one empty paragraph), a null id sorts last. Rows that
repeat an id and text are one document in the order "next document", and each keeps its own
result row. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.common import text_of
from casebook.session import stage

EQUALITY_LANES, EQUALITY_BITS = 8, 32
LIKENESS_LANES, LIKENESS_BITS = 128, 16
RUN_WORDS = 4

#: A word, or the end of a paragraph.
TOKEN_PATTERN = r"[^\n \t\x0B\f\r]+|\n"
#: Factors of the first, second, ... word of a run, and the prime that their sum is taken modulo.
FACTORS = (268435399, 181081817, 120721211, 80480807)
PRIME = 2147483647


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row (not once a use)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def equality_lanes(text: Column) -> Column:
    """Sums modulo 2**32 of the eight words of each paragraph's SHA-256: array<long>."""
    digests = F.transform(F.split(text, "\n"), lambda p: F.sha2(p, 256))

    def lane(digests: Column, i: Column) -> Column:
        return F.aggregate(
            digests, F.lit(0).cast("long"),
            lambda total, d: (total + F.conv(F.substring(d, i * 8 + 1, F.lit(8)), 16, 10).cast("long")) % (1 << EQUALITY_BITS))

    return let(digests, lambda ds: F.transform(F.sequence(F.lit(0), F.lit(EQUALITY_LANES - 1)), lambda i: lane(ds, i)))


def run_codes(text: Column) -> Column:
    """For each word the code of the run that it begins, array<long>: its lane, plus LIKENESS_LANES if its sign is minus."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0)
    hashes = F.transform(tokens, lambda w: F.when(w != "\n", F.crc32(w.cast("binary"))))

    def run(h: Column, i: Column, n: int = 0) -> Column:
        own = F.get(h, i + n) * F.lit(FACTORS[n])
        if n == RUN_WORDS - 1:
            return own
        # The end of the paragraph or of the text is null and ends the run.
        return own + F.coalesce(run(h, i, n + 1), F.lit(0).cast("long"))

    codes = let(hashes, lambda h: F.transform(h, lambda _, i: run(h, i) % F.lit(PRIME) % F.lit(2 * LIKENESS_LANES)))
    return F.filter(codes, lambda c: c.isNotNull())


def likeness_lanes(text: Column) -> Column:
    """Signed counts of the text's word runs in LIKENESS_LANES lanes: array<int>.

    Codes are sorted together with one mark before each code, so the places of the marks give the counts."""
    codes = 2 * LIKENESS_LANES
    marked = F.concat(F.transform(run_codes(text), lambda c: (2 * c + 1).cast("int")), F.transform(F.sequence(F.lit(0), F.lit(codes)), lambda c: 2 * c))
    places = F.filter(F.transform(F.sort_array(marked), lambda v, i: F.when(v % 2 == 0, i)), lambda i: i.isNotNull())

    def net(p: Column, lane: Column) -> Column:
        plus = F.get(p, lane + 1) - F.get(p, lane)
        minus = F.get(p, lane + LIKENESS_LANES + 1) - F.get(p, lane + LIKENESS_LANES)
        return (plus - minus).cast("int")

    return let(places, lambda p: F.transform(F.sequence(F.lit(0), F.lit(LIKENESS_LANES - 1)), lambda i: net(p, i)))


def fingerprint(text: Column) -> Column:
    """struct(same array<long>, like array<int>) of a text."""
    return F.struct(equality_lanes(text).alias("same"), likeness_lanes(text).alias("like"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of the union (sign 1) or difference (sign -1) of two paragraph multisets."""
    same = F.zip_with(a["same"], b["same"], lambda x, y: F.pmod(x + sign * y, F.lit(1 << EQUALITY_BITS)))
    like = F.zip_with(a["like"], b["like"], lambda x, y: (x + sign * y).cast("int"))
    return F.struct(same.alias("same"), like.alias("like"))


def as_text(fp: Column) -> Column:
    """Lower-case hex of all lanes, the likeness lanes modulo 2**16."""
    same = F.transform(fp["same"], lambda x: F.lpad(F.hex(x), EQUALITY_BITS // 4, "0"))
    like = F.transform(fp["like"], lambda x: F.lpad(F.hex(F.pmod(x, F.lit(1 << LIKENESS_BITS))), LIKENESS_BITS // 4, "0"))
    return F.lower(F.concat(F.array_join(same, ""), F.array_join(like, "")))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints; else the cosine of the likeness lanes, 0 where it is negative or a
    document has no word."""
    dot = F.aggregate(F.zip_with(a["like"], b["like"], lambda x, y: x.cast("long") * y), F.lit(0).cast("long"), lambda s, x: s + x)
    norm = lambda v: F.aggregate(v["like"], F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x)
    scale = F.sqrt(norm(a).cast("double")) * F.sqrt(norm(b).cast("double"))
    cosine = F.when(scale > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot / scale))).otherwise(F.lit(0.0))
    return F.when((a["same"] == b["same"]) & (a["like"] == b["like"]), F.lit(1.0)).otherwise(cosine)


def next_documents(keys: DataFrame) -> DataFrame:
    """``(_key, _next)`` over distinct ``(doc_id, _key)``: the next in descending order, cyclic.

    Only ids and keys are ordered, in ranges; the next of a range's last row is the first of the
    following range, found over one row per range (as many as there are shuffle partitions)."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("_key").desc()]
    ranges = stage(keys.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    inside = ranges.withColumn("_after", F.lead("_key").over(Window.partitionBy("_range").orderBy(*order)))
    heads = ranges.groupBy("_range").agg(F.max(F.struct("doc_id", "_key"))["_key"].alias("_head"))
    across = Window.orderBy("_range")
    heads = heads.select("_range", F.coalesce(F.lead("_head").over(across), F.first("_head").over(across)).alias("_following"))
    return inside.join(heads, "_range").select("_key", F.coalesce("_after", "_following").alias("_next"))


def edited_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, _key, _copies, _next, text, edited)``: one row per distinct document with its
    edited text. Texts are shuffled once by key (both uses below read the same columns, so that
    Spark reuses the exchange); only the third that replaces the end of another document travels
    again. What else is known of a document comes from the narrow table."""
    body = text_of(docs)
    keyed = body.withColumn("_key", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text"))))
    light = stage(keyed.groupBy("doc_id", "_key").agg(F.max(F.length("text")).alias("n"), F.count(F.lit(1)).alias("_copies")))
    follows = stage(next_documents(light.select("doc_id", "_key")))
    wanted = follows.join(light.select("_key", "n"), "_key").select(
        F.col("_next").alias("_key"), F.col("_key").alias("_for"), F.floor(F.col("n") / 3).cast("int").alias("_take"))
    same = Window.partitionBy("_key").orderBy("_key")
    single = (keyed.select("_key", "text").withColumn("_earlier", F.lag(F.lit(1)).over(same))
              .filter(F.col("_earlier").isNull()).drop("_earlier"))
    ends = single.join(wanted, "_key").select(
        F.col("_for").alias("_key"), F.col("_key").alias("_next"), F.expr("substring(text, 1, _take)").alias("_end"))
    return (single.join(ends, "_key").join(light.select("doc_id", "_key", "_copies"), "_key")
            .withColumn("edited", F.expr("concat(substring(text, 1, length(text) - cast(floor(length(text) / 3) as int)), _end)"))
            .drop("_end"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Contract rows: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next."""
    made = stage(edited_documents(docs).select(
        "doc_id", "_key", "_next", "_copies", F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("_own"),
        fingerprint(F.col("edited")).alias("_edited")))
    other = made.select(F.col("_key").alias("_next"), F.col("_own").alias("_other"))
    own, edited = F.col("_own"), F.col("_edited")
    return made.join(other, "_next").select(
        "doc_id", "n_chars", "edited_sha256", as_text(own).alias("fingerprint"), as_text(edited).alias("edited_fingerprint"),
        likeness(own, edited).alias("near_edited"), likeness(own, F.col("_other")).alias("near_next"),
        F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))).alias("_copy")).drop("_copy")
