"""Notes: word counts, cleaning, long tokens, TF-IDF, k-means clusters.

Tokens are arrays built by Column regex functions (no per-row Python). TF-IDF is relational: a
long ``(doc, term, tf)`` table, document frequencies by aggregate, sklearn's smoothed idf
``ln((1+n)/(1+df)) + 1`` and per-document L2 norms. k-means runs Lloyd's steps as joins on the
term key over that long table (sparse vectors never densify), with a reliable checkpoint every few
iterations to bound lineage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.columns import hex_prefix_int
from casebook.functions.rules import (EXTRA_STOP_WORDS, GERMAN_STOP_WORDS, MIN_TOKEN_LENGTH,
                                      RE_SINGLE_LETTER_EMBEDDING, RE_TAGS, SINGLE_LETTER)
from casebook.operators import neighbours  # noqa: F401  (registers the package for by-value pickling)
from casebook.operators.cohort import rank_by_hash
from casebook.operators.dates import entry_order
from casebook.operators.joins import BROADCAST_ROWS, SALT
from casebook.schema import PATIENT
from casebook.session import stage

WORD = r"[\p{L}\p{N}_]+"
WS = r"(?U)\s"


def german_stop_words() -> list[str]:
    """The public German stop-word list plus the domain words of the reference."""
    return GERMAN_STOP_WORDS + EXTRA_STOP_WORDS


# ---------------------------------------------------------------- T1: word count per patient


def patient_word_count(df: DataFrame, order: tuple[str, ...] | None = None, typ: str = "A") -> DataFrame:
    """Whitespace-separated words of each patient's anamnesis rows joined by ','.

    The joined document is never built. For non-empty rows r1..rn joined by ',', the word count is
    Σ runs(ri) + Σ ends_ws(ri) + Σ starts_ws(ri) − ends_ws(rn) − starts_ws(r1) − n + 1 (a ',' glues
    the words around it unless a blank touches it). Every term is an aggregate — partial
    aggregation, so a patient with a huge share of the rows is reduced map-side."""
    rows = df.filter((F.col("TYP") == typ) & F.col("TEXT").isNotNull() & (F.length("TEXT") > 0))
    runs = F.size(F.regexp_extract_all(F.col("TEXT"), F.lit(r"(?U)\S+"), 0))
    ends = F.col("TEXT").rlike(WS + "$").cast("int")
    starts = F.col("TEXT").rlike("^" + WS).cast("int")
    key = F.struct(*order) if order else entry_order()
    per = rows.select(PATIENT, runs.alias("r"), ends.alias("e"), starts.alias("s"), key.alias("k")).groupBy(PATIENT).agg(
        F.sum("r").alias("r"), F.sum("e").alias("e"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("n"),
        F.max_by("e", "k").alias("e_last"), F.min_by("s", "k").alias("s_first"))
    wc = F.col("r") + F.col("e") + F.col("s") - F.col("e_last") - F.col("s_first") - F.col("n") + 1
    return per.select(PATIENT, wc.cast("bigint").alias("notes_word_count"), F.col("n").alias("n_notes"))


# ---------------------------------------------------------------- T2/T3: cleaning and tokens


def clean_tokens(text: str | Column, stem: bool = True, for_embedding: bool = False) -> Column:
    """Tags → blank; tokens are word runs (letters, digits, '_'), lower-cased; single letters and
    German stop words (+ domain words) removed; stemmed (as the reference always does) unless
    ``stem`` is off. ``for_embedding`` keeps case, stop words, stems and the punctuation marks
    , . ! ? as tokens, but drops single letters and marks that stand inside a word."""
    c = F.col(text) if isinstance(text, str) else text
    no_tags = F.regexp_replace(F.coalesce(c, F.lit("")), RE_TAGS, " ")
    if for_embedding:
        return F.regexp_extract_all(F.regexp_replace(no_tags, "(?U)" + RE_SINGLE_LETTER_EMBEDDING, " "), F.lit(WORD + r"|[,.!?]"), 0)
    toks = _kept(F.regexp_extract_all(F.lower(no_tags), F.lit(WORD), 0))
    return F.transform(toks, german_stem) if stem else toks


def _kept(words: Column) -> Column:
    """Words that are neither stop words (looked up in one hash set) nor single letters."""
    stops = german_stop_words()
    return F.filter(words, lambda t: ~t.isin(stops) & ((F.length(t) != 1) | ~t.rlike(f"^{SINGLE_LETTER}$")))


def clean_long_tokens(text: str | Column, stem: bool = True, min_length: int = MIN_TOKEN_LENGTH) -> Column:
    """T2 + T3: ``long_tokens(clean_tokens(text))``. A stem is never longer than its word with ß as ss, so shorter words
    go before they are looked up and stemmed."""
    c = F.col(text) if isinstance(text, str) else text
    words = F.regexp_extract_all(F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), RE_TAGS, " ")), F.lit(WORD), 0)
    if not stem:
        return _kept(long_tokens(words, min_length))
    may = F.filter(words, lambda t: F.length(F.replace(t, F.lit("ß"), F.lit("ss"))) >= min_length)
    return long_tokens(F.transform(_kept(may), german_stem), min_length)


def long_tokens(tokens: str | Column, min_length: int = MIN_TOKEN_LENGTH) -> Column:
    """Keep tokens longer than 8 characters."""
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.filter(c, lambda t: F.length(t) >= min_length)


_V = "aeiouyäöü"
#: The endings that the stemmer's steps take off; no step touches a word without one of them.
RE_ENDING = "(?:e|em|en|er|ern|es|[bdfghklmnrt]s|st|isch|lich|heit|keit|end|ung|ig|ik)$"


def _region_start(w: Column) -> Column:
    """Start (0-based) of the Snowball region after the first non-vowel that follows a vowel."""
    m = F.regexp_extract(w, f"^.*?[{_V}][^{_V}]", 0)
    return F.when(F.length(m) == 0, F.length(w)).otherwise(F.length(m))


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times in ``body`` (a one-element ``transform``), so
    chained rules do not copy earlier steps into every later reference."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _chop(word: Column, k) -> Column:
    return word.substr(F.lit(1), F.length(word) - k)


def _first(word: Column, cases: list[tuple[Column, Column]]) -> Column:
    """The result of the first case whose condition holds, else the word."""
    out = None
    for cond, value in cases:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(word)


def _ends(word: Column, suffix: str, region: Column) -> Column:
    """Does the word end in the suffix, all of it in the region that starts at ``region``?"""
    return word.endswith(suffix) & (F.length(word) - len(suffix) >= region)


def _step1(w: Column, r1: Column) -> Column:
    cases = [(_ends(w, suf, r1), _chop(w, len(suf))) for suf in ("ern", "em", "er")]
    for suf in ("en", "es", "e"):
        cases.append((_ends(w, suf, r1), F.when(w.endswith("niss" + suf), _chop(w, len(suf) + 1)).otherwise(_chop(w, len(suf)))))
    cases.append((_ends(w, "s", r1) & w.rlike("[bdfghklmnrt]s$"), _chop(w, 1)))
    return _first(w, cases)


def _step2(w: Column, r1: Column) -> Column:
    cases = [(_ends(w, suf, r1), _chop(w, len(suf))) for suf in ("est", "en", "er")]
    cases.append((_ends(w, "st", r1) & w.rlike("[bdfghklmnt]st$") & (F.length(w) >= 6), _chop(w, 2)))
    return _first(w, cases)


def _step3(w: Column, r1: Column, r2: Column) -> Column:
    n = F.length(w)

    def no_e_before(k: int) -> Column:
        """No 'e' in R2 right before the last k letters."""
        return ~((n - k - 1 >= r2) & (w.substr(n - k, F.lit(1)) == "e"))

    cases = [(_ends(w, "isch", r2), F.when(no_e_before(4), _chop(w, 4)).otherwise(w))]
    for suf in ("lich", "heit"):
        er_en = _ends(w, "er" + suf, r1) | _ends(w, "en" + suf, r1)
        cases.append((_ends(w, suf, r2), F.when(er_en, _chop(w, 6)).otherwise(_chop(w, 4))))
    cases.append((_ends(w, "keit", r2), F.when(_ends(w, "lichkeit", r2), _chop(w, 8)).when(_ends(w, "igkeit", r2), _chop(w, 6))
                  .otherwise(_chop(w, 4))))
    for suf in ("end", "ung"):
        cases.append((_ends(w, suf, r2), F.when(_ends(w, "ig" + suf, r2) & no_e_before(5), _chop(w, 5)).otherwise(_chop(w, 3))))
    for suf in ("ig", "ik"):
        cases.append((_ends(w, suf, r2), F.when(no_e_before(2), _chop(w, 2)).otherwise(w)))
    return _first(w, cases)


def german_stem(word: Column) -> Column:
    """Snowball's German stemmer as Column expressions: ß → ss; u and y between vowels are consonants;
    regions R1 (at least three letters before it) and R2; steps 1-3; umlauts lose their dots. Words without any
    ending that a step takes off skip regions and steps."""
    sharp = F.replace(word, F.lit("ß"), F.lit("ss"))
    return F.when(word.rlike(RE_ENDING), _stem_steps(sharp)).otherwise(F.translate(sharp, "äöüUY", "aouuy"))


def _consonants(word: Column, letter: str) -> Column:
    """``letter`` (u or y) in upper case where it stands between vowels."""
    return let(word, lambda w: F.when(w.contains(letter), F.regexp_replace(
        w, f"([{_V}]){letter}(?=[{_V}])", f"$1{letter.upper()}")).otherwise(w))


def _stem_steps(sharp: Column) -> Column:
    marked = _consonants(_consonants(sharp, "u"), "y")
    return let(marked, lambda w: let(
        _region_start(w), lambda r: let(
            F.greatest(r, F.lit(3)), lambda r1: let(
                r + _region_start(w.substr(r + 1, F.lit(1 << 20))), lambda r2: let(
                    _step1(w, r1), lambda s1: let(
                        _step2(s1, r1), lambda s2: F.translate(_step3(s2, r1, r2), "äöüUY", "aouuy")))))))


def notes(df: DataFrame, doc: str, text: str, stem: bool = True) -> DataFrame:
    """T2/T3 per document: ``tokens`` (cleaned) and ``long_tokens``, plus ``comment_clean``."""
    toks = clean_tokens(text, stem=stem)
    return (df.select(doc, toks.alias("tokens"), clean_long_tokens(text, stem=stem).alias("long_tokens"))
            .withColumn("comment_clean", F.array_join("long_tokens", " ")))


# ---------------------------------------------------------------- T4: TF-IDF


def ngrams(tokens: str | Column, n_max: int = 2) -> Column:
    """Unigrams then bigrams of consecutive tokens (sklearn's word n-grams, range (1, 2))."""
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    if n_max == 1:
        return c
    bigrams = F.transform(F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))),
                          lambda x, i: F.concat(x, F.lit(" "), F.element_at(c, i + 2)))
    return F.concat(c, bigrams)


def tfidf(docs: DataFrame, doc: str, tokens: str, min_df: int = 10, max_df: float = 0.3, n_max: int = 2) -> DataFrame:
    """T4: long ``(doc, term, weight)``; terms in at least ``min_df`` documents and at most
    ``max_df``·n documents; weight = tf·(ln((1+n)/(1+df)) + 1), L2-normalised per document."""
    n = docs.agg(F.count(F.lit(1))).scalar()  # number of documents, a scalar subquery
    terms = docs.select(doc, F.explode(ngrams(tokens, n_max)).alias("term"))
    return weigh_terms(terms, doc, n, min_df, max_df)


def weigh_terms(terms: DataFrame, doc: str, n: Column, min_df: int = 10, max_df: float = 0.3) -> DataFrame:
    """TF-IDF weights from a long ``(doc, term)`` occurrence table and the document count ``n``.

    Occurrences are counted once (staged). Terms of more than ``max_df`` of the documents go before the join: their
    number is at most the mean vocabulary of a document divided by ``max_df``. What remains may still stand in
    nearly that share of the documents, so it joins in ``SALT`` parts."""
    tf = stage(terms.groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf")))
    dfs = stage(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    frequent = dfs.filter(F.col("df") > n * F.lit(max_df)).select("term")
    few = frequent.count()
    left = tf.join(F.broadcast(frequent) if few <= BROADCAST_ROWS else frequent, "term", "left_anti") if few else tf
    vocab = (dfs.filter((F.col("df") >= min_df) & (F.col("df") <= n * F.lit(max_df)))
             .select("term", (F.log((n + 1) / (F.col("df") + 1)) + 1).alias("idf")))
    w = salted_join(left, vocab, "term", doc).select(doc, "term", (F.col("tf") * F.col("idf")).alias("w"))
    norms = w.groupBy(doc).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    return w.join(norms, doc).select(doc, "term", (F.col("w") / F.col("_norm")).alias("weight"))


def salted_join(many: DataFrame, few: DataFrame, key: str, spread: str) -> DataFrame:
    """``many`` joined with ``few`` on ``key``, each key in SALT parts by the hash of ``spread``; no key gathers all
    of its rows in one task."""
    salt = F.pmod(F.xxhash64(spread), F.lit(SALT)).cast("int")
    copies = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return many.withColumn("_salt", salt).join(copies, [key, "_salt"]).drop("_salt")


def patient_terms(df: DataFrame, stem: bool = True, typ: str = "A") -> tuple[DataFrame, Column]:
    """T1-T4 per patient: the terms of the patient's notes joined in entry order (unigrams and
    bigrams of long tokens, including the bigram that spans two consecutive notes), without
    building the joined document.

    The previous non-empty note of a row is found in two bounded steps: a lag inside
    (patient, day), and for the first note of a day a lag over per-day summaries (one row per
    patient and day). No window covers all rows of a patient, so a very active patient does not
    end up in one task. Returns the ``(PATIENT_HASH, term)`` occurrences and the document count."""
    rows = df.filter((F.col("TYP") == typ) & F.col("TEXT").isNotNull())
    n_docs = rows.select(PATIENT).distinct().agg(F.count(F.lit(1))).scalar()
    lt = clean_long_tokens("TEXT", stem=stem)
    notes_ = (rows.select(PATIENT, "entry_date", "entry_id", lt.alias("lt")).filter(F.size("lt") > 0)
              .withColumn("_first", F.element_at("lt", 1)).withColumn("_last", F.element_at("lt", -1)))
    in_day = Window.partitionBy(PATIENT, "entry_date").orderBy("entry_id")
    notes_ = notes_.withColumn("_prev", F.lag("_last").over(in_day))
    days = notes_.groupBy(PATIENT, "entry_date").agg(F.max_by("_last", "entry_id").alias("_day_last"))
    over_days = Window.partitionBy(PATIENT).orderBy(F.col("entry_date").isNull(), "entry_date")
    days = days.withColumn("_prev_day", F.lag("_day_last").over(over_days)).drop("_day_last")
    days = days.withColumnRenamed(PATIENT, "_p").withColumnRenamed("entry_date", "_d")
    notes_ = notes_.join(days, (F.col(PATIENT) == F.col("_p")) & F.col("entry_date").eqNullSafe(F.col("_d")),
                         "left").drop("_p", "_d")
    prev = F.coalesce(F.col("_prev"), F.col("_prev_day"))
    cross = F.when(prev.isNotNull(), F.array(F.concat(prev, F.lit(" "), F.col("_first")))).otherwise(F.array())
    terms = notes_.select(PATIENT, F.explode(F.concat(ngrams("lt"), cross)).alias("term"))
    return terms, n_docs


# ---------------------------------------------------------------- T5: k-means on the long table


def initial_centres(vectors: DataFrame, doc: str, k: int, seed: int = 0) -> DataFrame:
    """The k documents (with a non-empty vector) first by md5(seed ':' doc) — a deterministic start."""
    docs = vectors.select(doc).distinct().withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(doc).cast("string"))))
    first = docs.orderBy("_h").limit(k)  # k rows: a top-k, not a cap on the data
    ranked = first.select(doc, F.row_number().over(Window.orderBy("_h")).alias("c"))  # k rows
    return (vectors.join(ranked, doc).select((F.col("c") - 1).alias("cluster"), "term", "weight"))


def spread_centres(vectors: DataFrame, doc: str, k: int, seed: int = 0) -> DataFrame:
    """k-means++ start: each next centre is a document drawn with probability proportional to its squared
    distance from the nearest centre so far. The draw is a race of exponential times, u from the
    document's md5 (one aggregate a round, reproducible). Fewer than k distinct vectors give fewer."""
    unit = F.col("u")
    docs = vectors.select(doc).distinct().withColumn("d", F.lit(2.0))  # unit vectors are within sqrt(2)
    now, chosen = stage(docs), []
    for i in range(k):
        draw = (hex_prefix_int(F.md5(F.concat(F.lit(f"{seed}:{i}:"), F.col(doc).cast("string"))), 12) + 1) / F.lit(float(1 << 48) + 1)
        race = now.filter(F.col("d") > 1e-9).withColumn("u", draw).withColumn("t", -F.log(unit) / F.col("d"))
        first = race.agg(F.min_by(doc, F.struct("t", doc)).alias("c")).first()["c"]
        if first is None:
            break
        chosen.append(first)
        centre = vectors.filter(F.col(doc) == F.lit(first)).select("term", F.col("weight").alias("cw"))
        dots = vectors.join(centre, "term").groupBy(doc).agg(F.sum(F.col("weight") * F.col("cw")).alias("dot"))
        now = stage(now.join(dots, doc, "left").select(doc, F.least("d", F.greatest(F.lit(0.0), 2 - 2 * F.coalesce("dot", F.lit(0.0)))).alias("d")))
    number = F.array_position(F.array(*[F.lit(c) for c in chosen]), F.col(doc)) - 1  # at most k ids
    return vectors.filter(F.col(doc).isin(chosen)).select(number.cast("int").alias("cluster"), "term", "weight")


def assign(vectors: DataFrame, all_docs: DataFrame, centres: DataFrame, doc: str) -> DataFrame:
    """One assignment step: nearest centre by squared distance |c|² − 2·x·c (|x| is constant per
    doc), ties to the lowest centre id.

    Only (doc, centre) pairs that share a term are formed (a join on the term key). A centre sharing
    no term with a doc is at |c|²; one extra candidate per doc — the smallest-norm centre at its
    plain |c|² — covers all of them exactly, because a centre that does share terms is never worse
    than its own |c|² (weights are non-negative). No docs × centres grid is built."""
    cnorm = centres.groupBy("cluster").agg(F.sum(F.col("weight") * F.col("weight")).alias("cn"))
    # Centres may share a term that stands in many documents: broadcast if counted to be small, else joined in parts.
    named = centres.withColumnRenamed("weight", "cw")
    met = vectors.join(F.broadcast(named), "term") if centres.count() <= BROADCAST_ROWS else salted_join(vectors, named, "term", doc)
    dots = (met.groupBy(doc, "cluster").agg(F.sum(F.col("weight") * F.col("cw")).alias("dot")))
    shared = dots.join(cnorm, "cluster").select(doc, "cluster", (F.col("cn") - 2 * F.col("dot")).alias("d"))
    fallback = cnorm.agg(F.min(F.struct(F.round("cn", 9).alias("d"), F.col("cluster").alias("c")))).scalar()
    plain = all_docs.select(doc, fallback.getField("c").alias("cluster"), fallback.getField("d").alias("d"))
    cand = shared.unionByName(plain)
    best = cand.groupBy(doc).agg(F.min(F.struct(F.round("d", 9).alias("d"), F.col("cluster").alias("c"))).alias("b"))
    return best.select(doc, F.col("b.c").alias("cluster"))


def update(vectors: DataFrame, assignment: DataFrame, doc: str, centres: DataFrame) -> DataFrame:
    """Mean of member vectors per cluster (sparse: sum of weights per term / member count). A cluster
    without members keeps its centre."""
    sizes = assignment.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"))
    sums = vectors.join(assignment, doc).groupBy("cluster", "term").agg(F.sum("weight").alias("s"))
    moved = sums.join(sizes, "cluster").select("cluster", "term", (F.col("s") / F.col("m")).alias("weight"))
    return moved.unionByName(centres.join(sizes, "cluster", "left_anti").select("cluster", "term", "weight"))


def cluster_notes(vectors: DataFrame, all_docs: DataFrame, doc: str, k: int = 15, max_iter: int = 100,
                  seed: int = 0) -> DataFrame:
    """T5: k-means++ start, then Lloyd's iterations (k = 15, up to 100, one start) on the TF-IDF long
    table. Stops when no document changes cluster. A vocabulary of at most ``BROADCAST_ROWS`` terms (counted) makes
    the centres small arrays: documents are packed once to a row each, and an iteration is one pass over them. With more
    terms every step is a join on the term key and centres are staged in every iteration."""
    vectors = stage(vectors)
    terms = vectors.select("term").distinct()
    if 0 < terms.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return _packed_clusters(vectors, stage(terms), all_docs, doc, k, max_iter, seed)
    centres = stage(spread_centres(vectors, doc, k, seed))
    current = stage(assign(vectors, all_docs, centres, doc))
    for _ in range(1, max_iter):
        centres = stage(update(vectors, current, doc, centres))
        nxt = stage(assign(vectors, all_docs, centres, doc))
        changed = nxt.join(current.withColumnRenamed("cluster", "_old"), doc).filter(F.col("cluster") != F.col("_old")).count()
        current = nxt
        if changed == 0:
            break
    return current


def _pack(vectors: DataFrame, terms: DataFrame, doc: str) -> DataFrame:
    """(doc, ids, weights), staged: a row a document, terms numbered from 0; a row is no longer than the vocabulary."""
    numbers = rank_by_hash(terms.withColumn("_h", F.md5("term")), [], "_h", "_n").select("term", (F.col("_n") - 1).cast("int").alias("n"))
    entries = vectors.join(F.broadcast(numbers), "term").groupBy(doc).agg(F.sort_array(F.collect_list(F.struct("n", "weight"))).alias("v"))
    return stage(entries.select(doc, F.col("v.n").alias("ids"), F.col("v.weight").alias("weights")))


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, weights, start of each row) of a batch; no row is empty."""
    ids, weights = batch.column("ids"), batch.column("weights")
    starts = ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()
    return ids.flatten().to_numpy(zero_copy_only=False), weights.flatten().to_numpy(zero_copy_only=False), starts


def _dots(ids: np.ndarray, weights: np.ndarray, starts: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(row, centre) inner products."""
    return np.stack([np.add.reduceat(weights * c[ids], starts) for c in centres], axis=1)


def _nearest(ids: np.ndarray, weights: np.ndarray, starts: np.ndarray, centres: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return np.round(norms - 2 * _dots(ids, weights, starts, centres), 9).argmin(axis=1)


def _packed_start(packed: DataFrame, doc: str, size: int, k: int, seed: int) -> np.ndarray:
    """``spread_centres`` over packed rows: (centre, term) weights; one pass a round."""
    centres = np.zeros((0, size))
    for i in range(k):
        draw = (hex_prefix_int(F.md5(F.concat(F.lit(f"{seed}:{i}:"), F.col(doc).cast("string"))), 12) + 1) / F.lit(float(1 << 48) + 1)

        def run(batches: Iterator[pa.RecordBatch], centres=centres) -> Iterator[pa.RecordBatch]:
            for batch in filter(len, batches):
                d = np.full(len(batch), 2.0)  # unit vectors are within sqrt(2)
                if len(centres):
                    d = np.minimum(d, np.maximum(0.0, 2 - 2 * _dots(*_lists(batch), centres)).min(axis=1))
                far = np.flatnonzero(d > 1e-9)
                if len(far):
                    t = -np.log(batch.column("u").to_numpy()[far]) / d[far]
                    ties = far[t == t.min()]
                    at = pa.array([min(ties.tolist(), key=lambda r: batch.column(0)[r].as_py())])
                    yield pa.RecordBatch.from_arrays([*[c.take(at) for c in batch.columns[:3]], pa.array([t.min()])], names=[*batch.schema.names[:3], "t"])

        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in packed.schema.fields)
        race = packed.select(doc, "ids", "weights", draw.alias("u")).mapInArrow(run, f"{kinds}, t double")
        first = race.agg(F.min_by(F.struct("ids", "weights"), F.struct("t", doc)).alias("c")).first()["c"]
        if first is None:
            break
        row = np.zeros((1, size))
        row[0, first["ids"]] = first["weights"]
        centres = np.vstack([centres, row])
    return centres


def _packed_pass(packed: DataFrame, centres: np.ndarray, norms: np.ndarray, before: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, int]:
    """One job: (members, sums of their weights) of every centre's cluster, and how many rows had another nearest centre
    ``before``. A task sums up its rows; what reaches the driver is centres x terms."""
    k, size = centres.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, members, changed = np.zeros(k * size), np.zeros(k, dtype=np.int64), 0
        for batch in filter(len, batches):
            ids, weights, starts = _lists(batch)
            now = _nearest(ids, weights, starts, centres, norms)
            if before is not None:
                changed += int((_nearest(ids, weights, starts, *before) != now).sum())
            members += np.bincount(now, minlength=k)
            np.add.at(sums, np.repeat(now, np.diff(np.append(starts, len(ids)))) * size + ids, weights)
        parts = [np.flatnonzero(sums[c * size:(c + 1) * size]) for c in range(k)]
        if members.any():
            yield pa.RecordBatch.from_pydict({
                "cluster": pa.array(range(k), pa.int32()), "members": members, "changed": np.where(np.arange(k) == 0, changed, 0),
                "ids": pa.array([p.astype(np.int32).tobytes() for p in parts], pa.binary()),
                "sums": pa.array([sums[c * size + p].tobytes() for c, p in enumerate(parts)], pa.binary())})

    def add(key: tuple, group: pa.Table) -> pa.Table:
        total = np.zeros(size)
        for i, s in zip(group.column("ids"), group.column("sums")):
            total[np.frombuffer(i.as_buffer(), dtype=np.int32)] += np.frombuffer(s.as_buffer())
        return pa.table({"cluster": pa.array([key[0].as_py()], pa.int32()), "members": [sum(group.column("members").to_pylist())],
                         "changed": [sum(group.column("changed").to_pylist())], "sums": pa.array([total.tobytes()], pa.binary())})

    parts = packed.select("ids", "weights").mapInArrow(run, "cluster int, members long, changed long, ids binary, sums binary")
    found = parts.groupBy("cluster").applyInArrow(add, "cluster int, members long, changed long, sums binary").collect()  # k rows
    members, sums = np.zeros(k, dtype=np.int64), np.zeros((k, size))
    for r in found:
        members[r["cluster"]], sums[r["cluster"]] = r["members"], np.frombuffer(bytes(r["sums"]))
    return members, sums, sum(r["changed"] for r in found)


def _packed_clusters(vectors: DataFrame, terms: DataFrame, all_docs: DataFrame, doc: str, k: int, max_iter: int, seed: int) -> DataFrame:
    """``cluster_notes`` over packed rows. Documents without a vector go to the centre of the smallest norm and count as
    members of its cluster."""
    packed, size = _pack(vectors, terms, doc), terms.count()
    bare = all_docs.select(doc).distinct().join(packed.select(doc), doc, "left_anti")
    bare_n, bare_known = bare.agg(F.count(F.lit(1)), F.count(doc)).first()
    centres = _packed_start(packed, doc, size, k, seed)
    norms = (centres ** 2).sum(axis=1)
    lowest = lambda n: int(np.round(n, 9).argmin())
    members, sums, _ = _packed_pass(packed, centres, norms, None)
    for _ in range(1, max_iter):
        members[lowest(norms)] += bare_n
        old = centres, norms
        mean = sums / np.maximum(members, 1)[:, None]
        centres = np.where((members > 0)[:, None], mean, centres)
        # As in ``update``: a cluster of documents without a vector has no centre any more.
        norms = np.where((members > 0) & ~sums.any(axis=1), np.inf, np.where(members > 0, (centres ** 2).sum(axis=1), norms))
        members, sums, changed = _packed_pass(packed, centres, norms, old)
        if changed + (bare_known if lowest(norms) != lowest(old[1]) else 0) == 0:
            break

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_nearest(*_lists(batch), centres, norms), pa.int32())], names=[doc, "cluster"])

    near = packed.mapInArrow(run, f"`{doc}` {packed.schema[doc].dataType.simpleString()}, cluster int")
    return stage(near.unionByName(bare.withColumn("cluster", F.lit(lowest(norms)))))
