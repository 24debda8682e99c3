"""Lab results parsed out of free text.

The long form ``(entry keys, pos, test_text, Lab_test, Result, Inference)`` is canonical: it comes
from ``posexplode(split(TEXT, ';'))`` — a narrow, per-row generator, no shuffle. Everything
per patient/test is a grouped aggregate with partial aggregation; wide forms are pivots over an
explicit whitelist (no extra job to discover the distinct test names, no case-insensitive name
clashes such as Hb/HB).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.columns import has
from casebook.functions.rules import (DOMINANT_CATEGORIES, INFERENCE_DEFAULT, INFERENCE_ORDINAL, INFERENCE_RULES,
                                      MAJORITY7_CATEGORIES, MAJORITY_CATEGORIES, NO_TEST)
from casebook.operators.joins import join_few
from casebook.schema import ENTRY_ID, PATIENT, SITE
from casebook.session import stage

EQ_PATTERN = r"(?U)[a-zA-Z0-9\s]+=[a-zA-Z0-9\s]+"
RANGE_PATTERN = r"(?U)\([.0-9\s]+-[.0-9\s]+\)"
MAP_KEYS = [PATIENT, SITE, "PATIENT_ID", "PAT_GESCHLECHT", "DATUM", "TYP", "TEXT"]
WIDE_KEYS = [PATIENT, SITE, "DATUM", "TYP", "TEXT"]


def infer_result(result: str | Column) -> Column:
    """L4: cut at the first '(' then ``--`` Very low, ``-`` Low, ``++`` Very high, ``+`` High,
    ``negativ`` Negative, ``positiv`` Positive (case-blind), else Normal."""
    r = F.col(result) if isinstance(result, str) else result
    head = F.substring_index(r, "(", 1)
    out = None
    for frag, label, blind in INFERENCE_RULES:
        cond = (F.lower(head) if blind else head).contains(frag)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return F.when(r.isNull(), F.lit(None)).otherwise(out.otherwise(INFERENCE_DEFAULT))


def lab_rows(df: DataFrame, dedup: bool = True) -> DataFrame:
    """Lab entries with text; exact duplicate rows dropped (they share the content hash, so the
    de-dup is keyed on it — a partial aggregate, safe for hot duplicate groups)."""
    y = df.filter((F.col("TYP") == "Y") & F.col("TEXT").isNotNull())
    return y.dropDuplicates([ENTRY_ID]) if dedup else y


def explode_labs(df: DataFrame, formats: Sequence[str] = ("eq",), dedup: bool = True) -> DataFrame:
    """L1-L3: one row per ';' piece that parses as a test. ``eq``: ``NAME=result`` split on the
    first '='; ``range``: a ``(a - b)`` reference range, split on the first blank. Formats are
    unioned (a piece matching both appears twice, as in the reference)."""
    y = lab_rows(df, dedup)
    pieces = (y.select("*", F.posexplode(F.split(F.col("TEXT"), ";")).alias("pos", "_piece"))
              .withColumn("test_text", F.regexp_replace("_piece", r"(?U)^\s+", "")).drop("_piece"))
    parts = []
    if "eq" in formats:
        eq = pieces.filter(F.col("test_text").rlike(EQ_PATTERN))
        kv = F.split(F.col("test_text"), "=", 2)
        parts.append(eq.withColumns({"Lab_test": kv.getItem(0), "Result": kv.getItem(1), "fmt": F.lit("eq")}))
    if "range" in formats:
        rg = pieces.filter(F.col("test_text").rlike(RANGE_PATTERN))
        kv = F.split(F.col("test_text"), r"(?U)\s", 2)
        parts.append(rg.withColumns({"Lab_test": kv.getItem(0), "Result": F.element_at(kv, 2), "fmt": F.lit("range")})
                     .filter(F.col("Result").isNotNull()))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("Inference", infer_result("Result"))


def filter_rare_tests(labs: DataFrame, min_count: int = 2, by: Sequence[str] = ()) -> DataFrame:
    """Keep tests seen at least ``min_count`` times (per ``by`` group, e.g. per site); a piece of an entry row that
    repeats counts once, whether or not ``labs`` still has the repeats.

    Counts are a small aggregate (one row per test name), staged. A test was seen twice if two of its pieces differ, which
    takes no exchange of the pieces. Few names hold all rows, so the semi join never hashes rows by name alone."""
    keys = [*by, "Lab_test"]
    piece = F.xxhash64(*[c for c in (ENTRY_ID, "pos", "fmt") if c in labs.columns])
    if min_count == 2:
        seen = labs.groupBy(*keys).agg(F.min(piece).alias("_a"), F.max(piece).alias("_b")).filter(F.col("_a") < F.col("_b"))
    else:
        pieces = labs.select(*keys, piece.alias("_piece")).distinct()
        seen = pieces.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_count)
    return join_few(labs, stage(seen.select(*keys)), keys, "left_semi")


def _last_per_test(labs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One value per (keys, test): the last one (row order by content hash, then piece position)."""
    return (labs.groupBy(*keys, "Lab_test")
            .agg(F.max_by(F.struct("Inference", "Result"), F.struct(ENTRY_ID, "pos")).alias("_v"))
            .select(*keys, "Lab_test", F.col("_v.Inference").alias("Inference"), F.col("_v.Result").alias("Result")))


def _values(labs: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per entry key ``values``, the last (test, ``columns``) of each test, sorted by name. The keys hold the text that the
    pieces were cut from, so rows of a key have equal pieces, and the last piece of a test is that of the last position. A
    key's pieces travel in one row: its text is sent once, not once a piece, and rows that repeat add nothing."""
    per = labs.dropna(subset=list(keys)).groupBy(*keys).agg(F.collect_set(F.struct("Lab_test", "pos", *columns)).alias("values"))

    def last(pieces: Column) -> Column:
        return F.filter(pieces, lambda x, i: ~F.get(pieces, i + 1)["Lab_test"].eqNullSafe(x["Lab_test"]))

    bound = F.transform(F.array(F.array_sort("values")), last)  # sorted once
    return per.withColumn("values", F.get(bound, F.lit(0)))


def lab_map(labs: DataFrame, keys: Sequence[str] = tuple(MAP_KEYS)) -> DataFrame:
    """Per entry key (its text among them), maps test → inference and test → result; null keys dropped (pandas
    groupby), last duplicate wins."""
    keys = list(keys)
    pairs = lambda c: F.map_from_entries(F.transform("values", lambda x: F.struct(x["Lab_test"], x[c])))
    return _values(labs, keys, ["Inference", "Result"]).select(*keys, pairs("Inference").alias("inference"), pairs("Result").alias("result"))


def map_text(m: str | Column) -> Column:
    """Sorted ``key:value`` entries joined by ';' — a comparable text form of a map."""
    c = F.col(m) if isinstance(m, str) else m
    entries = F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))
    return F.array_join(F.array_sort(entries), ";")


def lab_wide(labs: DataFrame, tests: Sequence[str], keys: Sequence[str] = tuple(MAP_KEYS),
             out_keys: Sequence[str] = tuple(WIDE_KEYS)) -> DataFrame:
    """One inference column per whitelisted test, per entry key, its text among them (PATIENT_ID and sex dropped
    afterwards, as the notebook does)."""
    last = _values(labs.filter(F.col("Lab_test").isin(list(tests))), list(keys), ["Inference"])
    found = last.withColumn("values", F.map_from_entries(F.transform("values", lambda x: F.struct(x["Lab_test"], x["Inference"]))))
    return found.select(*out_keys, *[F.try_element_at("values", F.lit(t)).alias(t) for t in tests])


def interpret_tests(df: DataFrame, tests: Sequence[str], min_count: int = 2, by: Sequence[str] = ()) -> DataFrame:
    """Lab rows → '=' pieces → inference → common tests → wide per entry key."""
    # Entry rows that repeat add nothing to counts or values, so they need no exchange of their own.
    return lab_wide(filter_rare_tests(explode_labs(df, ("eq",), dedup=False), min_count, by), tests)


def _entry_key() -> Column:
    """16 bytes for the five keys; a null enters as ``N``, other values with their length."""
    def part(c: str) -> Column:
        v = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("N"))

    return F.unhex(F.md5(F.concat(*[part(c) for c in WIDE_KEYS])))


def join_labs(entries: DataFrame, wide: DataFrame, keep: Sequence[Column] | None = None) -> DataFrame:
    """Attach wide labs to entries on (patient, site, date, kind, text), by an md5 key: the text travels only if it is
    asked for. ``keep`` gives the columns of the entries to keep, computed before the join (default: all)."""
    left = [*WIDE_KEYS, *[c for c in entries.columns if c not in WIDE_KEYS]] if keep is None else list(keep)
    right = wide.dropna(subset=WIDE_KEYS).withColumn("_entry", _entry_key()).drop(*WIDE_KEYS)  # null keys join nothing
    return entries.select(_entry_key().alias("_entry"), *left).join(right, "_entry", "left").drop("_entry")


def lab_majority(joined: DataFrame, tests: Sequence[str]) -> DataFrame:
    """Per patient and test, the most frequent of Low, High, Very low, Very high, Normal over the
    patient's lab rows (first in that order on ties); ``no_test`` when the patient has no value.

    Counts are conditional aggregates in one grouped pass; the argmax is ``array_max`` over
    ``(count, -priority, label)`` structs. With only Positive/Negative values all counts are 0 and
    the first category (Low) wins, as in the reference."""
    y = joined.filter(F.col("TYP") == "Y")
    aggs = []
    for t in tests:
        aggs.append(F.count(F.col(t)).alias(f"{t}__n"))
        for cat in MAJORITY_CATEGORIES:
            aggs.append(F.count_if(F.col(t) == cat).alias(f"{t}__{cat}"))
    per = y.groupBy(PATIENT).agg(*aggs)
    outs = []
    for t in tests:
        cands = [F.struct(F.col(f"{t}__{cat}").alias("n"), F.lit(-i).alias("p"), F.lit(cat).alias("label"))
                 for i, cat in enumerate(MAJORITY_CATEGORIES)]
        best = F.array_max(F.array(*cands)).getField("label")
        outs.append(F.when(F.col(f"{t}__n") == 0, F.lit(NO_TEST)).otherwise(best).alias(t))
    return per.select(PATIENT, *outs)


def one_hot(df: DataFrame, cols: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """``<col>_<category>`` 0/1 columns from an agreed category list (stable schema)."""
    outs = [F.col(PATIENT)]
    for c in cols:
        for cat in categories:
            outs.append((F.col(c) == cat).cast("int").alias(f"{c}_{cat.replace(' ', '_')}"))
    return df.select(*outs)


def entry_values(labs: DataFrame, entries: DataFrame) -> DataFrame:
    """``(PATIENT, Lab_test, Inference, n)``: the last value of each test per entry key, and the number
    ``n`` of lab entries that the five-key merge gives it to (an entry row that repeats counts each
    time). The free text only enters as part of an md5 key."""
    def key(keys: Sequence[str]) -> Column:
        return F.md5(F.concat_ws("\x1f", *[F.col(k).cast("string") for k in keys]))  # keys are not null here

    last = _last_per_test(labs.dropna(subset=MAP_KEYS), MAP_KEYS).select(
        PATIENT, "Lab_test", "Inference", key(WIDE_KEYS).alias("_entry"))
    times = (entries.filter(F.col("TYP") == "Y").dropna(subset=WIDE_KEYS).groupBy(key(WIDE_KEYS).alias("_entry"))
             .agg(F.count(F.lit(1)).alias("n")))
    return last.join(times, "_entry").drop("_entry")


def discriminative_tests(values: DataFrame, min_n: int = 5, min_share: float = 0.6) -> DataFrame:
    """L12 over ``entry_values``: per patient and test the 7-way majority without Normal; per test,
    patients whose majority is High/Low/Positive/Negative; n, share of the top outcome, Dominant; keep
    n > min_n and share > min_share, ordered by n desc."""
    x = values.filter(F.col("Inference") != "Normal")
    counts = x.groupBy(PATIENT, "Lab_test").agg(
        *[F.sum(F.when(F.col("Inference") == cat, F.col("n")).otherwise(0)).alias(f"c{i}") for i, cat in enumerate(MAJORITY7_CATEGORIES)])
    cands = [F.struct(F.col(f"c{i}").alias("n"), F.lit(-i).alias("p"), F.lit(cat).alias("label"))
             for i, cat in enumerate(MAJORITY7_CATEGORIES)]
    major = counts.select("Lab_test", F.array_max(F.array(*cands)).getField("label").alias("major"))
    per_test = major.groupBy("Lab_test").agg(
        *[F.count_if(F.col("major") == cat).alias(cat) for cat in DOMINANT_CATEGORIES])
    n = sum((F.col(c) for c in DOMINANT_CATEGORIES[1:]), F.col(DOMINANT_CATEGORIES[0]))
    cands4 = [F.struct(F.col(c).alias("n"), F.lit(-i).alias("p"), F.lit(c).alias("label"))
              for i, c in enumerate(DOMINANT_CATEGORIES)]
    out = (per_test.withColumn("n", n)
           .withColumn("share", F.round(F.greatest(*[F.col(c) for c in DOMINANT_CATEGORIES]) / F.col("n"), 6))
           .withColumn("Dominant", F.array_max(F.array(*cands4)).getField("label")))
    return out.filter((F.col("n") > min_n) & (F.col("share") > min_share)).orderBy(F.desc("n"), "Lab_test")


def relevant_test_score(values: DataFrame, dominant: DataFrame, patients: DataFrame) -> DataFrame:
    """L13 over ``entry_values``: per patient, the number of (entry, test) values equal to the test's
    Dominant outcome; patients without one have 0.

    ``dominant`` has one row per test that passed the discriminative filter — bounded by the
    number of distinct test names; AQE broadcasts it when small."""
    hits = values.join(dominant.select("Lab_test", F.col("Dominant").alias("Inference")), ["Lab_test", "Inference"])
    scores = hits.groupBy(PATIENT).agg(F.sum("n").alias("_hits"))
    return patients.join(scores, PATIENT, "left").select(PATIENT, F.coalesce("_hits", F.lit(0)).cast("long").alias("relevant_tests"))


def top_abnormal_tests(labs: DataFrame, entries: DataFrame, phrase: str, k: int = 20) -> DataFrame:
    """Among patients with any entry text mentioning ``phrase``, the ``k`` most frequent tests
    with a non-Normal result (ties by name). The patient filter is a per-patient ``bool_or`` + semi
    join — equal to searching the ','-joined patient text because the phrase has no ','; no
    per-patient string is built. ``k`` is the feature (a top-k report)."""
    pats = (entries.groupBy(PATIENT).agg(F.bool_or(has("TEXT", phrase)).alias("_hit"))
            .filter("_hit").select(PATIENT))
    abn = labs.filter(F.col("Inference") != "Normal").join(pats, PATIENT, "left_semi")
    return abn.groupBy("Lab_test").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "Lab_test").limit(k)


def inference_ordinal(c: str | Column = "Inference") -> Column:
    """Low/High 1, Very low/Very high/Negative 2, Normal 0; anything else (Positive) null."""
    col = F.col(c) if isinstance(c, str) else c
    out = None
    for label, v in INFERENCE_ORDINAL.items():
        out = F.when(col == label, v) if out is None else out.when(col == label, v)
    return out


def lab_pivot(labs: DataFrame, tests: Sequence[str]) -> DataFrame:
    """Mean ordinal per (patient, date) and test, one column per whitelisted test."""
    src = labs.filter(F.col("Lab_test").isin(list(tests))).withColumn("label", inference_ordinal())
    return src.groupBy(PATIENT, "DATUM").pivot("Lab_test", list(tests)).agg(F.avg("label"))

