"""Mixing sources to target weights (operator 11; DataFrame functions only).

The words of a source lie end to end on one line, its documents in the order of a hash, and the line is
packed into blocks of ``BLOCK`` words (the last may be shorter). The mix is a row of output slots, each
holding one block, ``SHARD_SLOTS`` of them to an output shard.

* **Targets.** Source r (by code point, null last) weighs ``WEIGHTS[r % 3]``; the sources share
  ``SHARE`` times all words by weight, none above ``MOST`` times its own words. The excess goes back to
  the others by weight until none is above: target = min(MOST * words, level * weight), where the level
  follows from running sums in the order of words / weight.
* **Draw.** A keyed permutation deals all slots, laid out source after source, to output shards. The
  counts of the sources in a shard (``shard_counts``) are thus a multinomial draw under the condition that
  each source's total is its target: shares hold exactly, not but for sampling noise, and no source is
  drawn beyond what it may give.
* **Slots to blocks.** The k-th slot of a source takes a block in pass k // blocks over the source, by a
  pseudorandom permutation of block numbers of its own for each (source, pass); its last block closes the pass. So every
  document is taken once per pass, hence never more than MOST times, and a pass cut short takes random blocks.
* **Join by index.** Documents, cut at block borders, meet slots on (source, block).

Permutations are swap-or-not networks: bijections on any range, computed for each number alone.

Nulls: a null text has no words; null is a source of its own, after all others; a null id is kept. Rows that
repeat are documents of their own. Documents without words are returned with ``taken`` 0. An empty table gives an
empty result; columns other than ``doc_id``, ``text`` and ``source`` are ignored. The result depends on ids, texts and
sources alone, not on partitions, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.session import stage

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
BLOCK = 512
SHARD_SLOTS = 1024
ROUNDS = 32
SEED = 7

#: Slots are made in chunks of so many, each in a row of its own first.
CHUNK = 4096
BLANK, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"

#: Modulus and multiplier of the permutations' hash, and a factor of the seed for each of their rounds.
PRIME, MULTIPLIER = 2147483647, 1103515245
FACTORS = [int(md5(f"round {i}".encode()).hexdigest()[:12], 16) % PRIME for i in range(ROUNDS)]


def running(df: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with, for each name, the sum over all rows before (0 for the first). Rows are dealt to ranges of
    ``order`` (which must be unique); only one row per range is summed in one place."""
    named = df.select("*", *[v.alias(f"_{k}") for k, v in sums.items()])
    ranges = stage(named.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("_range").agg(*[F.sum(f"_{k}").alias(f"_{k}") for k in sums]).select(
        "_range", *[F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_{k}_start") for k in sums])
    inside = ranges.select("*", *[F.coalesce(F.sum(f"_{k}").over(within), F.lit(0)).alias(f"_{k}_in") for k in sums])
    return inside.join(starts, "_range").select(*df.columns, *[(F.col(f"_{k}_start") + F.col(f"_{k}_in")).alias(k) for k in sums])


def permuted(x: Column, n: Column, seed: Column) -> Column:
    """The place of ``x`` under a swap-or-not permutation of 0 .. n - 1 that ``seed`` (below PRIME) picks. A round
    pairs x with key - x (modulo n) and swaps the pair or not, as a hash of the larger says, so it undoes itself."""
    def step(at: Column, factor: Column) -> Column:
        key = seed * factor
        other = F.pmod(key - at, n)
        mixed = (F.greatest(at, other) + key) % PRIME
        swap = F.shiftright(mixed * mixed % PRIME * MULTIPLIER % PRIME, 15) % 2 == 1
        return F.when(swap, other).otherwise(at)

    return F.aggregate(F.array(*[F.lit(f).cast("long") for f in FACTORS]), x, step)


def seed_of(salt: Column) -> Column:
    return F.conv(F.substring(F.md5(salt), 1, 12), 16, 10).cast("long") % PRIME


def word_count(text: Column) -> Column:
    """Each word, with the blanks around it, becomes one character; the length is the number of words."""
    one = F.regexp_replace(text, f"{BLANK}*{WORD}+{BLANK}*", "x")
    return F.when(text.rlike(WORD), F.length(one)).otherwise(0).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, _src, size, _slice, _digest), staged: texts are read once and stay where they are. ``_src`` is
    the source as a key that tells null from the empty string."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text)))
    return stage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("_src"),
        word_count(text).alias("size"), digest.alias("_digest"))
        .withColumn("_slice", F.substring("_digest", 1, 4)))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, words) -> (…, rank, weight, target, taken): real targets and the whole words to take."""
    ranked = running(sources, [F.col("source").asc_nulls_last()], {"rank": F.lit(1)})
    weighed = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    # While the sources before it in this order are at their limit, a source's share per weight is _level;
    # it rises as long as sources are above their limit and falls after, so its highest value is the true one.
    ordered = stage(running(weighed, [F.col("words") / F.col("weight"), F.col("rank")], {"_full": F.col("words"), "_used": F.col("weight")}))
    total, all_weight = (ordered.agg(F.sum(c).alias("v")).scalar() for c in ("words", "weight"))
    level = ordered.agg(F.max((total * F.lit(share) - F.col("_full") * most) / (all_weight - F.col("_used"))).alias("v")).scalar()
    target = F.least(F.col("words") * F.lit(float(most)), F.col("weight") * F.coalesce(level, F.lit(0.0)))
    return ordered.select(*ranked.columns, "weight", target.alias("target"), F.floor(target + 0.5).cast("long").alias("taken"))


def planned(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds ``blocks`` of the source, its ``slots``, ``first_slot`` (slots of sources before it) and ``all_slots``."""
    rest = F.col("taken") % F.col("words")
    slots = F.when(F.col("words") > 0, F.floor(F.col("taken") / F.col("words")).cast("long") * F.col("blocks") + F.ceil(rest / block).cast("long")).otherwise(0)
    counted = sources.withColumn("blocks", F.ceil(F.col("words") / block).cast("long")).withColumn("slots", F.coalesce(slots, F.lit(0)).cast("long"))
    laid = stage(running(counted, [F.col("rank")], {"first_slot": F.col("slots")}))
    return stage(laid.withColumn("all_slots", laid.agg(F.sum("slots").alias("v")).scalar()))


def slots(plan: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(_src, _block, shard, slot, position, _take): what each output slot holds; the last slot of a source may hold
    the beginning of its block only."""
    chunks = plan.filter("slots > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK))).alias("_chunk"))
    # A row here becomes a chunk of slots below: a number of partitions that is not coalesced by the size of these rows.
    chunks = chunks.repartition(int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col("_src"), F.col("_chunk"))
    each = chunks.select("*", F.explode(F.sequence(F.col("_chunk") * CHUNK, F.least(F.col("_chunk") * CHUNK + CHUNK, F.col("slots")) - 1)).alias("_k"))
    at = each.withColumn("_pass", F.floor(F.col("_k") / F.col("blocks"))).withColumn("_p", F.col("_k") % F.col("blocks"))
    at = at.withColumns({"_seed": seed_of(F.concat_ws(":", F.lit(seed), F.col("rank"), F.col("_pass"))), "_deal": seed_of(F.lit(f"{seed}:deal"))})
    within = F.when(F.col("_p") == F.col("blocks") - 1, F.col("_p")).otherwise(permuted(F.col("_p"), F.greatest(F.col("blocks") - 1, F.lit(1)), F.col("_seed")))
    dealt = permuted(F.col("first_slot") + F.col("_k"), F.col("all_slots"), F.col("_deal"))
    rest = F.col("taken") % F.col("words")
    take = F.when((F.col("_k") == F.col("slots") - 1) & (rest > 0), rest - (F.ceil(rest / block) - 1) * block).otherwise(block)
    out = at.select("_src", within.alias("_block"), dealt.alias("position"), take.cast("long").alias("_take"))
    return out.withColumns({"shard": F.floor(F.col("position") / shard_slots), "slot": F.col("position") % shard_slots})


def shard_counts(mixed_slots: DataFrame) -> DataFrame:
    """(shard, _src, n): the draw, slots of each source in each output shard."""
    return mixed_slots.groupBy("shard", "_src").agg(F.count(F.lit(1)).alias("n"))


def lines(docs_sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Documents with ``_start``, the words of their source before them. A source is summed by slices of the
    digest, so a source that holds most rows is many groups."""
    slices = docs_sized.groupBy("_src", "_slice").agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("_src").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(plan.select("_src", "words", "target"), "_src")
    within = Window.partitionBy("_src", "_slice").orderBy("_digest", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    return (docs_sized.withColumn("_in", F.coalesce(F.sum("size").over(within), F.lit(0))).join(starts, ["_src", "_slice"])
            .select("doc_id", "_src", "size", "words", "target", (F.col("_from") + F.col("_in")).alias("_start")))


def pieces(laid: DataFrame, block: int = BLOCK) -> DataFrame:
    """Documents with words, cut at block borders: adds (_block, _at, _length), a place within the block."""
    end = F.col("_start") + F.col("size")
    cut = laid.filter("size > 0").select("*", F.explode(F.sequence(F.floor(F.col("_start") / block), F.floor((end - 1) / block))).alias("_block"))
    low = F.greatest(F.col("_start"), F.col("_block") * block)
    return cut.withColumn("_at", low - F.col("_block") * block).withColumn("_length", F.least(end, (F.col("_block") + 1) * block) - low)


def mix(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents on their lines, the plan by source, the mix): the mix has a row for each piece of a
    document in a slot, with its output ``shard``, ``slot`` and ``position``, and the words ``taken``."""
    known = sized(docs)
    plan = planned(targets(known.groupBy("_src", "source").agg(F.sum("size").alias("words"))))
    laid = stage(lines(known, plan))
    mixed = pieces(laid).join(slots(plan).hint("merge"), ["_src", "_block"]).withColumn(
        "taken", F.greatest(F.lit(0), F.least(F.col("_at") + F.col("_length"), F.col("_take")) - F.col("_at")))
    return laid, plan, mixed


def mix_documents(docs: DataFrame) -> DataFrame:
    """Contract rows: doc_id, size, source_size, target, taken; and ``first_position``, the first place of the
    mix at which a word of the document stands (null: none)."""
    laid, _, mixed = mix(docs)
    sums = mixed.filter("taken > 0").groupBy("_src", "_start").agg(F.sum("taken").alias("taken"), F.min("position").alias("first_position"))
    found = laid.filter("size > 0").join(sums, ["_src", "_start"], "left")
    none = laid.filter("size = 0").withColumns({"taken": F.lit(0).cast("long"), "first_position": F.lit(None).cast("long")})
    rows = found.unionByName(none.select(*found.columns))
    return rows.select("doc_id", "size", F.col("words").alias("source_size"), F.col("target").cast("double").alias("target"),
                       F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_position")
