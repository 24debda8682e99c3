"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from casebook.llm import mixing, multiset
from casebook.llm.sharding import MODULUS, MULTIPLIER

#: CRC-32 of a text's bytes: the 256-entry table follows from the polynomial, then one lookup a byte.
_CRC = """
bit8(k, c) AS (
    SELECT k, k::BIGINT FROM range(256) t(k)
), crc_table AS (
    SELECT list(list_reduce([c] || range(8), lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY k) AS tab FROM bit8
)"""

JUMP_SHARDING = f"""
WITH RECURSIVE {_CRC}, d AS (
    SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 16 AS size,
        xor(list_reduce([4294967295] || list_transform(range(0, strlen(coalesce(text, ''))::BIGINT),
            lambda i: ('0x' || hx[2 * i + 1 : 2 * i + 2])::BIGINT), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::HUGEINT AS k0
    FROM (SELECT doc_id, text, hex(encode(coalesce(text, ''))) AS hx FROM documents) x, crc_table
), key_row AS (SELECT row_number() OVER () AS r, * FROM d
), jumps(r, k, b, j) AS (
    SELECT r, k0, -1::BIGINT, 0::BIGINT FROM key_row
    UNION ALL
    SELECT r, k2, j, ((j + 1) * 2147483648::BIGINT) // ((k2 // 8589934592)::BIGINT + 1)
    FROM (SELECT r, j, (k * {MULTIPLIER}::HUGEINT + 1) % {MODULUS}::HUGEINT AS k2 FROM jumps WHERE j < 40) s
), ended AS (SELECT r, b, j FROM jumps WHERE j >= 40
), placed AS (
    SELECT doc_id, size, text_crc32, b::INTEGER AS shard, (CASE WHEN j = 40 THEN 40 ELSE b END)::INTEGER AS grown_shard,
        substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || text_crc32::VARCHAR || ':' || size::VARCHAR), 1, 3) AS slice
    FROM key_row JOIN ended USING (r)
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
    row_number() OVER (PARTITION BY shard ORDER BY slice, doc_id, text_crc32, size) - 1 AS slot
FROM placed"""


def _run(n: int = 0) -> str:
    """The word at i + n of the list hs and those after it in its line, weighed and added up."""
    own = f"hs[i + {n}] * {multiset.FACTORS[n]}"
    return own if n == multiset.RUN_WORDS - 1 else f"({own} + coalesce({_run(n + 1)}, 0))"


def _fingerprint(text: str) -> str:
    """Scalar SQL: {same, like} of a text expression."""
    paragraphs = f"list_transform(string_split({text}, chr(10)), lambda p: sha256(p))"
    same = (f"list_transform(range(8), lambda i: list_sum(list_transform({paragraphs}, "
            "lambda d: ('0x' || substr(d, 8 * i + 1, 8))::BIGINT)) % 4294967296)")
    codes = f"{text}_codes"
    like = (f"list_transform(range(128), lambda l: len(list_filter({codes}, lambda c: c = l)) "
            f"- len(list_filter({codes}, lambda c: c = l + 128)))")
    return f"{{'same': {same}, 'like': {like}}}"


def _codes(text: str) -> str:
    """Scalar SQL over crc_table: the codes of the word runs of a text expression."""
    words = f"regexp_extract_all({text}, '[^\\n \\t\\x0B\\f\\r]+|\\n')"
    crc = ("xor(list_reduce([4294967295] || list_transform(range(0, strlen(w)::BIGINT), lambda i: ('0x' || hex(encode(w))[2 * i + 1 : 2 * i + 2])::BIGINT), "
           "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)")
    hashes = f"list_transform({words}, lambda w: CASE WHEN w <> chr(10) THEN {crc} END)"
    runs = f"list_transform([{hashes}], lambda hs: list_transform(range(1, len(hs) + 1), lambda i: {_run()} % {multiset.PRIME} % 256))[1]"
    return f"list_filter({runs}, lambda c: c IS NOT NULL)"


def _hex(fp: str) -> str:
    return (f"array_to_string(list_transform({fp}.same, lambda x: lpad(lower(hex(x::BIGINT)), 8, '0')), '') || "
            f"array_to_string(list_transform({fp}.like, lambda x: lpad(lower(hex(((x::BIGINT % 65536) + 65536) % 65536)), 4, '0')), '')")


def _likeness(a: str, b: str) -> str:
    def dot(x, y):
        return f"list_sum(list_transform(range(1, 129), lambda i: {x}.like[i] * {y}.like[i]))"
    return (f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN {dot(a, a)} = 0 OR {dot(b, b)} = 0 THEN 0.0::DOUBLE "
            f"ELSE least(1.0, greatest(0.0, {dot(a, b)} / (sqrt({dot(a, a)}::DOUBLE) * sqrt({dot(b, b)}::DOUBLE)))) END")


MULTISET_FINGERPRINTS = f"""
WITH {_CRC}, d AS (
    SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS k FROM documents
), u AS (SELECT DISTINCT doc_id, text, k FROM d
), o AS (
    SELECT doc_id, text, k, length(text) AS n, coalesce(lead(k) OVER w, first_value(k) OVER w) AS nk,
        coalesce(lead(text) OVER w, first_value(text) OVER w) AS nt
    FROM u WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, k DESC)
), e AS (SELECT *, substr(text, 1, (n - n // 3)::BIGINT) || substr(nt, 1, (n // 3)::BIGINT) AS edited FROM o
), c AS (SELECT e.*, {_codes('text')} AS text_codes, {_codes('edited')} AS edited_codes FROM e, crc_table
), f AS (SELECT *, {_fingerprint('text')} AS own, {_fingerprint('edited')} AS ed FROM c
), j AS (SELECT f.*, g.own AS other FROM f JOIN f AS g ON f.nk = g.k)
SELECT j.doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256, {_hex('own')} AS fingerprint,
    {_hex('ed')} AS edited_fingerprint, {_likeness('own', 'ed')} AS near_edited, {_likeness('own', 'other')} AS near_next
FROM j JOIN d USING (k)"""


def _seed(salt: str) -> str:
    return f"(('0x' || substr(md5({salt}), 1, 12))::BIGINT % {mixing.PRIME})"


def _permuted(x: str, n: str, seed: str) -> str:
    key = f"({seed} * factor)"
    other = f"((({key} - a) % {n} + {n}) % {n})"
    mixed = f"((greatest(a, {other}) + {key}) % {mixing.PRIME})"
    return (f"list_reduce([{x}::BIGINT] || {mixing.FACTORS}, lambda a, factor: CASE WHEN "
            f"(({mixed} * {mixed} % {mixing.PRIME} * {mixing.MULTIPLIER} % {mixing.PRIME}) >> 15) % 2 = 1 THEN {other} ELSE a END)")


_B = mixing.BLOCK

MIXED_SOURCES = f"""
WITH d AS (
    SELECT doc_id, source, coalesce('s' || source, '') AS src, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
        md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS digest
    FROM documents
), w AS (
    SELECT *, [{', '.join(map(str, mixing.WEIGHTS))}][(rank % {len(mixing.WEIGHTS)} + 1)::BIGINT]::BIGINT AS weight FROM (
        SELECT src, sum(size)::BIGINT AS words, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY src, source) s
), o AS (
    SELECT *, coalesce(sum(words) OVER before, 0)::DOUBLE AS full_words, coalesce(sum(weight) OVER before, 0)::DOUBLE AS used_weight,
        (sum(words) OVER ())::DOUBLE AS all_words, (sum(weight) OVER ())::DOUBLE AS all_weight
    FROM w WINDOW before AS (ORDER BY words / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
    SELECT src, words, rank, least(words * {mixing.MOST}::DOUBLE, weight * (SELECT max((all_words * {mixing.SHARE}::DOUBLE - full_words * {mixing.MOST}) / (all_weight - used_weight)) FROM o)) AS target
    FROM o
), p AS (
    SELECT *, sum(slots) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - slots AS first_slot, sum(slots) OVER () AS all_slots FROM (
        SELECT *, CASE WHEN words > 0 THEN (taken // words) * blocks + (taken % words + {_B - 1}) // {_B} ELSE 0 END AS slots FROM (
            SELECT *, floor(target + 0.5)::BIGINT AS taken, (words + {_B - 1}) // {_B} AS blocks FROM t) a) b
), k AS (
    SELECT src, rank, blocks, first_slot::BIGINT + k AS x, all_slots::BIGINT AS n, k // blocks AS pass, k % blocks AS p_at,
        CASE WHEN k = slots - 1 AND taken % words > 0 THEN taken % words - ((taken % words + {_B - 1}) // {_B} - 1) * {_B} ELSE {_B} END AS take
    FROM (SELECT *, unnest(range(0, slots::BIGINT)) AS k FROM p) e
), s AS (
    SELECT src, take, CASE WHEN p_at = blocks - 1 THEN p_at ELSE {_permuted('p_at', 'greatest(blocks - 1, 1)', 'seed')} END AS block, {_permuted('x', 'n', 'deal')} AS position
    FROM (SELECT *, {_seed(f"'{mixing.SEED}:' || rank::VARCHAR || ':' || pass::VARCHAR")} AS seed, {_seed(f"'{mixing.SEED}:deal'")} AS deal FROM k) a
), l AS (
    SELECT d.*, words, target, row_number() OVER () AS r, sum(size) OVER (PARTITION BY d.src ORDER BY digest, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
    FROM d JOIN p ON d.src = p.src
), c AS (
    SELECT r, src, block, greatest(start, block * {_B}) - block * {_B} AS low, least(start + size, (block + 1) * {_B}) - block * {_B} AS high
    FROM (SELECT *, unnest(range((start // {_B})::BIGINT, ((start + size - 1) // {_B} + 1)::BIGINT)) AS block FROM l WHERE size > 0) e
), m AS (
    SELECT r, sum(least(high, take) - low) AS taken, min(position) AS first_position FROM c JOIN s USING (src, block) WHERE least(high, take) > low GROUP BY r
)
SELECT doc_id, size, words AS source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_position FROM l LEFT JOIN m USING (r)"""


HARD_NEGATIVES = """
WITH e AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.r AS ar, a.vec_id AS anchor_id, c.r AS cr, c.vec_id AS id, a.label = c.label AS same,
        coalesce(list_sum(list_transform(list_zip(a.q, c.q), lambda p: coalesce(p[1] * p[2], 0))), 0)::BIGINT AS score
    FROM e a JOIN e c ON a.r <> c.r WHERE a.vec_id % 50 = 0
), p AS (
    SELECT ar, anchor_id, id AS positive_id, cr, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id NULLS LAST, cr) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.ar, p.cr ORDER BY score DESC, id NULLS LAST, s.cr)::INTEGER AS rank,
    id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.ar = s.ar AND NOT s.same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
QUALIFY rank <= 3"""


PHRASES = """
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p
), g AS (SELECT lang, ws, unnest([1, 2, 3]) AS words FROM w
), o AS (SELECT lang, words, ws, unnest(range(1, len(ws) - words + 2)) AS i FROM g
), f AS (SELECT lang, words, array_to_string(ws[i:i + words - 1], ' ') AS phrase, count(*) AS f FROM o GROUP BY ALL
), t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang
), c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE words >= 2 AND f >= 10
), k AS (
    SELECT lang, words, phrase, a, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k + 1:], ' ') AS rp
    FROM (SELECT *, unnest(range(1, words)) AS k FROM c) x
), s AS (
    SELECT k.lang, k.words, k.phrase, a, l.f AS l, r.f AS r, ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM k JOIN f l ON k.lang = l.lang AND k.lp = l.phrase JOIN f r ON k.lang = r.lang AND k.rp = r.phrase
    QUALIFY row_number() OVER (PARTITION BY k.lang, k.phrase ORDER BY score, k) = 1
), b AS (
    SELECT lang, array_to_string(ws[i:i + 1], ' ') AS phrase, max(a) AS around FROM (SELECT *, unnest([1, 2]) AS i FROM c WHERE words = 3) x GROUP BY ALL
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n, score
FROM s JOIN t ON s.lang = t.lang LEFT JOIN b ON s.lang = b.lang AND s.phrase = b.phrase
WHERE b.around IS NULL OR s.words = 3 OR 100 * b.around < 50 * a
QUALIFY rank <= 2000"""
