"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from shelfwise.llm.license_texts import NAMED, SENTENCES, TEXTS
from shelfwise.llm.mixing import CLOSE


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_LICENSE_ROWS = ", ".join(
    f"({_text(i)}, {_text(t)})" for i, t in [*TEXTS, *((i, s.format(name)) for i, name in NAMED for s in SENTENCES)]
)

# case, copyright lines, punctuation, then spellings
_CANONICAL = """replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
    trim(regexp_replace(regexp_replace(lower(x),
        '(?m)^[ \\t#*/;-]*(copyright[ \\t:]*(\\(c\\)|©|by |\\d{4})|(\\(c\\)|©)[ \\t]*\\d{4}|all rights reserved)[^\\n]*$', ' ', 'g'), '[^\\p{L}\\p{N}]+', ' ', 'g')),
    'licence', 'license'), 'sub license', 'sublicense'), 'non commercial', 'noncommercial'),
    'non infringement', 'noninfringement'), 'merchantibility', 'merchantability'), 'organisation', 'organization'),
    'recognise', 'recognize'), 'favour', 'favor'), 'wilful', 'willful'), 'whilst', 'while'), 'per cent', 'percent'),
    'copyright owner', 'copyright holder')"""


# a line is known by itself without outer blanks; lines without letters or digits are left alone
_LINE_DEDUP = r"""
WITH cut AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
    SELECT doc_id, source, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM cut
),
named AS (
    SELECT *, CASE WHEN regexp_matches(trim(line), '[\p{L}\p{N}]') THEN trim(line) END AS key FROM lines
),
spread AS (
    SELECT key, min((doc_id, pos)) AS first FROM named WHERE key IS NOT NULL
    GROUP BY key HAVING count(DISTINCT coalesce('s' || source, '')) >= 10
),
kept AS (
    SELECT doc_id, pos, line, first IS NULL OR first = (doc_id, pos) AS stays FROM named LEFT JOIN spread USING (key)
),
joined AS (
    SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '') AS text,
           CAST(count(*) AS INT) AS n_lines, CAST(count_if(NOT stays) AS INT) AS n_removed FROM kept GROUP BY doc_id
)
SELECT doc_id, joined.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents LEFT JOIN joined USING (doc_id)"""

_EMBEDDINGS = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.98
),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)"""


_MIX = rf"""
WITH RECURSIVE named AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5(concat_ws('|', 'mix', coalesce(CAST(doc_id AS VARCHAR), ''), text)) AS digest,
           row_number() OVER (PARTITION BY doc_id, text, source) - 1 AS nth FROM documents
),
docs AS (
    SELECT doc_id, source, size, floor(sqrt(size::DOUBLE)) AS liking, row_number() OVER () AS row,
           (CAST('0x' || substr(CASE WHEN nth = 0 THEN digest ELSE md5(digest || '|' || nth) END, 1, 13) AS BIGINT) + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
    FROM named
),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight FROM docs GROUP BY source
),
-- fixed at the limit are the first k by limit over weight, for the least k at which no other is above
sorted AS (
    SELECT *, 3.0::DOUBLE * source_size AS most, row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source) AS k FROM sources
),
shares AS (
    SELECT k, most, weight,
           ((SELECT sum(source_size) FROM sources)::DOUBLE - coalesce(sum(most) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM sorted
),
water AS (SELECT level FROM shares WHERE weight * level < most ORDER BY k LIMIT 1),
plan AS (
    SELECT source, source_size, k, CASE WHEN weight * coalesce((SELECT level FROM water), 1e308) >= most THEN most
                                        ELSE weight * (SELECT level FROM water) END AS target FROM sorted
),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS certain FROM plan),
-- inside a source the documents liked most reach a probability of one first
liked AS (
    SELECT k, target - certain * source_size AS missing, liking, CAST(sum(size) AS BIGINT) AS words
    FROM docs d JOIN parts s ON d.source IS NOT DISTINCT FROM s.source WHERE size > 0 GROUP BY k, missing, liking
),
tried AS (
    SELECT k, liking, (missing - coalesce(sum(words) OVER (PARTITION BY k ORDER BY liking DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
           / (sum(CAST(words * liking AS BIGINT)) OVER (PARTITION BY k ORDER BY liking DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM liked
),
levels AS (SELECT k, arg_max(level, liking) AS level FROM tried WHERE level * liking < 1 GROUP BY k),
wanted AS (
    SELECT d.*, s.source_size, s.target, s.k, CASE WHEN size > 0 THEN certain + coalesce(least(1.0::DOUBLE, level * liking), 0) ELSE 0 END AS e
    FROM docs d JOIN parts s ON d.source IS NOT DISTINCT FROM s.source LEFT JOIN levels USING (k)
),
gaps AS (SELECT k, target, target - CAST(sum(floor(e) * size) AS BIGINT) AS gap FROM wanted GROUP BY k, target),
line AS (
    SELECT k, row, size, row_number() OVER (PARTITION BY k ORDER BY u / (1 - u) / ((e - floor(e)) / (1 - (e - floor(e))))) AS i
    FROM wanted WHERE e > floor(e)
),
-- one after the other: what fits is taken; what would have fitted when the round began ends the round
walk (k, i, row, most, gap, target, took, done) AS (
    SELECT k, 0, NULL::BIGINT, gap, gap, target, FALSE, gap < 1 OR gap <= {CLOSE} * target FROM gaps
    UNION ALL
    SELECT w.k, l.i, l.row, CASE WHEN size <= w.most AND size > w.gap THEN w.gap ELSE w.most END,
           CASE WHEN size <= w.most AND size <= w.gap THEN w.gap - size ELSE w.gap END, target, size <= w.most AND size <= w.gap,
           size <= w.most AND size > w.gap AND (w.gap < 1 OR w.gap <= {CLOSE} * target)
    FROM walk w JOIN line l ON l.k = w.k AND l.i = w.i + 1 WHERE NOT done
),
took AS (SELECT row FROM walk WHERE took)
SELECT doc_id, size, source_size, target, CAST(size * (floor(e) + CASE WHEN t.row IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS taken
FROM wanted w LEFT JOIN took t ON t.row = w.row"""

# marks around a turn hold 12 + 1 + 11 characters
_CHAT = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;'))
            + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""

# CRC-32 of decimal digits, a bit at a time
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, range(8 * length(s))), lambda c, i:
    CASE WHEN xor(c, CASE WHEN i % 8 = 0 THEN ascii(s[i // 8 + 1]) ELSE 0 END) % 2 = 1
         THEN xor(xor(c, CASE WHEN i % 8 = 0 THEN ascii(s[i // 8 + 1]) ELSE 0 END) // 2, 3988292384)
         ELSE xor(c, CASE WHEN i % 8 = 0 THEN ascii(s[i // 8 + 1]) ELSE 0 END) // 2 END))"""
_SMALL_LETTERS = f"""{"".join("replace(" for _ in range(26))}text{"".join(f", '{chr(c)}', '{chr(c + 32)}')" for c in range(65, 91))}"""


def _leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


# a proof is the list of siblings from the leaf on; both trees and the climb go a level a round
_MERKLE = f"""
WITH RECURSIVE named AS (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents),
leaves AS (
    SELECT doc_id, lang, {_leaf("text")} AS leaf, {_leaf(f"CASE WHEN {_CRC32} % 3 = 0 THEN {_SMALL_LETTERS} ELSE text END")} AS claim,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place FROM named
),
built (tree, level, place, digest) AS (
    SELECT tree, 0, place, leaf FROM leaves
    UNION ALL
    SELECT tree, level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM built) WHERE n > 1 GROUP BY tree, level, place // 8
),
subroots AS (SELECT tree, max(level) AS height, arg_max(digest, level) AS subroot FROM built GROUP BY tree),
above (level, place, digest) AS (
    SELECT 0, tree, subroot FROM subroots
    UNION ALL
    SELECT level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER () AS n FROM above) WHERE n > 1 GROUP BY level, place // 8
),
runs AS (
    SELECT tree, level, place // 8 AS run, list(digest ORDER BY place) AS digests FROM built JOIN subroots USING (tree)
    WHERE level < height GROUP BY tree, level, place // 8
    UNION ALL
    SELECT -1, level, place // 8, list(digest ORDER BY place) FROM above
    WHERE level < (SELECT max(level) FROM above) GROUP BY level, place // 8
),
climb (doc_id, tree, home, level, place, round, proof, folded) AS (
    SELECT doc_id, tree, tree, 0, place, 0, '', claim FROM leaves
    UNION ALL
    SELECT doc_id, next_tree, home, next_level, next_place, round + 1, proof || before || behind, sha256(before || folded || behind) FROM (
        SELECT c.doc_id, c.home, c.round, c.proof, c.folded,
               coalesce(array_to_string(digests[:c.place % 8], ''), '') AS before, coalesce(array_to_string(digests[c.place % 8 + 2:], ''), '') AS behind,
               CASE WHEN c.tree >= 0 AND c.level + 1 = height THEN -1 ELSE c.tree END AS next_tree,
               CASE WHEN c.tree >= 0 AND c.level + 1 = height THEN 0 ELSE c.level + 1 END AS next_level,
               CASE WHEN c.tree >= 0 AND c.level + 1 = height THEN c.home ELSE c.place // 8 END AS next_place
        FROM (SELECT doc_id, home, round, proof, folded, CASE WHEN climb.tree >= 0 AND height = 0 THEN -1 ELSE climb.tree END AS tree, level,
                     CASE WHEN climb.tree >= 0 AND height = 0 THEN home ELSE place END AS place, height
              FROM climb JOIN subroots ON subroots.tree = home) c
        JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.run = c.place // 8
    )
),
ends AS (SELECT doc_id, arg_max(proof, round) AS proof, arg_max(folded, round) AS folded FROM climb GROUP BY doc_id),
root AS (SELECT arg_max(digest, level) AS root FROM above)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM leaves JOIN subroots USING (tree) JOIN ends USING (doc_id) CROSS JOIN root"""

_AUDIT = r"""
WITH words AS (SELECT *, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
failed AS (
    SELECT coalesce(lang, '') AS part, coalesce(quality = 1, FALSE) AS is_good, coalesce(toxic = 1, FALSE) AS is_toxic,
           [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
            100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text),
            regexp_matches(text, '[#$%&*|]'),
            doc_id > min(doc_id) OVER (PARTITION BY text)] AS f
    FROM (SELECT * REPLACE (coalesce(text, '') AS text) FROM words) LEFT JOIN labels USING (doc_id)
),
letters AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
    SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
),
steps AS (SELECT o, i AS step, o[i] AS x, o[:i - 1] AS before FROM orders, letters),
masks AS (SELECT part, f, is_good, is_toxic, count(*) AS n FROM failed GROUP BY ALL),
counted AS (
    SELECT part, o, step, x, f[x] AS fails, list_bool_or(list_transform(before, lambda k: f[k])) IS TRUE AS gone,
           list_sum(list_transform(f, lambda v: CAST(v AS INT))) AS n_failed, is_good, is_toxic, n FROM masks, steps
),
summed AS (
    SELECT part, o, step, x, sum(n) FILTER (NOT gone AND NOT fails) AS kept, sum(n) FILTER (NOT gone AND fails) AS removed,
           sum(n) FILTER (gone AND fails) AS redundant, sum(n) FILTER (fails AND n_failed = 1) AS unique_fails,
           sum(n) FILTER (NOT gone AND fails AND is_good) AS good_lost, sum(n) FILTER (NOT gone AND fails AND is_toxic) AS toxic_lost
    FROM counted GROUP BY part, o, step, x
)
SELECT part, array_to_string(list_transform(o, lambda k: chr(CAST(64 + k AS INT))), '') AS filter_order, CAST(step AS INT) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, x), 0) AS BIGINT) AS shapley FROM summed"""

ORACLES: dict[str, str] = {
    "op11_merkle": _MERKLE,
    "op13_filter_audit": _AUDIT,
    "op1_line_dedup": _LINE_DEDUP,
    "op4_embedding_dedup": _EMBEDDINGS,
    "op5_mixing": _MIX,
    "op6_chat": _CHAT,
    "op3_licenses": f"""
WITH raw(license_id, x) AS (VALUES {_LICENSE_ROWS}),
known AS (
    SELECT md5(c) AS digest, min(license_id) AS license_id
    FROM (SELECT license_id, {_CANONICAL} AS c FROM raw) WHERE c <> '' GROUP BY 1
),
docs AS (SELECT doc_id, text, {_CANONICAL} AS c FROM (SELECT doc_id, text, text AS x FROM documents)),
lines AS (
    SELECT doc_id, {_CANONICAL} AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents)
),
notices AS (
    SELECT doc_id, string_agg(license_id, ',' ORDER BY license_id) AS notices
    FROM (SELECT DISTINCT doc_id, license_id FROM lines JOIN known ON digest = md5(c)) GROUP BY doc_id
)
SELECT doc_id, CASE WHEN c <> '' THEN md5(c) END AS digest, license_id, notices
FROM docs LEFT JOIN known ON c <> '' AND digest = md5(c) LEFT JOIN notices USING (doc_id)
""",
}
