"""SQL for DuckDB of the queries that SQL can express, written on plain strings instead of hashes and automata."""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Lines one edit apart are equal without the character at one place, or one is the other without one.
LINE_DEDUP = r"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(range(len(lines))) AS no, unnest(lines) AS raw FROM split WHERE text IS NOT NULL),
norm AS (SELECT doc_id, no, raw, lower(trim(regexp_replace(raw, '[\t\n\x0B\f\r ]+', ' ', 'g'))) AS v FROM line),
first AS (SELECT v, min(row(doc_id, no)) AS pos FROM norm WHERE v <> '' GROUP BY v),
longer AS (SELECT v, pos, length(v) AS n FROM first WHERE length(v) >= 20),
place AS (SELECT v, pos, n, unnest(range(n)) AS i FROM longer),
without AS (SELECT v, pos, n, i, substr(v, 1, i) || substr(v, i + 2) AS k FROM place),
near AS (
  SELECT a.v FROM without a JOIN without b ON a.k = b.k AND a.i = b.i AND a.v <> b.v AND b.pos < a.pos
  UNION SELECT a.v FROM without a JOIN longer b ON a.k = b.v AND b.pos < a.pos
  UNION SELECT b.v FROM without a JOIN longer b ON a.k = b.v AND a.pos < b.pos
),
judged AS (
  SELECT n.doc_id, n.no, n.raw, f.v IS NOT NULL AND (row(n.doc_id, n.no) <> f.pos OR n.v IN (SELECT v FROM near)) AS gone
  FROM norm n LEFT JOIN first f ON n.v = f.v
),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY no) FILTER (NOT gone), '') AS text
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

#: Two hexadecimal digits stand for a byte; every 50-byte string is compared as it is.
SUFFIXES = """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
block AS (SELECT doc_id, n, o, substr(h, 2 * o + 1, 2 * (2000 + 49)) AS h
          FROM (SELECT doc_id, n, h, unnest(range(0, n, 2000)) AS o FROM doc WHERE n >= 50)),
string AS (SELECT doc_id, o + i AS i, substr(h, 2 * i + 1, 100) AS v
           FROM (SELECT doc_id, o, h, unnest(range(least(2000, n - 49 - o))) AS i FROM block WHERE n - 49 > o)),
first AS (SELECT v, min(doc_id) AS doc_id FROM string GROUP BY v),
gone AS (SELECT s.doc_id, s.i FROM string s JOIN first f ON s.v = f.v WHERE f.doc_id < s.doc_id),
step AS (SELECT doc_id, i, coalesce(i - lag(i) OVER w > 50, true)::INT AS opens FROM gone WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
run AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z
        FROM (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM step) GROUP BY doc_id, g),
gap AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM run),
kept AS (
  SELECT d.doc_id, sum(z - a) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) || substr(any_value(h), 2 * max(z) + 1) AS h
  FROM gap g JOIN doc d ON g.doc_id = d.doc_id GROUP BY d.doc_id
)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       coalesce(k.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM doc d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

DECONTAMINATION = f"""
WITH doc AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
item AS (SELECT item_id, {_WORDS.format("text")} AS ws FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
sized AS (SELECT item_id, ws, least(len(ws), 10) AS n FROM item WHERE len(ws) > 0),
pattern AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[s : s + n - 1], ' ') AS words
  FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM sized)
),
size AS (SELECT DISTINCT n FROM pattern),
opening AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM doc, size WHERE len(ws) >= n),
hit AS (
  SELECT o.doc_id, o.s, o.n, p.item_id
  FROM (SELECT doc_id, s, n, array_to_string(ws[s : s + n - 1], ' ') AS words FROM opening) o
  JOIN pattern p ON o.n = p.n AND o.words = p.words
),
word AS (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS w FROM (SELECT DISTINCT doc_id, s, n FROM hit)),
words AS (SELECT doc_id, count(*) AS n_hit FROM word GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(w.n_hit, 0)::BIGINT AS n_hit,
       coalesce(i.n_items, 0)::BIGINT AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(w.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN words w ON d.doc_id = w.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id
"""

#: Every group is compared term by term, zero counts too; whole numbers only.
DIVERGENCE = r"""
WITH doc AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(""" + _LOWER.format("coalesce(text, '')") + r""", '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
use AS (SELECT row, lang, source, unnest(terms) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS n FROM use GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
groups AS (SELECT DISTINCT lang, source FROM doc),
found AS (SELECT u.lang, u.source, u.term, count(*) AS n FROM use u JOIN kept k ON u.lang = k.lang AND u.term = k.term GROUP BY ALL),
whole AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
total AS (SELECT lang, source, sum(n) AS n FROM found GROUP BY lang, source),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(f.n, 0) + 1)) // (coalesce(t.n, 0) + w.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 1)) // (w.n + w.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN whole w ON g.lang = w.lang
  LEFT JOIN total t ON g.lang = t.lang AND g.source = t.source
  LEFT JOIN found f ON g.lang = f.lang AND g.source = f.source AND k.term = f.term
),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM dense WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
) WHERE part = 'pair' OR rank <= 200
"""

#: Windows are compared as strings of their words.
SUBSTRINGS = r"""
WITH doc AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS ws FROM documents
),
place AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM doc WHERE len(ws) >= 13),
opening AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS words FROM place),
first AS (SELECT words, min(doc_id) AS doc_id FROM opening GROUP BY words),
later AS (SELECT o.doc_id, o.i FROM opening o JOIN first f ON o.words = f.words WHERE f.doc_id < o.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM later),
word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w FROM doc),
kept AS (
  SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS text, count(*) AS n
  FROM word w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id
)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, (len(d.ws) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM doc d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""



def _crc_step() -> str:
    """One byte ``b`` of a CRC-32 ``c``: the shifted value and a fixed remainder for each set bit."""
    step = "c >> 8"
    for bit in range(8):
        remainder = 1 << bit
        for _ in range(8):
            remainder = (remainder >> 1) ^ (0xEDB88320 if remainder & 1 else 0)
        step = f"xor({step}, ((xor(c, b) >> {bit}) & 1) * {remainder})"
    return step


#: Costs of 17 shards; the first 16 decide the shard. The parts of a shard follow the MD5 of the row.
SHARDING = f"""
WITH doc AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
summed AS (
  SELECT doc_id, size, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda c, b: {_crc_step()}), 4294967295) AS text_crc32
  FROM doc
),
cost AS (
  SELECT *, list_transform(range(17), lambda s: -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || s), 1, 13))
    ::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)) AS costs
  FROM summed
),
dealt AS (
  SELECT doc_id, size, text_crc32, list_position(costs[1:16], list_min(costs[1:16])) - 1 AS shard,
         list_position(costs, list_min(costs)) - 1 AS grown_shard
  FROM cost
),
part AS (
  SELECT *, substr(md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), size, text_crc32, shard, grown_shard)), 1, 2) AS bucket
  FROM dealt
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32, grown_shard) - 1)::BIGINT AS slot,
       grown_shard::INTEGER AS grown_shard
FROM part
"""

ORACLE: dict[str, str] = {
    "op2_line_dedup": LINE_DEDUP,
    "op6_suffixes": SUFFIXES,
    "op7_sharding": SHARDING,
    "op8_decontamination": DECONTAMINATION,
    "op12_divergence": DIVERGENCE,
    "op13_substrings": SUBSTRINGS,
}
