"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from termlift.llm import licenses, nra, phrases, quality, sharding
from termlift.llm.queries import SHARD_BYTES

GAP = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_DEPTHS = f"generate_series(0, {sharding.HASH_BITS})"

OP4 = f"""
WITH hashed AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         right(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {sharding.HASH_BITS // 4}))::UBIGINT | (1::UBIGINT << 62)), {sharding.HASH_BITS}) AS bits
  FROM documents),
tried AS (SELECT hashed.*, depth, substr(bits, 1, depth) AS shard FROM hashed, (SELECT unnest({_DEPTHS}) AS depth)),
sizes AS (
  SELECT depth, shard, sum(n_bytes) AS bytes, count(DISTINCT bits) AS hashes FROM tried GROUP BY depth, shard),
chosen AS (
  SELECT doc_id, n_bytes, depth, shard, bytes > {SHARD_BYTES} AS oversized,
         row_number() OVER (PARTITION BY doc_id, bits ORDER BY depth) AS nth
  FROM tried JOIN sizes USING (depth, shard)
  WHERE bytes <= {SHARD_BYTES} OR hashes = 1 OR depth = {sharding.HASH_BITS})
SELECT doc_id, shard, depth::INTEGER AS depth, n_bytes, oversized FROM chosen WHERE nth = 1
"""

_TEMPLATE_ROWS = ", ".join(
    f"({_quoted(name)}, [{', '.join(_quoted(gram) for gram in licenses.template_bigrams(body))}])"
    for name, body in licenses.TEMPLATES.items()
)

OP9 = f"""
WITH templates AS (SELECT * FROM (VALUES {_TEMPLATE_ROWS}) AS t(name, grams)),
paragraphs AS (
  SELECT doc_id, unnest(p) AS part, generate_subscripts(p, 1) AS nth, len(p) AS parts
  FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '\\n{GAP}*\\n') AS p FROM documents)),
lines AS (
  SELECT doc_id, nth, unnest(l) AS line, len(l) AS many FROM (SELECT *, string_split(part, chr(10)) AS l FROM paragraphs)),
units AS (
  SELECT doc_id, line AS unit FROM lines
  UNION ALL SELECT doc_id, part FROM paragraphs WHERE contains(part, chr(10))
  UNION ALL SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM paragraphs WHERE parts > 1)),
cut AS (
  SELECT row_number() OVER () AS u, doc_id,
         list_filter(regexp_split_to_array(lower(unit), '{licenses.SEPARATOR}'), lambda x: x <> '') AS words
  FROM units),
grams AS (
  SELECT u, doc_id, CASE WHEN len(words) > 1
         THEN list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
         ELSE words END AS grams
  FROM cut WHERE len(words) > 0),
hits AS (
  SELECT u, doc_id, name, len(list_intersect(g.grams, t.grams)) AS c, len(g.grams) + len(t.grams) AS total
  FROM grams g, templates t
  WHERE 200 * least(len(g.grams), len(t.grams)) >= {licenses.PERCENT} * (len(g.grams) + len(t.grams))),
good AS (SELECT *, 2.0::DOUBLE * c / total AS dice FROM hits WHERE 200 * c >= {licenses.PERCENT} * total),
best AS (
  SELECT doc_id, name, dice, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, name) AS nth,
         count(DISTINCT u) OVER (PARTITION BY doc_id) AS n_units
  FROM good)
SELECT d.doc_id, name AS license, coalesce(dice, 0.0)::DOUBLE AS dice, coalesce(n_units, 0)::BIGINT AS n_units
FROM documents d LEFT JOIN (SELECT * FROM best WHERE nth = 1) b ON d.doc_id = b.doc_id
"""

_MEASURES = {
    "symbols": ("n_symbols", "n_words"),
    "word_length": ("word_chars", "n_words"),
    "repeats": ("n_repeat_words", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "capitals": ("n_capitals", "word_chars"),
}
_LONG = " UNION ALL ".join(
    f"SELECT lang, source, doc_id, '{name}' AS measure, CASE WHEN {whole} > 0 THEN {part} * 1000 // {whole} ELSE 0 END AS v, "
    f"{1000 * quality.EVENTS * quality.UNITS[name]} // greatest({whole}, 1) AS chance, {name in quality.LOW_SIDE} AS low_side FROM counts"
    for name, (part, whole) in _MEASURES.items()
)


OP10 = f"""
WITH cut AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{GAP}+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + {quality.WINDOW - 1}], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {quality.WINDOW - 2})) AS i FROM cut)),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS seen FROM windows), (SELECT unnest(range({quality.WINDOW})) AS k)
  WHERE seen > 1 GROUP BY doc_id),
counts AS (
  SELECT cut.doc_id, lang, source, len(words)::BIGINT AS n_words, len(lines)::BIGINT AS n_lines,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '{quality.SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         (length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')))::BIGINT AS n_capitals,
         coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM cut LEFT JOIN repeated ON cut.doc_id = repeated.doc_id),
bucketed AS (
  SELECT *, v // (1::BIGINT << greatest(length(bin(v)) - 6, 0)) * (1::BIGINT << greatest(length(bin(v)) - 6, 0)) AS bucket FROM ({_LONG})),
fine AS (SELECT lang, source, measure, bucket, low_side, count(*)::HUGEINT AS n FROM bucketed GROUP BY ALL),
in_lang AS (SELECT lang, count(*)::HUGEINT AS all_docs FROM documents GROUP BY lang),
shares AS (
  SELECT f.lang, source, measure, bucket, low_side, n * all_docs AS n
  FROM fine f JOIN in_lang l ON f.lang IS NOT DISTINCT FROM l.lang
  UNION ALL
  SELECT s.lang, s.source, measure, bucket, low_side, {quality.PRIOR} * n
  FROM (SELECT DISTINCT lang, source FROM documents) s JOIN fine f ON f.lang IS NOT DISTINCT FROM s.lang),
running AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY lang, source, measure) AS whole
  FROM (SELECT lang, source, measure, bucket, low_side, sum(n) AS n FROM shares GROUP BY ALL)),
quantiles AS (
  SELECT lang, source, measure, low_side, min(bucket) FILTER (5 * upto >= {5 - quality.UPPER} * whole) AS lower_q,
         min(bucket) FILTER (2 * upto >= whole) AS middle, min(bucket) FILTER (5 * upto >= {quality.UPPER} * whole) AS upper_q
  FROM running GROUP BY ALL),
fences AS (
  SELECT lang, source, measure, CASE WHEN low_side THEN lower_q - {quality.SPREAD} * (middle - lower_q) ELSE 0 END AS low,
         upper_q + {quality.SPREAD} * (upper_q - middle) AS high
  FROM quantiles),
verdict AS (
  SELECT doc_id, bool_and(v BETWEEN low - chance AND high + chance) AS inside
  FROM bucketed b
  JOIN fences f ON b.lang IS NOT DISTINCT FROM f.lang AND b.source IS NOT DISTINCT FROM f.source AND b.measure = f.measure
  GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words) AS base_failed,
       (n_words >= {quality.MIN_WORDS} AND 100 * n_repeat_words <= {quality.MAX_REPEAT_PERCENT} * n_words AND inside) AS kept
FROM counts JOIN verdict USING (doc_id)
"""

def _lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _term_lists(name: str, key: str) -> str:
    split = f"regexp_split_to_array({_lowered('text')}, '{nra.BETWEEN}')"
    return f"SELECT {key}, row_number() OVER () AS r, list_filter({split}, lambda x: x <> '') AS terms FROM {name}"


OP12 = f"""
WITH docs AS ({_term_lists("documents", "doc_id")}),
stats AS (SELECT count(*) AS many, sum(len(terms))::BIGINT AS total FROM docs WHERE len(terms) > 0),
tf AS (SELECT r, doc_id, len(terms) AS n, term, count(*) AS tf FROM (SELECT *, unnest(terms) AS term FROM docs) GROUP BY r, doc_id, len(terms), term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest(terms) AS term FROM ({_term_lists("benchmark", "item_id")})),
weights AS (SELECT item_id, term, floor(1000 * ln((2 * many + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM asked JOIN df USING (term), stats),
scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * many) // total))))::BIGINT AS score
  FROM weights JOIN tf USING (term), stats GROUP BY item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {nra.BEST}
"""

_PARTS = "[.,;:!?\\x0A-\\x0D]"

OP13 = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{phrases.NO_LANGUAGE}') AS lang, unnest(regexp_split_to_array({_lowered('text')}, '{_PARTS}')) AS piece FROM documents),
cut AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM pieces),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM cut GROUP BY lang),
starts AS (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM cut, (SELECT unnest(range(1, {phrases.MAX_WORDS + 1})) AS k)),
f AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM starts
  GROUP BY ALL HAVING count(*) >= {phrases.SUPPORT}),
split AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE k > 1),
parts AS (
  SELECT lang, phrase, f, c, array_to_string(words[1:c], ' ') AS head, array_to_string(words[c + 1:k], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS c FROM split)),
scored AS (
  SELECT p.lang, p.phrase, p.f AS a, p.c, h.f AS l, t.f AS r, n, ((1000::HUGEINT * p.f * n) // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM parts p JOIN f h ON p.lang = h.lang AND p.head = h.phrase JOIN f t ON p.lang = t.lang AND p.rest = t.phrase
  JOIN totals ON p.lang = totals.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_spans AS (
  SELECT lang, f, array_to_string(words[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, f, words, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM split))),
covered AS (SELECT lang, phrase, max(f) AS outside FROM inner_spans GROUP BY lang, phrase),
free AS (SELECT best.* FROM best LEFT JOIN covered USING (lang, phrase) WHERE outside IS NULL OR 100 * outside < 100 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {phrases.TOP}
"""

ORACLES = {
    "op4_sharding": OP4,
    "op9_licenses": OP9,
    "op10_quality": OP10,
    "op12_nra_search": OP12,
    "op13_son_phrases": OP13,
}
