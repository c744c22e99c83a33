"""DuckDB twins of the subpackage's queries that SQL can say. The others learn
a model (4, 5, 6, 7, 9) and are tested against brute force or held-out labels."""

from __future__ import annotations

from .licenses import PHRASES, SHARE, TEMPLATES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _low(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


def _alnum(text: str) -> str:
    return rf"regexp_extract_all({_low(text)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _nonspace(text: str) -> str:
    return rf"regexp_extract_all({_low(text)}, '[^\x20\x09-\x0D]+')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OP1 = rf"""
WITH d AS (SELECT doc_id, {_alnum('text')} AS ws FROM documents),
b AS (SELECT item_id, {_alnum('text')} AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(ws)) AS n,
         array_to_string(list_slice(ws, i, i + least(13, len(ws)) - 1), ' ') AS w
       FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
lengths AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, i, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS w
       FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lengths WHERE len(ws) >= n)),
hits AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.w = iw.w),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_PHRASES = ", ".join(f"({_text(p)}, {_text(label)})" for p, label in PHRASES.items())
_TEMPLATES = ", ".join(f"({_text(label)}, {_text(t)})" for label, texts in TEMPLATES.items() for t in texts)

OP2 = rf"""
WITH d AS (SELECT doc_id, text, {_alnum('text')} AS ws FROM documents),
phrases AS (SELECT string_split(p, ' ') AS p, label FROM (VALUES {_PHRASES}) v(p, label)),
places AS (SELECT doc_id, i - 1 AS place, label
           FROM (SELECT doc_id, ws, p, label, unnest(range(1, len(ws) - len(p) + 2)) AS i FROM d, phrases WHERE len(ws) >= len(p))
           WHERE list_slice(ws, i, i + len(p) - 1) = p),
base AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY doc_id),
t AS (SELECT label, list_distinct({_alnum('v.t')}) AS tw FROM (VALUES {_TEMPLATES}) v(label, t)),
blocks AS (SELECT DISTINCT doc_id, list_distinct({_alnum('block')}) AS bw
           FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?;])([ \t-\r])', '\1' || chr(10) || '\2', 'g'), chr(10))) AS block
                 FROM documents WHERE text IS NOT NULL)),
found AS (SELECT doc_id, label, len(list_intersect(bw, tw)) / len(tw) AS share
          FROM blocks, t WHERE list_has_any(bw, tw) AND {SHARE[1]} * len(list_intersect(bw, tw)) >= {SHARE[0]} * len(tw)),
every AS (SELECT doc_id, label, share FROM found UNION ALL SELECT doc_id, label, 1.0 FROM places),
al AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM every GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN al USING (doc_id)
"""

OP3 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
w AS (SELECT doc_id, i, hash(substr(hx, 2 * i + 1, 200)) AS h
      FROM (SELECT doc_id, hx, unnest(range(0, greatest(len(hx) // 2 - 99, 0))) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
starts AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS new FROM again),
runs AS (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts),
spans AS (SELECT doc_id, min(i) AS s, max(i) + 100 AS e FROM runs GROUP BY doc_id, run),
pieces AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM spans),
kept AS (SELECT doc_id, count(*) AS n_spans, sum(e - s) AS n_removed,
           string_agg(substr(hx, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) || substr(any_value(hx), 2 * max(e) + 1) AS hx
         FROM pieces JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.hx) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.hx, d.hx))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT html, max(page_id) AS holder FROM p WHERE octet_length(encode(html)) >= 1000 GROUP BY html)
SELECT page_id, CAST(octet_length(encode(p.html)) AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM p LEFT JOIN h USING (html)
"""

OP10 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_nonspace('text')} AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 2), chr(0)) AS s
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""

def _crc_table() -> list[int]:
    """The table of the reflected CRC-32 polynomial, by its rule."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


OP11 = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_low('text')}, '[a-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
bytes AS (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hx FROM counted),
crc AS (SELECT run, n, xor(list_reduce(
    list_transform(range(0, len(hx) // 2), lambda i: CAST('0x' || substr(hx, 2 * i + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, list_extract({_crc_table()}::BIGINT[], (xor(c, b) & 255) + 1)),
    4294967295::BIGINT), 4294967295) AS h FROM bytes),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM crc),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
without AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS gap FROM places),
pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM without a JOIN without b ON a.i = b.i AND a.gap = b.gap AND a.word <> b.word
          UNION SELECT w.word, b.word, b.n FROM without b JOIN w ON w.word = b.gap
          UNION SELECT b.word, w.word, w.n FROM without b JOIN w ON w.word = b.gap),
best AS (SELECT word, near, near_n, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k,
           count(*) OVER (PARTITION BY word) AS n_near FROM pairs),
known AS (SELECT w.word, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
            CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
          FROM w LEFT JOIN best ON best.word = w.word AND k = 1),
chain(word, last) AS (SELECT word, word FROM known UNION ALL SELECT c.word, form FROM chain c JOIN known k ON k.word = c.last WHERE form IS NOT NULL)
SELECT known.word, known.form, c.last AS root, known.n, known.n_near, known.form_n
FROM known JOIN chain c ON c.word = known.word JOIN known e ON e.word = c.last AND e.form IS NULL
"""

OP12 = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_low('text')}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM pieces),
g AS (SELECT lang, size, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS w
      FROM (SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM p, (VALUES (1), (2), (3)) s(size) WHERE len(ws) >= size)),
f AS (SELECT lang, size, w, count(*) AS f FROM g GROUP BY lang, size, w),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
often AS (SELECT lang, w, f FROM f WHERE f >= 10),
c AS (SELECT lang, size, w, string_split(w, ' ') AS ws, f AS a FROM f WHERE size > 1 AND f >= 10),
cut AS (SELECT lang, w, a, k, array_to_string(list_slice(ws, 1, k), ' ') AS lw, array_to_string(list_slice(ws, k + 1, size), ' ') AS rw
        FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
cuts AS (SELECT cut.lang, cut.w, a, k, x.f AS l, y.f AS r, (1000000 * a::HUGEINT * a) // (x.f::HUGEINT * y.f) AS score
         FROM cut JOIN often x ON x.lang = cut.lang AND x.w = lw JOIN often y ON y.lang = cut.lang AND y.w = rw),
low AS (SELECT *, row_number() OVER (PARTITION BY lang, w ORDER BY score, k) AS choice FROM cuts),
around AS (SELECT lang, array_to_string(list_slice(ws, i, i + 1), ' ') AS w, max(a) AS around
           FROM (SELECT lang, ws, a, unnest([1, 2]) AS i FROM c WHERE size = 3) GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN around USING (lang, w)
         WHERE choice = 1 AND (around IS NULL OR 100 * around < 50 * low.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, w) AS rank FROM kept)
SELECT lang, rank, w AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": OP1, "op2_license_scan": OP2, "op3_suffix_dedup": OP3, "op8_warc_salvage": OP8,
    "op10_jaccard_join": OP10, "op11_spelling_variants": OP11,
    "op12_phrase_collocations": OP12}
