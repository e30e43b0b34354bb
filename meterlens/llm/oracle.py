"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

#: Lower-cases A-Z only, unlike ``lower``.
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

WORD = r"[^\x20\x09-\x0D]+"

# The table of CRC-32 from its rule; the bytes of a text come from the hexadecimal form of its UTF-8.
CRC_TABLE = """entries AS (
    SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM (SELECT unnest(range(256))::BIGINT AS i))"""


def crc32(text: str) -> str:
    """CRC-32 of an SQL text; ``entries`` is among the tables."""
    digit = "instr('0123456789ABCDEF', substr(hex(encode({0})), 2 * k::INT + {1}, 1)) - 1"
    byte = f"(16 * ({digit.format(text, 1)}) + {digit.format(text, 2)})::BIGINT"
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(strlen({text})),
        lambda k: {byte})), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)"""


ORACLES["op12_importance_resampling"] = rf"""
WITH words AS (
    SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text,
           coalesce(regexp_extract_all({LOWERED}, '{TERM}'), []) AS ws FROM documents
    UNION ALL
    SELECT 'b', row_number() OVER (), item_id, text,
           coalesce(regexp_extract_all({LOWERED}, '{TERM}'), []) FROM benchmark),
{CRC_TABLE},
tokens AS (SELECT side, r, unnest(ws) AS w FROM words),
hashed AS (SELECT w, {crc32('w')} % 10000 AS bucket FROM (SELECT DISTINCT w FROM tokens), entries),
placed AS (SELECT side, r, bucket FROM tokens JOIN hashed USING (w)),
counts AS (
    SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
    FROM placed GROUP BY bucket),
totals AS (SELECT sum(s)::BIGINT AS all_s, sum(t)::BIGINT AS all_t FROM counts),
gains AS (
    SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + 10000))::DOUBLE
                                   / ((s + 1) * (all_t + 10000))::DOUBLE))::BIGINT AS gain
    FROM counts, totals),
weights AS (
    SELECT r, sum(gain)::BIGINT AS weight FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
    SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((
               ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
               / 4294967296::DOUBLE)))::BIGINT AS score
    FROM words LEFT JOIN weights USING (r) WHERE side = 'd')
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
             count(*) FILTER (n_features >= 20) OVER () AS eligible FROM scored)
"""

ORACLES["op13_ranked_search"] = rf"""
WITH terms AS (
    SELECT doc_id, regexp_extract_all({LOWERED}, '{TERM}') AS ws FROM documents WHERE text IS NOT NULL),
lengths AS (SELECT doc_id, len(ws)::BIGINT AS n FROM terms WHERE len(ws) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS all_terms FROM lengths),
postings AS (
    SELECT doc_id, w, count(*)::BIGINT AS tf
    FROM (SELECT doc_id, unnest(ws) AS w FROM terms) GROUP BY doc_id, w),
held AS (SELECT w, count(*)::BIGINT AS df FROM postings GROUP BY w),
weights AS (
    SELECT w, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
    FROM held, totals),
item_terms AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWERED}, '{TERM}')) AS w
    FROM benchmark WHERE text IS NOT NULL),
scores AS (
    SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (
        1000 * tf + 20 * (50 + (50 * n * docs) // all_terms))))::BIGINT AS score
    FROM item_terms JOIN weights USING (w) JOIN postings USING (w) JOIN lengths USING (doc_id), totals
    GROUP BY item_id, doc_id),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
    FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLES["op5_suffix_dedup"] = """
WITH bytes AS (SELECT doc_id, encode(coalesce(text, '')) AS x FROM documents),
starts AS (
    SELECT doc_id, i, x[i + 1:i + 50] AS s
    FROM (SELECT doc_id, x, unnest(range(greatest(octet_length(x) - 49, 0))) AS i FROM bytes)),
firsts AS (SELECT s, min(doc_id) AS least FROM starts GROUP BY s),
hits AS (SELECT doc_id, i FROM starts JOIN firsts USING (s) WHERE least < doc_id),
marked AS (
    SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true)::INT AS opens
    FROM hits),
spans AS (
    SELECT doc_id, min(i) AS a, max(i) + 50 AS b
    FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked)
    GROUP BY doc_id, span),
kept AS (
    SELECT doc_id, count(*) AS n, sum(b - a) AS removed, max(b) AS last,
           string_agg(CASE WHEN a > before THEN hex(x[before + 1:a]) ELSE '' END, '' ORDER BY a) AS head
    FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans)
    JOIN bytes USING (doc_id) GROUP BY doc_id)
SELECT doc_id, octet_length(x)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
       coalesce(n, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || CASE WHEN coalesce(last, 0) < octet_length(x)
           THEN hex(x[coalesce(last, 0) + 1:octet_length(x)]) ELSE '' END)) AS kept_sha256
FROM bytes LEFT JOIN kept USING (doc_id)
"""

ORACLES["op8_minhash_dedup"] = rf"""
WITH RECURSIVE words AS (SELECT doc_id, coalesce(regexp_extract_all({LOWERED}, '{WORD}'), []) AS ws FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 3, 2)),
        lambda i: array_to_string(ws[i:i + 4], ' '))) AS s
    FROM words WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT x, y FROM (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2)
    JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * c >= 75 * (p.n + q.n - c)),
reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, y FROM reached r JOIN links ON x = r.other)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least_id AS component_id, doc_id = least_id AS kept
FROM (SELECT doc_id, min(other) AS least_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""

ORACLES["edited_texts"] = """
WITH ordered AS (
    SELECT doc_id, coalesce(text, '') AS own, length(coalesce(text, '')) AS n,
           coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS next
    FROM documents WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, n::BIGINT AS n_chars,
       sha256(substr(own, 1, n - n // 3) || substr(next, 1, n // 3)) AS edited_sha256
FROM ordered
"""

# Places of the matches from the lengths of the matches and of what lies between them.
_SPANS = r"""
    SELECT doc_id, '{kind}' AS kind, {number} AS k, unnest(list_filter(list_transform(range(1, len(found) + 1), lambda i: struct_pack(
        a := list_sum(list_transform(between[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda p: length(p))), 0),
        n := length(found[i]), long := length(value[i]) >= {least})), lambda m: m.long)) AS m
    FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS found, regexp_extract_all(text, '{pattern}', {group}) AS value,
                 string_split_regex(text, '{pattern}') AS between FROM documents WHERE text IS NOT NULL)"""
_ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
ORACLES["secret_base_spans"] = "WITH spans AS (" + " UNION ALL ".join(
    _SPANS.format(kind=kind, number=i, pattern=pattern, group=group, least=least)
    for i, (kind, pattern, group, least) in enumerate([
        ("assign", _ASSIGN, 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]{32,}", 0, 32)])) + """),
texts AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || m.a::BIGINT || ':' || (m.a + m.n)::BIGINT, ',' ORDER BY m.a, k) AS listed
    FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(listed, '')) AS base_sha256
FROM documents LEFT JOIN texts USING (doc_id)
"""

# A round caps the sources whose share of the rest is above their limit; 30 rounds cap all there are.
ORACLES["mix_targets"] = rf"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
sources AS (
    SELECT source, n, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1] AS w
    FROM (SELECT source, sum(size)::BIGINT AS n FROM sized GROUP BY source)),
lists AS (SELECT list(n ORDER BY source NULLS LAST) AS ns, list(w ORDER BY source NULLS LAST) AS ws,
                 list(coalesce(source, '') ORDER BY source NULLS LAST) AS names, count(*)::INT AS k FROM sources),
rounds AS (
    SELECT 0 AS r, list_transform(ns, lambda n: false) AS capped FROM lists
    UNION ALL
    SELECT r + 1, list_transform(range(1, k + 1), lambda i: capped[i] OR rest * ws[i] / weight > 3 * ns[i])
    FROM (SELECT r, capped, ns, ws, k,
                 list_sum(ns) - coalesce(list_sum(list_transform(range(1, k + 1), lambda i: CASE WHEN capped[i] THEN 3 * ns[i] ELSE 0 END)), 0) AS rest,
                 greatest(coalesce(list_sum(list_transform(range(1, k + 1), lambda i: CASE WHEN capped[i] THEN 0 ELSE ws[i] END)), 1), 1) AS weight
          FROM rounds, lists) WHERE r < 30),
done AS (
    SELECT unnest(range(1, k + 1)) AS i, capped, ns, ws, k,
           list_sum(ns) - coalesce(list_sum(list_transform(range(1, k + 1), lambda i: CASE WHEN capped[i] THEN 3 * ns[i] ELSE 0 END)), 0) AS rest,
           greatest(coalesce(list_sum(list_transform(range(1, k + 1), lambda i: CASE WHEN capped[i] THEN 0 ELSE ws[i] END)), 1), 1) AS weight
    FROM rounds, lists WHERE r = 30),
numbered AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM sources)
SELECT doc_id, size, n AS source_size,
       round(CASE WHEN capped[i] THEN 3 * n ELSE rest * w / weight END::DOUBLE, 3) AS target
FROM sized JOIN numbered ON sized.source IS NOT DISTINCT FROM numbered.source JOIN done USING (i)
"""

ORACLES["base_language_model"] = rf"""
WITH {CRC_TABLE},
texts AS (
    SELECT doc_id, {crc32('doc_id::VARCHAR')} % 5 = 1 AS held_out,
           list_concat(coalesce(regexp_extract_all({LOWERED}, '{WORD}'), []), [' ']) AS ws
    FROM documents, entries),
tokens AS (SELECT doc_id, held_out, unnest(ws) AS w FROM texts),
counted AS (SELECT w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY w),
totals AS (SELECT sum(c)::BIGINT AS n, count(*) AS v FROM counted)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, n AS train_tokens,
       round(sum(log10((coalesce(c, 0) + 0.5) / (n + 0.5 * (v + 1)))), 5) AS base_score
FROM tokens LEFT JOIN counted USING (w), totals GROUP BY doc_id, held_out, n
"""

_HIDDEN = r"(?is)<!--.*?(?:-->|\z)" + "".join(
    rf"|<{e}\b[^>]*>.*?(?:</{e}\s*>|\z)" for e in ("script", "style", "title", "noscript", "template"))
_BREAKS = (r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|blockquote|pre)"
           r"\b[^>]*>")


def _digest(block: str) -> str:
    return f"""'sha1:' || array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform(
        [15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            ((('0x' || substr(sha1({block}), 5 * g::INT + 1, 5))::INT >> s) & 31) + 1, 1)), '')), '')"""


def _identifier(text: str) -> str:
    h = f"sha1({text})"
    return (f"'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3)"
            f" || '-8' || substr({h}, 18, 3) || '-' || substr({h}, 21, 12) || '>'")


# The references the test pages hold; an ampersand comes last, so none is read twice.
_READ = "flat"
for _name, _text in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
    _READ = f"replace({_READ}, '&{_name};', '{_text}')"
ORACLES["op9_warc_derivatives"] = rf"""
WITH pages_read AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
texts AS (
    SELECT *, {_identifier("concat_ws('|', 'response', coalesce(page_id::VARCHAR, ''), coalesce(url, ''), sha1(body))")} AS response,
           {_digest('body')} AS payload_digest,
           regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '{_HIDDEN}', ' ', 'g'),
               '[ \t\r\n]+', ' ', 'g'), '{_BREAKS}', chr(10), 'g'), '<[A-Za-z/!?][^>]*>', '', 'g') AS flat
    FROM pages_read),
stripped AS (
    SELECT *, regexp_replace(regexp_replace({_READ}, '[ ]*\n[ \n]*', chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g') AS text,
           regexp_extract_all(body, '(?i)<a\s[^>]*?href\s*=\s*["'']([^"'']*)', 1) AS found
    FROM texts),
described AS (
    SELECT *, {_identifier("concat_ws('|', 'conversion', response)")} AS conversion_id,
           {_identifier("concat_ws('|', 'metadata', response)")} AS metadata_id,
           to_json(struct_pack(response := response, status := '200',
               headers := ['HTTP/1.1 200 OK', 'Content-Type: text/html; charset=utf-8'],
               title := trim(regexp_extract(body, '(?is)<title[^>]*>(.*?)</title', 1)),
               links := list_filter(found, lambda x, i: list_position(found, x) = i),
               body_bytes := strlen(body), text_chars := length(text),
               payload_digest := payload_digest))::VARCHAR AS described
    FROM stripped),
records AS (
    SELECT page_id, 'metadata' AS record_type, metadata_id AS record_id, response AS refers_to,
           conversion_id AS concurrent_to, url, 'application/json' AS content_type, payload_digest, described AS block
    FROM described
    UNION ALL
    SELECT page_id, 'conversion', conversion_id, response, NULL, url, 'text/plain', payload_digest, text FROM described)
SELECT page_id, record_type, record_id, refers_to, concurrent_to, url AS target_uri, '1970-01-01T00:00:00Z' AS date,
       content_type, payload_digest, {_digest('block')} AS block_digest, strlen(block)::BIGINT AS content_length,
       sha256(block) AS block_sha256
FROM records
"""

# The primes of XXH64. Products of 64 bits are taken in 128 and cut.
_P1, _P2, _P3 = 11400714785074694791, 14029467366897019727, 1609587929392839161
_P4, _P5, _SEED = 9650029242287828579, 2870177450012600261, 42
_2_64 = 1 << 64


def _u(x: str | int) -> str:
    return f"{x}::UHUGEINT"


def _times(a: str, b: int) -> str:
    return f"(({_u(a)} * {_u(b)}) % {_u(_2_64)})"


def _turned(x: str, r: int) -> str:
    return f"(({_u(x)} * {_u(1 << r)}) % {_u(_2_64)} + {_u(x)} // {_u(1 << 64 - r)})"


def _xor(a: str, b: str) -> str:
    return f"xor({a}::UBIGINT, {b}::UBIGINT)"


def _lane(at: str, size: int) -> str:
    """The little-endian number at byte ``at`` (from 0) of column ``x``, hexadecimal digits."""
    return "(" + " + ".join(
        f"('0x' || substr(x, 2 * ({at})::INT + {2 * i + 1}, 2))::UHUGEINT * {_u(1 << 8 * i)}" for i in range(size)) + ")"


def _round(v: str, lane: str) -> str:
    return _times(_turned(f"(({v} + {_times(lane, _P2)}) % {_u(_2_64)})", 31), _P1)


def _stripes(number: int, start: int) -> str:
    lanes = f"list_transform(range(n // 32), lambda i: {_lane(f'32 * i + {8 * number}', 8)})"
    return f"list_reduce(list_concat([{_u(start % _2_64)}], {lanes}), lambda v, k: {_round('v', 'k')})"


def _merged(h: str, v: str) -> str:
    return f"(({_times(_xor(h, _round('0::UHUGEINT', v)), _P1)} + {_u(_P4)}) % {_u(_2_64)})"


_EIGHTS = f"list_transform(range((n % 32) // 8), lambda i: {_round('0::UHUGEINT', _lane('n - n % 32 + 8 * i', 8))})"
_BYTES = f"list_transform(range(n % 4), lambda i: {_lane('n - n % 4 + i', 1)})"
ORACLES["op11_simhash_dedup"] = rf"""
WITH RECURSIVE words AS (SELECT doc_id, coalesce(regexp_extract_all({LOWERED}, '{WORD}'), []) AS ws FROM documents),
shingles AS (
    SELECT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 1, 2)), lambda i: array_to_string(ws[i:i + 2], ' '))) AS s
    FROM words WHERE len(ws) > 0),
texts AS (SELECT s, hex(encode(s)) AS x, strlen(s)::INT AS n FROM (SELECT DISTINCT s FROM shingles)),
stripes AS (
    SELECT s, x, n, {_stripes(0, _SEED + _P1 + _P2)} AS a, {_stripes(1, _SEED + _P2)} AS b,
           {_stripes(2, _SEED)} AS c, {_stripes(3, _SEED - _P1)} AS d FROM texts),
started AS (
    SELECT *, CASE WHEN n < 32 THEN {_u((_SEED + _P5) % _2_64)} ELSE
        ({_turned('a', 1)} + {_turned('b', 7)} + {_turned('c', 12)} + {_turned('d', 18)}) % {_u(_2_64)} END AS h FROM stripes),
one AS (SELECT s, x, n, b, c, d, CASE WHEN n < 32 THEN h ELSE {_merged('h', 'a')} END AS h FROM started),
two AS (SELECT s, x, n, c, d, CASE WHEN n < 32 THEN h ELSE {_merged('h', 'b')} END AS h FROM one),
three AS (SELECT s, x, n, d, CASE WHEN n < 32 THEN h ELSE {_merged('h', 'c')} END AS h FROM two),
four AS (SELECT s, x, n, ((CASE WHEN n < 32 THEN h ELSE {_merged('h', 'd')} END) + n::UHUGEINT) % {_u(_2_64)} AS h FROM three),
eights AS (
    SELECT s, x, n, list_reduce(list_concat([h], {_EIGHTS}),
        lambda v, k: ({_times(_turned(_xor('v', 'k'), 27), _P1)} + {_u(_P4)}) % {_u(_2_64)}) AS h FROM four),
fours AS (
    SELECT s, x, n, CASE WHEN n % 8 < 4 THEN h ELSE ({_times(_turned(_xor('h', _times(_lane('n - n % 8', 4), _P1)), 23), _P2)}
        + {_u(_P3)}) % {_u(_2_64)} END AS h FROM eights),
ends AS (
    SELECT s, list_reduce(list_concat([h], {_BYTES}),
        lambda v, k: {_times(_turned(_xor('v', _times('k', _P5)), 11), _P1)}) AS h FROM fours),
mixed AS (SELECT s, {_times(_xor('h', f'(h // {_u(1 << 33)})'), _P2)} AS h FROM ends),
mixed_again AS (SELECT s, {_times(_xor('h', f'(h // {_u(1 << 29)})'), _P3)} AS h FROM mixed),
hashed AS (SELECT s, {_xor('h', f'(h // {_u(1 << 32)})')} AS h FROM mixed_again),
prints AS (
    SELECT doc_id, ({' + '.join(f"CASE WHEN 2 * sum((h >> {b}) & 1) > count(*) THEN {_u(1 << b)} ELSE 0::UHUGEINT END" for b in range(64))})::UBIGINT AS p
    FROM shingles JOIN hashed USING (s) GROUP BY doc_id),
all_prints AS (SELECT doc_id, coalesce(p, 0::UBIGINT) AS p FROM documents LEFT JOIN prints USING (doc_id)),
classes AS (SELECT p, min(doc_id) AS least FROM all_prints GROUP BY p),
links AS (SELECT a.p AS x, b.p AS y FROM classes a JOIN classes b ON bit_count(xor(a.p, b.p)) <= 3 AND a.p <> b.p),
reached AS (SELECT p, p AS other FROM classes UNION SELECT r.p, y FROM reached r JOIN links ON x = r.other),
components AS (SELECT r.p, min(c.least) AS component_id FROM reached r JOIN classes c ON c.p = r.other GROUP BY r.p)
SELECT doc_id, format('{{:016x}}', p) AS fingerprint, component_id FROM all_prints JOIN components USING (p)
"""
