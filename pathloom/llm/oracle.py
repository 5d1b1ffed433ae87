"""The queries that SQL can express, as DuckDB SQL."""

from __future__ import annotations

from pathloom.llm.queries import BLOCKED_HOSTS, URL_RULES

_RATIOS = {
    "symbols": ("1000 * n_symbols // greatest(n_words, 1)", 100),
    "length": ("1000 * word_chars // greatest(n_words, 1)", 1500),
    "dup_lines": ("1000 * n_dup_lines // greatest(n_lines, 1)", 500),
    "repeats": ("1000 * n_repeat_words // greatest(n_words, 1)", 300),
}
_LEVELS = {"own": "lang, source, feature", "of_lang": "lang, feature", "of_all": "feature"}
_SPACE = r"[^\x20\x09-\x0D]+"


def _level(name: str, keys: str) -> str:
    return f"""{name} AS (
  SELECT {keys}, max(total) AS docs, min(bucket) FILTER (4 * upto >= total) AS q1, min(bucket) FILTER (4 * upto >= 3 * total) AS q3
  FROM (SELECT {keys}, bucket, sum(n) OVER (PARTITION BY {keys} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {keys}) AS total
        FROM (SELECT {keys}, bucket, sum(n) AS n FROM sketch GROUP BY ALL))
  GROUP BY {keys})"""


QUALITY_RULES = f"""
WITH words AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_SPACE}')) AS lines
  FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM words),
texts AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS t FROM windows),
again AS (SELECT doc_id, i FROM texts QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1),
cover AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM again) GROUP BY doc_id),
base AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN cover USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base),
ratios AS ({" UNION ALL ".join(f"SELECT doc_id, lang, source, base_failed, '{k}' AS feature, {v} AS v FROM judged" for k, (v, _) in _RATIOS.items())}),
sketch AS (
  SELECT lang, source, feature, (v >> greatest(length(bin(v)) - 5, 0)) << greatest(length(bin(v)) - 5, 0) AS bucket, count(*) AS n
  FROM ratios WHERE NOT base_failed GROUP BY ALL),
{", ".join(_level(k, v) for k, v in _LEVELS.items())},
limits AS (
  SELECT own.lang, own.source, own.feature, CASE WHEN own.docs >= 200 THEN own.q1 WHEN l.docs >= 200 THEN l.q1 ELSE a.q1 END AS q1,
         CASE WHEN own.docs >= 200 THEN own.q3 WHEN l.docs >= 200 THEN l.q3 ELSE a.q3 END AS q3,
         CASE own.feature {" ".join(f"WHEN '{k}' THEN {s}" for k, (_, s) in _RATIOS.items())} END AS slack
  FROM own JOIN of_lang l ON own.lang IS NOT DISTINCT FROM l.lang AND own.feature = l.feature JOIN of_all a ON own.feature = a.feature),
inside AS (
  SELECT r.doc_id, bool_and(v <= q3 + 3 * (q3 - q1) + slack AND (r.feature <> 'length' OR v >= q1 - 3 * (q3 - q1) - slack)) AS ok
  FROM ratios r JOIN limits m ON r.lang IS NOT DISTINCT FROM m.lang AND r.source IS NOT DISTINCT FROM m.source AND r.feature = m.feature
  GROUP BY r.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(ok, FALSE) AS kept
FROM judged LEFT JOIN inside USING (doc_id)
"""


def _fits(host: str, path: str) -> str:
    return f"(ends_with('.' || host, '.{host}') AND starts_with(path, '{path}'))"


def _glob(host: str) -> str:
    inner = "".join("[^/]*" if c == "*" else f"[{c}]" if c in ".-" else c for c in host)
    return f"regexp_full_match('.' || host || path, '{inner}(/[\\s\\S]*)?')"


_RANKED = sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
URL_FILTERS = f"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parts),
split AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM hosts)
SELECT page_id, host, path,
  CASE {" ".join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for h, p, _ in _RANKED)} END AS rule,
  CASE {" ".join(f"WHEN {_fits(h, p)} THEN '{v}'" for h, p, v in _RANKED)}
       WHEN {" OR ".join(_glob(h) for h in BLOCKED_HOSTS)} THEN 'block' ELSE 'allow' END AS verdict
FROM split
"""



def _side(name: str) -> str:
    return f"""{name} AS (
  SELECT pair_id, string_agg(shown, '' ORDER BY place) AS body,
         string_agg((begins + length(role) + 5) || ':' || (begins + length(shown) - 8), ',' ORDER BY place) FILTER (role = 'assistant') AS mask
  FROM (SELECT s.*, (coalesce(sum(length(shown)) OVER (PARTITION BY pair_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::INTEGER AS begins
        FROM shown_{name} s JOIN cut USING (pair_id) WHERE place > prefix_turns)
  GROUP BY pair_id)"""


def _shown(name: str, source: str) -> str:
    return f"""placed_{name} AS (
  SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS place FROM (SELECT DISTINCT * FROM ({source}))),
shown_{name} AS (SELECT pair_id, place, role, text, '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS shown FROM placed_{name})"""


PREFERENCES = f"""
WITH rows AS (
  SELECT floor(conv_id / 2)::BIGINT AS pair_id, conv_id % 2 = 0 AS chosen, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
first AS (SELECT pair_id, role, min(text) AS text FROM rows WHERE chosen AND turn = 0 GROUP BY ALL),
{_shown("c", "SELECT pair_id, turn, role, text FROM rows WHERE chosen")},
{_shown("r", "SELECT s.pair_id, s.turn, s.role, CASE WHEN f.pair_id IS NULL THEN s.text ELSE f.text END AS text FROM rows s LEFT JOIN first f ON s.pair_id = f.pair_id AND s.turn = 0 AND s.role IS NOT DISTINCT FROM f.role WHERE NOT s.chosen")},
cut AS (
  SELECT pair_id, coalesce(min(place) FILTER (c.place IS NULL OR r.place IS NULL OR c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text) - 1, max(place))::INTEGER AS prefix_turns
  FROM shown_c c FULL JOIN shown_r r USING (pair_id, place) GROUP BY pair_id),
prompt AS (SELECT pair_id, string_agg(shown, '' ORDER BY place) AS body FROM shown_c JOIN cut USING (pair_id) WHERE place <= prefix_turns GROUP BY pair_id),
{_side("c")}, {_side("r")}
SELECT pair_id, prefix_turns, coalesce(prompt.body, '') AS prompt, coalesce(c.body, '') AS chosen, coalesce(c.mask, '') AS chosen_mask,
       coalesce(r.body, '') AS rejected, coalesce(r.mask, '') AS rejected_mask
FROM cut LEFT JOIN prompt USING (pair_id) LEFT JOIN c USING (pair_id) LEFT JOIN r USING (pair_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _near_copies(size: int, percent: int, more: str = "") -> str:
    """Classes of documents by Jaccard similarity of their shingles of `size` words, all pairs compared."""
    component = "least(doc_id, coalesce(y, doc_id))"
    return f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACE}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {size} THEN list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(s) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= {percent} * (p.n + q.n - c)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT doc_id, n AS n_shingles, {component} AS component_id{more.format(component=component)}
FROM sizes LEFT JOIN least ON x = doc_id
"""


# CRC-32 in SQL: the 256 remainders of a byte, and a fold over the bytes of a text's UTF-8.
_CRC_TABLE = "remainders AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) AS v FROM range(256) r(i)))"


def _crc(h: str) -> str:
    """The checksum of a text of which `h` is the hexadecimal UTF-8, beside `remainders`."""
    byte = f"(16 * (instr('0123456789ABCDEF', {h}[i]) - 1) + instr('0123456789ABCDEF', {h}[i + 1]) - 1)::BIGINT"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({h}), 2), lambda i: {byte})), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295)"


RESAMPLING = f"""
WITH {_CRC_TABLE},
texts AS (SELECT 0 AS side, doc_id AS id, {_LOWER} AS text FROM documents UNION ALL SELECT 1, item_id, {_LOWER} FROM benchmark),
words AS (SELECT side, id, regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
runs AS (
  SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                                      list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM words),
kinds AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM runs)),
hashed AS (SELECT f, {_crc("h")} % 10000 AS bucket FROM kinds, remainders),
features AS (SELECT side, id, bucket, count(*) AS n FROM runs JOIN hashed USING (f) GROUP BY ALL),
held AS (SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t FROM features GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM held),
weights AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM features JOIN gains USING (bucket) WHERE side = 0 GROUP BY id),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM documents d JOIN words w ON w.side = 0 AND w.id = d.doc_id LEFT JOIN weights k ON k.id = d.doc_id),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS total FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * total // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""

SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT run, n, {_crc("h")} AS c FROM (SELECT *, hex(encode(doc_id || ':' || run)) AS h FROM counted), remainders),
planted AS (SELECT CASE WHEN c % 97 = 0 THEN substr(run, 1, (c % length(run))::BIGINT) || substr(run, (c % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM planted WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
holes AS (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT x.word, y.word AS near FROM holes x JOIN holes y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT h.word, w.word FROM holes h JOIN words w ON w.word = h.a || h.b
  UNION SELECT w.word, h.word FROM holes h JOIN words w ON w.word = h.a || h.b),
ranked AS (
  SELECT p.word, w.word AS near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, w.word) AS place
  FROM near p JOIN words w ON w.word = p.near),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1),
way AS (SELECT word, word AS at FROM forms UNION ALL SELECT y.word, f.form FROM way y JOIN forms f ON f.word = y.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, y.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN way y ON y.word = f.word JOIN forms e ON e.word = y.at AND e.form IS NULL
"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": QUALITY_RULES,
    "op2_preferences": PREFERENCES,
    "op6_url_filters": URL_FILTERS,
    "op10_ngram_join": _near_copies(5, 80),
    "op11_importance_resampling": RESAMPLING,
    "op12_super_minhash": _near_copies(3, 85, ", doc_id = {component} AS kept"),
    "op13_spelling_variants": SPELLING,
}
