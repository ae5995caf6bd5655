"""DuckDB SQL for the corpus queries that SQL can express, each written from
the operator's definition rather than from its plan."""

from .mixing import BLOCK_WORDS, MAX_EPOCHS, MIN_BLOCKS, PHI, SEED
from .quality_rules import FENCES, MAX_REPEAT_PERCENT, MIN_WORDS, SYMBOLS
from .url_filter import PATTERNS, PLACES, pattern

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

MIX = rf"""
WITH d AS (SELECT doc_id, source, len({WORDS}) AS size,
                  md5('{SEED}' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight,
              {MAX_EPOCHS} * source_size AS cap FROM s0),
-- the share of a unit of weight when the sources with a lower limit per weight are at it
s2 AS (SELECT a.*, ((SELECT sum(source_size) FROM s1)
          - coalesce((SELECT sum(b.cap) FROM s1 b WHERE b.cap / b.weight < a.cap / a.weight), 0))
        / (SELECT sum(b.weight) FROM s1 b WHERE b.cap / b.weight >= a.cap / a.weight) AS level
       FROM s1 a),
s3 AS (SELECT source, source_size, least(CAST(cap AS DOUBLE),
          (SELECT max(level) FROM s2 WHERE level * weight <= cap) * weight) AS target FROM s2),
s4 AS (SELECT *, CAST(round(target) AS BIGINT) AS quota, greatest(1, ceil(source_size / {BLOCK_WORDS}),
          least(source_size, {MIN_BLOCKS}))::BIGINT AS blocks FROM s3),
s5 AS (SELECT *, source_size // blocks AS long, source_size % blocks AS extra,
          CASE WHEN source_size > 0 THEN target * blocks / source_size ELSE 0 END AS slots FROM s4),
s6 AS (SELECT *, sum(slots) OVER (ORDER BY source IS NULL, source
          ROWS UNBOUNDED PRECEDING) / (SELECT sum(slots) FROM s5) AS hi FROM s5),
s AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS sid,
          coalesce(lag(hi) OVER (ORDER BY source IS NULL, source), 0) AS lo FROM s6),
points AS (SELECT i AS slot, (i + 1) * {PHI}::DOUBLE - floor((i + 1) * {PHI}::DOUBLE) AS x
  FROM (SELECT unnest(range((SELECT CAST(floor(sum(slots) * 1.05) AS BIGINT) + 1024 FROM s))) AS i)),
ranked AS (SELECT sid, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS k
  FROM points JOIN s ON x >= lo AND x < hi AND slots > 0),
given AS (SELECT r.sid, slot, k, (k % blocks) * long + least(k % blocks, extra) AS f,
     (k % blocks + 1) * long + least(k % blocks + 1, extra) AS l, (k // blocks) * source_size AS past,
     quota FROM ranked r JOIN s USING (sid)),
cut AS (SELECT sid, slot, f, least(l, quota - past) AS l FROM given WHERE least(l, quota - past) > f),
line AS (SELECT d.*, sid, source_size, target, coalesce(sum(size) OVER (PARTITION BY sid
     ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
takes AS (SELECT sid, a, sum(least(l, a + size) - greatest(f, a)) AS taken, min(slot) AS first_slot
  FROM line JOIN cut USING (sid) WHERE size > 0 AND f < a + size AND l > a GROUP BY sid, a)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, first_slot
FROM line LEFT JOIN takes ON line.sid = takes.sid AND line.a = takes.a AND size > 0
"""


def _count(chars: str) -> str:
    text = "coalesce(text, '')"
    rest = text
    for c in chars:
        rest = f"replace({rest}, '{c}', '')"
    return f"length({text}) - length({rest})"


def _bin(v: str) -> str:
    """Keeps the five highest bits below the leading one."""
    low = f"greatest(length(bin({v})) - 6, 0)"
    return f"(({v}) >> {low}) << {low}"


def _fence(f) -> str:
    width = f"{f.k} * greatest(q3 - q1, {f.spread})"
    value = f"CASE metric WHEN '{f.metric}' THEN {{}} END"
    lo = value.format(f"q1 - {width}" if f.two_sided else "-1")
    return f"max({value.format(f'q3 + {width}')}) AS hi_{f.metric}, max({lo}) AS lo_{f.metric}"


QUALITY = rf"""
WITH t AS (SELECT row_number() OVER () AS r, * FROM documents),
w AS (SELECT r, doc_id, lang, source, text, {WORDS} AS words,
      list_filter(string_split(coalesce(text, ''), chr(10)),
                  lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
wins AS (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS win
         FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM wins) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + j) AS n_repeat_words
            FROM again, (SELECT unnest(range(8)) AS j) GROUP BY r),
c AS (SELECT w.r, doc_id, lang, source, len(words) AS n_words,
      length(array_to_string(words, '')) AS word_chars, {_count(SYMBOLS)} AS n_symbols,
      len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
      coalesce(n_repeat_words, 0) AS n_repeat_words, {_count("!?")} AS n_marks,
      length(regexp_replace(coalesce(text, ''), '\P{{Lu}}+', '', 'g')) AS n_upper
      FROM w LEFT JOIN covered ON w.r = covered.r),
m AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
      1000 * n_symbols // greatest(n_words, 1) AS symbols, 1000 * n_marks // greatest(n_words, 1) AS marks,
      1000 * n_upper // greatest(word_chars, 1) AS upper, 1000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines,
      1000 * n_repeat_words // greatest(n_words, 1) AS repeats,
      1000 * word_chars // greatest(n_words, 1) AS word_len FROM c),
v AS ({" UNION ALL ".join(
    f"SELECT lang, source, '{f.metric}' AS metric, {_bin(f.metric)} AS v FROM m WHERE NOT base_failed"
    for f in FENCES)}),
own AS (SELECT lang, source, metric, count(*) AS n, quantile_disc(v, 0.25) AS q1,
        quantile_disc(v, 0.75) AS q3 FROM v GROUP BY ALL),
tongue AS (SELECT lang, metric, count(*) AS n, quantile_disc(v, 0.25) AS q1,
           quantile_disc(v, 0.75) AS q3 FROM v GROUP BY ALL),
every AS (SELECT metric, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3 FROM v GROUP BY ALL),
q AS (SELECT o.lang, o.source, o.metric,
      CASE WHEN o.n >= 200 THEN o.q1 WHEN g.n >= 200 THEN g.q1 ELSE e.q1 END AS q1,
      CASE WHEN o.n >= 200 THEN o.q3 WHEN g.n >= 200 THEN g.q3 ELSE e.q3 END AS q3
      FROM own o JOIN tongue g ON o.lang IS NOT DISTINCT FROM g.lang AND o.metric = g.metric
      JOIN every e ON o.metric = e.metric),
f AS (SELECT lang, source, {", ".join(map(_fence, FENCES))} FROM q GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  coalesce(NOT base_failed AND {" AND ".join(f"{x.metric} BETWEEN lo_{x.metric} AND hi_{x.metric}" for x in FENCES)},
           false) AS kept
FROM m LEFT JOIN f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source
"""


def _places() -> str:
    """(rule, says) of each place rule that fits, as rows of a list."""
    out = []
    for rule, verdict in PLACES:
        host, _, path = rule.partition("/")
        out.append(f"CASE WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}') "
                   f"THEN {{'n': {len(rule)}, 'rule': '{rule}', 'says': '{verdict}'}} END")
    return ", ".join(out)


URLS = rf"""
WITH u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN
    translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    ELSE '' END AS host,
  CASE WHEN contains(url, '://') THEN regexp_extract(url, '://[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
  CASE WHEN contains(url, '://') THEN lower(substr(url, instr(url, '://') + 3)) END AS rest FROM pages),
r AS (SELECT *, list_reverse_sort(list_filter([{_places()}], lambda x: x IS NOT NULL))[1] AS best,
  list_sort(list_filter([{", ".join(f"CASE WHEN regexp_matches(rest, '{pattern(p).regex}') THEN '{p}' END" for p in PATTERNS)}],
            lambda x: x IS NOT NULL))[1] AS pattern FROM u)
SELECT page_id, host, path, best.rule AS rule, pattern,
  coalesce(best.says, CASE WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict FROM r
"""


def _crc32(text: str) -> str:
    """crc32 of a text's UTF-8 bytes, with the list ``t`` of crc_table in scope."""
    digit = "instr('0123456789ABCDEF', substr(hex(encode({0})), {1}, 1)) - 1"
    byte = f"16 * ({digit.format(text, 'i')}) + {digit.format(text, 'i + 1')}"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, list_transform("
            f"range(1, 2 * octet_length(encode({text})) + 1, 2), lambda i: {byte})), "
            f"lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1])))")


CRC_TABLE = """crc_bits(b, x, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT b, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, k + 1 FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(x ORDER BY b) AS t FROM crc_bits WHERE k = 8)"""

SPELLING = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
     unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]{{7,}}')) AS run FROM documents),
lowered AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run,
     count(*) AS c FROM runs GROUP BY ALL),
hashed AS (SELECT run, c, {_crc32("id || ':' || run")} AS h FROM lowered, crc_table),
words AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
     ELSE run END AS word, CAST(sum(c) AS BIGINT) AS n FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND n >= 2),
places AS (SELECT word, n, unnest(range(length(word))) AS p FROM words),
cut AS (SELECT word, n, p, substr(word, 1, p) || substr(word, p + 2) AS less FROM places),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.less = b.less AND a.p = b.p AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.less = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.less = w.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS top_n, list(other ORDER BY m DESC, other)[1] AS top
  FROM near GROUP BY word),
formed AS (SELECT w.word, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
     CASE WHEN top_n >= 10 * n THEN top END AS form, CASE WHEN top_n >= 10 * n THEN top_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
paths(word, root) AS (SELECT word, word FROM formed UNION ALL
  SELECT p.word, f.form FROM paths p JOIN formed f ON p.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, p.root
FROM formed f JOIN paths p ON p.word = f.word JOIN formed l ON l.word = p.root WHERE l.form IS NULL
"""


def _way(state: str, cost: str, initial: str, line: str | None) -> str:
    """A path that begins with one edit and goes on as from ``state``."""
    rest = f"{state}.r" if line is None else f"chr(10) || {line} || {state}.r"
    return f"{{'c': {state}.c + {cost}, 'a': '{initial}' || {state}.a, 'r': {rest}}}"


def _least(ways: list[str]) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


_STATES = {"x": ("u", "user"), "s": ("u", "user"), "u": ("a", "assistant"), "a": ("u", "user")}
_KEEPS = {"x": [("s", "s"), ("u", "u")], "s": [("u", "u")], "u": [("a", "a")], "a": [("u", "u")]}
_NEVER = "{'c': 1000000000000, 'a': '', 'r': ''}"


def _row_ways(q: str) -> str:
    to, name = _STATES[q]
    keeps = [f"CASE WHEN keeps AND initial = '{i}' THEN {_way('p.' + t, 'more', 'K', 'line')} ELSE {_NEVER} END"
             for i, t in _KEEPS[q]]
    reroles = f"CASE WHEN keeps THEN {_way('p.' + to, '3 + more', 'R', chr(39) + name + ':' + chr(39) + ' || text')} ELSE {_NEVER} END"
    return _least([_way("p." + q, "4", "D", None), *keeps, reroles])


def _insert(q: str, source: str) -> str:
    to, name = _STATES[q]
    return _least([f"{source}{q}", _way(source + to, "3", "I", f"'{name}:'")])


CONVERSATIONS = rf"""
WITH RECURSIVE {CRC_TABLE},
hit AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32(
    "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS f
  FROM conversations, crc_table),
broken AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
     CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
     unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM hit WHERE f <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id
     ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i,
     regexp_extract(text, '([^ 	-])[ 	-]*$', 1) AS last FROM broken),
judged AS (SELECT *, CASE WHEN last = '' THEN 'blank'
       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
       WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
     left(role, 1) AS initial, role || ':' || text AS line,
     lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed),
turns AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS keeps, 3 * CAST(fault = 'truncated' AS INT) AS more FROM judged),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
     count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
     count(*) FILTER (fault = 'truncated') AS truncated,
     count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows
  FROM turns GROUP BY conv_id),
paths(conv_id, i, p) AS (
  SELECT conv_id, rows + 1, {{'x': {{'c': 0, 'a': '', 'r': ''}}, 's': {{'c': 6, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}},
     'u': {{'c': 3, 'a': 'I', 'r': chr(10) || 'assistant:'}}, 'a': {{'c': 0, 'a': '', 'r': ''}}}} FROM counted
  UNION ALL
  SELECT conv_id, i, {{'x': {_insert('x', 'g.')}, 's': {_insert('s', 'g.')}, 'u': g.u, 'a': g.a}}
  FROM (SELECT conv_id, i, {{'x': h.x, 's': h.s, 'u': {_insert('u', 'h.')}, 'a': {_insert('a', 'h.')}}} AS g
    FROM (SELECT p.conv_id, t.i, {{'x': {_row_ways('x').replace('p.', 'p.p.')}, 's': {_row_ways('s').replace('p.', 'p.p.')},
        'u': {_row_ways('u').replace('p.', 'p.p.')}, 'a': {_row_ways('a').replace('p.', 'p.p.')}}} AS h
      FROM paths p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i - 1))),
best AS (SELECT conv_id, p.x.c AS cost, p.x.a AS audit, sha256(substr(p.x.r, 2)) AS repaired_sha256 FROM paths WHERE i = 1)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""
