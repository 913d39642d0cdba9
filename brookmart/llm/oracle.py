"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from brookmart.llm import collocations, decontaminate, tiledcosine
from brookmart.llm.rules import BOILERPLATE, LONG_LINE, MAX_LOST, MAX_REPEAT_PERCENT, MIN_WORDS, WINDOW

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_BARE = r"regexp_replace({}, '[ \x09-\x0D]+', '', 'g')"


def _without(line: str, some: str) -> str:
    """How many of some characters a line has."""
    return f"(length({line}) - length(translate({line}, '{some}', '')))"


_SPACES = "(length(line) - length(translate(line, ' ' || chr(9), '')))"
_BOILER = " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)


def collocations_sql(support: int = collocations.SUPPORT, top: int = collocations.TOP) -> str:
    return rf"""
WITH p AS (
  SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^ \x09]+') AS w
  FROM (SELECT coalesce(lang, '{collocations.NO_LANG}') AS lang,
               translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents)),
tot AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM p GROUP BY lang),
g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM p, unnest(range(1, {collocations.LONGEST} + 1)) AS s(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM g GROUP BY ALL HAVING count(*) >= {support}),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT lang, a, w, k, unnest(range(2, k)) AS m FROM c WHERE k > 2)) GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.j, l.a AS l, r.a AS r, n, (1000 * c.a * n) // (l.a * r.a) AS score
  FROM (SELECT c.*, unnest(range(1, k)) AS j FROM c LEFT JOIN inside USING (lang, phrase)
        WHERE most IS NULL OR most < c.a) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[j + 1:], ' ')
  JOIN tot ON tot.lang = c.lang),
least AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS nth FROM cuts),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM least WHERE nth = 1)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
  score::BIGINT AS score
FROM ranked WHERE rank <= {top}
"""


ORACLE: dict[str, str] = {
    "op2_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT k, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
  FROM (SELECT k, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})),
twice AS (SELECT k, i, count(*) OVER (PARTITION BY k, s) AS n FROM win),
rep AS (
  SELECT k, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT k, unnest(range(i, i + {WINDOW})) AS p FROM twice WHERE n > 1) GROUP BY k),
lines AS (SELECT k, unnest(string_split(text, chr(10))) AS line FROM d),
faults AS (
  SELECT k, line, length({_BARE.format('line')}) AS bare,
    CASE WHEN ({_BOILER}) AND length(line) <= 200 THEN 'boilerplate'
         WHEN {_without('line', '|»›·')} >= 3 AND {_without('line', '|»›·')} * 4 >= {_SPACES} THEN 'navigation'
         WHEN length(line) - length(replace(line, '!!', '')) >= 6
          AND (length(line) - length(replace(line, '!!', ''))) * 2 >= {_SPACES} THEN 'punctuation'
         WHEN {_without('line', '#*$%&<>{}')} >= 6 AND {_without('line', '#*$%&<>{}')} * 2 >= {_SPACES} THEN 'punctuation'
         WHEN {_SPACES} >= {LONG_LINE} AND NOT regexp_matches(line, '[.!?…。！？]') THEN 'punctuation' END AS fault
  FROM lines),
per AS (
  SELECT k, count(line) FILTER (bare > 0) - count(DISTINCT line) FILTER (bare > 0) AS n_dup_lines,
    coalesce(sum(bare) FILTER (fault IS NOT NULL), 0)::BIGINT AS lost_chars,
    count(*) FILTER (fault = 'punctuation') AS n_punctuation,
    count(*) FILTER (fault = 'navigation') AS n_navigation,
    count(*) FILTER (fault = 'boilerplate') AS n_boilerplate
  FROM faults GROUP BY k),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length({_BARE.format('text')})::BIGINT AS word_chars,
    {_without('text', '#*$%&|<>')}::BIGINT AS n_symbols, n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, n_punctuation, n_navigation, n_boilerplate, lost_chars
  FROM d JOIN per USING (k) LEFT JOIN rep USING (k)),
failed AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND lost_chars <= {MAX_LOST} * word_chars AS kept FROM failed
""",
    "op9_warc_fixity": """
SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
  sha256(coalesce(html, '')) AS payload_sha256, page_id % 50 = 0 AS damaged
FROM pages
""",
    "op10_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT k, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
hits AS (SELECT k, i, n, item_id FROM dw JOIN bw USING (n, win)),
pos AS (
  SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM hits) GROUP BY k),
its AS (
  SELECT k, count(DISTINCT item_id) AS n_items,
    sha256(array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',')) AS items_sha256
  FROM hits GROUP BY k),
wt AS (
  SELECT win, unnest(string_split(win, ' ')) AS word, unnest(range(0, n)) AS o FROM (SELECT DISTINCT n, win FROM bw)),
tw AS (
  SELECT * FROM (SELECT k, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d)
  WHERE word IN (SELECT word FROM wt)),
rare AS (
  SELECT win, arg_min(word, {decontaminate.WINDOW} * c + o) AS word, count(DISTINCT word) AS n
  FROM wt LEFT JOIN (SELECT word, count(*) AS c FROM tw GROUP BY word) USING (word)
  GROUP BY win HAVING count(c) = count(*)),
anchors AS (SELECT win, rare.n, k, p FROM rare JOIN tw USING (word)),
near AS (
  SELECT DISTINCT a.win, a.k
  FROM anchors a JOIN (SELECT DISTINCT win, word FROM wt) t ON t.win = a.win
    JOIN tw x ON x.k = a.k AND x.word = t.word AND x.p BETWEEN a.p - {decontaminate.SLOP} AND a.p + {decontaminate.SLOP}
  GROUP BY a.win, a.k, a.p, a.n HAVING count(DISTINCT x.word) = a.n),
nrs AS (
  SELECT k, count(DISTINCT item_id) AS n_near_items
  FROM (SELECT k, item_id FROM near JOIN bw USING (win) UNION SELECT k, item_id FROM hits) GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated,
  coalesce(n_near_items, 0) AS n_near_items
FROM d LEFT JOIN pos USING (k) LEFT JOIN its USING (k) LEFT JOIN nrs USING (k)
""",
    "op11_son_collocations": collocations_sql(),
    "op12_tiled_cosine": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
    AND isfinite(list_min(embedding)) AND isfinite(list_max(embedding))
    AND (list_min(embedding) <> 0 OR list_max(embedding) <> 0)),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {tiledcosine.THRESHOLD}),
reach AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
c AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(c.least, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(c.least, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
""",
}
