"""SQL for DuckDB with the rows of newer queries, from the tables alone."""

from __future__ import annotations

from oreflow.llm.licenses import COVERAGE, GRAM, NOTICES, PHRASES, SLACK

# A-Z and white space that ends a word.
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "list_filter(regexp_split_to_array(coalesce({0}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
# CRC-32 of the decimal digits of a number, bit by bit (fixed value: the reversed polynomial).
_CRC = """xor(list_reduce(flatten(list_transform(range(length(cast({0} AS varchar))), lambda i:
      list_transform(range(8), lambda b: (ascii(substr(cast({0} AS varchar), cast(i AS integer) + 1, 1)) >> cast(b AS integer)) & 1))),
    lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384), 4294967295), 4294967295)"""


def _leaf(text: str) -> str:
    values = ["cast(doc_id AS varchar)", "source", "lang", "cast(n_chars AS varchar)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


def _grown(name: str, start: str) -> str:
    """A recursive table of all nodes over the rows of ``start``: ``tree, level, place, n, digest``."""
    return f"""{name}(tree, level, place, n, digest) AS (
  {start}
  UNION ALL
  SELECT tree, level + 1, place // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM {name} WHERE n > 1 GROUP BY tree, level, place // 8)"""


def _walk(name: str, start: str, runs: str) -> str:
    """Rows of ``start`` led up through ``runs``: ``id, tree, level, place, n, now, proof``."""
    return f"""{name}(id, tree, level, place, n, now, proof) AS (
  {start}
  UNION ALL
  SELECT w.id, w.tree, w.level + 1, w.place // 8, (w.n + 7) // 8,
         sha256(array_to_string(r.run[:w.place % 8], '') || w.now || array_to_string(r.run[w.place % 8 + 2:], '')),
         w.proof || array_to_string(r.run[:w.place % 8], '') || array_to_string(r.run[w.place % 8 + 2:], '')
  FROM {name} w JOIN {runs} r ON w.tree IS NOT DISTINCT FROM r.tree AND w.level = r.level AND w.place // 8 = r.up
  WHERE w.n > 1)"""


def _runs(nodes: str) -> str:
    return f"""SELECT tree, level, place // 8 AS up, list(digest ORDER BY place) AS run FROM {nodes} WHERE n > 1 GROUP BY ALL"""


MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST, leaf) AS id,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {_leaf("text")} AS leaf,
               CASE WHEN {_CRC.format("doc_id")} % 3 = 0 THEN {_leaf(_LOWER.format("text"))} END AS tampered FROM documents)),
{_grown("low", "SELECT lang, 0, place, n, leaf FROM leaves")},
subroots AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1),
{_grown("high", "SELECT '', 0, place, n, digest FROM subroots")},
low_runs AS ({_runs("low")}),
high_runs AS ({_runs("high")}),
{_walk("up", "SELECT id, lang, 0, place, n, coalesce(tampered, leaf), '' FROM leaves", "low_runs")},
{_walk("across", "SELECT u.id, '', 0, s.place, s.n, u.now, u.proof FROM up u JOIN subroots s ON u.tree IS NOT DISTINCT FROM s.tree WHERE u.n = 1", "high_runs")}
SELECT l.doc_id, l.leaf, s.digest AS subroot, h.digest AS root, sha256(o.proof) AS proof_sha256, o.now AS folded_root,
       o.now = h.digest AS verified
FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.tree JOIN across o ON l.id = o.id AND o.n = 1
JOIN high h ON h.n = 1"""


PERIODIC = f"""
WITH plain AS (
  SELECT doc_id, row_number() OVER () AS r, {_WORDS.format("text")} AS w, coalesce({_CRC.format("doc_id")}, 1) AS h FROM documents),
aimed AS (SELECT *, len(w) AS n, (h // 10) % nullif(len(w), 0) AS a FROM plain),
timed AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM aimed),
texts AS (
  SELECT doc_id, r, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w FROM timed),
grams AS (
  SELECT r, unnest(range(len(w) - 4)) AS i, unnest(list_transform(range(len(w) - 4), lambda i: w[i + 1:i + 5])) AS g
  FROM texts WHERE len(w) > 5),
same AS (
  SELECT x.r, y.i - x.i AS q, x.i FROM grams x JOIN grams y ON x.r = y.r AND x.g = y.g AND x.i < y.i),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM same),
stretches AS (
  SELECT r, min(i) AS start, count(*) + 4 + q AS length, q FROM islands GROUP BY r, q, island
  HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
runs AS (SELECT r, start, length, min(q) AS period FROM stretches GROUP BY ALL),
lists AS (
  SELECT r, count(*) AS n_runs,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM runs GROUP BY r),
best AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY length::hugeint * 1000000000000 // period DESC, start, period) AS place FROM runs),
words AS (SELECT r, unnest(range(len(w))) AS i, unnest(w) AS word FROM texts),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT t.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
       sha256(coalesce(l.listed, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM texts t LEFT JOIN lists l ON t.r = l.r LEFT JOIN best b ON t.r = b.r AND b.place = 1 LEFT JOIN kept k ON t.r = k.r"""


_TEMPLATES = ", ".join(
    f"({i}, '{label}', {str(phrase).lower()}, {k}, '{text}')"
    for i, (label, text, phrase, k) in enumerate(
        [*((v, t, True, 2) for t, v in PHRASES.items()), *((v, t, False, GRAM) for v, t in NOTICES)]
    )
)
_GRAMS = "list_transform(range(len({0}) - {1} + 1), lambda i: array_to_string({0}[i + 1:i + {1}], ' '))"

LICENSES = f"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")},
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
given(template, label, phrase, k, text) AS (VALUES {_TEMPLATES}),
split AS (SELECT *, string_split(text, ' ') AS w FROM given),
wanted AS (
  SELECT template, label, phrase, k, len(w) - k + 1 AS grams, unnest(range(len(w) - k + 1)) AS at_,
         unnest(CASE k WHEN 2 THEN {_GRAMS.format("w", 2)} ELSE {_GRAMS.format("w", GRAM)} END) AS gram FROM split),
held AS (
  SELECT r, 2 AS k, unnest(range(len(w) - 1)) AS pos, unnest({_GRAMS.format("w", 2)}) AS gram FROM texts WHERE len(w) >= 2
  UNION ALL
  SELECT r, {GRAM}, unnest(range(len(w) - {GRAM - 1})), unnest({_GRAMS.format("w", GRAM)}) FROM texts WHERE len(w) >= {GRAM}),
votes AS (SELECT h.r, t.*, h.pos, h.pos - t.at_ AS diagonal FROM held h JOIN wanted t ON h.k = t.k AND h.gram = t.gram),
apart AS (
  SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal)
                     > CASE WHEN phrase THEN 0 ELSE {SLACK} END, true) AS new FROM votes),
parts AS (SELECT *, sum(new::int) OVER (PARTITION BY r, template ORDER BY diagonal RANGE UNBOUNDED PRECEDING) AS part FROM apart),
passages AS (
  SELECT r, label, phrase, grams, count(DISTINCT at_) AS votes, min(pos) AS lo, max(pos) AS hi, min(diagonal) AS first
  FROM parts GROUP BY r, template, label, phrase, grams, part),
judged AS (
  SELECT *, phrase AND votes = grams AS base, least(votes / grams, 1.0::double) AS matched,
         NOT phrase AND votes / grams >= {COVERAGE} AND hi - lo <= 2 * (grams + {GRAM}) AS whole FROM passages),
told AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR whole) AS labels, max(matched) AS score
  FROM judged GROUP BY r)
SELECT t.doc_id, len(t.w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::double) AS score
FROM texts t LEFT JOIN told d ON t.r = d.r"""
