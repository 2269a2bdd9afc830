"""The same queries in SQL, where SQL can express them."""

from tideline.llm import licenses

OP2_LINE_DEDUP = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
starts AS (SELECT doc_id, l, unnest(range(0, len(l) - 2)) AS pos FROM d WHERE len(l) >= 3),
w AS (SELECT doc_id, pos, l[pos + 1] AS a, l[pos + 2] AS b, l[pos + 3] AS c FROM starts
      WHERE trim(l[pos + 1]) <> '' OR trim(l[pos + 2]) <> '' OR trim(l[pos + 3]) <> ''),
f AS (SELECT *, first_value(doc_id) OVER o AS first_doc, first_value(pos) OVER o AS first_pos
      FROM w WINDOW o AS (PARTITION BY a, b, c ORDER BY doc_id, pos)),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(CASE WHEN first_doc = doc_id THEN greatest(pos, first_pos + 3) ELSE pos END, pos + 3)) AS pos
  FROM f WHERE first_doc <> doc_id OR first_pos <> pos),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS pos FROM d)
  WHERE (doc_id, pos) NOT IN (SELECT doc_id, pos FROM covered) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(len(d.l), 0)::BIGINT AS n_lines, (coalesce(len(d.l), 0) - coalesce(k.n, 0))::BIGINT AS n_removed
FROM d LEFT JOIN kept k USING (doc_id)
"""



OP9_CHAT = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (
  SELECT *, row_number() OVER o AS nth, count(*) OVER (PARTITION BY conv_id) AS turns,
         -- '[INST] ', a line feed and '</s>'; a backslash, [ and < take two characters, in a role a line feed too
         12 + length(role) + length(text) + length(regexp_replace(role, '[^\\[<\\\\\n]', '', 'g'))
         + length(regexp_replace(text, '[^\\[<\\\\]', '', 'g')) AS chars
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY nth) AS upto FROM n)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
       coalesce(sum(upto) FILTER (role = 'assistant' OR nth = turns), 0)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP10_SEARCH = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, v, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, c.v, sum(q.x * c.x)::BIGINT AS score
      FROM c q JOIN c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""

OP12_DIVERGENCE = """
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents),
w AS (SELECT doc, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
slots AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + 1000000000 * (n + 2) // ((sum(n) OVER (PARTITION BY lang, source))::BIGINT + 2 * v) AS p
      FROM slots JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + 1000000000 * (n + 2) // ((sum(n) OVER (PARTITION BY lang))::BIGINT + 2 * v) AS q
      FROM (SELECT lang, term, sum(n)::BIGINT AS n FROM slots GROUP BY ALL) JOIN v USING (lang)),
apart AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def _op3() -> str:
    """Base phrases and notices by their word positions, from the same fixed texts."""
    rows = ", ".join(
        f"({n}, '{label}', {n < len(licenses.BASE)}, {phrase.split()!r}::VARCHAR[])"
        for n, (phrase, label) in enumerate(licenses.BASE + licenses.NOTICES))
    k, drift, coverage = licenses.K, licenses.DRIFT, licenses.COVERAGE
    gram = lambda words, at: " || ' ' || ".join(f"{words}[{at} + {i + 1}]" for i in range(k))
    return f"""
WITH t AS (SELECT * FROM (VALUES {rows}) x(template, label, base, words)),
tg AS (SELECT template, label, base, len(words) - {k - 1} AS grams, q, {gram('words', 'q')} AS gram
       FROM (SELECT *, unnest(range(0, len(words) - {k - 1})) AS q FROM t)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
dg AS (SELECT doc_id, p, {gram('words', 'p')} AS gram
       FROM (SELECT doc_id, words, unnest(range(0, len(words) - {k - 1})) AS p FROM d WHERE len(words) >= {k})),
votes AS (SELECT doc_id, template, label, base, grams, q, p FROM dg JOIN tg USING (gram)),
b AS (SELECT doc_id, label, p - q AS start FROM votes WHERE base
      GROUP BY doc_id, template, label, grams, p - q HAVING count(*) = grams),
bases AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list(DISTINCT label) AS labels FROM b GROUP BY 1),
g AS (SELECT doc_id, template, label, grams, p - q AS d, min(p) AS low, max(p) AS high, list(DISTINCT q) AS qs
      FROM votes WHERE NOT base GROUP BY ALL),
gaps AS (SELECT *, CASE WHEN d - lag(d) OVER o <= {drift} THEN 0 ELSE 1 END AS cut FROM g
         WINDOW o AS (PARTITION BY doc_id, template ORDER BY d)),
spans AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id, template ORDER BY d) AS span FROM gaps),
held AS (SELECT doc_id, label, len(list_distinct(flatten(list(qs)))) / grams AS share FROM spans
         GROUP BY doc_id, template, label, grams, span
         HAVING share >= {coverage} AND max(high) - min(low) + 1 <= grams * 1.5 + {drift}),
notices AS (SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS best FROM held GROUP BY 1)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       array_to_string(list_sort(coalesce(x.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(x.labels, []), coalesce(n.labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(n.best, 0) END::DOUBLE AS score
FROM d LEFT JOIN bases x USING (doc_id) LEFT JOIN notices n USING (doc_id)
"""


def oracles() -> dict[str, str]:
    return {"op2_line_dedup": OP2_LINE_DEDUP, "op3_licenses": _op3(), "op9_chat": OP9_CHAT, "op10_search": OP10_SEARCH,
            "op12_divergence": OP12_DIVERGENCE}
