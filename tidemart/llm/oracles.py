"""The operators' questions in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

OP2 = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
      END) AS s
  FROM cut
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 185 * c >= 85 * (x.n + y.n)
), reach AS (
  SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
), least_id AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(b, d.doc_id)) AS kept
FROM documents d LEFT JOIN size s ON s.doc_id = d.doc_id LEFT JOIN least_id l ON l.a = d.doc_id
"""

OP6 = r"""
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = first_value(doc_id) OVER g AS kept, text_sha256
FROM bare WINDOW g AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""

#: A node's budget is split by the same rule at three levels.
_SPLIT = """
SELECT * EXCLUDE (point, filled, open_weight), CASE WHEN is_full THEN capacity
    ELSE coalesce((given - filled) * weight / nullif(open_weight, 0), 0) END AS taken
FROM (
  SELECT *, sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER (PARTITION BY {parent}) AS filled,
    sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY {parent}) AS open_weight
  FROM (
    SELECT *, coalesce(point * (sum(weight) OVER (PARTITION BY {parent})
        - coalesce(sum(weight) OVER before, 0))
      <= given - coalesce(sum(CASE WHEN weight > 0 THEN capacity ELSE 0 END) OVER before, 0), false) AS is_full
    FROM (SELECT *, capacity / nullif(weight, 0) AS point FROM ({nodes}))
    WINDOW before AS (PARTITION BY {parent} ORDER BY point NULLS LAST, {level}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  )
)
"""


def _mixing() -> str:
    domains = _SPLIT.format(parent="root", level="domain", nodes="""
      SELECT 0 AS root, domain, sum(capacity) AS capacity,
        CASE domain WHEN 'crawl' THEN 2.0 WHEN 'reference' THEN 5.0 ELSE 3.0 END::DOUBLE AS weight,
        (SELECT sum(capacity) FROM leaf) * 0.25::DOUBLE AS given FROM leaf GROUP BY domain""")
    langs = _SPLIT.format(parent="domain", level="lang", nodes="""
      SELECT l.*, d.taken AS given FROM (SELECT domain, lang, sum(capacity) AS capacity,
        CASE lang WHEN 'en' THEN 4.0 WHEN 'de' THEN 2.0 WHEN 'fr' THEN 2.0 WHEN 'es' THEN 2.0
          ELSE 1.0 END::DOUBLE AS weight FROM leaf GROUP BY domain, lang) l
      JOIN domains d USING (domain)""")
    leaves = _SPLIT.format(parent="domain, lang", level="source", nodes="""
      SELECT l.*, 1.0::DOUBLE AS weight, g.taken AS given FROM leaf l JOIN langs g USING (domain, lang)""")
    return rf"""
    WITH token AS (
      SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        CASE WHEN source = 'src0' THEN 'crawl' WHEN regexp_full_match(source, 'src[1-9]') THEN 'reference'
          ELSE 'community' END AS domain,
        len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS n_tokens
      FROM documents
    ), leaf AS (
      SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens) * 3::DOUBLE AS capacity
      FROM token GROUP BY ALL
    ), domains AS ({domains}), langs AS ({langs}), leaves AS ({leaves}), given AS (
      SELECT domain, lang, source, tokens, floor(taken + 1e-6)::BIGINT AS tokens_given,
        coalesce(floor(taken + 1e-6)::BIGINT // nullif(tokens, 0), 0) AS whole FROM leaves
    ), placed AS (
      SELECT t.*, whole, tokens_given - whole * tokens AS rest,
        sum(n_tokens) OVER (PARTITION BY domain, lang, source
          ORDER BY md5('17:' || whole || ':' || coalesce(doc_id::VARCHAR, ''))
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM token t JOIN given USING (domain, lang, source)
    )
    SELECT doc_id, domain, lang, source, n_tokens, whole AS whole_epochs,
      greatest(0, least(n_tokens, rest - coalesce(before, 0)))::BIGINT AS last_tokens,
      (whole * n_tokens + greatest(0, least(n_tokens, rest - coalesce(before, 0))))::BIGINT AS taken_tokens
    FROM placed
    """


_SMALL = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text whose characters lie below U+0800; needs the
    relation ``crc_table`` with the list ``t``."""
    points = f"list_transform(string_split({text}, ''), lambda c: unicode(c))"
    octets = (
        f"flatten(list_transform({points},"
        " lambda u: CASE WHEN u < 128 THEN [u] ELSE [192 + (u >> 6), 128 + (u & 63)] END))"
    )
    step = "lambda r, b: xor(t[(xor(r, b) & 255) + 1], r >> 8)"
    return f"xor(list_reduce(list_transform({octets}, lambda b: b::BIGINT), {step}, 4294967295::BIGINT), 4294967295)"


#: The remainders of the 256 bytes, by the rule that makes them.
_CRC_TABLE = """crc_table AS (
  SELECT list(r ORDER BY b) AS t FROM (
    SELECT b, list_reduce(range(8), lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384)
      ELSE r >> 1 END, b::BIGINT) AS r FROM range(256) x(b)
  )
)"""


def _merkle() -> str:
    """Levels by recursion, one row per node; then each leaf's way up, by recursion as well."""
    def field(name: str) -> str:
        return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        names = ("doc_id", "source", "lang", "n_chars")
        return f"sha256({' || '.join(field(name) for name in names)} || {field(text)})"

    def forest(name: str, leaves: str, key: str) -> str:
        return f"""{name} AS (
          SELECT {key}, 0 AS level, i, h FROM {leaves}
          UNION ALL
          SELECT {key}, level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)) FROM {name}
          WHERE ({key}, level) IN (SELECT ({key}, level) FROM {name} GROUP BY ALL HAVING count(*) > 1)
          GROUP BY {key}, level, i // 16
        )"""

    return rf"""
    WITH RECURSIVE {_CRC_TABLE}, leaf AS (
      SELECT doc_id, coalesce('.' || source, '') AS src,
        {leaf('text')} AS h,
        CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN {leaf(_SMALL.format(text='text'))} END AS changed
      FROM documents, crc_table
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id, h) - 1 AS i FROM leaf
    ), {forest('node', 'ranked', 'src')}, sub AS (
      SELECT src, h, row_number() OVER (ORDER BY src) - 1 AS i, 0 AS k
      FROM (SELECT * FROM node QUALIFY level = max(level) OVER (PARTITION BY src))
    ), {forest('over', 'sub', 'k')}, whole AS (
      SELECT h AS root FROM over ORDER BY level DESC LIMIT 1
    ), all_nodes AS (
      SELECT 's' || src AS tree, level, i, h FROM node UNION ALL SELECT 't', level, i, h FROM over
    ), top AS (SELECT tree, max(level) AS height FROM all_nodes GROUP BY tree
    ), sides AS (
      SELECT a.tree, a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
        coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
      FROM all_nodes a JOIN all_nodes b ON a.tree = b.tree AND a.level = b.level AND a.i // 16 = b.i // 16
      GROUP BY a.tree, a.level, a.i
    ), way AS (
      SELECT doc_id, h AS leaf, 's' || src AS tree, 0 AS level, i, coalesce(changed, h) AS cur, '' AS proof, src
      FROM ranked
      UNION ALL
      SELECT w.doc_id, w.leaf, CASE WHEN w.level = t.height THEN 't' ELSE w.tree END,
        CASE WHEN w.level = t.height THEN 0 ELSE w.level + 1 END,
        CASE WHEN w.level = t.height THEN sub.i ELSE w.i // 16 END,
        CASE WHEN w.level = t.height THEN w.cur ELSE sha256(s.before || w.cur || s.after) END,
        CASE WHEN w.level = t.height THEN w.proof ELSE w.proof || s.before || s.after END, w.src
      FROM way w JOIN top t ON t.tree = w.tree JOIN sub ON sub.src = w.src
      JOIN sides s ON s.tree = w.tree AND s.level = w.level AND s.i = w.i
      WHERE NOT (w.tree = 't' AND w.level = t.height)
    )
    SELECT w.doc_id, w.leaf, sub.h AS subroot, root, sha256(w.proof) AS proof_sha256,
      w.cur AS folded_root, w.cur = root AS verified
    FROM way w JOIN top t ON t.tree = w.tree AND w.tree = 't' AND w.level = t.height
    JOIN sub ON sub.src = w.src, whole
    """


#: Windows of 10 words as texts; each document word looks up to nine places back for one.
OP12 = rf"""
WITH item AS (
  SELECT item_id, regexp_extract_all({_SMALL.format(text="coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, size, array_to_string(w[p : p + size - 1], ' ') AS words
  FROM (SELECT *, least(10, len(w)) AS size FROM item WHERE len(w) > 0),
    LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS p)
), doc AS (
  SELECT doc_id, regexp_extract_all({_SMALL.format(text="coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), size AS (SELECT DISTINCT size FROM win
), found AS (
  SELECT doc_id, p, size, item_id FROM (
    SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS p, w FROM doc, size WHERE len(w) >= size
  ) JOIN win USING (size) WHERE array_to_string(w[p : p + size - 1], ' ') = win.words
), hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM found)
  GROUP BY doc_id
), held AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)
"""

#: Neighbours by one wildcard in place of a character, or by a character left out.
OP13 = rf"""
WITH RECURSIVE {_CRC_TABLE}, run AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({_SMALL.format(text="coalesce(text, '')")}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents
  ) GROUP BY ALL
), hashed AS (
  SELECT run, n, {_crc32("doc_id || ':' || run")} AS h FROM run, crc_table
), word AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN run[: (h % length(run))] || run[(h % length(run)) + 2 :]
      ELSE run END AS word FROM hashed
  ) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), spot AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM word
), pattern AS (
  SELECT word, n, word[: p - 1] || '*' || word[p + 1 :] AS k FROM spot
), shorter AS (
  SELECT DISTINCT word, n, word[: p - 1] || word[p + 1 :] AS k FROM spot
), pair AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM pattern a JOIN pattern b ON a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN word b ON a.k = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN word b ON a.k = b.word
), best AS (
  SELECT word, n, count(*) AS n_near, arg_min(near, (-near_n, encode(near))) AS near, max(near_n) AS near_n
  FROM pair GROUP BY word, n
), formed AS (
  SELECT word, near AS form, near_n AS form_n FROM best WHERE near_n >= 2 * n
), way AS (
  SELECT word, form AS root FROM formed
  UNION ALL SELECT way.word, formed.form FROM way JOIN formed ON formed.word = way.root
), ended AS (
  SELECT word, root FROM way WHERE root NOT IN (SELECT word FROM formed)
)
SELECT w.word, form, coalesce(root, w.word) AS root, w.n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
FROM word w LEFT JOIN best b USING (word) LEFT JOIN formed f USING (word) LEFT JOIN ended e USING (word)
"""

ORACLES = {
    "op1_mixing": _mixing(),
    "op2_near_dedup": OP2,
    "op6_exact_dedup": OP6,
    "op11_merkle": _merkle(),
    "op12_decontamination": OP12,
    "op13_spelling": OP13,
}
