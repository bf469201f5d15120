"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op4_line_dedup": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
         unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT *, {_LOWER.format(f"trim(line, {_WHITE})")} AS key FROM l),
shared AS (
  SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
kept AS (SELECT k.*, s.key IS NOT NULL AND doc_id <> keep AS gone FROM k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM kept GROUP BY doc_id""",
    "op6_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM p)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10""",
    "op9_exact_dedup": f"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
         sha256(translate(coalesce(text, ''), {_WHITE}, '')) AS text_sha256 FROM documents),
k AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k""",
}


#: Unsigned crc32 of a text, bit by bit.
_CRC = (
    "xor(list_reduce(list_transform(range(-1, octet_length(encode({0})))::BIGINT[], lambda i: CASE WHEN i < 0 THEN 4294967295 "
    "ELSE ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT END), "
    "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], "
    "lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
)


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _merkle(levels: int = 8, fan_in: int = 8) -> str:
    """Levels one below the other; each keeps the path so far beside its nodes. Enough for fan_in ** levels rows."""
    head = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    leaf = "sha256(" + head + " || {})"
    steps = [
        f"""l AS (
  SELECT doc_id, lang, {leaf.format(_field("text"))} AS leaf,
         CASE WHEN {_CRC.format("doc_id::VARCHAR")} % 3 = 0 THEN {leaf.format(_field(_LOWER.format("text")))} END AS forged
  FROM documents)""",
        """t0 AS (
  SELECT *, leaf AS node, coalesce(forged, leaf) AS folded, '' AS proof,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM l)""",
    ]

    def climb(name: str, below: str, tree: str) -> str:
        # One row per leaf throughout: nodes of a level are the different (tree, place).
        return f"""{name}n AS (SELECT DISTINCT {tree} AS tree, place, node FROM {below}),
{name}r AS (
  SELECT tree, place // {fan_in} AS run, list(node ORDER BY place) AS nodes, sum(count(*)) OVER (PARTITION BY tree) AS size
  FROM {name}n GROUP BY tree, run),
{name}s AS (
  SELECT t.*, size, nodes, array_to_string(nodes[1:place % {fan_in}], '') AS l, array_to_string(nodes[place % {fan_in} + 2:], '') AS r
  FROM {below} t JOIN {name}r ON tree IS NOT DISTINCT FROM {tree} AND run = place // {fan_in}),
{name} AS (
  SELECT * EXCLUDE (size, nodes, l, r) REPLACE (
    CASE WHEN size = 1 THEN node ELSE sha256(array_to_string(nodes, '')) END AS node,
    CASE WHEN size = 1 THEN folded ELSE sha256(l || folded || r) END AS folded,
    CASE WHEN size = 1 THEN proof ELSE proof || l || r END AS proof,
    place // {fan_in} AS place)
  FROM {name}s)"""

    for k in range(levels):
        steps.append(climb(f"t{k + 1}", f"t{k}", "lang"))
    steps.append(
        f"""r0 AS (
  SELECT * EXCLUDE (place), node AS subroot, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place
  FROM t{levels})"""
    )
    for k in range(levels):
        steps.append(climb(f"r{k + 1}", f"r{k}", "0"))
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = node AS verified
FROM r{levels}"""
    )


ORACLES["op13_merkle_manifest"] = _merkle()


def _variants(steps: int = 20) -> str:
    """Near words share a text with one letter left out, or masked; forms are followed one step at a time."""
    chain = "\n".join(
        f", c{k + 1} AS (SELECT c.word, coalesce(f.form, c.root) AS root FROM c{k} c LEFT JOIN f ON f.word = c.root)"
        for k in range(steps)
    )
    return f"""
WITH d AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS text FROM documents),
r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM d),
o AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY ALL),
h AS (SELECT run, n, {_CRC.format("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM o WHERE length(run) >= 7),
v AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM v WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
i AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
cut AS (SELECT DISTINCT word, n, left(word, i::INT - 1) || substr(word, i::INT + 1) AS k FROM i),
mask AS (SELECT word, n, left(word, i::INT - 1) || '*' || substr(word, i::INT + 1) AS k FROM i),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM mask a JOIN mask b ON a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN w b ON a.k = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN w b ON a.k = b.word),
g AS (SELECT word, n, count(*) AS n_near, first(other ORDER BY m DESC, encode(other)) AS other, max(m) AS m FROM near GROUP BY ALL),
f AS (SELECT word, other AS form, m AS form_n FROM g WHERE m >= 10 * n),
c0 AS (SELECT word, word AS root FROM w){chain}
SELECT w.word, f.form, c.root, w.n, coalesce(g.n_near, 0) AS n_near, f.form_n
FROM w LEFT JOIN g USING (word) LEFT JOIN f USING (word) JOIN c{steps} c USING (word)"""


ORACLES["op11_spelling_variants"] = _variants()

ORACLES["op12_jaccard_join"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(min(r.root), d.doc_id), d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY d.doc_id, n.n"""
