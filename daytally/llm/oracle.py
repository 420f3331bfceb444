"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from daytally.llm.mixing import MOST, SEED

#: Words of a text as the contracts count them, null as none.
WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

MIXED = rf"""
sized AS (SELECT *, {WORDS}::BIGINT AS size FROM docs),
sources AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
),
filled AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(source_size) OVER closed, 0) AS size_before,
         coalesce(sum(weight) OVER closed, 0) AS weight_before
  FROM sources
  WINDOW closed AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
closing AS (
  SELECT *, {MOST} * source_size * (weights - weight_before) < (total - {MOST} * size_before) * weight AS over FROM filled
),
rest AS (
  SELECT max(total) - {MOST} * coalesce(sum(source_size) FILTER (over), 0) AS rest_size,
         max(weights) - coalesce(sum(weight) FILTER (over), 0) AS rest_weight FROM closing
),
goals AS (
  SELECT source, source_size::BIGINT AS source_size,
         CASE WHEN over THEN ({MOST} * source_size)::DOUBLE
              ELSE (rest_size * weight)::DOUBLE / rest_weight::DOUBLE END AS target
  FROM closing, rest
),
rated AS (
  SELECT s.*, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
),
mixed AS (
  SELECT *, (floor(rate) + (draw < rate - floor(rate))::INT)::BIGINT AS copies FROM rated
)"""

OP1 = f"WITH docs AS (SELECT * FROM documents), {MIXED} SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM mixed"

OP9 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (same ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


OP4 = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
         ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3])) END AS s
  FROM worded
),
sets AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM shingled WHERE len(s) > 0),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS c
  FROM sets x JOIN sets y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * (na + nb - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION SELECT r.node, l.b FROM reached r JOIN both_ways l ON r.seen = l.a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, (SELECT min(seen) FROM reached WHERE node = doc_id) AS component_id
FROM shingled"""


OP2 = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])), lambda a, b: a + b)) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id != c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, (row_number() OVER near)::INT AS rank, vec_id, score FROM scored
WINDOW near AS (PARTITION BY query_id ORDER BY score, vec_id) QUALIFY row_number() OVER near <= 10"""


def _nearest(codebook: str) -> str:
    """Each part with its nearest entry, ties to the lower one."""
    return f"""
SELECT r, p, any_value(x) AS x, min(struct_pack(d := d, e := e)) AS best FROM (
  SELECT a.r, a.p, a.x, c.e, list_reduce(list_transform(range(1, len(a.x) + 1), lambda i: (a.x[i] - c.x[i]) * (a.x[i] - c.x[i])), lambda u, v: u + v) AS d
  FROM parted a JOIN {codebook} c USING (p)
) GROUP BY r, p"""


def _averaged(codebook: str, assigned: str) -> str:
    return f"""
SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM {codebook} c LEFT JOIN (
  SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM (
    SELECT p, best.e AS e, i, sum(x[i]) AS s, count(*) AS n FROM {assigned}, range(1, len(x) + 1) t(i) GROUP BY ALL
  ) GROUP BY p, e
) m USING (p, e)"""


OP11 = f"""
WITH usable AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % 16 = 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parted AS (SELECT r, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x FROM usable, range(16) t(p)),
book0 AS (SELECT p, r AS e, x FROM parted WHERE r < 64),
near0 AS ({_nearest("book0")}), book1 AS ({_averaged("book0", "near0")}),
near1 AS ({_nearest("book1")}), book2 AS ({_averaged("book1", "near1")}),
near2 AS ({_nearest("book2")}),
coded AS (
  SELECT vec_id, label, code, error FROM usable JOIN (
    SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near2 GROUP BY r
  ) USING (r)
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded"""


def _framed(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR END"


def _leaf(**changed: str) -> str:
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    return f"sha256({' || '.join(_framed(changed.get(c, c)) for c in columns)})"


def _crc32(text: str) -> str:
    """Bit by bit, as there is no such function."""
    bits = f"list_transform(range(8 * len({text})), lambda i: CASE WHEN i % 8 = 0 THEN ascii(({text})[i // 8 + 1]) ELSE 0 END::BIGINT)"
    step = "xor(xor(crc, b) >> 1, (xor(crc, b) & 1) * 3988292384)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda crc, b: {step}), 4294967295)"


def _climbed(tree: str, nodes: str) -> str:
    return f"""{tree} AS (
  SELECT grp, 0 AS level, place AS i, n, h FROM {nodes}
  UNION ALL
  SELECT grp, level + 1, i // 2, max((n + 1) // 2), sha256(string_agg(h, '' ORDER BY i)) FROM {tree} WHERE n > 1 GROUP BY grp, level, i // 2
)"""


def _steps(name: str, tree: str, nodes: str) -> str:
    return f"""{name} AS (
  SELECT l.grp, l.place, list(CASE WHEN t.i % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(s.h, '') ORDER BY t.level) AS steps
  FROM {nodes} l JOIN {tree} t ON t.grp IS NOT DISTINCT FROM l.grp AND t.i = l.place >> t.level AND t.n > 1
  LEFT JOIN {tree} s ON s.grp IS NOT DISTINCT FROM t.grp AND s.level = t.level AND s.i = xor(t.i, 1)
  GROUP BY l.grp, l.place
)"""


OP12 = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang AS grp, {_leaf()} AS h,
         CASE WHEN doc_id IS NOT NULL AND {_crc32("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf(n_chars="n_chars + 1")} ELSE {_leaf()} END AS seen
  FROM documents
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS place, count(*) OVER (PARTITION BY grp) AS n FROM hashed
),
{_climbed("tree", "leaves")},
tops AS (SELECT 0 AS grp, grp AS lang, h, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1),
{_climbed("upper", "tops")},
{_steps("inner_steps", "tree", "leaves")},
{_steps("outer_steps", "upper", "tops")},
joined AS (
  SELECT l.doc_id, l.h AS leaf, l.seen, t.h AS subroot, (SELECT h FROM upper WHERE n = 1) AS root,
         list_concat(coalesce(i.steps, []), coalesce(o.steps, [])) AS steps
  FROM leaves l JOIN tops t ON t.lang IS NOT DISTINCT FROM l.grp
  LEFT JOIN inner_steps i ON i.grp IS NOT DISTINCT FROM l.grp AND i.place = l.place
  LEFT JOIN outer_steps o ON o.place = t.place
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
       list_reduce(list_prepend(seen, steps), lambda below, s: CASE WHEN s[1] = 'L' THEN sha256(s[2:] || below) ELSE sha256(below || s[2:]) END) AS folded_root,
       folded_root = root AS verified
FROM joined"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": OP1, "op2_knn": OP2, "op4_ngram_join": OP4, "op9_exact_dedup": OP9, "op11_part_codes": OP11, "op12_merkle": OP12}
