"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op9_warc_dictionary"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex,
             min(page_id) OVER (PARTITION BY sha1(payload)) AS first FROM p),
bits AS (SELECT *, list_transform(range(0, 40), lambda i:
           list_position(['0','1','2','3','4','5','6','7','8','9','a','b','c','d','e','f'],
                         substr(hex, i + 1, 1)) - 1) AS h FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
           (((h[(5 * i) // 4 + 1] * 16 + coalesce(h[(5 * i) // 4 + 2], 0))
             >> CAST(3 - (5 * i) % 4 AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM bits
"""

SQL["op10_grid_order_join"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id, vec_id AS to_id FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.to_id),
comp AS (SELECT vec_id, min(to_id) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT c.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM comp c LEFT JOIN n ON n.vec_id = c.vec_id
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = (f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          f"'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')")
SQL["op12_best_position"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
h AS (SELECT r, doc_id, ts, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0),
g AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM h),
p AS (SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(ts) AS t FROM h) GROUP BY r, t),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) /
  CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, g GROUP BY t),
q AS (SELECT item_id, text, t, CAST(count(*) AS BIGINT) AS times
  FROM (SELECT item_id, text, unnest(ts) AS t
        FROM (SELECT DISTINCT item_id, text, {_TERMS} AS ts FROM benchmark)) GROUP BY item_id, text, t),
s AS (SELECT q.item_id, q.text, h.r, any_value(h.doc_id) AS doc_id, CAST(sum(q.times * w.w *
    ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * h.n * g.big_n) // g.big_l)))) AS BIGINT) AS score
  FROM q JOIN w ON w.t = q.t JOIN p ON p.t = q.t JOIN h ON h.r = p.r, g GROUP BY q.item_id, q.text, h.r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text
    ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""


def _tree(prefix: str, leaves: str, levels: int = 16) -> str:
    """CTEs of a tree with runs of three over ``leaves`` (tree, rank, node):
    ``{prefix}_top`` (tree, top) and ``{prefix}_path`` (tree, rank, l0, r0, ...),
    the siblings left and right of each leaf's path; up to 3 ** levels leaves."""
    ctes = [f"{prefix}0 AS (SELECT tree, rank, node, count(*) OVER (PARTITION BY tree) AS total "
            f"FROM {leaves})"]
    for j in range(levels):
        ctes.append(f"""{prefix}_s{j} AS (SELECT tree, rank, total,
  CASE WHEN total > 1 THEN coalesce(string_agg(node, '') OVER (PARTITION BY tree, rank // 3 ORDER BY rank
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS l,
  CASE WHEN total > 1 THEN coalesce(string_agg(node, '') OVER (PARTITION BY tree, rank // 3 ORDER BY rank
    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS r,
  node FROM {prefix}{j})""")
        ctes.append(f"""{prefix}{j + 1} AS (SELECT tree, rank // 3 AS rank,
  CASE WHEN any_value(total) > 1 THEN sha256(string_agg(node, '' ORDER BY rank)) ELSE any_value(node) END AS node,
  (any_value(total) + 2) // 3 AS total FROM {prefix}{j} GROUP BY tree, rank // 3)""")
    cols = ", ".join(f"s{j}.l AS {prefix}l{j}, s{j}.r AS {prefix}r{j}, s{j}.total > 1 AS {prefix}u{j}"
                     for j in range(levels))
    joins = " ".join(f"JOIN {prefix}_s{j} s{j} ON s{j}.tree = a.tree AND s{j}.rank = a.rank // {3 ** j}"
                     for j in range(levels))
    ctes.append(f"{prefix}_path AS MATERIALIZED (SELECT a.tree, a.rank, {cols} FROM {prefix}0 a {joins})")
    ctes.append(f"{prefix}_top AS (SELECT tree, node AS top FROM {prefix}{levels} WHERE rank = 0)")
    return ",\n".join(ctes)


def _field(c: str, text: str | None = None) -> str:
    text = text or f"CAST({c} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text: bit by bit over its bytes."""
    bits = (f"flatten(list_transform(string_split({text}, ''), lambda ch: "
            "list_concat([CAST(ascii(ch) AS BIGINT)], [0, 0, 0, 0, 0, 0, 0])))")
    return (f"xor(4294967295, list_reduce({bits}, lambda c, x: "
            "xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1)), CAST(4294967295 AS BIGINT)))")


def _folds(prefixes: list[str], levels: int = 16) -> tuple[str, str]:
    """CTEs that fold ``given`` up the paths, and the name of the last one."""
    ctes, last = [], "paths"
    for p in prefixes:
        for j in range(levels):
            ctes.append(f"fold_{p}{j} AS (SELECT * REPLACE (CASE WHEN {p}u{j} THEN "
                        f"sha256({p}l{j} || given || {p}r{j}) ELSE given END AS given) FROM {last})")
            last = f"fold_{p}{j}"
    return ",\n".join(ctes), last


_LEVELS = range(16)
_CTES, _LAST = _folds(["t", "g"])
SQL["op13_merkle_witnesses"] = f"""
WITH d AS (SELECT *, coalesce('s' || source, '-') AS tree,
  sha256({' || '.join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
  sha256({' || '.join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))} ||
    {_field("text", "replace(text, chr(10), '')")}) AS cut
  FROM documents),
e AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
  CASE WHEN doc_id IS NOT NULL AND {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN cut ELSE leaf END AS given
  FROM d),
tl AS (SELECT tree, rank, leaf AS node FROM e),
{_tree("t", "tl")},
gl AS (SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY tree) - 1 AS rank, top AS node FROM t_top),
{_tree("g", "gl")},
paths AS (SELECT e.doc_id, e.leaf, t_top.top AS subroot, g_top.top AS root, e.given, t_path.*, g_path.*
  FROM e JOIN t_path ON t_path.tree = e.tree AND t_path.rank = e.rank JOIN t_top ON t_top.tree = e.tree
  JOIN gl ON gl.name = e.tree JOIN g_path ON g_path.rank = gl.rank JOIN g_top ON true),
{_CTES}
SELECT doc_id, leaf, subroot, root,
  sha256({' || '.join(f'{p}l{j} || {p}r{j}' for p in "tg" for j in _LEVELS)}) AS proof_sha256,
  given AS folded_root, given = root AS verified FROM {_LAST}
"""
