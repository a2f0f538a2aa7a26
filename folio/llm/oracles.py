"""DuckDB SQL of the operators that SQL can express, over the same tables."""

from __future__ import annotations

_USABLE = ("embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, "
           "lambda x: x IS NULL OR NOT isfinite(x))) = 0")
ROUNDS = 6


def _vector_codes() -> str:
    """op11: one assignment and one replacement of the codebooks for each round."""

    def assign(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (SELECT r, p, min(16 * list_sum(list_transform(x,
          lambda v, i: (v - c[i]) * (v - c[i]))) + e) AS m
        FROM parts JOIN b{k} USING (p) GROUP BY r, p)"""

    def replace(k: int) -> str:
        return f"""s{k} AS MATERIALIZED (SELECT p, CAST(m % 16 AS BIGINT) AS e, i,
          CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n
        FROM a{k} JOIN parts USING (r, p), unnest(range(1, 1 + len(x))) t(i) GROUP BY p, m % 16, i),
      u{k} AS MATERIALIZED (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
        FROM s{k} GROUP BY p, e),
      b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(u.c, b.c) AS c
        FROM b{k} b LEFT JOIN u{k} u ON b.p = u.p AND b.e = u.e)"""

    rounds = ",\n".join(f"{assign(k)},\n{replace(k)}" for k in range(ROUNDS))
    return f"""
    WITH base AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label,
        list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE {_USABLE}),
    parts AS MATERIALIZED (SELECT r, vec_id, p,
        v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS x
      FROM base, unnest(range(8)) t(p)),
    b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e,
        x AS c FROM parts QUALIFY e < 16),
    {rounds},
    {assign(ROUNDS)},
    coded AS MATERIALIZED (SELECT r, string_agg(printf('%02x', CAST(m % 16 AS BIGINT)), ''
        ORDER BY p) AS code, CAST(sum(m // 16) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r),
    labelled AS (SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT)
        AS label_error FROM coded JOIN base USING (r))
    SELECT vec_id, code, error, label_error, (SELECT sha256(string_agg(array_to_string(c, ','),
        ',' ORDER BY p, e)) FROM b{ROUNDS}) AS codebooks_sha256
    FROM labelled"""


_TOPK = f"""
    WITH base AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding,
        lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
      FROM embeddings WHERE {_USABLE}),
    pairs AS (SELECT q.r, q.vec_id AS query_id, c.vec_id,
        CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM base q JOIN base c ON q.r <> c.r WHERE q.vec_id % 50 = 0)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC,
        vec_id NULLS LAST) AS INTEGER) AS rank, vec_id, score
    FROM pairs QUALIFY rank <= 5"""

_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      string_split(CAST({c} AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
        lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""

_TRIE = rf"""
    WITH RECURSIVE turns AS MATERIALIZED (SELECT conv_id, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, role, text) AS i, coalesce(role, '') AS role,
        coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    told AS MATERIALIZED (SELECT *, sha256(concat(length(role), ':', role, text)) AS id,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM turns),
    ids AS MATERIALIZED (SELECT conv_id, {_CRC.format(c="conv_id")} % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM turns)),
    rebuilt AS MATERIALIZED (SELECT ids.conv_id, t.i, 0 AS own, t.id, t.words FROM ids JOIN told t
        ON t.conv_id = ids.conv_id - ids.conv_id % 20 AND t.i <= h
      UNION ALL SELECT conv_id, i, 1, id, words FROM told JOIN ids USING (conv_id) WHERE i > h),
    paths AS MATERIALIZED (SELECT conv_id, list(id ORDER BY own, i) AS path,
        list(words ORDER BY own, i) AS words FROM rebuilt GROUP BY conv_id
      UNION ALL SELECT conv_id, [], [] FROM ids WHERE conv_id NOT IN (SELECT conv_id FROM rebuilt)),
    member AS MATERIALIZED (SELECT conv_id, d, sha256(array_to_string(path[1:d], '/')) AS node,
        CASE WHEN d > 0 THEN sha256(array_to_string(path[1:d - 1], '/')) END AS parent,
        CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, d = len(path) AS ends
      FROM paths, unnest(range(0, len(path) + 1)) t(d)),
    node AS MATERIALIZED (SELECT node, any_value(parent) AS parent, any_value(d) AS depth,
        min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
          FILTER (WHERE ends), '')) AS ends_sha256 FROM member GROUP BY node),
    children AS MATERIALIZED (SELECT parent AS node, count(*) AS n FROM node
      WHERE parent IS NOT NULL GROUP BY parent),
    up AS (SELECT node AS below, node FROM node
      UNION ALL SELECT up.below, n.parent FROM up JOIN node n USING (node)
        WHERE n.parent IS NOT NULL),
    subtree AS MATERIALIZED (SELECT up.node, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves,
        CAST(sum(b.saved) AS BIGINT) AS saved_tokens
      FROM up JOIN node b ON b.node = up.below LEFT JOIN children c ON c.node = up.below
      GROUP BY up.node)
    SELECT node.conv_id, node.depth, p.conv_id AS parent_conv_id, node.n_convs,
      coalesce(c.n, 0) AS n_children, s.n_leaves, s.saved_tokens, node.ends_sha256
    FROM node JOIN subtree s USING (node) LEFT JOIN children c USING (node)
    LEFT JOIN node p ON p.node = node.parent"""

ORACLES: dict[str, str] = {
    "op11_vector_codes": _vector_codes(),
    "op12_topk": _TOPK,
    "op13_prefix_trie": _TRIE,
}
