"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

OP8_SQL = r"""
WITH own AS (
    SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS text
    FROM documents
), cut AS (
    SELECT rid, doc_id, host, text,
        regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)),
            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM own
), windows AS (
    SELECT rid, i, list_slice(words, i, i + 4) AS w
    FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM cut)
), repeated AS (
    SELECT rid, i FROM windows
    QUALIFY count(*) OVER (PARTITION BY rid, w) > 1
), held AS (
    SELECT rid, count(DISTINCT p) AS n FROM (
        SELECT rid, unnest(range(i, i + 5)) AS p FROM repeated
    ) GROUP BY rid
), counted AS (
    SELECT rid, doc_id, host,
        CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        len(lines) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(held.n, 0) AS BIGINT) AS n_repeat_words
    FROM cut LEFT JOIN held USING (rid)
), failed AS (
    SELECT *,
        n_words < 10 AS short, 100 * n_repeat_words > 20 * n_words AS repeats,
        n_symbols > n_words AS symbols, 100 * n_dup_lines > 30 * n_lines AS dups
    FROM counted
), per_rule AS (
    UNPIVOT (SELECT rid, host, short, repeats, symbols, dups FROM failed)
    ON short, repeats, symbols, dups INTO NAME rule VALUE fails
), hosts AS (
    SELECT host, rule, count(*) AS n, count(*) FILTER (fails) AS f
    FROM per_rule WHERE host IS NOT NULL GROUP BY host, rule
), moments AS (
    SELECT rule, sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) AS square,
        count(*) / sum(n) AS chance
    FROM hosts GROUP BY rule
), prior AS (
    SELECT rule, mean, CASE WHEN between_hosts > 0
        THEN least(greatest(mean * (1 - mean) / between_hosts - 1, 1), 1e6) ELSE 1e6 END AS weight
    FROM (SELECT *, square - mean * mean - mean * (1 - mean) * chance AS between_hosts
          FROM moments)
), strict AS (
    SELECT host, rule FROM hosts JOIN prior USING (rule)
    WHERE (f + mean * weight) / (n + weight) >= 0.5
), rejected AS (
    SELECT DISTINCT rid FROM per_rule JOIN strict USING (host, rule) WHERE fails
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    short OR repeats AS base_failed,
    NOT (short OR repeats) AND rid NOT IN (SELECT rid FROM rejected) AS kept
FROM failed
"""

OP11_SQL = r"""
WITH vectors AS (
    SELECT row_number() OVER () AS rid, vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.rid AS anchor, a.vec_id AS anchor_id, c.rid, c.vec_id, a.label = c.label AS same,
        CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
    FROM vectors a JOIN vectors c ON a.rid <> c.rid
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor, anchor_id, rid AS positive, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    CAST(row_number() OVER (
        PARTITION BY p.anchor, p.positive ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
    n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n USING (anchor)
WHERE NOT n.same AND 30 * p.positive_score <= 100 * n.score
    AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""

OP12_SQL = r"""
WITH own AS (
    SELECT doc_id,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
FROM own WINDOW same AS (PARTITION BY text_sha256)
"""

_CRC32 = """list_reduce(
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda held, byte: list_reduce(range(8), lambda bits, k:
        xor(bits >> 1, CASE WHEN bits & 1 = 1 THEN 3988292384 ELSE 0 END), xor(held, byte)),
    4294967295)"""


def _leaf(n_chars: str) -> str:
    framed = [
        f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
        for c in ("doc_id", "source", "lang", n_chars, "text")
    ]
    return f"sha256({' || '.join(framed)})"


def _tree(name: str, start: str) -> str:
    return f"""{name} AS (
    {start}
    UNION ALL
    SELECT tree, lvl + 1, pos // 2, (max(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
    FROM {name} WHERE n > 1 GROUP BY tree, lvl, pos // 2
)"""


def _steps(nodes: str, tree: str, pos: str, first: int) -> str:
    """Per row and level: where the other node stands, and its digest or nothing."""
    return f"""SELECT rid, {first} + own.lvl AS nth,
        CASE WHEN (CAST({pos} AS BIGINT) >> own.lvl) & 1 = 1 THEN 'L' ELSE 'R' END
            || coalesce(other.digest, '') AS step
    FROM placed
    JOIN (SELECT DISTINCT tree, CAST(lvl AS INTEGER) AS lvl FROM {nodes} WHERE n > 1) own
        ON own.tree = {tree}
    LEFT JOIN {nodes} other ON other.tree = own.tree AND other.lvl = own.lvl
        AND other.pos = xor(CAST({pos} AS BIGINT) >> own.lvl, CAST(1 AS BIGINT))"""


OP13_SQL = f"""
WITH RECURSIVE claims AS (
    SELECT *, {_leaf("n_chars")} AS leaf, {_leaf("claim")} AS claimed
    FROM (SELECT *, n_chars + CASE WHEN xor({_CRC32}, 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS claim
          FROM documents)
), placed AS (
    SELECT row_number() OVER () AS rid, doc_id, leaf, claimed,
        dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS n
    FROM claims
), {_tree("nodes", "SELECT tree, 0 AS lvl, pos, n, leaf AS digest FROM placed")
}, {_tree("tops", '''SELECT 0 AS tree, 0 AS lvl, tree AS pos, count(*) OVER () AS n, digest
    FROM nodes WHERE n = 1''')
}, steps AS (
    {_steps("nodes", "placed.tree", "placed.pos", 0)}
    UNION ALL
    {_steps("tops", "0", "placed.tree", 100)}
), paths AS (
    SELECT rid, list(step ORDER BY nth) AS path FROM steps GROUP BY rid
), whole AS (
    SELECT doc_id, leaf, claimed, sub.digest AS subroot,
        (SELECT digest FROM tops WHERE n = 1) AS root,
        coalesce(path, CAST([] AS VARCHAR[])) AS path
    FROM placed JOIN (SELECT tree, digest FROM nodes WHERE n = 1) sub USING (tree)
    LEFT JOIN paths USING (rid)
), folds AS (
    SELECT *, list_reduce(path, lambda held, step: sha256(CASE WHEN step[1] = 'L'
        THEN step[2:] || held ELSE held || step[2:] END), claimed) AS folded_root
    FROM whole
)
SELECT doc_id, leaf, subroot, root,
    sha256(array_to_string(list_transform(path, lambda step: step[2:]), '')) AS proof_sha256,
    folded_root, folded_root = root AS verified
FROM folds
"""
