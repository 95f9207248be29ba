"""The corpus queries that SQL can express, for DuckDB on the same tables."""

from __future__ import annotations


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(*values: str) -> str:
    fields = [f"CASE WHEN {v} IS NULL THEN '-' ELSE concat(strlen(CAST({v} AS VARCHAR)), ':', {v}) END" for v in values]
    return f"sha256(concat({', '.join(fields)}))"


def _climb(source: str, name: str, group: str) -> str:
    """The levels of the trees over ``source`` (group, place, total, digest)."""
    keys = f"{group}, level, place // 2, total" if group else "level, place // 2, total"
    head = f"{group}, " if group else ""
    return f"""{name} AS (
        SELECT {head}0 AS level, place, total, digest FROM {source}
        UNION ALL
        SELECT {head}level + 1, place // 2, (total + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
        FROM {name} WHERE total > 1 GROUP BY {keys})"""


# CRC-32 of the digits of an id, with the reflected polynomial 0xEDB88320.
_CRC32 = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
    list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT))),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"""

_SIBLING = """CASE WHEN s.digest IS NULL THEN '' WHEN s.place % 2 = 0 THEN concat('<', s.digest)
    ELSE concat('>', s.digest) END"""
_FOLD = """lambda d, s: CASE left(s, 1) WHEN '<' THEN sha256(concat(substr(s, 2), d))
    ELSE sha256(concat(d, substr(s, 2))) END"""

EXACT_DEDUP = f"""
    WITH normal AS (SELECT doc_id, {_lower("text")} AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
           count(*) OVER (PARTITION BY t) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
    FROM normal
"""

MERKLE = f"""
    WITH RECURSIVE leaves AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, digest) - 1 AS place,
          count(*) OVER (PARTITION BY lang) AS total
        FROM (SELECT doc_id, lang, {_leaf("doc_id", "source", "lang", "n_chars", "text")} AS digest,
                CASE WHEN {_CRC32} % 7 = 0 AND n_chars IS NOT NULL
                  THEN {_leaf("doc_id", "source", "lang", "(n_chars + 1)", "text")} END AS changed
              FROM documents)),
    {_climb("leaves", "nodes", "lang")},
    subroots AS (
        SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS total
        FROM nodes WHERE total = 1),
    {_climb("subroots", "upper_nodes", "")},
    steps AS (SELECT DISTINCT lang, level FROM nodes WHERE total > 1),
    upper_steps AS (SELECT DISTINCT level FROM upper_nodes WHERE total > 1),
    lower_paths AS (
        SELECT l.lang, l.place, list({_SIBLING} ORDER BY t.level) AS path
        FROM leaves l JOIN steps t ON l.lang IS NOT DISTINCT FROM t.lang
        LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM l.lang AND s.level = t.level
          AND s.place = xor(l.place >> t.level, 1)
        GROUP BY l.lang, l.place),
    upper_paths AS (
        SELECT r.place, list({_SIBLING} ORDER BY t.level) AS path
        FROM subroots r CROSS JOIN upper_steps t
        LEFT JOIN upper_nodes s ON s.level = t.level AND s.place = xor(r.place >> t.level, 1)
        GROUP BY r.place),
    whole AS (
        SELECT l.doc_id, l.digest AS leaf, l.changed, r.digest AS subroot,
          (SELECT digest FROM upper_nodes WHERE total = 1) AS root,
          list_concat(coalesce(p.path, []), coalesce(u.path, [])) AS path
        FROM leaves l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang
        LEFT JOIN lower_paths p ON p.lang IS NOT DISTINCT FROM l.lang AND p.place = l.place
        LEFT JOIN upper_paths u ON u.place = r.place),
    folded AS (
        SELECT *, list_reduce(list_concat([coalesce(changed, leaf)], path), {_FOLD}) AS folded_root,
          sha256(list_aggregate(list_concat([''], list_transform(path, lambda s: substr(s, 2))), 'string_agg', '')) AS proof_sha256
        FROM whole)
    SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified,
      CASE WHEN changed IS NULL THEN 0 ELSE CAST(len(path) + 1 AS BIGINT) END AS copied_nodes
    FROM folded
"""

COLLOCATIONS = rf"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_lower("text")}, '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    words AS (
        SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
    places AS (
        SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS phrase
        FROM words, range(1, 6) t(k)),
    counted AS (SELECT lang, k, phrase, count(*) AS f FROM places GROUP BY ALL),
    candidates AS (SELECT * FROM counted WHERE k > 1 AND f >= 100),
    covered AS (
        SELECT DISTINCT s.lang, s.phrase FROM candidates s JOIN (
          SELECT lang, f, unnest([phrase[1:k - 1], phrase[2:k]]) AS part FROM candidates WHERE k > 2) longer
        ON s.lang = longer.lang AND s.phrase = longer.part AND longer.f >= s.f),
    cuts AS (
        SELECT c.lang, c.phrase, c.f AS a, cut, x.f AS l, y.f AS r, t.n,
          CAST(1000 * CAST(c.f AS HUGEINT) * t.n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates ANTI JOIN covered USING (lang, phrase)) c
        JOIN counted x ON x.lang = c.lang AND x.phrase = c.phrase[1:cut]
        JOIN counted y ON y.lang = c.lang AND y.phrase = c.phrase[cut + 1:c.k]
        JOIN totals t ON t.lang = c.lang),
    best AS (
        SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, n, score FROM cuts
        QUALIFY row_number() OVER (PARTITION BY lang, cuts.phrase ORDER BY score, cut) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM best QUALIFY rank <= 2000
"""
