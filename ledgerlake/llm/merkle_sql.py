"""The manifest's query in DuckDB's SQL, and the CRC-32 that some queries' SQL shares."""

from __future__ import annotations

#: A common table expression that `crc32` needs: the 256 remainders of the polynomial 0xEDB88320.
CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
         lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS remainder
)"""


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text that is not empty."""
    letters = f"list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT))"
    step = "xor(c >> 8, remainder[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({letters}, lambda c, b: {step}), 4294967295)"


def _framed(value: str) -> str:
    text = f"({value})::VARCHAR"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _levels(name: str, nodes: str) -> str:
    """All levels of the trees over the rows (grp, slot, node) of `nodes`, and how many nodes each has."""
    return f"""{name} AS (
  SELECT grp, 0 AS level, slot, node FROM {nodes}
  UNION ALL
  SELECT grp, level + 1, slot // 2, sha256(string_agg(node, '' ORDER BY slot))
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {name}) WHERE n > 1 GROUP BY ALL
), {name}_size AS (SELECT grp, level, count(*) AS n FROM {name} GROUP BY ALL
), {name}_top AS (SELECT grp, arg_max(node, level) AS node FROM {name} GROUP BY ALL
)"""


def _walk(name: str, tree: str, start: str) -> str:
    """From the rows (id, grp, slot, proof, folded) of `start` up to the tops of a tree."""
    return f"""{name} AS (
  SELECT id, grp, 0 AS level, slot, proof, folded FROM {start}
  UNION ALL
  SELECT w.id, w.grp, w.level + 1, w.slot // 2, proof || coalesce(b.node, ''),
         sha256(CASE WHEN w.slot % 2 = 1 THEN b.node || folded ELSE folded || coalesce(b.node, '') END)
  FROM {name} w JOIN {tree}_size s ON s.grp = w.grp AND s.level = w.level AND s.n > 1
  LEFT JOIN {tree} b ON b.grp = w.grp AND b.level = w.level AND b.slot = xor(w.slot, 1)
), {name}_end AS (
  SELECT id, arg_max(proof, level) AS proof, arg_max(folded, level) AS folded FROM {name} GROUP BY id
)"""


def merkle_sql() -> str:
    def leaf(n_chars: str) -> str:
        values = ["doc_id", "source", "lang", n_chars, "text"]
        return f"sha256({' || '.join(map(_framed, values))})"

    return f"""
WITH RECURSIVE {CRC_TABLE}, d AS (
  SELECT *, coalesce('=' || lang, '') AS grp, {leaf("n_chars")} AS node,
         coalesce({crc32("doc_id::VARCHAR")} % 7 = 0, false) AS tampered
  FROM documents, crc
), leaf AS (
  SELECT row_number() OVER () AS id, doc_id, grp, node,
         row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, node) - 1 AS slot,
         CASE WHEN tampered THEN {leaf("n_chars + 1")} ELSE node END AS changed
  FROM d
), {_levels("tree", "leaf")}, subroot AS (
  SELECT '' AS grp, grp AS name, row_number() OVER (ORDER BY grp) - 1 AS slot, node FROM tree_top
), {_levels("upper", "subroot")}, start_low AS (SELECT *, '' AS proof, changed AS folded FROM leaf
), {_walk("low", "tree", "start_low")}, start_high AS (
  SELECT l.id, s.grp, s.slot, e.proof, e.folded
  FROM leaf l JOIN low_end e USING (id) JOIN subroot s ON s.name = l.grp
), {_walk("high", "upper", "start_high")}
SELECT doc_id, l.node AS leaf, s.node AS subroot, u.node AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = u.node AS verified
FROM leaf l JOIN high_end USING (id) JOIN subroot s ON s.name = l.grp, upper_top u
"""
