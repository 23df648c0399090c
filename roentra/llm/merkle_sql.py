"""The manifest as SQL: one common table expression for each level of the trees."""

from __future__ import annotations

# Levels that cover 16^6 rows of a source and 16^4 sources.
SOURCE_LEVELS, TOP_LEVELS = 6, 4


def _field(expression: str) -> str:
    text = f"CAST({expression} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return f"sha256({' || '.join(_field(f) for f in fields)})"


def _joined(part: str) -> str:
    return f"array_to_string({part}, '')"


# CRC-32 bit by bit: each byte is mixed in, then eight times shifted out (-1).
_STEPS = "flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])"
_CRC = f"""xor(list_reduce(list_concat([4294967295::BIGINT], {_STEPS}::BIGINT[]),
        lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""


def _levels(name: str, key: str, levels: int) -> str:
    """``name``_0 (key, pos, digest) hashed upwards: runs of nodes and the nodes of the next level,
    where a tree of one node stays as it is."""
    parts = []
    for k in range(levels):
        parts.append(f"""{name}_run_{k} AS (
    SELECT {key}, pos // 16 AS pos, list(digest ORDER BY pos) AS run,
           sum(count(*)) OVER (PARTITION BY {key}) AS n
    FROM {name}_{k} GROUP BY {key}, pos // 16
), {name}_{k + 1} AS (
    SELECT {key}, pos, CASE WHEN n = 1 THEN run[1] ELSE sha256({_joined('run')}) END AS digest FROM {name}_run_{k}
)""")
    return ", ".join(parts)


def _climb(rows: str, name: str, key: str, levels: int, first: int) -> str:
    """Each row of ``rows``_``first`` (key, pos, proof, folded, ...) up the levels of a tree."""
    parts = []
    for k in range(levels):
        left, right = "run[1:pos % 16]", "run[pos % 16 + 2:]"
        at, to = f"{rows}_{first + k}", f"{rows}_{first + k + 1}"
        parts.append(f"""{to} AS (
    SELECT l.* REPLACE (
        l.pos // 16 AS pos,
        CASE WHEN r.n = 1 THEN l.proof ELSE l.proof || {_joined(left.replace('pos', 'l.pos'))} || {_joined(right.replace('pos', 'l.pos'))} END AS proof,
        CASE WHEN r.n = 1 THEN l.folded ELSE sha256({_joined(left.replace('pos', 'l.pos'))} || l.folded || {_joined(right.replace('pos', 'l.pos'))}) END AS folded)
    FROM {at} l JOIN {name}_run_{k} r ON l.{key} IS NOT DISTINCT FROM r.{key} AND l.pos // 16 = r.pos
)""")
    return ", ".join(parts)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE = f"""
WITH leaves AS (
    SELECT doc_id, source, {_leaf('text')} AS leaf,
           CASE WHEN {_CRC} % 5 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} END AS bad
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
), s_0 AS (
    SELECT source, place AS pos, leaf AS digest FROM placed
), {_levels('s', 'source', SOURCE_LEVELS)}, subroots AS (
    SELECT source, digest AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS place
    FROM s_{SOURCE_LEVELS}
), t_0 AS (
    SELECT 0 AS tree, place AS pos, subroot AS digest FROM subroots
), {_levels('t', 'tree', TOP_LEVELS)}, up_0 AS (
    SELECT p.doc_id, p.leaf, p.source, s.subroot, 0 AS tree, p.place AS pos, s.place AS above, '' AS proof,
           coalesce(p.bad, p.leaf) AS folded
    FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
), {_climb('up', 's', 'source', SOURCE_LEVELS, 0)}, over_0 AS (
    SELECT * REPLACE (above AS pos) FROM up_{SOURCE_LEVELS}
), {_climb('over', 't', 'tree', TOP_LEVELS, 0)}
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = digest AS verified
FROM over_{TOP_LEVELS}, t_{TOP_LEVELS}
"""
