"""The repair of conversations in DuckDB's SQL: turn by turn from the back, the best edits of each state."""

from __future__ import annotations

from ledgerlake.llm.merkle_sql import CRC_TABLE, crc32

# States by number from 1: nothing said, the system's turn, a user's, an assistant's.
_NEXT = {1: 3, 2: 3, 3: 4, 4: 3}
_ROLE = {3: "user", 4: "assistant"}
#: Kept turns: from a state with an initial to a state.
_KEPT = [(1, "s", 2), (1, "u", 3), (2, "u", 3), (4, "u", 3), (3, "a", 4)]


def _edit(letter: str, cost: str, behind: str, line: str = "''") -> str:
    return f"{{'c': {behind}.c + {cost}, 'a': '{letter}' || {behind}.a, 'o': {line} || {behind}.o}}"


def _taken(state: int) -> str:
    """The best way from a state that takes the turn at once."""
    to = _NEXT[state]
    late = "CASE WHEN cut THEN 3 ELSE 0 END"
    never = "{'c': 1000000000, 'a': '', 'o': ''}"
    ways = [_edit("D", "4", f"best[{state}]")]
    given = _edit("R", f"3 + {late}", f"best[{to}]", f"'{_ROLE[to]}:' || text || chr(10)")
    ways.append(f"CASE WHEN gone THEN {never} ELSE {given} END")
    for start, initial, kept in _KEPT:
        if start == state:
            way = _edit("K", late, f"best[{kept}]", "role || ':' || text || chr(10)")
            ways.append(f"CASE WHEN gone OR initial <> '{initial}' THEN {never} ELSE {way} END")
    return f"least({', '.join(ways)})"


def _inserted(name: str, behind: str) -> str:
    ways = [
        f"least({name}[{s}], {_edit('I', '3', f'{behind}[{to}]', f"'{_ROLE[to]}:' || chr(10)")})"
        for s, to in _NEXT.items()
    ]
    return f"[{', '.join(ways)}]"


def conversations_sql() -> str:
    text_of = "coalesce({}::VARCHAR, ' ')".format
    key = f"{text_of('conv_id')} || ':' || {text_of('turn')}"
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE {CRC_TABLE}, raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32(key)} % 20 AS f
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM raw WHERE f <> 0
), placed AS (
  SELECT *, trim(text, {white}) AS said,
         row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text), copy) AS place
  FROM damaged
), judged AS (
  SELECT conv_id, turn, role, text, place, said = '' AS blank, left(role, 1) AS initial,
         said <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS again,
         right(said, 1) NOT IN ('.', '!', '?') AS cut,
         place > 1 AND lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1)
           NOT IN ('su', 'ua', 'au') AS illegal
  FROM placed
), turns AS (
  SELECT *, blank OR again AS gone FROM judged
), step AS (
  SELECT conv_id, max(place) AS place,
         [{{'c': 0, 'a': '', 'o': ''}}, {{'c': 6, 'a': 'II', 'o': 'user:' || chr(10) || 'assistant:' || chr(10)}},
          {{'c': 3, 'a': 'I', 'o': 'assistant:' || chr(10)}}, {{'c': 0, 'a': '', 'o': ''}}] AS best
  FROM turns GROUP BY conv_id
  UNION ALL
  SELECT conv_id, place, {_inserted("taken", "once")} FROM (
    SELECT conv_id, place, taken, {_inserted("taken", "taken")} AS once FROM (
      SELECT s.conv_id, s.place - 1 AS place, [{", ".join(_taken(s) for s in _NEXT)}] AS taken
      FROM step s JOIN turns t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.place = s.place
    )
  )
), repair AS (SELECT conv_id, best[1] AS way FROM step WHERE place = 0
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
         count(*) FILTER (cut AND NOT gone) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM turns GROUP BY conv_id
)
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(way.c, 0)::BIGINT AS cost, coalesce(way.a, '') AS audit,
       sha256(coalesce(left(way.o, length(way.o) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN repair r ON r.conv_id IS NOT DISTINCT FROM k.conv_id
"""
