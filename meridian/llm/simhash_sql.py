"""The rows of the SimHash query in DuckDB's SQL: XXH64 by hand, votes bit by bit, all pairs of fingerprints, reachability.

Numbers of 64 bits are multiplied and added as 128-bit ones and cut back. A shingle's bytes are read from its hex text.
"""

from __future__ import annotations

from meridian.llm.simhash import MOST_BITS, SEED

_ALL = 1 << 64
#: The primes of XXH64, and how far it turns each of its four sums.
P1, P2, P3, P4, P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
TURNS = (1, 7, 12, 18)


def _times(x: str, prime: int) -> str:
    return f"CAST((CAST({x} AS UHUGEINT) * {prime}::UHUGEINT) % {_ALL}::UHUGEINT AS UBIGINT)"


def _plus(x: str, y: str | int) -> str:
    return f"CAST((CAST({x} AS UHUGEINT) + {y}::UHUGEINT) % {_ALL}::UHUGEINT AS UBIGINT)"


def _turned(x: str, by: int) -> str:
    return f"((({x}) % {1 << (64 - by)}::UBIGINT) * {1 << by}::UBIGINT + (({x}) >> {64 - by}))"


def _round(x: str) -> str:
    return _times(_turned(_times(x, P2), 31), P1)


def _number(at: str, size: int = 8) -> str:
    """The bytes from a place in the hex text x on, the lowest first, as a number."""
    return "CAST('0x' || " + " || ".join(f"substr(x, {at} + {2 * k}, 2)" for k in reversed(range(size))) + " AS UBIGINT)"


def _lane(k: int) -> str:
    start = ((SEED + P1 + P2) % _ALL, (SEED + P2) % _ALL, SEED, (SEED - P1) % _ALL)[k]
    numbers = f"list_transform(range(0, stripes), lambda i: {_times(_number(f'(1 + 64 * i + {16 * k})'), P2)})"
    return f"list_reduce(list_prepend({start}::UBIGINT, {numbers}), lambda a, y: {_times(_turned(_plus('a', 'y'), 31), P1)})"


def _merged(h: str, lane: str) -> str:
    return _plus(_times(f"xor({h}, {_round(lane)})", P1), P4)


def _long(whole: str, short: str) -> str:
    """Only texts of 32 bytes or more have lanes."""
    return f"CASE WHEN stripes > 0 THEN {whole} ELSE {short} END"


_SUMMED = "v0"
for _k in range(1, 4):
    _SUMMED = _plus(_turned("v0", TURNS[0]) if _k == 1 else _SUMMED, _turned(f"v{_k}", TURNS[_k]))

HASHED = f"""
words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words),
raw AS (SELECT s, hex(encode(s)) AS x, CAST(octet_length(encode(s)) AS BIGINT) AS n, CAST(octet_length(encode(s)) AS BIGINT) // 32 AS stripes FROM (SELECT DISTINCT s FROM shingles)),
lanes AS (SELECT *, {", ".join(f"CASE WHEN stripes > 0 THEN {_lane(k)} END AS v{k}" for k in range(4))} FROM raw),
h0 AS (SELECT *, {_long(_SUMMED, f"{(SEED + P5) % _ALL}::UBIGINT")} AS h FROM lanes),
h1 AS (SELECT * REPLACE ({_long(_merged("h", "v0"), "h")} AS h) FROM h0),
h2 AS (SELECT * REPLACE ({_long(_merged("h", "v1"), "h")} AS h) FROM h1),
h3 AS (SELECT * REPLACE ({_long(_merged("h", "v2"), "h")} AS h) FROM h2),
h4 AS (SELECT * REPLACE ({_plus(_long(_merged("h", "v3"), "h"), "n")} AS h), (n % 32) // 8 AS eights FROM h3),
h5 AS (SELECT * REPLACE (list_reduce(list_prepend(h, list_transform(range(0, eights), lambda i: {_round(_number("(1 + 64 * stripes + 16 * i)"))})), lambda a, k: {_plus(_times(_turned("xor(a, k)", 27), P1), P4)}) AS h), 32 * stripes + 8 * eights AS done FROM h4),
h6 AS (SELECT * REPLACE (CASE WHEN n - done >= 4 THEN {_plus(_times(_turned(f"xor(h, {_times(_number('(1 + 2 * done)', 4), P1)})", 23), P2), P3)} ELSE h END AS h, CASE WHEN n - done >= 4 THEN done + 4 ELSE done END AS done) FROM h5),
h7 AS (SELECT * REPLACE (list_reduce(list_prepend(h, list_transform(range(done, n), lambda i: {_times(_number("(1 + 2 * i)", 1), P5)})), lambda a, k: {_times(_turned("xor(a, k)", 11), P1)}) AS h) FROM h6),
h8 AS (SELECT s, {_times("xor(h, h >> 33)", P2)} AS h FROM h7),
h9 AS (SELECT s, {_times("xor(h, h >> 29)", P3)} AS h FROM h8),
hashed AS MATERIALIZED (SELECT s, xor(h, h >> 32) AS h FROM h9)"""

SQL = f"""
WITH RECURSIVE {HASHED},
votes AS (SELECT doc_id, count(*) AS n, {", ".join(f"sum(CAST((h >> {k}) & 1 AS INT)) AS b{k}" for k in range(64))} FROM shingles JOIN hashed USING (s) GROUP BY doc_id),
prints AS MATERIALIZED (SELECT words.doc_id, CAST({" + ".join(f"CASE WHEN 2 * coalesce(b{k}, 0) > n THEN {1 << k}::UHUGEINT ELSE 0::UHUGEINT END" for k in range(64))} AS UBIGINT) AS fp FROM words LEFT JOIN votes ON votes.doc_id = words.doc_id),
nodes AS MATERIALIZED (SELECT fp, min(doc_id) AS node FROM prints GROUP BY fp),
links AS MATERIALIZED (SELECT p.node AS a, q.node AS b FROM nodes p JOIN nodes q ON bit_count(CAST(xor(p.fp, q.fp) AS HUGEINT)) <= {MOST_BITS}),
reach AS (SELECT node AS a, node AS b FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
named AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, lower(lpad(to_hex(prints.fp), 16, '0')) AS fingerprint, component_id FROM prints JOIN nodes ON nodes.fp = prints.fp JOIN named ON named.a = nodes.node
"""
