"""Oracle SQL fragments: WKB decoded with DuckDB's core functions, in either byte order."""

from __future__ import annotations


def double_at(hexa: str, at: str, little: str) -> str:
    """SQL for the IEEE double whose 16 hex digits start at the 1-based position ``at`` of ``hexa``."""
    turned = ", ".join(f"substr({hexa}, {at} + {i}, 2)" for i in range(14, -1, -2))
    bits = f"CAST('0x' || CASE WHEN {little} THEN concat({turned}) ELSE substr({hexa}, {at}, 16) END AS UBIGINT)"
    return (
        f"list_transform([{bits}], lambda u: CASE WHEN (u & 9223372036854775807::UBIGINT) = 0 THEN 0.0::DOUBLE ELSE "
        "(CASE WHEN (u >> 63) = 1 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END) * "
        "CAST((u & 4503599627370495::UBIGINT) + 4503599627370496::UBIGINT AS DOUBLE) * "
        "pow(2.0::DOUBLE, CAST((u >> 52) & 2047 AS INT) - 1075) END)[1]"
    )


def int_at(hexa: str, at: str, little: str) -> str:
    """SQL for the unsigned 32-bit number whose 8 hex digits start at ``at``."""
    turned = ", ".join(f"substr({hexa}, {at} + {i}, 2)" for i in range(6, -1, -2))
    return f"CAST('0x' || CASE WHEN {little} THEN concat({turned}) ELSE substr({hexa}, {at}, 8) END AS BIGINT)"


def points_cte(name: str, source: str, columns: str = "id") -> str:
    """``name(columns, lon, lat)`` of the point rows of ``source``."""
    x, y = double_at("h", "11", "le"), double_at("h", "27", "le")
    return (
        f"{name}_h AS (SELECT {columns}, hex(geometry) AS h, substr(hex(geometry), 1, 2) = '01' AS le FROM {source} "
        f"WHERE geometry IS NOT NULL AND octet_length(geometry) = 21), "
        f"{name} AS (SELECT {columns}, {x} AS lon, {y} AS lat FROM {name}_h)"
    )


def paths_cte(name: str, source: str, columns: str = "id") -> str:
    """``name(columns, kind, part, path, i, x, y)``: every vertex of every path of ``source``, by a recursive walk.

    ``source`` needs a unique ``id``.  The states of the walk are: a geometry header (``todo`` counts the geometries
    left), and a path (``rings`` counts the paths left of the current part).
    """
    le = "substr(s.h, s.pos, 2) = '01'"
    code, count = int_at("s.h", "s.pos + 2", "t.le"), int_at("s.h", "s.pos + 10", "t.le")
    points = int_at("s.h", "s.pos", "t.le")
    x, y = double_at("h", "(first + 32 * i)", "le"), double_at("h", "(first + 32 * i + 16)", "le")
    own = ", ".join("s." + c.strip() for c in columns.split(","))
    return f"""{name}_src AS (SELECT id, hex(geometry) AS h FROM {source} WHERE geometry IS NOT NULL AND id IS NOT NULL),
{name}_walk(id, h, kind, pos, le, todo, part, rings, path, first, n) AS (
  SELECT id, h, 0::BIGINT, 1::BIGINT, TRUE, 1::BIGINT, -1::BIGINT, 0::BIGINT, -1::BIGINT, 0::BIGINT, 0::BIGINT FROM {name}_src
  UNION ALL
  SELECT s.id, s.h, CASE WHEN s.kind = 0 THEN u.code ELSE s.kind END,
    s.pos + CASE WHEN s.rings > 0 THEN 8 + 32 * v.n WHEN u.code = 1 THEN 42 WHEN u.code = 2 THEN 18 + 32 * v.n ELSE 18 END,
    t.le,
    CASE WHEN s.rings > 0 THEN s.todo WHEN u.code > 3 THEN s.todo - 1 + v.parts ELSE s.todo - 1 END,
    CASE WHEN s.rings > 0 OR u.code > 3 THEN s.part ELSE s.part + 1 END,
    CASE WHEN s.rings > 0 THEN s.rings - 1 WHEN u.code = 3 THEN v.parts ELSE 0 END,
    CASE WHEN s.rings > 0 OR u.code IN (1, 2) THEN s.path + 1 ELSE s.path END,
    CASE WHEN s.rings > 0 THEN s.pos + 8 WHEN u.code = 1 THEN s.pos + 10 WHEN u.code = 2 THEN s.pos + 18 ELSE 0 END,
    v.n
  FROM {name}_walk s,
    LATERAL (SELECT CASE WHEN s.rings > 0 THEN s.le ELSE {le} END AS le) t,
    LATERAL (SELECT CASE WHEN s.rings > 0 THEN 0 ELSE {code} END AS code) u,
    LATERAL (SELECT CASE WHEN s.rings > 0 THEN {points} WHEN u.code = 1 THEN 1 WHEN u.code = 2 THEN {count} ELSE 0 END AS n,
      CASE WHEN s.rings = 0 AND u.code >= 3 THEN {count} ELSE 0 END AS parts) v
  WHERE s.rings > 0 OR s.todo > 0
),
{name}_v AS (SELECT id, h, le, kind, part, path, first, unnest(range(n)) AS i FROM {name}_walk WHERE n > 0),
{name}_xy AS (SELECT id, kind, part, path, i, {x} AS x, {y} AS y FROM {name}_v),
{name} AS (SELECT {own}, w.kind, w.part, w.path, w.i, w.x, w.y
  FROM {name}_xy w JOIN (SELECT DISTINCT {columns} FROM {source}) s ON s.id = w.id)"""
