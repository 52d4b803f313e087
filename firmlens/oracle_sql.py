"""SQL building blocks for the DuckDB oracle (test side only).

The oracle is an independent, plain-SQL statement of each query's meaning. These helpers
only assemble repeated fragments (role-view CTEs, the Lambert conversion, the mart) so the
statements in ``catalog`` stay readable. Nothing here runs on Spark.
"""

from __future__ import annotations

import math

from .fixed import PLACE_PREFIX_RULES, PLACE_SEPARATORS
from .functions.geo import (
    GRS80_E,
    ITERATIONS,
    LAMBERT93_C,
    LAMBERT93_LON0_DEG,
    LAMBERT93_N,
    LAMBERT93_XS,
    LAMBERT93_YS,
)
from .roles import role_sql


def d(v: float) -> str:
    """A double literal that parses to exactly ``v``."""
    return f"CAST({v!r} AS DOUBLE)"


def money_sum(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(18,2))) AS DOUBLE)"


def money_mean(col: str) -> str:
    return f"(CAST(SUM(CAST({col} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({col}))"


def normalize_place_sql(col: str) -> str:
    """The place-name normaliser in SQL (regexp_replace needs the 'g' flag in DuckDB)."""
    seps = PLACE_SEPARATORS.replace("'", "''")
    t = f"trim(regexp_replace(regexp_replace(upper({col}), '[{seps}]', ' ', 'g'), '\\s+', ' ', 'g'))"
    rules = " ".join(f"WHEN {t} LIKE '{p}%' THEN '{n}'" for p, n in PLACE_PREFIX_RULES)
    return f"CASE {rules} ELSE {t} END"


def lambert_ctes(src: str, x: str, y: str, out: str, decimals: int | None = None) -> str:
    """CTEs converting ``src``'s Lambert-93 columns into longitude/latitude; the last CTE
    is named ``out`` and has every column of ``src`` plus ``longitude`` and ``latitude``."""
    n, c, e = d(LAMBERT93_N), d(LAMBERT93_C), d(GRS80_E)
    dx = f"({x} - {d(LAMBERT93_XS)})"
    dy = f"({d(LAMBERT93_YS)} - {y})"
    r = f"sqrt({dx} * {dx} + {dy} * {dy})"
    ok = f"({dy} > 0 AND {r} > 0)"
    half_pi = d(math.pi / 2)
    parts = [
        f"{out}_g0 AS (SELECT *, "
        f"CASE WHEN {ok} THEN degrees({d(math.radians(LAMBERT93_LON0_DEG))} + atan({dx} / {dy}) / {n}) END AS longitude, "
        f"CASE WHEN {ok} THEN -ln({r} / {c}) / {n} END AS __l FROM {src})",
        f"{out}_g1 AS (SELECT *, {d(2.0)} * atan(exp(__l)) - {half_pi} AS __phi0 FROM {out}_g0)",
    ]
    for i in range(ITERATIONS):
        s = f"({e} * sin(__phi{i}))"
        parts.append(
            f"{out}_g{i + 2} AS (SELECT *, {d(2.0)} * atan(pow((1.0 + {s}) / (1.0 - {s}), {d(GRS80_E / 2)}) "
            f"* exp(__l)) - {half_pi} AS __phi{i + 1} FROM {out}_g{i + 1})"
        )
    lat = f"degrees(__phi{ITERATIONS})"
    lon = "longitude"
    if decimals is not None:
        lat, lon = f"round({lat}, {decimals})", f"round(longitude, {decimals})"
    drop = ", ".join(["__l"] + [f"__phi{i}" for i in range(ITERATIONS + 1)] + ["longitude"])
    parts.append(
        f"{out} AS (SELECT * EXCLUDE ({drop}), {lon} AS longitude, {lat} AS latitude FROM {out}_g{ITERATIONS + 1})"
    )
    return ",\n".join(parts)


def ctes(*items: str) -> str:
    """``WITH`` clause from role-view names and ready ``name AS (...)`` fragments."""
    out = []
    for it in items:
        out.append(it if " AS (" in it else f"{it} AS (\n  {role_sql(it)}\n)")
    return "WITH " + ",\n".join(out) + "\n"


MART = (
    "etablissements", "unite_legale", "code_naf",
    """mart0 AS (
  SELECT e.*, u.activiteprincipaleunitelegale,
         coalesce(u.denominationunitelegale, e.siret) AS denominationunitelegale,
         u.categorieentreprise, u.anneecategorieentreprise, n.libelle, n.code
  FROM etablissements e
  LEFT JOIN unite_legale u ON e.siren = u.siren
  LEFT JOIN code_naf n ON u.activiteprincipaleunitelegale IS NOT DISTINCT FROM n.code
)""",
    lambert_ctes("mart0", "coordonneelambertabscisseetablissement", "coordonneelambertordonneeetablissement",
                 "mart1"),
    "mart AS (SELECT * FROM mart1 WHERE latitude IS NOT NULL AND longitude IS NOT NULL)",
)
