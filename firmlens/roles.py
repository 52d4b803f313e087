"""Role views: the register's logical tables played by the driver's TPC-H-style tables.

The driver tables hold no company data and no nulls, so each view maps columns onto the
register schema and injects nulls, bad strings and unmatched keys (see FIXTURES.md §3).
Every view is one list of ``(name, SQL expression)`` pairs over one source table. The same
text is used by Spark (``selectExpr``) and by the DuckDB oracle (a CTE), so both engines
start from identical inputs. The expressions only use functions both dialects share.

``*_raw`` views keep the camel-case names and the untyped strings of the source system;
the other views are the cleaned, typed, lower-case tables the analytics read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@dataclass(frozen=True)
class RoleView:
    source: str
    columns: tuple[tuple[str, str], ...]
    where: str | None = None
    join: tuple[str, str] | None = None  # (second table, equi-join condition)

    def sql(self) -> str:
        cols = ",\n    ".join(f"{expr} AS {name}" for name, expr in self.columns)
        where = f"\n  WHERE {self.where}" if self.where else ""
        join = f" JOIN {self.join[0]} ON {self.join[1]}" if self.join else ""
        return f"SELECT\n    {cols}\n  FROM {self.source}{join}{where}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, as its files split."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad(expr: str, width: int) -> str:
    """Left-pad digits with zeros to ``width`` (never truncating longer numbers)."""
    text = f"cast({expr} as string)"
    return f"lpad({text}, cast(greatest({width}, length({text})) as int), '0')"


_SIRET = _pad("o_orderkey", 14)
_SIREN_O = _pad("o_custkey", 9)
# Every 11th unit is delivered under a key no establishment uses: those establishments have
# no parent (and those units no establishment) — the unmatched keys of FIXTURES.md §3.
_SIREN_C = f"case when c_custkey % 11 = 0 then concat('U', {_pad('c_custkey', 9)}) else {_pad('c_custkey', 9)} end"
_COMMUNE = "case when o_orderkey % 17 = 0 then null else o_orderpriority end"
_POSTAL_RAW = (
    "case when o_orderkey % 23 = 0 then null "
    "else lpad(cast(o_orderkey % 200000 as string), case when o_orderkey % 5 = 0 then 6 else 5 end, '0') end"
)
_X_INT = "100000 + (o_orderkey * 7919) % 1100000"
_Y_INT = "6050000 + (o_orderkey * 104729) % 1050000"
_ADDRESS = (
    ("complementadresseetablissement",
     "case when o_orderkey % 3 = 0 then null when o_orderkey % 3 = 1 then '  ' "
     "else concat('BAT ', cast(o_orderkey % 9 as string)) end"),
    ("numerovoieetablissement",
     "case when o_orderkey % 5 = 0 then null else cast(1 + o_orderkey % 250 as string) end"),
    ("typevoieetablissement",
     "case o_orderkey % 4 when 0 then 'RUE' when 1 then 'AV' when 2 then 'BD' else null end"),
    ("libellevoieetablissement", "concat('VOIE ', cast(o_custkey % 97 as string))"),
)
_UL_DATE_TEXT = (
    "case when c_custkey % 10 = 3 then 'bad' else concat(cast(2010 + c_custkey % 15 as string), '-', "
    "lpad(cast(1 + c_custkey % 12 as string), 2, '0'), '-', lpad(cast(1 + c_custkey % 28 as string), 2, '0')) end"
)
_UL_ACTIVITY = "case when c_custkey % 47 = 0 then null else lpad(cast(c_nationkey as string), 2, '0') end"
_FIN_REVENUE = (
    "case when o_orderkey % 7 = 0 then null when o_orderkey % 29 = 0 then -o_totalprice else o_totalprice end"
)

ROLE_VIEWS: dict[str, RoleView] = {
    # establishments as the source system delivers them: camel case, text values
    "etablissements_raw": RoleView("orders", (
        ("siret", _SIRET),
        ("siren", _SIREN_O),
        ("etatAdministratifEtablissement", "case when o_orderstatus = 'F' then 'A' else 'F' end"),
        ("dateCreationEtablissement",
         "case when o_orderkey % 13 = 0 then 'bad' else cast(cast(o_orderdate as date) as string) end"),
        ("trancheEffectifsEtablissement", "lpad(cast(o_orderkey % 7 as string), 2, '0')"),
        ("anneeEffectifsEtablissement", "cast(year(o_orderdate) as int)"),
        ("complementAdresseEtablissement", _ADDRESS[0][1]),
        ("numeroVoieEtablissement", _ADDRESS[1][1]),
        ("typeVoieEtablissement", _ADDRESS[2][1]),
        ("libelleVoieEtablissement", _ADDRESS[3][1]),
        ("codePostalEtablissement", _POSTAL_RAW),
        ("libelleCommuneEtablissement", _COMMUNE),
        ("coordonneeLambertAbscisseEtablissement",
         f"case when o_orderkey % 19 = 0 then null when o_orderkey % 31 = 0 then 'n/a' "
         f"else cast({_X_INT} as string) end"),
        ("coordonneeLambertOrdonneeEtablissement", f"cast({_Y_INT} as string)"),
    )),
    # cleaned establishments (what the dashboard reads)
    "etablissements": RoleView("orders", (
        ("siret", _SIRET),
        ("siren", _SIREN_O),
        ("etatadministratifetablissement", "case when o_orderstatus = 'F' then 'A' else 'F' end"),
        ("datecreationetablissement",
         "case when o_orderkey % 13 = 0 then null else cast(o_orderdate as date) end"),
        ("trancheeffectifsetablissement", "lpad(cast(o_orderkey % 7 as string), 2, '0')"),
        ("anneeeffectifsetablissement", "cast(year(o_orderdate) as int)"),
        *_ADDRESS,
        ("codepostaletablissement",
         "case when o_orderkey % 23 = 0 or o_orderkey % 5 = 0 then null "
         "else lpad(cast(o_orderkey % 200000 as string), 5, '0') end"),
        ("libellecommuneetablissement", _COMMUNE),
        ("coordonneelambertabscisseetablissement",
         f"case when o_orderkey % 19 = 0 or o_orderkey % 31 = 0 then null else cast({_X_INT} as double) end"),
        ("coordonneelambertordonneeetablissement", f"cast({_Y_INT} as double)"),
    )),
    "unite_legale_raw": RoleView("customer", (
        ("siren", _SIREN_C),
        ("denominationUniteLegale", "case when c_custkey % 6 = 0 then null else c_name end"),
        ("dateCreationUniteLegale", _UL_DATE_TEXT),
        ("activitePrincipaleUniteLegale", _UL_ACTIVITY),
        ("categorieEntreprise", "c_mktsegment"),
        ("anneeCategorieEntreprise", "cast(2015 + c_custkey % 8 as string)"),
        ("trancheEffectifsUniteLegale", "lpad(cast(c_custkey % 6 as string), 2, '0')"),
        ("anneeEffectifsUniteLegale", "cast(2015 + c_custkey % 8 as int)"),
        ("etatAdministratifUniteLegale", "case when c_custkey % 13 = 0 then 'C' else 'A' end"),
        ("statutDiffusionUniteLegale", "case when c_custkey % 9 = 0 then 'P' else 'O' end"),
    )),
    "unite_legale": RoleView("customer", (
        ("siren", _SIREN_C),
        ("denominationunitelegale", "case when c_custkey % 6 = 0 then null else c_name end"),
        ("datecreationunitelegale", f"try_cast({_UL_DATE_TEXT} as date)"),
        ("activiteprincipaleunitelegale", _UL_ACTIVITY),
        ("categorieentreprise", "c_mktsegment"),
        ("anneecategorieentreprise", "cast(2015 + c_custkey % 8 as double)"),
        ("trancheeffectifsunitelegale", "lpad(cast(c_custkey % 6 as string), 2, '0')"),
        ("anneeeffectifsunitelegale", "cast(2015 + c_custkey % 8 as int)"),
        ("etatadministratifunitelegale", "case when c_custkey % 13 = 0 then 'C' else 'A' end"),
    )),
    "donnees_financieres_raw": RoleView("orders", (
        ("siren", _SIREN_O),
        ("date_cloture_exercice",
         "case when o_orderkey % 41 = 0 then 'bad' else cast(cast(o_orderdate as date) as string) end"),
        ("chiffre_d_affaires", f"cast({_FIN_REVENUE} as string)"),
        ("resultat_net", "case when o_orderkey % 43 = 0 then 'n/a' else cast(o_totalprice - 100000 as string) end"),
    )),
    "donnees_financieres": RoleView("orders", (
        ("siren", _SIREN_O),
        ("date_cloture_exercice", "case when o_orderkey % 41 = 0 then null else cast(o_orderdate as date) end"),
        ("chiffre_d_affaires", _FIN_REVENUE),
        ("resultat_net", "case when o_orderkey % 43 = 0 then null else o_totalprice - 100000 end"),
    )),
    # label dictionaries
    # every 9th code is listed under another code: sectors 00, 09, 18 have no label
    "code_naf": RoleView("nation", (
        ("code", "case when n_nationkey % 9 = 0 then concat('X', cast(n_nationkey as string)) "
                 "else lpad(cast(n_nationkey as string), 2, '0') end"),
        ("libelle", "case when n_nationkey = 4 then concat(n_name, ' - SERVICES') else n_name end"),
    )),
    "tranches_effectifs": RoleView("region", (
        ("code", "lpad(cast(r_regionkey as string), 2, '0')"),
        ("libelle", "r_name"),
    )),
    # sector code → region name (activity codes roll up to regions)
    "regions": RoleView("nation", (
        ("code", "lpad(cast(n_nationkey as string), 2, '0')"),
        ("libelle", "r_name"),
    ), join=("region", "n_regionkey = r_regionkey")),
    # place names of a region file (hyphens, apostrophes, repeated spaces, districts)
    "communes_geo": RoleView("part", (
        ("feature_id", "p_partkey"),
        ("nom",
         "case p_partkey % 7 when 0 then concat('Marseille ', cast(1 + p_partkey % 16 as string), 'e Arrondissement') "
         "when 1 then 'L''Estaque' when 2 then 'Aix-en-Provence' when 3 then '1-urgent' "
         "when 4 then '2  -  High' when 5 then '3-MEDIUM' else p_name end"),
        ("lon", "cast(p_size as double) / 10 + 4"),
        ("lat", "cast(p_partkey % 100 as double) / 100 + 43"),
    )),
    # financial ratios records (the open-data ratios feed)
    "ratios": RoleView("orders", (
        ("siren", _SIREN_O),
        ("date_cloture_exercice", "cast(cast(o_orderdate as date) as string)"),
        ("chiffre_d_affaires", "o_totalprice"),
        ("marge_brute", "o_totalprice * 3 / 10"),
        ("ebe", "o_totalprice * 12 / 100"),
        ("ebit", "o_totalprice * 8 / 100"),
        ("resultat_net", "o_totalprice * 5 / 100"),
        ("taux_d_endettement", "cast(o_orderkey % 150 as double)"),
        ("ratio_de_liquidite", "cast(o_orderkey % 300 as double) / 100"),
        ("ratio_de_vetuste", "cast(o_orderkey % 90 as double)"),
        ("autonomie_financiere", "cast(o_orderkey % 70 as double)"),
        ("poids_bfr_exploitation_sur_ca", "cast(o_orderkey % 40 as double)"),
        ("page", "cast(floor(o_orderkey / 100) as bigint)"),
    )),
}


def role_sql(name: str) -> str:
    return ROLE_VIEWS[name].sql()


def with_roles(names: list[str] | tuple[str, ...], body: str) -> str:
    """Prefix an oracle query with the role views it reads, as CTEs."""
    ctes = ",\n".join(f"{n} AS (\n  {role_sql(n)}\n)" for n in names)
    return f"WITH {ctes}\n{body}"


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A role view as a lazy DataFrame over the driver table (scan + projection only)."""
    view = ROLE_VIEWS[name]
    df = table(spark, sf_dir, view.source)
    if view.join:
        df = df.join(table(spark, sf_dir, view.join[0]), F.expr(view.join[1]))
    if view.where:
        df = df.where(view.where)
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in view.columns])
