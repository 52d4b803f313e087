"""Cleaning pipelines (X1-X5): raw register tables → clean tables.

X1-X4 is the clean-and-insert run: establishments of the target places, then the legal
units and accounts of *their* units (a semi join on the establishments' keys — the key set
never travels through the driver), then keyed appends. X5 is the monthly staging run with
its own, different rules (kept as they are).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..fixed import DEFAULT_PLACES, ESTABLISHMENT_COLUMNS, FINANCIAL_COLUMNS, LEGAL_UNIT_COLUMNS
from ..functions.scalars import lenient_date, lenient_double, postal_or_null
from ..operators.aggregates import distinct_keys
from ..operators.filters import (
    drop_null_subset,
    filter_active,
    filter_in_list,
    filter_non_negative,
    filter_postal,
)
from ..operators.joins import semi_join_keys
from ..operators.project import project_present
from ..session import materialize
from ..sources.sinks import append_new


def _status(df: DataFrame, lower: str) -> str:
    return next(c for c in df.columns if c.lower() == lower)


def clean_establishments(raw: DataFrame, places: Sequence[str] = DEFAULT_PLACES) -> DataFrame:
    """Active establishments of the given places, wanted columns (present ones),
    creation date parsed leniently, postal code kept only when 5 long, coordinates as
    doubles, rows without identifiers dropped. The status and place predicates reach the
    source scan (Parquet/JDBC pushdown)."""
    df = filter_active(raw, _status(raw, "etatadministratifetablissement"))
    df = filter_in_list(df, _status(raw, "libellecommuneetablissement"), places)
    df = project_present(df, ESTABLISHMENT_COLUMNS)
    fixes = {
        "datecreationetablissement": lenient_date("datecreationetablissement"),
        "codepostaletablissement": postal_or_null("codepostaletablissement"),
        "coordonneelambertabscisseetablissement": lenient_double("coordonneelambertabscisseetablissement"),
        "coordonneelambertordonneeetablissement": lenient_double("coordonneelambertordonneeetablissement"),
    }
    df = df.withColumns({k: v for k, v in fixes.items() if k in df.columns})
    return drop_null_subset(df, ["siret", "siren"])


def clean_legal_units(raw: DataFrame, keys: DataFrame, key: str = "siren") -> DataFrame:
    """Active legal units whose key is among ``keys`` (semi join), wanted columns,
    creation date parsed leniently, rows without key dropped. An empty key set gives an
    empty table (the reference skipped the step)."""
    df = filter_active(raw, _status(raw, "etatadministratifunitelegale"))
    df = semi_join_keys(df, keys, key)
    df = project_present(df, LEGAL_UNIT_COLUMNS)
    if "datecreationunitelegale" in df.columns:
        df = df.withColumn("datecreationunitelegale", lenient_date("datecreationunitelegale"))
    return drop_null_subset(df, ["siren"])


def clean_financials(raw: DataFrame, keys: DataFrame, key: str = "siren") -> DataFrame:
    """Accounts of the units among ``keys``, closing date and amounts parsed leniently."""
    df = semi_join_keys(raw, keys, key)
    df = project_present(df, FINANCIAL_COLUMNS)
    df = df.withColumns({
        "date_cloture_exercice": lenient_date("date_cloture_exercice"),
        "chiffre_d_affaires": lenient_double("chiffre_d_affaires"),
        "resultat_net": lenient_double("resultat_net"),
    })
    return drop_null_subset(df, ["siren"])


def run_clean_pipeline(
    raw_etab: DataFrame,
    raw_ul: DataFrame,
    raw_fin: DataFrame,
    target_root: str,
    places: Sequence[str] = DEFAULT_PLACES,
) -> dict[str, int]:
    """X1 → keys (A1) → X2, X3 → keyed appends of the three clean tables.

    The clean establishments are computed once and stored; the table, the keys and so the two dependent tables come
    from them: a run loads the units and accounts of its own establishments, whatever the tables held before. A rerun after any
    failure adds nothing twice. Establishments and units are found again by a key index, accounts by closing year, so a run
    opens the files that may hold its keys. Returns rows appended.
    """
    etab = materialize(clean_establishments(raw_etab, places), "clean_establishments")
    counts = {"etablissements": append_new(etab, f"{target_root}/etablissements", ["siret"], key_index=True)["rows"]}
    keys = distinct_keys(etab, "siren")
    counts["unite_legale"] = append_new(
        clean_legal_units(raw_ul, keys), f"{target_root}/unite_legale", ["siren"], key_index=True)["rows"]
    counts["donnees_financieres"] = _append_accounts(clean_financials(raw_fin, keys), f"{target_root}/donnees_financieres")
    return counts


def _append_accounts(accounts: DataFrame, path: str) -> int:
    """Keyed append of accounts; the table is partitioned by the closing year (part of the key), so
    that only the years a batch touches are compared."""
    by_year = accounts.withColumn("annee_cloture", F.year(lenient_date("date_cloture_exercice")))
    return append_new(by_year, path, list(FINANCIAL_COLUMNS), partition_col="annee_cloture")["rows"]


# X5 staging schemas: identifiers and codes stay text (no inference, leading zeros kept).
STAGED_ESTABLISHMENT = StructType(
    [StructField(c, StringType()) for c in ESTABLISHMENT_COLUMNS[:-2]]
    + [StructField(c, DoubleType()) for c in ESTABLISHMENT_COLUMNS[-2:]]
)
STAGED_LEGAL_UNIT = StructType([StructField(c, StringType()) for c in LEGAL_UNIT_COLUMNS])
STAGED_FINANCIAL = StructType([
    StructField("siren", StringType()), StructField("date_cloture_exercice", StringType()),
    StructField("chiffre_d_affaires", DoubleType()), StructField("resultat_net", DoubleType()),
])


def monthly_staging(
    raw_etab: DataFrame,
    raw_ul: DataFrame,
    raw_fin: DataFrame,
    staging_root: str,
    target_root: str,
) -> dict[str, int]:
    """Extract (active units and establishments, all accounts) → staging → clean
    (establishments: postal code present and at most 5 long, both coordinates present;
    accounts: revenue ≥ 0; legal units unchanged) → keyed append to the targets.
    Staging is Parquet with the staged types, in a shared folder: texts pass unchanged. The cleaned rows are staged
    by the append itself, which keeps its batch."""
    extract = {
        "unite_legale": project_present(filter_active(raw_ul, _status(raw_ul, "etatadministratifunitelegale")),
                                        LEGAL_UNIT_COLUMNS, lower=False),
        "etablissements": project_present(
            filter_active(raw_etab, _status(raw_etab, "etatadministratifetablissement")),
            ESTABLISHMENT_COLUMNS, lower=False),
        "donnees_financieres": project_present(raw_fin, FINANCIAL_COLUMNS, lower=False),
    }
    schemas = {"unite_legale": STAGED_LEGAL_UNIT, "etablissements": STAGED_ESTABLISHMENT,
               "donnees_financieres": STAGED_FINANCIAL}
    staged = {n: _stage(extract[n], f"{staging_root}/raw/{n}", s) for n, s in schemas.items()}
    etab = filter_postal(staged["etablissements"], "codePostalEtablissement")
    etab = drop_null_subset(etab, ["coordonneeLambertAbscisseEtablissement", "coordonneeLambertOrdonneeEtablissement"])
    fin = filter_non_negative(staged["donnees_financieres"], "chiffre_d_affaires")
    return {
        "unite_legale": append_new(staged["unite_legale"], f"{target_root}/unite_legale", ["siren"], key_index=True)["rows"],
        "etablissements": append_new(etab, f"{target_root}/etablissements", ["siret"], key_index=True)["rows"],
        "donnees_financieres": _append_accounts(fin, f"{target_root}/donnees_financieres"),
    }


def _stage(df: DataFrame, path: str, schema: StructType) -> DataFrame:
    """Write the columns of ``schema`` in its types (numbers leniently) and read them back."""
    typed = [
        (lenient_double(f.name) if f.dataType == DoubleType() else F.col(f.name).cast("string")).alias(f.name) for f in schema
    ]
    df.select(*typed).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)

