"""Projections (P1-P4): fixed, lenient and schema-walking column selections.

Column names are matched case-insensitively (sources deliver camel case, the clean tables
are lower case) and output names are lower case unless stated otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _by_lower(df: DataFrame) -> dict[str, str]:
    return {c.lower(): c for c in df.columns}


def project_present(df: DataFrame, wanted: Sequence[str], lower: bool = True) -> DataFrame:
    """Keep the wanted columns that exist (in the wanted order); absent ones are skipped."""
    have = _by_lower(df)
    cols = [
        F.col(_quote(have[w.lower()])).alias(w.lower() if lower else w)
        for w in wanted
        if w.lower() in have
    ]
    return df.select(*cols)


def _resolve(schema: StructType, path: str) -> tuple[str, DataType] | None:
    """Find a (possibly dotted) path in a schema, case-insensitively.

    A top-level column whose own name contains dots (a flattened name) wins over a walk
    into structs. Returns the quoted column reference and its type.
    """
    top = {f.name.lower(): f for f in schema.fields}
    if path.lower() in top:
        f = top[path.lower()]
        return _quote(f.name), f.dataType
    parts = path.split(".")
    fields, ref, dtype = schema, [], None
    for part in parts:
        if not isinstance(fields, StructType):
            return None
        match = {f.name.lower(): f for f in fields.fields}.get(part.lower())
        if match is None:
            return None
        ref.append(_quote(match.name))
        dtype = match.dataType
        fields = dtype
    return ".".join(ref), dtype


def project_reindex(
    df: DataFrame,
    wanted: Sequence[str] | Mapping[str, str],
    types: Mapping[str, DataType | str] | None = None,
) -> DataFrame:
    """Exactly the wanted columns, in order; an absent column becomes a typed null.

    ``wanted`` is a list of names or a ``{output name: source path}`` map, where a path may
    address a nested field (``"uniteLegale.denominationUniteLegale"``) or a flattened name.
    """
    mapping = dict(wanted) if isinstance(wanted, Mapping) else {w: w for w in wanted}
    types = dict(types or {})
    cols: list[Column] = []
    for out, path in mapping.items():
        found = _resolve(df.schema, path)
        if found is None:
            t = types.get(out, StringType())
            cols.append(F.lit(None).cast(t).alias(out))
        else:
            c = F.col(found[0])
            cols.append((c.cast(types[out]) if out in types else c).alias(out))
    return df.select(*cols)


def json_flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Flatten nested structs to top-level columns named by their path; arrays stay
    arrays (like a JSON normaliser). Pure projection: no shuffle, no Python per row."""
    cols: list[Column] = []

    def walk(dtype: DataType, ref: str, name: str) -> None:
        if isinstance(dtype, StructType) and dtype.fields:
            for f in dtype.fields:
                walk(f.dataType, f"{ref}.{_quote(f.name)}", f"{name}{sep}{f.name}")
        else:
            cols.append(F.col(ref).alias(name))

    for f in df.schema.fields:
        walk(f.dataType, _quote(f.name), f.name)
    return df.select(*cols)


def project_fixed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns; a missing one is an analysis error (fail fast)."""
    return df.select(*[F.col(_quote(c)) for c in columns])
