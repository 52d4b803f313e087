"""Secret scans over an incremental blob ledger.

Every version of every file is addressed by its content (SHA-256). The ledger is a table of
(blob, rule, rule version, spans); only pairs of blob and rule version that it lacks are
scanned, once however many paths and versions hold the blob, and findings are joined back
to all of them.

DataFrame functions only. Positions come from what a rule's matches and the gaps between
them (the text split by the rule) measure in code points.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.sources.sinks import table_exists


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    literal: str = ""  # a string that every match contains, to skip other texts

    @property
    def version(self) -> str:
        return hashlib.sha256(repr((self.pattern, self.group, self.least)).encode()).hexdigest()[:16]


# The rules, in the order in which kinds are listed
RULES = (
    Rule(
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
        r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16, literal="AKIA"),
    # runs shorter than 32 never count, so the pattern asks for 32: the same runs, fewer matches
    Rule("hex", r"[0-9a-f]{32,}", least=32),
)

SPAN = "struct<kind:string,start:long,end:long>"
BLOCK = 128  # matches walked at a time
LEDGER = f"blob string, rule string, version string, spans array<{SPAN}>"


def rule_spans(text: str, rule: Rule) -> Column:
    """Spans (code points, end exclusive) of a rule's matches in the column ``text``."""

    def lit(x: str) -> str:
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"

    none = f"cast(array() as array<{SPAN}>)"
    # per match: its text, the checked group and the gap before it; the gap after the last match pairs with null
    rows = (
        f"arrays_zip(regexp_extract_all({text}, {lit(rule.pattern)}, 0), "
        f"regexp_extract_all({text}, {lit(rule.pattern)}, {rule.group}), split({text}, {lit(rule.pattern)}, -1))"
    )
    match, checked, gap = "get(m, i)['0']", "get(m, i)['1']", "get(m, i)['2']"
    # appending copies an array, so matches are walked in blocks: first what each measures, then its spans from where it begins
    block = f"sequence(b * {BLOCK}, least((b + 1) * {BLOCK}, size(m) - 1) - 1)"
    blocks = f"sequence(0, (size(m) - 2) div {BLOCK})"
    sizes = f"transform({blocks}, b -> aggregate({block}, 0L, (n, i) -> n + length({gap}) + length({match})))"
    begins = f"aggregate({sizes}, array(0L), (a, n) -> array_append(a, element_at(a, -1) + n))"
    start, end = f"a.at + length({gap})", f"a.at + length({gap}) + length({match})"
    span = f"named_struct('kind', {lit(rule.kind)}, 'start', {start}, 'end', {end})"
    step = f"named_struct('at', {end}, 'spans', if(length({checked}) >= {rule.least}, array_append(a.spans, {span}), a.spans))"
    walk = f"aggregate({block}, named_struct('at', get(begins, b), 'spans', {none}), (a, i) -> {step}, a -> a.spans)"
    # transform over an array of one binds a name, so that what stands for it is computed once
    walks = f"transform(array({begins}), begins -> flatten(transform({blocks}, b -> {walk})))[0]"
    walk = f"transform(array({rows}), m -> if(size(m) < 2, {none}, {walks}))[0]"
    sure = f"contains({text}, {lit(rule.literal)})" if rule.literal else f"{text} rlike {lit(rule.pattern)}"
    return F.expr(f"if({sure}, {walk}, {none})")


def read_ledger(df: DataFrame, ledger: str) -> DataFrame:
    """The ledger table, empty where none has been written yet."""
    spark = df.sparkSession
    if not table_exists(spark, ledger):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def scan_versions(versions: DataFrame, ledger: str, path: str = "path", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``path, blob, spans`` for every row of ``versions``, after scanning what the ledger lacks.

    ``ledger`` is a folder in the shared store; newly scanned pairs are appended to it, also
    those without findings. ``spans`` (kind, start, end) are sorted by start, then kind as listed.
    Null text counts as empty, a null path stays null; repeated rows are returned each. Rows are
    addressed by content: equal texts are one blob whatever their path. No rows: none.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = versions.select(F.col(path).alias("path"), content.alias("text")).withColumn("blob", F.sha2("text", 256))
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    known = read_ledger(versions, ledger).select("blob", "rule", "version")
    unseen = (
        rows.groupBy("blob").agg(F.min("path").alias("path"))
        .select("blob", "path", F.inline(wanted))
        .join(known, ["blob", "rule", "version"], "left_anti")
        .groupBy("blob", "path").agg(F.collect_set("rule").alias("todo"))
        .hint("merge")
    )
    texts = rows.alias("r").join(unseen.alias("u"), F.expr("r.blob = u.blob AND r.path <=> u.path")).select("r.blob", "u.todo", "r.text")
    scanned = texts.select(
        "blob", F.array(*[
            F.struct(
                F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"),
                F.when(F.array_contains("todo", r.kind), rule_spans("text", r)).alias("spans"),
            ) for r in rules
        ]).alias("found"),
    )
    # rows that repeat path and text meet here as equal, small rows
    fresh = scanned.select("blob", F.inline("found")).where("spans IS NOT NULL").distinct()
    fresh.write.mode("append").parquet(ledger)
    current = " OR ".join(f"(rule = '{r.kind}' AND version = '{r.version}')" for r in rules)
    order = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (r.kind, k)])
    sortable = F.transform("all", lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("at"), s["kind"].alias("kind"), s["end"].alias("end")))
    findings = (
        read_ledger(versions, ledger).where(current).where("size(spans) > 0")
        .dropDuplicates(["blob", "rule", "version"])
        .groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("all"))
        .select("blob", F.transform(F.array_sort(sortable), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))
    )
    return rows.select("path", "blob").join(findings, "blob", "left").select(
        "path", "blob", F.coalesce("spans", F.expr(f"cast(array() as array<{SPAN}>)")).alias("spans")
    )
