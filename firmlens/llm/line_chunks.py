"""Line deduplication by content-defined chunks of lines.

Every line has a 32-bit hash, and a rolling hash over it and the line before. A chunk ends after
a line whose rolling hash is smaller than both neighbours', so boundaries depend on a few lines
around them only and shift with the text. Two such lines are never neighbours, and the last line
but one is none: every chunk of a document of several lines has two lines or more. Chunks of several lines that occur more than once in
the corpus are removed, but for their first occurrence (by doc_id, then place), after
comparison of their bytes.

DataFrame functions only. Hashes, not texts, are shuffled to find repeated chunks; whole
texts move twice: to fetch the bytes of the candidates, and to be rebuilt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.common import stored

MULTIPLIER = 1_000_003
MODULUS = 1 << 32


def line_chunks(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``lines`` (the text split at line feeds) and ``chunks``, an array of ``start`` (line
    number from 0) and ``size`` (lines). Null text: null."""
    # each step is used more than once by the next, so it is computed once per row
    hashes = "transform(lines, l -> cast(conv(substr(md5(cast(l as binary)), 1, 8), 16, 10) as bigint))"
    rolling = f"transform(hashes, (h, i) -> (if(i = 0, 0L, get(hashes, i - 1) * {MULTIPLIER}) + h) % {MODULUS})"
    cuts = (
        "filter(sequence(0, size(rolling)), i -> i = 0 or i = size(rolling) or "
        "(i > 1 and i < size(rolling) - 1 and get(rolling, i - 1) < get(rolling, i - 2) and get(rolling, i - 1) < get(rolling, i)))"
    )
    pairs = "transform(slice(cuts, 1, size(cuts) - 1), (c, k) -> named_struct('start', c, 'size', get(cuts, k + 1) - c))"
    out = df.withColumn("lines", F.split(F.col(text), "\n", -1))
    for name, expr in (("hashes", hashes), ("rolling", rolling), ("cuts", cuts), ("chunks", pairs)):
        out = out.withColumn(name, F.expr(expr))
    return out.drop("hashes", "rolling", "cuts")


def _with_text(chunks: str, fields: str) -> str:
    """The array ``chunks`` (elements c) with the field ``chunk``, the joined lines, after ``fields``."""
    # transform over an array of one binds the lines, so that they are never split anew per chunk
    joined = "array_join(transform(sequence(c.start, c.start + c.size - 1), i -> get(ls, i)), '\\n')"
    return f"transform(array(lines), ls -> transform({chunks}, c -> named_struct({fields}, 'chunk', {joined})))[0]"


def remove_repeated_chunks(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` packed as ``doc`` (a struct of all its columns) with ``clean`` (the text without removed
    chunks), ``n_lines``, and ``removed`` (``start`` and ``size`` of removed chunks, in order).

    Chunks of one line, and of white space only, stay. Null text: ``clean`` null, no lines. A null id comes
    before others. Rows with equal id and text are one document given twice: both get its
    result. Equal texts under different ids lose their chunks, but the first. No rows: none.
    """
    packed = df_with_key(docs, text, id_col)
    found = line_chunks(packed.select("id", "mark", "text"))
    # explode_outer: for a plain explode Spark would infer a filter on the chunks and, pushing it down,
    # repeat the whole chain of steps inside it
    texts = _with_text("filter(chunks, c -> c.size > 1)", "'start', c.start, 'size', c.size")
    occurrence = found.select("id", "mark", F.expr(texts).alias("texts")).select("id", "mark", F.explode_outer("texts").alias("c"))
    hashed = occurrence.where("c.chunk rlike '[^ \\t\\r\\n\\f\\x0B]'").selectExpr("id", "mark", "c.start", "c.size", "xxhash64(c.chunk) AS hash")
    hashed = stored(hashed, "line_chunk_hashes")
    # stored: a join of two exchanges, so adaptive execution can split a hash that many documents share
    repeated = stored(hashed.groupBy("hash").count().where("count > 1").select("hash"), "line_chunk_repeated")
    wanted = hashed.join(repeated, "hash").groupBy("id", "mark").agg(F.collect_set(F.struct("start", "size", "hash")).alias("wanted"))
    # bytes of the candidates
    same = lambda other: packed["id"].eqNullSafe(other["id"]) & (packed["mark"] == other["mark"])
    wanted = wanted.hint("merge")
    lines = packed.join(wanted, same(wanted)).select(packed["id"], packed["mark"], F.split(packed["text"], "\n", -1).alias("lines"), "wanted")
    texts = _with_text("wanted", "'start', c.start, 'size', c.size, 'hash', c.hash")
    bytes_ = stored(lines.select("id", "mark", F.inline(F.expr(texts))), "line_chunk_bytes", compression="zstd")
    place = F.struct("id", "mark", "start")
    first = bytes_.groupBy("hash", "chunk").agg(F.min(place).alias("first"))
    first = stored(first, "line_chunk_first", compression="zstd")  # as for the repeated hashes
    removed = (
        bytes_.join(first, ["hash", "chunk"])
        .where(~place.eqNullSafe(F.col("first")))
        .groupBy("id", "mark")
        .agg(F.array_sort(F.collect_set(F.struct("start", "size"))).alias("removed"))
        .hint("merge")
    )
    joined = packed.join(removed, same(removed), "left").select(
        "doc", F.coalesce("removed", F.expr("cast(array() as array<struct<start:int,size:int>>)")).alias("removed"),
        F.split(F.col(f"doc.`{text}`").cast("string"), "\n", -1).alias("lines"),  # not the copy: it would be shuffled too
    )
    # the lines between removed chunks, one walk over both
    upto = "coalesce(get(removed, k).start, size(ls))"
    after = "coalesce(get(removed, k - 1).start + get(removed, k - 1).size, 0)"
    between = f"if({after} < {upto}, transform(sequence({after}, {upto} - 1), i -> get(ls, i)), cast(array() as array<string>))"
    keep = f"transform(array(lines), ls -> if(ls is null, null, flatten(transform(sequence(0, size(removed)), k -> {between}))))[0]"
    return joined.select(
        "doc", F.expr(f"array_join({keep}, '\\n')").alias("clean"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"), "removed",
    ).withColumn("n_lines", F.greatest("n_lines", F.lit(0).cast("long")))


def df_with_key(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    """``doc`` (all columns), ``id``, ``text`` and ``mark``, a hash of the text."""
    value = F.col(f"doc.`{text}`").cast("string")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    return packed.select("doc", F.col(f"doc.`{id_col}`").alias("id"), value.alias("text"), F.xxhash64(value).alias("mark"))
