"""Records that span lines, read from files that many tasks share.

A quoted CSV value may hold line breaks, a pretty-printed JSON array has each element on several lines: where a
record ends depends on everything before it in the file, so readers give such a file to one task. Here a first pass, made of
column functions, sums up for each file block how it moves the state that matters (inside quotes or not; how deep in
brackets); a running sum over the blocks of a file says in which state each block begins. With that, every task cuts
its own block's lines into records, and the few records that cross from block to block are put together from their pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# a piece of text and whether a record starts, and ends, with it
Pieces = list[tuple[str, bool, bool]]


class Quoted:
    """CSV: a line break inside quotes doesn't end a record. The state is the parity of the quotes so far, so quotes
    must stand in pairs, as RFC 4180 has it."""

    def __init__(self, quote: str = '"'):
        self.quote = quote

    def move(self, line: Column) -> Column:
        return (F.length(line) - F.length(F.replace(line, F.lit(self.quote), F.lit("")))) % 2

    def inside(self, state: int) -> bool:
        return state % 2 == 1

    def cut(self, lines: list[str], moves: np.ndarray, state: int) -> tuple[Pieces, int]:
        after = (state + np.cumsum(moves)) % 2
        before = (after - moves) % 2
        return list(zip(lines, (before == 0).tolist(), (after == 0).tolist())), int(after[-1]) if len(after) else state


class Elements:
    """JSON: the objects and arrays that are ``level`` brackets deep, wherever lines break. The state is the depth; strings hold
    no line breaks, so every line begins outside of them."""

    STRING = r'"(\\.|[^"\\])*"'

    def __init__(self, level: int):
        self.level = level
        self._mark = re.compile(rf"{self.STRING}|[{{\[]|[}}\]]")

    def move(self, line: Column) -> Column:
        bare = F.regexp_replace(line, self.STRING, "")
        return F.length(F.regexp_replace(bare, r"[}\]]", "")) - F.length(F.regexp_replace(bare, r"[{\[]", ""))

    def inside(self, state: int) -> bool:
        return state > self.level

    def cut(self, lines: list[str], moves: np.ndarray, state: int) -> tuple[Pieces, int]:
        out: Pieces = []
        for line in lines:
            at, began = 0, False  # where the element at hand starts in this line, and whether it starts here
            for m in self._mark.finditer(line):
                if m[0] in "{[":
                    if state == self.level:
                        at, began = m.start(), True
                    state += 1
                elif m[0] in "}]":
                    state -= 1
                    if state == self.level:
                        out.append((line[at : m.end()], began, True))
            if state > self.level:
                out.append((line[at:] if began else line, began, False))
        return out, state


@dataclass(frozen=True)
class Blocks:
    """In which state each block of each file begins, and each file ends."""

    states: dict[str, tuple[np.ndarray, np.ndarray]]
    last: dict[str, int]


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, block, value)``: the lines of text files, as the files split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def block_states(lines: DataFrame, shape: Quoted | Elements) -> Blocks:
    """One aggregate over the lines; two numbers per block come to the driver, which holds as much of every block to plan a scan."""
    moves = lines.groupBy("file", "block").agg(F.sum(shape.move(F.col("value"))).alias("m"))
    rows = moves.toArrow().sort_by([("file", "ascending"), ("block", "ascending")])
    states, last = {}, {}
    files = rows.column("file").to_pylist()
    block, move = rows.column("block").to_numpy(), rows.column("m").to_numpy()
    at = 0
    while at < len(files):
        to = at
        while to < len(files) and files[to] == files[at]:
            to += 1
        total = np.cumsum(move[at:to])
        states[files[at]], last[files[at]] = (block[at:to], np.concatenate([[0], total[:-1]])), int(total[-1])
        at = to
    return Blocks(states, last)


def records(lines: DataFrame, shape: Quoted | Elements, blocks: Blocks) -> DataFrame:
    """``(file, block, seq, text)``: the records of ``lines``; ``(block, seq)`` is their order in the file. A record that crosses
    blocks is put together by one task; one that the end of the file cuts off is returned as far as it goes."""
    spark = lines.sparkSession
    whole = _cut(lines, shape, blocks).where("starts AND ends").select("file", "block", "seq", "text")
    # blocks that begin inside a record, and those before them, hold the pieces
    crossed = [
        (file, int(b)) for file, (starts, state) in blocks.states.items() for k, s in enumerate(state) if shape.inside(int(s)) for b in starts[max(k - 1, 0) : k + 1]
    ] + [(file, int(blocks.states[file][0][-1])) for file, s in blocks.last.items() if shape.inside(s)]
    if not crossed:
        return whole
    some = spark.createDataFrame(sorted(set(crossed)), "file string, block long")
    pieces = _cut(lines.join(F.broadcast(some), ["file", "block"], "left_semi"), shape, blocks).where("NOT (starts AND ends)")
    order = Window.partitionBy("file").orderBy("block", "seq")
    pieces = pieces.withColumn("record", F.sum(F.col("starts").cast("int")).over(order))
    part = F.struct("block", "seq", "text")
    joined = pieces.groupBy("file", "record").agg(F.min(F.struct("block", "seq")).alias("first"), F.array_sort(F.collect_list(part)).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    return whole.unionByName(joined.select("file", "first.block", "first.seq", text.alias("text")))


def _cut(lines: DataFrame, shape: Quoted | Elements, blocks: Blocks) -> DataFrame:
    """``(file, block, seq, starts, ends, text)``: records and pieces of records, each block by itself and in order."""
    spark = lines.sparkSession
    _share_package_path(spark)
    sent = spark.sparkContext.broadcast(blocks.states)  # two numbers per block

    def begin(file: str, block: int) -> int:
        starts, state = sent.value[file]
        at = int(np.searchsorted(starts, block))
        if at == len(starts) or starts[at] != block:
            raise RuntimeError(f"{file} was split otherwise than before: read it again")
        return int(state[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: tuple[str, int] | None = None
        state = seq = 0
        open_, started = [], False  # the record that goes on

        def row(texts, starts, ends, first):
            n = len(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array([own[0]] * n, pa.string()), pa.array([own[1]] * n, pa.int64()), pa.array(range(first, first + n), pa.int64()),
                 pa.array(starts, pa.bool_()), pa.array(ends, pa.bool_()), pa.array(texts, pa.string())],
                names=["file", "block", "seq", "starts", "ends", "text"],
            )

        for batch in batches:
            files, places = batch.column("file").to_pylist(), batch.column("block").to_pylist()
            values, moves = batch.column("value").to_pylist(), batch.column("move").to_numpy()
            at = 0
            while at < len(files):
                if (files[at], places[at]) != own:
                    if open_:
                        yield row(["\n".join(open_)], [started], [False], seq)
                    own = (files[at], places[at])
                    state, seq, open_, started = begin(*own), 0, [], False
                to = at + 1
                while to < len(files) and places[to] == own[1] and files[to] == own[0]:
                    to += 1
                pieces, state = shape.cut(values[at:to], moves[at:to], state)
                texts, starts, ends = [], [], []
                for text, start, end in pieces:
                    if start and not open_:
                        started = True
                    if end:
                        texts.append("\n".join([*open_, text]) if open_ else text)
                        starts.append(started if open_ else start)
                        ends.append(True)
                        open_, started = [], False
                    else:
                        open_.append(text)
                if texts:
                    yield row(texts, starts, ends, seq)
                    seq += len(texts)
                at = to
        if open_:
            yield row(["\n".join(open_)], [started], [False], seq)

    moved = lines.select("file", "block", "value", shape.move(F.col("value")).cast("long").alias("move"))
    return moved.mapInArrow(run, "file string, block long, seq long, starts boolean, ends boolean, text string")


def _share_package_path(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it (the same shared path on a cluster, unless it is
    installed there or sent with ``--py-files``)."""
    root, env = str(Path(__file__).parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (env.get("PYTHONPATH"), root) if x)
