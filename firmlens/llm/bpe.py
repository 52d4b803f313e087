"""Byte-level BPE: encoding and decoding with the vocabulary of a public tokenizer file.

Text is split by the tokenizer's pattern and every piece is encoded by merge ranks. The pattern looks ahead only
in runs of white space, so text is cut there first, and the rest is split without looking ahead, which costs half as much. A piece
of text that the pattern leaves unsplit for long is encoded as a tree: leaves in parallel
threads, then neighbours are joined level by level. A join re-encodes a window around the
seam, growing until its first token is the left side's and its last the right side's; then
every pair of neighbouring tokens is one of a valid encoding, and so is the whole.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from firmlens.llm.common import annotate

LEAF = 1024  # bytes of unsplit text encoded at once
LONG = LEAF // 4  # characters without (or of) white space that a longer piece has at least
THREADS = 2

# Fixed value: the split pattern of byte-level tokenizers with ``use_regex``
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
AHEAD = r"\s+(?!\S)|\s+"
SINGLE = PATTERN.removesuffix(AHEAD) + r"\s"  # the same where no two white space characters stand side by side
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # the pattern's white space; Python's has four more
_RUN = re.compile(f"[{WHITE}]{{2,}}")


def byte_letters() -> dict[str, int]:
    """The letters that stand for the 256 bytes in the file: printable bytes for themselves, the
    others, in order, as the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(4)
def _long_run(least: int) -> regex.Pattern:
    return regex.compile(rf"(?<!\S)\S{{{least},}}+|(?<!\s)\s{{{least},}}+")


def _may_run(text: str) -> bool:
    """Whether a run of ``LONG`` characters with, or without, white space is possible: a cheap test of the
    parts of half that length, one of which such a run would fill. False only if there is none."""
    size = LONG // 2
    for at in range(0, len(text) - size + 1, size):
        part = text[at : at + size]
        if " " not in part or part.isspace():
            return True
    return False


class Codec:
    """Encoder and decoder of one tokenizer file (BPE model, byte-level splitting)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        self.ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.bytes = {i: b for b, i in self.ranks.items()} | {i: t.encode() for t, i in self.special.items()}
        self.single = tiktoken.Encoding("single", pat_str=SINGLE, mergeable_ranks=self.ranks, special_tokens={})
        self.split = regex.compile(PATTERN)

    @cached_property
    def bpe(self) -> tiktoken.Encoding:
        """The library's encoding with the whole pattern, to compare with: the operator does without its memory."""
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def cut(self) -> regex.Pattern:
        return regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def encode(self, text: str) -> list[int]:
        """Token ids; strings of special tokens in the text are those tokens."""
        if not any(s in text for s in self.special):
            return self._plain(text)
        out: list[int] = []
        for part in self.cut.split(text):
            out += [self.special[part]] if part in self.special else self._plain(part)
        return out

    def encode_bytes(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        ids = array("I", self.encode(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _plain(self, text: str) -> list[int]:
        if not _may_run(text) or not _long_run(LONG).search(text):
            return self._cut_at_runs(text)
        out: list[int] = []
        for piece in self.split.findall(text):
            data = piece.encode()
            out += self.encode_unsplit(data) if len(data) > LEAF else self._piece(data)
        return out

    def _cut_at_runs(self, text: str) -> list[int]:
        """Of a run of white space the pattern leaves the last character to what follows."""
        out, at = [], 0
        for run in _RUN.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            out += self.single.encode_ordinary(text[at : run.start()])
            out += self._piece(text[run.start() : end].encode())
            at = end
        rest = self.single.encode_ordinary(text[at:])
        return out + rest if out else rest

    def _piece(self, data: bytes) -> list[int]:
        return self.single._encode_single_piece(data)

    def encode_unsplit(self, data: bytes, leaf: int = LEAF) -> list[int]:
        """Ids of one piece that the pattern doesn't split, by halving and joining."""
        cuts = [0, len(data)]
        while cuts[1] - cuts[0] > leaf:
            cuts = sorted({*cuts, *((a + b) // 2 for a, b in zip(cuts, cuts[1:]))})
        parts = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        with ThreadPoolExecutor(THREADS) as pool:
            level = list(pool.map(self._piece, parts))
            while len(level) > 1:
                odd = level[len(level) & ~1 :]
                level = list(pool.map(self.join, level[0 : len(level) & ~1 : 2], level[1::2])) + odd
        return level[0]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the concatenation of two encoded byte strings of one piece."""
        w = 1
        while True:
            a, b = min(w, len(left)), min(w, len(right))
            window = self._piece(b"".join(map(self.bytes.__getitem__, left[len(left) - a :] + right[:b])))
            if (a == len(left) or window[0] == left[-a]) and (b == len(right) or window[-1] == right[b - 1]):
                return left[: len(left) - a] + window + right[b:]
            w *= 2

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; unknown ids give nothing, broken UTF-8 the replacement character."""
        return b"".join([self.bytes.get(i, b"") for i in ids]).decode("utf-8", "replace")


@lru_cache(4)
def codec(path: str) -> Codec:
    """One codec per file and Python worker."""
    return Codec(path)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_texts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` packed as ``doc`` (see ``common.annotate``) with ``n_tokens`` and ``ids``, the token ids
    of the whole text as little-endian unsigned 32-bit integers.

    ``path`` names the tokenizer file where the executors find it. No special token is added;
    their strings in a text become those tokens. Null or empty text: no ids.
    """

    def compute(texts: list[bytes | None]) -> list[pa.Array]:
        c = codec(path)
        made = [c.encode_bytes((t or b"").decode("utf-8", "replace")) for t in texts]
        return [pa.array([len(m) // 4 for m in made], pa.int64()), pa.array(made, pa.binary())]

    return annotate(docs, text, "n_tokens long, ids binary", compute)


def decode_ids(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` packed as ``doc`` with ``decoded``, the text of the ids (null ids: empty)."""

    def compute(values: list[bytes | None]) -> list[pa.Array]:
        c = codec(path)
        return [pa.array([c.decode(np.frombuffer(v or b"", dtype="<u4").tolist()) for v in values], pa.string())]

    return annotate(df, ids, "decoded string", compute)
