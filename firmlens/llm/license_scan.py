"""Licence scan by matching statistics over a generalised suffix automaton.

The automaton holds every run of words of all templates (phrases and notices). A text is streamed through
it word by word: after each word the automaton tells the longest run of words that ends there and stands in
a template. Runs that are long enough and can't be extended become matches with the places of the templates
where they stand; matches of one template that follow each other closely in both are chained, and a chain that
covers enough of its template is a licence span.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from firmlens.llm.common import annotate
from firmlens.llm.license_text import NOTICES, PHRASES
from firmlens.llm.words import word_parts

LEAST_MATCH = 3  # words of a match (fewer, if its template has fewer)
LEAST_SHARE = 0.5  # share of its template's words that a chain covers
GAP = 12  # words between two matches of a chain, in the text and in the template
MAX_WORDS = 1 << 17  # words of all templates, which every worker holds


class SuffixAutomaton:
    """All runs of words of several templates, with the places where they end."""

    def __init__(self, templates: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for t, words in enumerate(templates):
            last = 0
            for at, w in enumerate(words):
                last = self._extend(last, w, ends)
                ends[last].add((t, at + 1))
        for s in sorted(range(1, len(ends)), key=self.length.__getitem__, reverse=True):
            ends[self.link[s]] |= ends[s]
        self.ends = [sorted(e) for e in ends]  # (template, words up to the end of the run)

    def _new(self, length: int, ends: list, like: int | None = None) -> int:
        self.next.append({} if like is None else dict(self.next[like]))
        self.link.append(0 if like is None else self.link[like])
        self.length.append(length)
        ends.append(set())
        return len(self.next) - 1

    def _split(self, p: int, q: int, w: int, ends: list) -> int:
        """The state of the runs that lead from ``p`` by ``w``, parted from the longer ones of ``q``."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(self.length[p] + 1, ends, q)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int, ends: list) -> int:
        if w in self.next[last]:
            return self._split(last, self.next[last][w], w, ends)
        new = self._new(self.length[last] + 1, ends)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        self.link[new] = 0 if p < 0 else self._split(p, self.next[p][w], w, ends)
        return new

    def state(self, words: list[int]) -> int:
        s = 0
        for w in words:
            s = self.next[s][w]
        return s


@dataclass
class Chain:
    template: int
    start: int
    end: int
    until: int  # words of the template up to the end of the last match
    covered: int


@dataclass
class Found:
    n_words: int = 0
    places: list[tuple[int, int]] = field(default_factory=list)  # (start, phrase)
    chains: list[Chain] = field(default_factory=list)


class Scanner:
    """Automaton and limits of one set of templates."""

    def __init__(self, phrases: dict[str, str], notices: list[tuple[str, str]], least_match: int, least_share: float, gap: int):
        split = [[w for part in word_parts(t.encode()) for w in part.split()] for t in [*phrases, *(t for _, t in notices)]]
        if any(not words for words in split):
            raise ValueError("a template without words")
        if sum(map(len, split)) > MAX_WORDS:
            raise ValueError(f"templates of more than {MAX_WORDS} words")
        self.labels, self.n_phrases = [*phrases.values(), *(label for label, _ in notices)], len(phrases)
        self.number = {w: k for k, w in enumerate(dict.fromkeys(w for words in split for w in words))}
        templates = [[self.number[w] for w in words] for words in split]
        self.sizes = [len(t) for t in templates]
        self.least, self.share, self.gap = least_match, least_share, gap
        self.automaton = a = SuffixAutomaton(templates)
        # phrases that end wherever a state's runs end: those of the state and of all shorter suffixes
        own: dict[int, list[int]] = {}
        for k, t in enumerate(templates[: self.n_phrases]):
            own.setdefault(a.state(t), []).append(k)
        self.phrases: list[list[int]] = [[] for _ in a.next]
        for s in sorted(range(1, len(a.next)), key=a.length.__getitem__):
            self.phrases[s] = own.get(s, []) + self.phrases[a.link[s]]
        self.shortest = min([least_match, *self.sizes])

    def scan(self, parts: Iterable[list[bytes]]) -> Found:
        """Streams the lists of words that make up a text."""
        found, stream = Found(), Stream(self)
        for words in parts:
            known = np.array(list(map(self.number.get, words, [-1] * len(words))), np.int64)
            at = np.flatnonzero(known >= 0)
            # a run of one word goes through only if it is at the edge of a part or long enough by itself
            if len(at) and self.shortest > 1:
                beside = np.zeros(len(known) + 2, bool)
                beside[1:-1] = known >= 0
                keep = beside[:-2] | beside[2:]
                keep[[0, -1]] = True
                at = at[keep[at]]
            stream.feed(found, at + found.n_words, known[at])
            found.n_words += len(words)
        stream.close(found)
        return found


class Stream:
    """Matching statistics of the words so far, and the chains that may still grow."""

    def __init__(self, scanner: Scanner):
        self.scanner, self.state, self.size, self.at = scanner, 0, 0, -1
        self.open: dict[int, list[Chain]] = {}

    def feed(self, found: Found, places: np.ndarray, words: np.ndarray) -> None:
        a, phrases, sizes = self.scanner.automaton, self.scanner.phrases, self.scanner.sizes
        follow, link, length = a.next, a.link, a.length
        state, size, last = self.state, self.size, self.at
        for at, w in zip(places.tolist(), words.tolist()):
            if at != last + 1:
                self._match(found, state, size, last + 1)
                state = size = 0
            elif w not in follow[state]:
                self._match(found, state, size, at)
                while state and w not in follow[state]:
                    state = link[state]
                    size = length[state]
            if w in follow[state]:
                state, size = follow[state][w], size + 1
            last = at
            for k in phrases[state]:
                if sizes[k] <= size:
                    found.places.append((at + 1 - sizes[k], k))
        self.state, self.size, self.at = state, size, last

    def _match(self, found: Found, state: int, size: int, end: int) -> None:
        """A run of ``size`` words that ends before word ``end`` of the text and can't be extended."""
        s = self.scanner
        if size < s.shortest:
            return
        for template, until in s.automaton.ends[state]:
            if size >= min(s.least, s.sizes[template]):
                self._chain(found, template, end - size, end, until)

    def _chain(self, found: Found, template: int, start: int, end: int, until: int) -> None:
        gap, best = self.scanner.gap, None
        held = self.open.setdefault(template, [])
        keep = []
        for c in held:
            if c.end + gap < start:
                self._done(found, c)
                continue
            keep.append(c)
            from_ = until - (end - start)
            # the part of the match that lies behind the chain in both, text and template
            cut = max(c.end - start, c.until - from_, 0)
            if cut < end - start and from_ + cut - c.until <= gap and (best is None or c.covered - cut > best[0]):
                best = (c.covered - cut, cut, c)
        if best is not None:
            _, cut, c = best
            keep.remove(c)
            keep.append(Chain(template, c.start, end, until, c.covered + end - start - cut))
        else:
            keep.append(Chain(template, start, end, until, end - start))
        self.open[template] = keep

    def _done(self, found: Found, c: Chain) -> None:
        if c.covered >= self.scanner.share * self.scanner.sizes[c.template]:
            found.chains.append(c)

    def close(self, found: Found) -> None:
        self._match(found, self.state, self.size, self.at + 1)
        for held in self.open.values():
            for c in held:
                self._done(found, c)


_SPANS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]))
_PLACES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_BUILT: dict[tuple, Scanner] = {}


def scan_licenses(
    docs: DataFrame, text: str = "text", phrases: dict[str, str] | None = None, notices: list[tuple[str, str]] | None = None,
    least_match: int = LEAST_MATCH, least_share: float = LEAST_SHARE, gap: int = GAP,
) -> DataFrame:
    """``docs`` packed as ``doc`` (see ``common.annotate``), with ``n_words``, ``places`` (label, start and end
    word of every place of a phrase, overlapping ones too, by start) and ``spans`` (label, start and end word and
    covered share of every chain, by start).

    Words are runs of digits, a-z (A-Z lower-cased) and non-ASCII characters. ``phrases`` maps phrases to labels,
    ``notices`` are (label, text); both are templates. A match has ``least_match`` words, or all of a shorter
    template; a chain covers ``least_share`` of its template, with at most ``gap`` other words between matches. Each match
    joins the chain that it leaves best covered. A run that stands in several templates counts for each of them; what stands
    only inside a longer run counts with that run's templates.

    Null or empty text: no words, places or spans. Every row is returned; repeated rows give equal results. The time
    follows the text's length, whatever it holds; texts are read in parts, matches don't end at the borders. Templates
    without words, or of more than ``MAX_WORDS`` words in all, are an error.
    """
    phrases = PHRASES if phrases is None else phrases
    notices = NOTICES if notices is None else notices
    key = (tuple(phrases.items()), tuple(notices), least_match, least_share, gap)
    Scanner(phrases, notices, least_match, least_share, gap)  # here too: wrong templates fail before a job runs

    def compute(texts: list[bytes | None]) -> list[pa.Array]:
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = Scanner(dict(key[0]), list(key[1]), *key[2:])
        s = _BUILT[key]
        size, places, spans = [], [], []
        for t in texts:
            found = s.scan(part.split() for part in word_parts(t))
            size.append(found.n_words)
            places.append([{"label": s.labels[k], "start": at, "end": at + s.sizes[k]} for at, k in sorted(found.places)])
            spans.append(sorted(
                ({"label": s.labels[c.template], "start": c.start, "end": c.end, "share": c.covered / s.sizes[c.template]} for c in found.chains),
                key=lambda x: (x["start"], x["end"], x["label"]),
            ))
        return [pa.array(size, pa.int64()), pa.array(places, _PLACES), pa.array(spans, _SPANS)]

    fields = (
        "n_words long, places array<struct<label:string,start:bigint,end:bigint>>, "
        "spans array<struct<label:string,start:bigint,end:bigint,share:double>>"
    )
    return annotate(docs, text, fields, compute)
