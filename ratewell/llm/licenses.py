"""License scan by template markup: optional and replaceable regions compiled into one token automaton.

The automaton's places are the template words; a place knows which places may follow it. Optional
regions can be stepped over, replaceable ones become places for any word or for the listed wordings.
A text is read once, only from words that can begin a template, and only by the places that are alive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ratewell.llm import kernels
from ratewell.llm.license_texts import PHRASES, TEMPLATES

ANY = -1
_TAG = re.compile(r"<<(.*?)>>", re.S)
_SIGNS = np.full(256, 0x20, np.uint8)  # a byte's sign in words; everything else parts them
_SIGNS[0x80:] = np.arange(0x80, 0x100)
for _first, _low, _many in ((0x30, 0x30, 10), (0x61, 0x61, 26), (0x41, 0x61, 26)):
    _SIGNS[_first : _first + _many] = np.arange(_low, _low + _many)

_SPAN = pa.struct([("label", pa.string()), ("how", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
FOUND = "doc_id bigint, n_words bigint, n_covered bigint, spans array<struct<label:string,how:string,start:bigint,end:bigint>>"


def words_of(data: np.ndarray, offsets: np.ndarray) -> kernels.Words:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of every row after A-Z are lower-cased."""
    return kernels.words(_SIGNS[data], offsets, lower=False)


def _hashes(words: Sequence[str]) -> np.ndarray:
    data, offsets = kernels.flat(pa.array([" ".join(words)]))
    return words_of(data, offsets).hashes


def _split(text: str) -> list[str]:
    data, offsets = kernels.flat(pa.array([text]))
    low, found = _SIGNS[data], words_of(data, offsets)
    return [low[a:b].tobytes().decode() for a, b in zip(found.starts, found.ends)]


@dataclass
class Automaton:
    """Places of all templates: the word each wants, those that may follow, and where templates begin and end."""

    words: dict[str, int] = field(default_factory=dict)
    wants: list[int] = field(default_factory=list)
    follow: list[set[int]] = field(default_factory=list)
    begins: dict[int, list[int]] = field(default_factory=dict)
    ends: dict[int, int] = field(default_factory=dict)
    labels: list[str] = field(default_factory=list)

    def word(self, text: str) -> int:
        return self.words.setdefault(text, len(self.words) + 1)

    def _place(self, wants: int) -> int:
        self.wants.append(wants)
        self.follow.append(set())
        return len(self.wants) - 1

    def _chain(self, parts: list[tuple[set[int], set[int], bool]]) -> tuple[set[int], set[int], bool]:
        """Parts one after the other; each part is its first places, its last places and whether it may be empty."""
        first: set[int] = set()
        last: set[int] = set()
        empty = True
        for begin, end, skips in parts:
            for place in last:
                self.follow[place] |= begin
            first |= begin if empty else set()
            last = last | end if skips else set(end)
            empty &= skips
        return first, last, empty

    def _wording(self, text: str) -> list[tuple[set[int], set[int], bool]]:
        places = [self._place(self.word(w)) for w in _split(text)]
        return [({p}, {p}, False) for p in places]

    def _region(self, tag: str) -> tuple[set[int], set[int], bool]:
        """A replaceable region: ``words=a-b`` or ``match=one|other wording``."""
        key, _, value = tag.split(";")[-1].partition("=")
        if key == "words":
            low, high = map(int, value.split("-"))
            parts = [({p}, {p}, k >= low) for k, p in enumerate(self._place(ANY) for _ in range(high))]
            return self._chain(parts)
        if key != "match":
            raise ValueError(f"unknown region: {tag}")
        ways = [self._chain(self._wording(way)) for way in value.split("|")]
        return set().union(*(w[0] for w in ways)), set().union(*(w[1] for w in ways)), any(w[2] for w in ways)

    def add(self, label: str, markup: str) -> None:
        """Compile one template; it must begin and cannot be passed over without a mandatory word."""
        stack: list[list[tuple[set[int], set[int], bool]]] = [[]]
        for k, part in enumerate(_TAG.split(markup)):
            if k % 2 == 0:
                stack[-1] += self._wording(part)
            elif part == "beginOptional":
                stack.append([])
            elif part == "endOptional":
                begin, end, _ = self._chain(stack.pop())
                stack[-1].append((begin, end, True))
            else:
                stack[-1].append(self._region(part))
        if len(stack) != 1:
            raise ValueError("an optional region is not closed")
        first, last, empty = self._chain(stack[0])
        if empty or any(self.wants[p] == ANY for p in first):
            raise ValueError("a template must begin with wording")
        self.labels.append(label)
        for place in first:
            self.begins.setdefault(self.wants[place], []).append(place)
        self.ends.update(dict.fromkeys(last, len(self.labels) - 1))

    def accept(self, ids: np.ndarray, starts: list[int]) -> list[tuple[str, int, int]]:
        """Accepted wordings ``(label, start, end)`` in one text, per label leftmost, longest and without overlap.

        ``ids`` are word numbers, 0 for a word of no template; ``starts`` the places where a template can begin.
        """
        alive: dict[int, int] = {}
        best: dict[tuple[int, int], int] = {}
        coming, at, n = 0, 0, len(ids)
        while True:
            if not alive:
                while coming < len(starts) and starts[coming] < at:
                    coming += 1
                if coming == len(starts):
                    break
                at = starts[coming]
            if at >= n:
                break
            word, reached = int(ids[at]), {}
            for place, start in alive.items():
                for to in self.follow[place]:
                    if self.wants[to] in (word, ANY) and start < reached.get(to, n):
                        reached[to] = start
            for to in self.begins.get(word, ()):
                reached.setdefault(to, at)
            at += 1
            for place, start in reached.items():
                if place in self.ends:
                    best[self.ends[place], start] = at
            alive = reached
        found: list[tuple[str, int, int]] = []
        free: dict[str, int] = {}
        for start, end, label in sorted(((s, e, self.labels[t]) for (t, s), e in best.items()), key=lambda x: (x[0], -x[1], x[2])):
            if start >= free.get(label, 0):
                found.append((label, start, end))
                free[label] = end
        return found


def compiled(templates: Sequence[tuple[str, str]]) -> Automaton:
    machine = Automaton()
    for label, markup in templates:
        machine.add(label, markup)
    return machine


def scan_licenses(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES
) -> DataFrame:
    """License phrases and accepted template wordings of every text.

    Returns ``doc_id``, ``n_words``, ``n_covered`` (words inside any span) and ``spans``, an array of
    (label, how, start, end) by start, end, label; ``how`` is ``phrase`` or ``template`` and places are
    word numbers from 0, end exclusive. A template is accepted where its mandatory wording stands word
    by word, with anything its regions allow between. Phrases are reported at all their places; a
    template once per stretch of text. A null or empty text has no words and no spans. Every row is
    read by itself, whole, whatever its ``doc_id``; other columns are not read. The templates go to the
    tasks, their size doesn't depend on the data.
    """
    machine = compiled(templates)
    wordings = [(label, [machine.word(w) for w in _split(text)]) for label, text in phrases]
    hashes = _hashes(list(machine.words))
    order = np.argsort(hashes)
    ranked, numbers = hashes[order], np.arange(1, len(hashes) + 1, dtype=np.int32)[order]
    begins = np.zeros(len(hashes) + 1, bool)
    begins[list(machine.begins)] = True

    def found_in(texts: pa.Array) -> tuple[np.ndarray, dict[int, list[dict]]]:
        data, offsets = kernels.flat(texts)
        table = words_of(data, offsets)
        at = np.minimum(np.searchsorted(ranked, table.hashes), len(ranked) - 1)
        ids = np.where(ranked[at] == table.hashes, numbers[at], 0)
        spans: dict[int, list[dict]] = {}

        def add(row: int, label: str, how: str, start: int, end: int) -> None:
            low = int(table.rows[row])
            spans.setdefault(row, []).append({"label": label, "how": how, "start": start - low, "end": end - low})

        for label, wanted in wordings:
            size = len(wanted)
            places = np.flatnonzero(ids[: len(ids) - size + 1] == wanted[0]) if len(ids) >= size else np.zeros(0, np.int64)
            for k, word in enumerate(wanted[1:], 1):
                places = places[ids[places + k] == word]
            rows = np.searchsorted(table.rows, places, side="right") - 1
            inside = places + size <= table.rows[rows + 1]
            for row, place in zip(rows[inside].tolist(), places[inside].tolist()):
                add(row, label, "phrase", place, place + size)
        starts = np.flatnonzero(begins[ids])
        where = np.searchsorted(starts, table.rows)
        for row in np.flatnonzero(np.diff(where)).tolist():
            low, high = int(table.rows[row]), int(table.rows[row + 1])
            mine = (starts[where[row] : where[row + 1]] - low).tolist()
            for label, start, end in machine.accept(ids[low:high], mine):
                add(row, label, "template", low + start, low + end)
        return np.diff(table.rows), spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans = found_in(batch["text"])
            listed, covered = [], np.zeros(len(counts), np.int64)
            for row in range(len(counts)):
                mine = sorted(spans.get(row, ()), key=lambda s: (s["start"], s["end"], s["label"], s["how"]))
                listed.append(mine)
                upto = 0
                for span in mine:
                    covered[row] += max(0, span["end"] - max(upto, span["start"]))
                    upto = max(upto, span["end"])
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "n_words": pa.array(counts.astype(np.int64)),
                    "n_covered": pa.array(covered),
                    "spans": pa.array(listed, pa.list_(_SPAN)),
                }
            )

    columns = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return columns.mapInArrow(run, FOUND)
