"""Repair of conversation structure by the cheapest edits, streamed over sorted turns.

Rows are dealt by conversation and sorted by turn. The first pass walks every conversation from its
last turn to its first and carries the least cost to the end from each state of the wanted role
pattern; per row it leaves one byte, the best edit from each of the four states. The bytes are
written to the shared folder in pieces, so neither pass holds a conversation, however long it is.
The second pass walks forward, reads the bytes beside the texts and carries only its state.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.llm.storage import stored

BLANKS = " \t\n\x0b\x0c\r"
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3  # what an edit costs; the last is added to truncated rows that stay
EDITS = "DIKR"
PIECE = 1 << 16  # rows whose bytes travel in one piece

# States of (s?(ua)+)?: nothing yet, after s, after u, after a pair. Where u, a and s lead; -1 is nowhere.
_NEXT = ((2, -1, 1), (2, -1, -1), (-1, 3, -1), (2, -1, -1))
_WANTED = tuple(max(row[0], row[1]) for row in _NEXT)  # where an inserted or renamed row leads
_NAMES = {2: "user", 3: "assistant"}
_AT_END = (0, 2 * INSERT, INSERT, 0)  # least cost to the end when no row is left
_LEGAL = {(2, 0), (0, 1), (1, 0)}  # su, ua, au
_FINE, _CUT_OFF, _BLANK, _REPEATED = range(4)

ORDER = ["has_turn", "t", "role", "mark"]
_KEY = "has_id boolean, conv long, has_turn boolean, t long, role string, mark long"
_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_PIECES = f"{_KEY}, piece long, back binary, {_COUNTS}"
MESSAGES = f"conv_id long, seq long, edit string, role string, text string, {_COUNTS}"


def _keyed(turns: DataFrame) -> DataFrame:
    """Columns without nulls: pandas would turn ids with nulls into floats."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return turns.select(
        F.col("conv_id").isNotNull().alias("has_id"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("turn").isNotNull().alias("has_turn"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("t"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.xxhash64(text, F.length(text)).alias("mark"),
        text.alias("text"),
    )


def _kinds(rows: DataFrame) -> DataFrame:
    """Role class and first fault of every row; a repetition inside one turn is left to the walk."""
    end = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "u", 0).when(initial == "a", 1).when(initial == "s", 2).otherwise(3)
    fault = F.when(end == "", _BLANK).when(end.isin(".", "!", "?"), _FINE).otherwise(_CUT_OFF)
    group = ["has_id", "conv", "role", "mark"]
    marked = rows.select("has_id", "conv", *ORDER, kind.alias("kind"), fault.alias("fault"))
    again = (
        marked.groupBy(*group)
        .agg(F.min(F.struct("has_turn", "t")).alias("first"), F.max(F.struct("has_turn", "t")).alias("last"))
        .where(F.col("first") < F.col("last"))
        .select(*group, "first")
    )
    later = F.coalesce(F.struct("has_turn", "t") > F.col("first"), F.lit(False)) & (F.col("fault") != _BLANK)
    return marked.join(again, group, "left").withColumn("fault", F.when(later, _REPEATED).otherwise(F.col("fault"))).drop("first")


def _backward(costs: tuple[int, ...], kind: int, fault: int) -> tuple[tuple[int, ...], int]:
    """Least costs to the end before a row, and the row's byte: two bits for each state's best edit.

    Of equally cheap edits the one with the least letter wins; every edit leads to one state, so
    this makes the whole audit ASCII-least.
    """
    options = []
    extra = TRUNCATED if fault == _CUT_OFF else 0
    for state in range(4):
        found = {0: DELETE + costs[state]}
        if fault < _BLANK:
            to = _NEXT[state][kind] if kind < 3 else -1
            if to >= 0:
                found[2] = extra + costs[to]
            found[3] = REROLE + extra + costs[_WANTED[state]]
        options.append(found)
    least = [min(found.values()) for found in options]
    for _ in range(3):  # an insertion leads on at most three times
        least = [min(c, INSERT + least[_WANTED[q]]) for q, c in enumerate(least)]
    byte = 0
    for state, found in enumerate(options):
        found[1] = INSERT + least[_WANTED[state]]
        byte |= min(edit for edit, cost in found.items() if cost == least[state]) << (2 * state)
    return tuple(least), byte


class _Costs:
    """The backward walk of one conversation; steps are remembered by relative costs."""

    known: dict[tuple, tuple[tuple[int, ...], int, int]] = {}

    def __init__(self) -> None:
        self.relative, self.base = _AT_END, 0
        self.counts = [0, 0, 0]  # truncated, blank, duplicate
        self.illegal = self.turns = 0
        self.high = self.low = self.after = None
        self.back, self.piece = bytearray(), 0

    def row(self, kind: int, fault: int, turn: int | None) -> None:
        step = (self.relative, kind, fault)
        if step not in self.known:
            least, byte = _backward(*step)
            self.known[step] = (tuple(c - min(least) for c in least), min(least), byte)
        self.relative, added, byte = self.known[step]
        self.base += added
        self.back.append(byte)
        if fault:
            self.counts[fault - 1] += 1
        if self.after is not None and (kind, self.after) not in _LEGAL:
            self.illegal += 1
        self.after = kind
        if turn is not None:
            self.high = turn if self.high is None else self.high
            self.turns += turn != self.low
            self.low = turn

    def piece_of(self, key: tuple, last: bool) -> tuple:
        back, self.back = bytes(reversed(self.back)), bytearray()
        self.piece += 1
        counts: tuple = (None,) * 6
        if last:
            gaps = 0 if self.high is None else self.high - self.low + 1 - self.turns
            truncated, blank, duplicate = self.counts
            counts = (gaps, blank, duplicate, truncated, self.illegal, self.base + self.relative[0])
        return (*key, self.piece, back, *counts)


def _typed(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]
    frame = pd.DataFrame(rows, columns=names)
    for part in schema.split(", "):
        name, kind = part.split()
        if kind == "long":
            frame[name] = frame[name].astype("Int64")
    return frame


def _leave_bytes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces of bytes of every conversation; rows come from the last turn to the first."""
    walk, waiting, out = _Costs(), None, []
    for frame in frames:
        columns = ["has_id", "conv", *ORDER, "kind", "fault"]
        for row in zip(*(frame[c].tolist() for c in columns)):
            if waiting is not None:
                walk, piece = _take(walk, waiting, row)
                if piece:
                    out.append(piece)
            waiting = row
        if out:
            yield _typed(out, _PIECES)
            out = []
    if waiting is not None:
        yield _typed([_take(walk, waiting, None)[1]], _PIECES)


def _take(walk: _Costs, row: tuple, earlier: tuple | None) -> tuple[_Costs, tuple | None]:
    """Walk over one row; ``earlier`` is the row before it in the order of turns."""
    *key, kind, fault = row
    if fault < _BLANK and earlier is not None and list(earlier[:6]) == key:
        fault = _REPEATED
    walk.row(kind, fault, key[3] if key[2] else None)
    last = earlier is None or earlier[:2] != row[:2]
    if last or len(walk.back) >= PIECE:
        piece = walk.piece_of(tuple(key), last)
        return (_Costs() if last else walk), piece
    return walk, None


class _Edits:
    """The forward walk of one conversation: rows wait only while bytes of equal keys come first."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.state, self.seq = conv, 0, 0
        self.bytes: deque[int] = deque()

    def message(self, edit: str | None, role: str | None, text: str | None, counts: tuple = (None,) * 6) -> tuple:
        found = (self.conv, self.seq, edit, role, text, *counts)
        self.seq += 1
        return found

    def insert(self) -> tuple:
        self.state = _WANTED[self.state]
        return self.message("I", _NAMES[self.state], "")

    def row(self, kind: int, role: str, text: str) -> Iterator[tuple]:
        byte = self.bytes.popleft()
        while (edit := byte >> (2 * self.state) & 3) == 1:
            yield self.insert()
        if edit == 2:
            self.state = _NEXT[self.state][kind]
        elif edit == 3:
            self.state = _WANTED[self.state]
            role = _NAMES[self.state]
        yield self.message(EDITS[edit], role, text)

    def end(self) -> Iterator[tuple]:
        while self.state in (1, 2):
            yield self.insert()


def _apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Headers and edited rows of every conversation, in order."""
    walk: _Edits | None = None
    current = None
    headed = False
    counts = [part.split()[0] for part in _COUNTS.split(", ")]
    for frame in frames:
        out: list[tuple] = []
        columns = ["has_id", "conv", "flag", "role", "text", "back", "piece", *counts]
        for has_id, conv, flag, role, text, back, piece, *found in zip(*(frame[c].tolist() for c in columns)):
            if (has_id, conv) != current:
                if walk is not None:
                    out += [] if headed else [walk.message(None, None, None, (0,) * 6)]
                    out += walk.end()
                walk, current, headed = _Edits(conv if has_id else None), (has_id, conv), False
            if flag == 1:
                walk.bytes.extend(back)
                if not headed:
                    out.append(walk.message(None, None, None, tuple(int(x) for x in found)))
                    headed = True
            elif flag == 2:
                out += walk.row("uas".find(role[:1]) if role else 3, role, text)
        if out:
            yield _typed(out, MESSAGES)
    if walk is not None:
        out = [] if headed else [walk.message(None, None, None, (0,) * 6)]
        yield _typed([*out, *walk.end()], MESSAGES)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def repair(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Edits that give every conversation's role initials the pattern ``(s?(ua)+)?`` at the least cost.

    ``turns`` needs ``conv_id``, ``turn``, ``role`` and ``text``; a conversation's rows count in order
    of turn (nulls first), then role, then a hash of the text. A null role or text is one space; a null
    ``conv_id`` is a conversation of its own; other columns are not read. A row's first fault counts:
    blank (nothing but blanks), duplicate (role and text seen earlier in the conversation), truncated
    (the last sign is not ``. ! ?``). Keeping costs 0, a new role 3, deleting 4 and an inserted empty
    row 3; blank and duplicate rows must go, truncated ones that stay cost 3 more. Of equally cheap
    edits the ASCII-least string of their initials wins.

    Returns, in the order of each conversation within its partition: a header (``seq`` 0, no
    ``edit``) with the counts ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal`` (adjacent
    initials other than su, ua, au) and ``cost``, then one row per edit with ``edit`` (D, I, K or R),
    ``role`` and ``text``; deleted rows show what went. A conversation of ``ids`` (``conv_id``) without
    rows has a header of zeros; an empty table gives no rows.
    """
    rows = _keyed(turns)
    walk = ["has_id", "conv"]
    backward = _kinds(rows).repartition(*walk).sortWithinPartitions(*walk, *[F.desc(c) for c in ORDER])
    pieces = stored(backward.mapInPandas(_leave_bytes, _PIECES), "dialogue")
    parts = [pieces.withColumn("flag", F.lit(1)), rows.withColumn("flag", F.lit(2))]
    if ids is not None:
        heads = ids.select(F.col("conv_id").cast("long").alias("c")).distinct()
        parts.append(
            heads.select(
                F.col("c").isNotNull().alias("has_id"), F.coalesce("c", F.lit(0)).alias("conv"), F.lit(False).alias("has_turn"),
                F.lit(-(1 << 63)).cast("long").alias("t"), F.lit("").alias("role"), F.lit(-(1 << 63)).cast("long").alias("mark"), F.lit(0).alias("flag"),
            )
        )
    forward = _union(parts).repartition(*walk).sortWithinPartitions(*walk, *ORDER, "flag", F.desc("piece"))
    return forward.mapInPandas(_apply, MESSAGES)


def _fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    schema = f"conv_id long, {_COUNTS}, audit string, repaired_sha256 string"
    head = None
    letters: list[str] = []
    digest, apart = sha256(), b""
    for frame in frames:
        out = []
        names = ["conv_id", "seq", "edit", "role", "text", *[part.split()[0] for part in _COUNTS.split(", ")]]
        for conv, seq, edit, role, text, *counts in zip(*(frame[c].astype(object).where(frame[c].notna(), None).tolist() for c in names)):
            if seq == 0:
                if head is not None:
                    out.append((*head, "".join(letters), digest.hexdigest()))
                head, letters, digest, apart = (conv, *counts), [], sha256(), b""
                continue
            letters.append(edit)
            if edit != "D":
                digest.update(apart + f"{role}:{text}".encode())
                apart = b"\n"
        if out:
            yield _typed(out, schema)
    if head is not None:
        yield _typed([(*head, "".join(letters), digest.hexdigest())], schema)


def digests(messages: DataFrame) -> DataFrame:
    """One row per conversation of :func:`repair`: its counts, the initials of its edits and the SHA-256 of what is left.

    ``messages`` must come straight from :func:`repair`, whose partitions hold whole conversations in
    order. The digest is taken as rows pass by; only the audit, one letter per edit, is kept.
    """
    return messages.mapInPandas(_fold, f"conv_id long, {_COUNTS}, audit string, repaired_sha256 string")


def spaced(column: str) -> Column:
    """The column as text, null as one space."""
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """Faults planted by ``crc32(conv_id:turn) % 20``: dropped, emptied, cut off, repeated and renamed rows.

    0 drops the row, 1 empties its text, 2 removes its ``. ! ?``, 3 repeats it, 4 sets the role to
    user. A null becomes one space, except in ``conv_id`` and ``turn``, which keep theirs.
    """
    lot = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % 20
    text = F.when(lot == 1, F.lit("")).when(lot == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    times = F.when(lot == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.where(lot != 0).select(
        "conv_id", "turn", F.when(lot == 4, F.lit("user")).otherwise(spaced("role")).alias("role"), text.alias("text"), F.explode(times).alias("_copy")
    ).drop("_copy")
