"""Conversation structure repair by secondary-sorted streaming.

Turns are dealt by conversation and sorted by turn inside each task, so a conversation
arrives as a run of rows over as many Arrow batches as it takes.  ``mapInPandas`` carries
its state from batch to batch: faults, gaps, and the cheapest costs of bringing the roles
read so far into each state of the grammar ``(system? (user assistant)+)?``.

Edits: keep a turn (0), rerole it to user or assistant (2), delete it (3; the only edit of a
blank or repeated turn), insert an empty turn of the user or assistant (2); an undeleted
truncated turn costs 1 more.  The audit is the edits' initials; of several cheapest ones
the least as ASCII.

Costs differ by a few units between the grammar's states (a state behind by more can no
longer be cheapest), so the dynamic programme over a turn is one of some hundred known
transitions.  A turn's backpointer is the number of its transition, two bytes whatever
the text.  At the end of a conversation one pass from its last turn to its first replaces
each by the number of the edits that start a cheapest way on, and one pass from the
first turn on reads the audit and hashes the repaired text.  Backpointers and turns stay
in memory up to ``SPILL`` bytes each and go to an unnamed file of the task beyond it, as
a sort's spill does, so a conversation of any length needs bounded memory but for the
digests of its turns (16 bytes each, to know repeated ones) and its audit, one value of
the result.  A conversation is one run by this method, so the task that has the
longest one reads all of it.

Results for odd input: nulls count as one space (a null turn sorts first; a null
conversation is a conversation); turns of the same number are ordered by role and text;
a repeated row is a duplicate; roles other than system, user and assistant go by their
first character, and one that the grammar does not have is never kept; an empty table
gives an empty result; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tontine.llm.batches import small_batches

#: Bytes of turns, and of backpointers, that a conversation keeps in memory.
SPILL = 4 << 20
#: Backpointers of one block.
BLOCK = 1 << 15
SPACE, END_MARKS = " \t\n\v\f\r", ".!?"
LEGAL = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

# States of the grammar: nothing yet, after system, after user, after assistant.
STATES, ENDS = range(4), (0, 3)
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The state that a user's or assistant's turn leads to; which of them it is follows from the state.
MADE = {0: 2, 1: 2, 2: 3, 3: 2}
ROLE_OF = {2: "user", 3: "assistant"}
FAR = 1 << 30
#: A state that costs this much more than the cheapest is on no cheapest way: from after the assistant's
#: turn, which costs at most 4 more than the cheapest, deleting one system turn (3) does as well.
BEHIND = 8
FINE, CUT, GONE = 0, 1, 2                                  # faults, as they bear on the edits


def _with_inserts(costs: tuple[int, ...]) -> tuple[int, ...]:
    out = list(costs)
    for _ in STATES:
        for q in STATES:
            out[MADE[q]] = min(out[MADE[q]], out[q] + INSERT)
    return tuple(min(c, FAR) for c in out)


def _insertions(costs: tuple[int, ...]) -> tuple[tuple[int, int], ...]:
    """Insertions on cheapest ways between the states of one place."""
    return tuple((q, MADE[q]) for q in STATES if costs[q] < FAR and costs[q] + INSERT == costs[MADE[q]])


START = _with_inserts((0, FAR, FAR, FAR))


class _Tables:
    """Known transitions of the costs, and known steps of the way back."""

    def __init__(self) -> None:
        self.moves: list[tuple] = []                       # (insertions before the turn, edits of the turn)
        self.number: dict[tuple, int] = {}
        self.ways: list[tuple] = []                        # per state: (edits, state after)
        self.way_number: dict[tuple, int] = {}
        self.next: dict[tuple, tuple[tuple[int, ...], int, int]] = {}
        self.back: dict[tuple, tuple[int, int]] = {}

    def forward(self, costs: tuple[int, ...], initial: str, fault: int) -> tuple[tuple[int, ...], int, int]:
        """Costs after a turn, less the cheapest, which is given beside, and the transition's number."""
        key = (costs, initial, fault)
        if key not in self.next:
            extra = TRUNCATED if fault == CUT else 0
            edits = []
            for q in STATES:
                if costs[q] >= FAR:
                    continue
                edits.append((q, "D", q, costs[q] + DELETE))
                if fault != GONE:
                    edits.append((q, "R", MADE[q], costs[q] + REROLE + extra))
                    if (q, initial) in AFTER:
                        edits.append((q, "K", AFTER[q, initial], costs[q] + KEEP + extra))
            reached = [FAR] * len(STATES)
            for _, _, to, cost in edits:
                reached[to] = min(reached[to], cost)
            reached = _with_inserts(tuple(reached))
            tight = tuple((q, letter, to) for q, letter, to, cost in edits if cost == reached[to])
            move = (_insertions(costs), tight)
            if move not in self.number:
                self.number[move] = len(self.moves)
                self.moves.append(move)
            least = min(reached)
            ahead = tuple(c - least if c - least <= BEHIND else FAR for c in reached)
            self.next[key] = (ahead, least, self.number[move])
        return self.next[key]

    def backward(self, useful: int, move: int) -> tuple[int, int]:
        """States before a turn that are on a cheapest way, given those after it, and the number of the
        edits by which a cheapest way goes on from each."""
        key = (useful, move)
        if key not in self.back:
            insertions, edits = self.moves[move]
            choice: dict[int, tuple[str, int]] = {}
            for q, letter, to in edits:
                if useful >> to & 1:
                    choice[q] = min(choice.get(q, ("Z", 0)), (letter, to))
            way = self._with_insertions(insertions, choice)
            if way not in self.way_number:
                self.way_number[way] = len(self.ways)
                self.ways.append(way)
            self.back[key] = (sum(1 << q for q in STATES if way[q]), self.way_number[way])
        return self.back[key]

    @staticmethod
    def _with_insertions(insertions: tuple[tuple[int, int], ...], choice: dict[int, tuple[str, int]]) -> tuple:
        """Edits of each state up to the turn's own, or None where no cheapest way goes on: an insertion
        where it leads to one, unless deleting is as cheap."""
        way: dict[int, tuple[str, int] | None] = dict.fromkeys(STATES)
        for _ in STATES:
            for q in STATES:
                best = choice.get(q)
                for a, b in insertions:
                    if a == q and way[b] and (best is None or best[0] > "I"):
                        best = ("I" + way[b][0], way[b][1])
                way[q] = best
        return tuple(way[q] for q in STATES)

    def end(self, costs: tuple[int, ...]) -> tuple[int, int, tuple]:
        """Cost of ending, the states useful after the last turn, and the insertions that end from each."""
        least = min(costs[q] for q in ENDS)
        way = self._with_insertions(_insertions(costs), {q: ("", q) for q in ENDS if costs[q] == least})
        return least, sum(1 << q for q in STATES if way[q]), way


@lru_cache(maxsize=1)
def _tables() -> _Tables:
    return _Tables()


class _Seen:
    """Digests of the turns so far, 16 bytes each: a small set, and sorted runs of doubling length."""

    def __init__(self) -> None:
        self.recent: set[bytes] = set()
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, digest: bytes) -> bool:
        """Whether the digest is new."""
        if digest in self.recent or self._held(digest):
            return False
        self.recent.add(digest)
        if len(self.recent) >= 1 << 16:
            pairs = np.frombuffer(b"".join(self.recent), "<u8").reshape(-1, 2)
            hi, lo = pairs[:, 0], pairs[:, 1]
            self.recent = set()
            while self.runs and len(self.runs[-1][0]) <= len(hi):
                other = self.runs.pop()
                hi, lo = np.concatenate([other[0], hi]), np.concatenate([other[1], lo])
            order = np.argsort(hi, kind="stable")
            self.runs.append((hi[order], lo[order]))
        return True

    def _held(self, digest: bytes) -> bool:
        if not self.runs:
            return False
        a, b = np.frombuffer(digest, "<u8")
        for hi, lo in self.runs:
            k = int(np.searchsorted(hi, a))
            while k < len(hi) and hi[k] == a:
                if lo[k] == b:
                    return True
                k += 1
        return False


class _Conversation:
    def __init__(self, key: tuple) -> None:
        self.key = key
        self.tables = _tables()
        self.blank = self.duplicate = self.truncated = self.illegal = self.rows = 0
        self.first = self.last = None
        self.distinct = 0
        self.initial: str | None = None
        self.seen = _Seen()
        self.costs, self.cost = START, 0
        self.moves = array("H")
        self.move_file = None
        self.turns: list[tuple[int | None, str, str]] = []
        self.turn_bytes = 0
        self.turn_file = None

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            if self.first is None:
                self.first = turn
            if turn != self.last:
                self.distinct += 1
            self.last = turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        name = role.encode("utf-8", "surrogatepass")
        new = self.seen.add(hashlib.blake2b(b"%d:" % len(name) + name + text.encode("utf-8", "surrogatepass"), digest_size=16).digest())
        body = text.rstrip(SPACE)
        if not body:
            fault, self.blank = GONE, self.blank + 1
        elif not new:
            fault, self.duplicate = GONE, self.duplicate + 1
        elif body[-1] not in END_MARKS:
            fault, self.truncated = CUT, self.truncated + 1
        else:
            fault = FINE
        self.costs, least, move = self.tables.forward(self.costs, initial, fault)
        self.cost += least
        self._keep(move, turn, role, text)

    def _keep(self, move: int, turn: int | None, role: str, text: str) -> None:
        self.rows += 1
        self.moves.append(move)
        if len(self.moves) >= BLOCK:
            self.move_file = self.move_file or tempfile.SpooledTemporaryFile(max_size=SPILL)
            self.move_file.write(self.moves.tobytes())
            self.moves = array("H")
        self.turns.append((turn, role, text))
        self.turn_bytes += len(text) + 100
        if self.turn_bytes >= SPILL:
            self.turn_file = self.turn_file or tempfile.TemporaryFile()
            pickle.dump(self.turns, self.turn_file)
            self.turns, self.turn_bytes = [], 0

    def _way_back(self, useful: int) -> None:
        """Replace the backpointers, from the last turn's on, by the ways on."""
        def replaced(block: array) -> array:
            nonlocal useful
            for k in range(len(block) - 1, -1, -1):
                useful, block[k] = self.tables.backward(useful, block[k])
            return block
        replaced(self.moves)
        if self.move_file:
            size = BLOCK * self.moves.itemsize
            for at in range(self.move_file.tell() - size, -1, -size):
                self.move_file.seek(at)
                block = replaced(array("H", self.move_file.read(size)))
                self.move_file.seek(at)
                self.move_file.write(block.tobytes())

    def _ways(self) -> Iterator[int]:
        if self.move_file:
            self.move_file.seek(0)
            while block := self.move_file.read(BLOCK * self.moves.itemsize):
                yield from array("H", block)
        yield from self.moves

    def _all_turns(self) -> Iterator[tuple[int | None, str, str]]:
        if self.turn_file:
            end = self.turn_file.tell()
            self.turn_file.seek(0)
            while self.turn_file.tell() < end:
                yield from pickle.load(self.turn_file)
        yield from self.turns

    def edits(self) -> Iterator[tuple[str, int | None, str, str]]:
        """(edit's initial, turn, role, text) of the cheapest edits in order; call once."""
        cost, useful, ending = self.tables.end(self.costs)
        self.cost += cost
        self._way_back(useful)
        q = 0
        for (turn, role, text), way in zip(self._all_turns(), self._ways(), strict=True):
            letters, to = self.tables.ways[way][q]
            for _ in letters[:-1]:
                q = MADE[q]
                yield "I", None, ROLE_OF[q], ""
            yield letters[-1], turn, ROLE_OF[to] if letters[-1] == "R" else role, text
            q = to
        for _ in ending[q][0]:
            q = MADE[q]
            yield "I", None, ROLE_OF[q], ""

    def summary(self) -> tuple:
        audit, repaired, sha = [], False, hashlib.sha256()
        for letter, _, role, text in self.edits():
            audit.append(letter)
            if letter != "D":
                sha.update(f"{chr(10) if repaired else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                repaired = True
        gaps = self.last - self.first + 1 - self.distinct if self.first is not None else 0
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(audit), sha.hexdigest())


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
#: Rows of one output batch of messages.
ROWS_OUT = 2000


def _stream(messages: bool):
    """The task's function: one summary a conversation, or its messages with their edits."""
    summary = ["conv", "no_conv", *COUNTS, "audit", "repaired_sha256"]
    message = ["conv", "no_conv", "seq", "edit", "turn", "role", "text"]

    def results(conversation: _Conversation) -> Iterator[tuple]:
        no_conv, conv = conversation.key
        if not messages:
            yield (conv, no_conv, *conversation.summary())
        else:
            for seq, edit in enumerate(conversation.edits()):
                yield (conv, no_conv, seq, *edit)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=message if messages else summary)
        return out.astype({"turn": "Int64"}) if messages else out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, out = None, []
        for b in batches:
            columns = [b[c].tolist() for c in ("no_conv", "conv", "no_turn", "turn", "role", "text", "absent")]
            for no_conv, conv, no_turn, turn, role, text, absent in zip(*columns, strict=True):
                if now is None or now.key != (no_conv, conv):
                    if now is not None:
                        for row in results(now):
                            out.append(row)
                            if len(out) >= ROWS_OUT:
                                yield frame(out)
                                out = []
                    now = _Conversation((no_conv, conv))
                if not absent:
                    now.add(None if no_turn else turn, role, text)
        for row in results(now) if now is not None else ():
            out.append(row)
            if len(out) >= ROWS_OUT:
                yield frame(out)
                out = []
        if out:
            yield frame(out)
    return run


def _streamed(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, absent_col: str | None, messages: bool) -> DataFrame:
    small_batches(turns.sparkSession)
    of = turns.schema[conv_col].dataType
    conv, turn = F.col(conv_col), F.col(turn_col).cast("long")
    absent = F.coalesce(F.col(absent_col).cast("boolean"), F.lit(False)) if absent_col else F.lit(False)
    rows = turns.select(conv.isNull().alias("no_conv"), F.coalesce(conv, F.lit("0").cast(of)).alias("conv"),
                        turn.isNull().alias("no_turn"), F.coalesce(turn, F.lit(0)).alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"), absent.alias("absent"))
    keys = ["no_conv", "conv"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, F.col("no_turn").desc(), "turn", "role", "text")
    schema = [T.StructField("conv", of), T.StructField("no_conv", T.BooleanType())]
    if messages:
        schema += [T.StructField(n, t) for n, t in (("seq", T.LongType()), ("edit", T.StringType()), ("turn", T.LongType()),
                                                    ("role", T.StringType()), ("text", T.StringType()))]
    else:
        schema += [T.StructField(n, T.LongType()) for n in COUNTS]
        schema += [T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    out = dealt.mapInPandas(_stream(messages), T.StructType(schema))
    return out.select(F.when(~F.col("no_conv"), F.col("conv")).alias("conv_id"), *[f.name for f in schema[2:]])


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           absent_col: str | None = None) -> DataFrame:
    """One row a conversation: ``conv_id``, numbers of faults, ``cost``, ``audit`` and the repaired text's SHA-256.
    Rows with ``absent_col`` only name their conversation: they are no turns of it."""
    return _streamed(turns, conv_col, turn_col, role_col, text_col, absent_col, messages=False)


def repaired_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """One row an edit, in order of ``seq``: ``edit`` (K, R, D or I), the turn's number (null if inserted),
    its repaired role and its text; the rows that are not deleted are the repaired conversation."""
    return _streamed(turns, conv_col, turn_col, role_col, text_col, None, messages=True)


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns with planted faults, by crc32 of ``conv:turn`` modulo 20: 0 is lost (kept as ``absent``), 1 loses its
    text, 2 its end marks, 3 is there twice, 4 becomes the user's; nulls are one space."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", said(conv_col), said(turn_col)).cast("binary")) % 20
    text = (F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", r"[.!?]", "")).otherwise(F.col("text")))
    return (turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), said(role_col).alias("role"),
                         said(text_col).alias("text"), fault.alias("fault"))
            .select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                    (F.col("fault") == 0).alias("absent"),
                    F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy"))
