"""Repair of conversations whose turns are out of shape, by the cheapest list of edits.

A conversation is well-formed if the first letters of its roles spell ``(s?(ua)+)?``: an
optional system turn, then user and assistant in turn. Edits are Keep, Rerole (to user or
assistant), Delete and Insert (an empty user or assistant turn).

**Scalar weights.** A list of edits is one integer. Its high digits are the cost; below
stands, in ``WIDTH`` bits a letter, the audit: the initials of the edits from the left, with
zeros behind its end. Among integers of one conversation, which all have room for the
longest audit, the smaller one is the cheaper list, and of equally cheap ones that with the
smaller audit in ASCII order, because letters are numbered in that order and a zero is less
than any. An edit adds its cost and its letter at its place, so the least integer over all
paths of a graph (nodes: rows read, state of the pattern, turns inserted) decides
everything, and the audit is read from its digits. Nodes from which the end can't be reached at
the least cost, by a first run over costs alone, are not visited.

**Two passes.** Conversations are read as streams of ordered rows. The first pass sees a few
bytes of a row and ends with the audits; the second puts each audit before the rows of its
conversation and applies it row by row. A task holds letters of one conversation and no
texts, however long it is; the integers grow with the conversation, so its time grows with
the square of its turns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowtables.llm.common import staged

#: The blanks of a text, and what a whole text ends with.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Letters of an audit in ASCII order; a letter's digit is its place, from one.
LETTERS = "DIKR"
WIDTH = 3
_DELETE, _INSERT, _KEEP, _REROLE = (LETTERS.index(c) + 1 for c in "DIKR")
#: The pattern: states are what the last kept turn was, and 0 before any.
_START, _S, _U, _A = range(4)
_NEXT = {_START: {"s": _S, "u": _U}, _S: {"u": _U}, _U: {"a": _A}, _A: {"u": _U}}
_FINAL = (_START, _A)
_ROLES = {"u": "user", "a": "assistant"}
_SOURCE = "conv_id long, turn long, role string, text string"
_VERDICT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


@dataclass(frozen=True)
class Costs:
    """Whole costs of the edits, and what a truncated turn adds that isn't deleted. An insert is above zero."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


@lru_cache(maxsize=None)
def _edges(initial: str, gone: bool, truncated: bool, costs: Costs) -> tuple:
    """Edits of a row, from each state: (next state, cost, digit)."""
    out = []
    for state in range(4):
        mine = [(state, costs.delete, _DELETE)]
        if not gone:
            extra = costs.truncated if truncated else 0
            mine += [(to, extra, _KEEP) for role, to in _NEXT[state].items() if role == initial]
            mine += [(to, costs.rerole + extra, _REROLE) for role, to in _NEXT[state].items() if role in _ROLES and role != initial]
        out.append(tuple(mine))
    return tuple(out)


def _inserts(state: int) -> list[int]:
    return [to for role, to in _NEXT[state].items() if role in _ROLES]


def _costs_to_end(rows: list[tuple], costs: Costs) -> list[list[int]]:
    """The least cost from each row and state to the end: the same minimum over costs alone."""
    far = 1 << 60
    out = [[0 if s in _FINAL else far for s in range(4)]]
    for row in [None, *reversed(rows)]:
        least = list(out[-1]) if row is None else [min(cost + out[-1][to] for to, cost, _ in edges) for edges in _edges(*row, costs)]
        for _ in range(3):  # no useful row of inserts is longer
            least = [min([least[s], *(costs.insert + least[to] for to in _inserts(s))]) for s in range(4)]
        if row is None:
            out[-1] = least
        else:
            out.append(least)
    return out[::-1]


def cheapest(rows: list[tuple[str, bool, bool]], costs: Costs = Costs()) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits, in ties with the smallest audit.

    A row is the first letter of its role, whether it has to be deleted, and whether it is truncated.
    """
    if costs.insert <= 0:
        raise ValueError("an insert must cost something")
    ahead = _costs_to_end(rows, costs)
    best = ahead[0][_START]
    width = WIDTH * (len(rows) + best // costs.insert)
    layer = {(_START, 0): 0}
    for i in range(len(rows) + 1):
        todo = sorted(layer, key=lambda node: node[1])
        for state, inserted in todo:  # grows: nodes with one more insert come behind
            weight = layer[state, inserted]
            digit = width - WIDTH * (i + inserted + 1)
            for to in _inserts(state):
                if (weight >> width) + costs.insert + ahead[i][to] <= best:
                    new = weight + (costs.insert << width) + (_INSERT << digit)
                    node = (to, inserted + 1)
                    if node not in layer:
                        todo.append(node)
                    if node not in layer or new < layer[node]:
                        layer[node] = new
        if i == len(rows):
            break
        after: dict = {}
        edges = _edges(*rows[i], costs)
        for (state, inserted), weight in layer.items():
            digit, paid = width - WIDTH * (i + inserted + 1), weight >> width
            for to, cost, letter in edges[state]:
                if paid + cost + ahead[i + 1][to] <= best:
                    new = weight + (cost << width) + (letter << digit)
                    if (to, inserted) not in after or new < after[to, inserted]:
                        after[to, inserted] = new
        layer = after
    weight = min(w for (state, _), w in layer.items() if state in _FINAL)
    digits = (weight & ((1 << width) - 1)).to_bytes((width + 7) // 8, "big") if width else b""
    bits = "".join(f"{b:08b}" for b in digits)[-width:] if width else ""
    numbers = (int(bits[k : k + WIDTH], 2) for k in range(0, width, WIDTH))
    return weight >> width, "".join(LETTERS[n - 1] for n in numbers if n)


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows of a conversation side by side: by kind, turn (null first), role and text."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text")


def _verdict(conv_id, turns: list, facts: list[tuple], costs: Costs) -> tuple:
    """One conversation: ``facts`` has (initial, tail, name) of its rows in order."""
    seen: set = set()
    blank = duplicate = truncated = illegal = 0
    rows, before = [], None
    for initial, tail, name in facts:
        again = name in seen
        seen.add(name)
        cut = bool(tail) and not again and tail not in ENDS
        blank += not tail
        duplicate += bool(tail) and again
        truncated += cut
        illegal += before is not None and before + initial not in ("su", "ua", "au")
        before = initial
        rows.append((initial if initial in ("s", "u", "a") else "", not tail or again, cut))
    numbers = [t for t in turns if t is not None]
    gaps = numbers[-1] - numbers[0] + 1 - len(set(numbers)) if numbers else 0
    cost, audit = cheapest(rows, costs)
    return conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit


def verdicts(turns: DataFrame, conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Faults and cheapest edits of each conversation that ``conversations`` (conv_id) names, also without turns.

    Returns conv_id, gaps (turn numbers missing between the smallest and the largest), blank,
    duplicate and truncated (rows by their first fault), illegal (neighbours whose roles don't
    follow each other), cost and audit. ``turns`` has conv_id, turn, role and text; see
    ``repair`` for nulls and ties.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        current, numbers, facts, open_ = None, [], [], False
        for batch in batches:
            for conv_id, kind, turn, initial, tail, name in zip(*(batch[c].to_pylist() for c in ("conv_id", "kind", "turn", "initial", "tail", "name"))):
                if not kind:  # every conversation opens with a row that names it
                    if open_:
                        out.append(_verdict(current, numbers, facts, costs))
                    current, numbers, facts, open_ = conv_id, [], [], True
                else:
                    numbers.append(turn)
                    facts.append((initial, tail, name))
            if len(out) >= 1000:
                yield _batch(out)
                out = []
        if open_:
            out.append(_verdict(current, numbers, facts, costs))
        if out:
            yield _batch(out)

    named = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    rows = named.selectExpr("conv_id", "0 AS kind", "cast(null AS long) AS turn", "'' AS role", "'' AS text")
    rows = rows.unionByName(turns.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text"))
    # A name is equal for equal role and text; a tail is the last letter that isn't blank.
    name = F.unhex(F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 32))
    tail = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    light = _ordered(rows).select("conv_id", "kind", "turn", F.substring("role", 1, 1).alias("initial"), tail.alias("tail"), name.alias("name"))
    return light.mapInArrow(run, _VERDICT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split(" ")[0] for field in _VERDICT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "audit" else pa.int64()) for n, c in zip(names, zip(*rows))], names=names)


class Repair:
    """Applies an audit to the rows of a conversation as they come; yields (role, text) of what stays."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, _START

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._next(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = _NEXT[self.state][role[:1]]
            yield role, text
        elif letter == "R":
            yield self._next(), text

    def _next(self) -> str:
        """The one role of a rerole or insert: whatever the state, user or assistant can't both follow."""
        (letter,) = (role for role in _NEXT[self.state] if role in _ROLES)
        self.state = _NEXT[self.state][letter]
        return _ROLES[letter]


def _with_audits(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows behind the audit of their conversation, which stands in ``text``."""
    heads = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    return _ordered(heads.unionByName(turns.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text")))


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, role, text) of the repaired rows; role is null where a conversation begins."""
    current, fixing = None, None
    for batch in batches:
        for conv_id, kind, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "kind", "role", "text"))):
            if not kind:
                if fixing:
                    yield from ((current, *t) for t in fixing.inserted())
                current, fixing = conv_id, Repair(text)
                yield current, None, None
            else:
                yield from ((current, *t) for t in fixing.row(role, text))
    if fixing:
        yield from ((current, *t) for t in fixing.inserted())


def repaired_turns(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, place = [], 0, 0
        for conv_id, role, text in _repaired(batches):
            if role is None:
                place = 0
                continue
            out.append((conv_id, place, role, text))
            place, size = place + 1, size + len(text)
            if size > 1 << 20 or len(out) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["conv_id", "place", "role", "text"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["conv_id", "place", "role", "text"])

    return _with_audits(turns, audits).mapInArrow(run, "conv_id long, place long, role string, text string")


def repaired_digests(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256: SHA-256 of the repaired rows as ``role:text``, joined by line breaks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, digest, first = [], [], None, True
        for conv_id, role, text in _repaired(batches):
            if role is None:
                if digest:
                    hashes.append(digest.hexdigest())
                ids.append(conv_id)
                digest, first = hashlib.sha256(), True
            else:
                digest.update((("" if first else "\n") + role + ":" + text).encode())
                first = False
        if digest:
            hashes.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes)], names=["conv_id", "repaired_sha256"])

    return _with_audits(turns, audits).mapInArrow(run, "conv_id long, repaired_sha256 string")


def damage(turns: DataFrame) -> DataFrame:
    """Damage a fixed part of all rows by the crc32 of ``conv_id:turn`` modulo 20 (null: one space).

    0 drops the row, 1 empties its text, 2 removes the ends of its sentences, 3 repeats it, and 4 makes its role user.
    """

    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")), F.lit(20))
    marked = cleaned(turns).withColumn("kind", kind).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def cleaned(turns: DataFrame) -> DataFrame:
    """Only conv_id, turn, role and text; null roles and texts are one space."""
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def repair(turns: DataFrame, conversations: DataFrame | None = None, costs: Costs = Costs()) -> DataFrame:
    """Faults, cheapest edits and the digest of the repaired conversation, one row per conv_id.

    Returns the columns of ``verdicts`` and repaired_sha256. ``conversations`` names
    conversations that must appear even if ``turns`` has no row of them.

    Null roles and texts are one space, hence no role that fits and a blank text. A null
    conv_id is a conversation like others. Rows are taken by turn, null first; rows of one
    turn by role and text. A conversation without rows has zeros, no audit and the digest of
    the empty string; empty tables give no rows. Texts of any length are hashed row by row.
    Other columns are not read.
    """
    rows = staged(cleaned(turns), "turns")
    judged = staged(verdicts(rows, rows if conversations is None else conversations, costs), "verdicts")
    done = repaired_digests(rows, judged).withColumnRenamed("conv_id", "digest_of")
    return judged.join(done, judged["conv_id"].eqNullSafe(done["digest_of"])).drop("digest_of")
