"""Repair of conversations whose turns do not follow the role grammar, by generalised LR parsing with weighted edits.

The grammar is an optional system turn and pairs of user and assistant, or nothing.  A conversation is read row by row; all parses
that are still open share one graph-structured stack, whose tops are LR states.  A row may be kept, given another role or deleted,
and a turn may be inserted; each edit costs its weight.  Tops of equal state are merged into the one of least (cost, audit):
what follows depends on the state alone, so nothing better is lost.

Rows come sorted and pass one by one; held are a few tops, the part of their audits in which they differ, a running digest for each,
and 16 bytes for every different turn of the conversation at hand.  No conversation is gathered whole.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import read

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

#: LR automaton of the rules  S -> (nothing),  S -> P,  S -> s P,  P -> u a,  P -> P u a.
#: Shifts by state and token; a shift that completes a rule for P pops as many states as the rule has symbols, then goes on by GOTO.
SHIFT = {(0, "s"): 2, (0, "u"): 3, (2, "u"): 3, (1, "u"): 5, (4, "u"): 5, (3, "a"): 6, (5, "a"): 7}
REDUCE = {6: 2, 7: 3}
GOTO = {0: 1, 2: 4}
ACCEPT = {0, 1, 4}
#: From the cheapest top any other state is reached, or done without, by two insertions and a deletion; dearer tops cannot win.
SLACK = 2 * INSERT + DELETE


@dataclass(frozen=True)
class Node:
    """A stack top: its LR state and the node below, which other tops may share."""

    state: int
    below: Node | None = None

    def shift(self, token: str) -> Node | None:
        to = SHIFT.get((self.state, token))
        if to is None:
            return None
        node = Node(to, self)
        if to in REDUCE:
            under = node
            for _ in range(REDUCE[to]):
                under = under.below
            node = Node(GOTO[under.state], under)
        return node


@dataclass
class Parse:
    """The best way to a top: cost, the audit since the last common edit, and the digest of what it keeps."""

    node: Node
    cost: int
    audit: str
    digest: object
    lines: bool

    @property
    def rank(self) -> tuple[int, str]:
        return self.cost, self.audit

    def step(self, node: Node, cost: int, edit: str, line: tuple[str, str] | None) -> tuple[tuple[int, str], Node, Parse, tuple[str, str] | None]:
        return (self.cost + cost, self.audit + edit), node, self, line


def taken(offers: Iterable) -> dict[int, Parse]:
    """Merges equal tops by least (cost, audit); only the winners' lines are digested."""
    best: dict[int, tuple] = {}
    for offer in offers:
        (rank, node, _, _) = offer
        if node.state not in best or rank < best[node.state][0]:
            best[node.state] = offer
    tops = {}
    for state, ((cost, audit), node, source, line) in best.items():
        digest, lines = source.digest, source.lines
        if line is not None:
            digest = digest.copy()
            digest.update((("\n" if lines else "") + f"{line[0]}:{line[1]}").encode("utf-8", "surrogatepass"))
            lines = True
        tops[state] = Parse(node, cost, audit, digest, lines)
    return tops


class Repair:
    """One conversation's rows, given in order, and its repaired form."""

    def __init__(self):
        self.tops = {0: Parse(Node(0), 0, "", hashlib.sha256(), False)}
        self.settled: list[str] = []
        self.rows = 0
        self._insert()

    def _insert(self) -> None:
        """Adds what insertions reach from the tops there are; two in a row are the most that can help."""
        for _ in range(2):
            offers = [p.step(p.node, 0, "", None) for p in self.tops.values()]
            for p in self.tops.values():
                for token, role in ROLES.items():
                    if (node := p.node.shift(token)) is not None:
                        offers.append(p.step(node, INSERT, "I", (role, "")))
            self.tops = taken(offers)

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        offers, extra = [], TRUNCATED if truncated else 0
        for p in self.tops.values():
            offers.append(p.step(p.node, DELETE, "D", None))
            if must_go:
                continue
            if (node := p.node.shift(role[:1])) is not None:
                offers.append(p.step(node, extra, "K", (role, text)))
            for token, name in ROLES.items():
                if (node := p.node.shift(token)) is not None:
                    offers.append(p.step(node, REROLE + extra, "R", (name, text)))
        self.tops = taken(offers)
        self._insert()
        least = min(p.cost for p in self.tops.values())
        self.tops = {s: p for s, p in self.tops.items() if p.cost <= least + SLACK}
        self.rows += 1
        if self.rows % 64 == 0:
            self._settle()

    def _settle(self) -> None:
        """Takes the edits that all tops share off their audits, which keeps these short."""
        common = os.path.commonprefix([p.audit for p in self.tops.values()])
        self.settled.append(common)
        for p in self.tops.values():
            p.audit = p.audit[len(common) :]

    def result(self) -> tuple[int, str, str]:
        """(cost, audit, digest of the repaired lines)."""
        best = min((p for s, p in self.tops.items() if s in ACCEPT), key=lambda p: p.rank)
        return best.cost, "".join(self.settled) + best.audit, best.digest.hexdigest()


class Report:
    """Counts over one conversation's rows beside their repair."""

    def __init__(self):
        self.turns, self.low, self.high, self.last_turn = 0, 0, 0, None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.seen: set[bytes] = set()
        self.before: str | None = None
        self.repair = Repair()

    def row(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.last_turn:  # sorted, so equal turns are neighbours
            self.low = turn if self.last_turn is None else self.low
            self.high, self.last_turn = turn, turn
            self.turns += 1
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        body = text.rstrip(BLANK)
        blank, duplicate = not body, key in self.seen
        truncated = not blank and not duplicate and body[-1] not in ENDS
        self.blank += blank
        self.duplicate += duplicate and not blank
        self.truncated += truncated
        self.seen.add(key)
        self.repair.row(role, text, blank or duplicate, truncated)

    def result(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.result())


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", gone: str | None = None) -> DataFrame:
    """One row per conversation: counted faults, cost and audit of the cheapest repair, digest of the repaired turns.

    ``gone`` names a boolean column of rows that are not there but for their conversation's name.  Defined cases: null role and text
    count as one blank; a null conversation id is a conversation; rows go by turn (nulls first), equal turns by role and text,
    so repeated rows stand side by side; a role that starts with none of s, u and a cannot be kept; an empty table gives no rows; other
    columns are not read.  One digest over a conversation has to be made in order, so a conversation passes one task, as a sorted stream.
    """
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    slim = rows.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"), blank(role_col).alias("role"),
        blank(text_col).alias("text"), (F.col(f"`{gone}`") if gone else F.lit(False)).alias("gone"),
    )
    ordered = slim.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        report, at = None, None
        for batch in batches:
            done: list[tuple] = []
            for conv, turn, role, text, is_gone in zip(*(c.to_pylist() for c in batch.columns)):
                if report is None or conv != at:
                    if report is not None:
                        done.append((at, *report.result()))
                    report, at = Report(), conv
                if not is_gone:
                    report.row(turn, role, text)
            if done:
                yield as_batch(done, batch.schema.field(0).type)
            kind = batch.schema.field(0).type
        if report is not None:
            yield as_batch([(at, *report.result())], kind)

    def as_batch(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], ["conv_id", *NAMES])

    kind = slim.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(repaired, f"conv_id {kind}, " + ", ".join(f"{n} bigint" for n in NAMES[:6]) + ", audit string, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, by the remainder of crc32(``conv_id:turn``) by 20.

    0 marks a row ``gone``, 1 empties its text, 2 takes its sentence marks away, 3 repeats it, 4 makes its role user; nulls count as one blank.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    told = rows.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    hurt = told.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") == 0).alias("gone"), copies)
    return hurt.drop("copy")


def op13_glr_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    return repair(damaged(read(spark, sf_dir, "conversations")), gone="gone")
