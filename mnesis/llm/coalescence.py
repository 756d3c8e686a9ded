"""Repair of conversations' structure by the cheapest edits, found by a Viterbi pass that emits what is settled.

A repaired conversation's role initials read ``(s?(ua)+)?``. Every row is kept (free), given the role that its place asks
for (1) or deleted (2; blank rows and repeats must go); rows without text may be inserted (5); a row whose text breaks
off and that stays costs 5 more. Of the cheapest edits those with the least string of initials (D, I, K, R) are taken.

The decoder reads a conversation's rows in order. For each of four states (nothing yet, after the system's, the user's,
the assistant's turn) it has one survivor: a leaf of a tree of back pointers, whose nodes count their children and
leaves. Nodes that no survivor needs go at once; when all survivors share an ancestor, the edits down to it are emitted
and forgotten, so what is held is the unresolved suffixes alone. A row's edits form one of the tokens D, K, R, IK, IR
(an insertion before a deletion never has the least string), none of which begins another: so survivors' whole
unresolved suffixes keep their order when they grow, and comparing two of them by the order of their ends and then by the
new token is comparing them whole. A survivor goes when another, with the dearest way from there to any end that the
first could reach (``AHEAD``), is cheaper still; no end of it could be the cheapest.

Rows travel once, by conversation; whether a row repeats an earlier one is found by a window over conversation, role and
text in the same partitioning. One conversation streams through one task in bounded memory, however many rows it has
(its hash is a chain, so its rows must be read in turn): held are the rows of the unresolved suffixes, which end where
survivors meet. Two cheapest repairs that stay tied to a conversation's end (such as one where every row is the user's)
keep its rows from the tie on.

Defined results: null roles and texts count as one space; a null turn stands first and makes no gap; rows without a
conversation are one conversation; rows of equal turn stand by role, then text; equal rows repeat each other; an empty
table gives an empty table; conversations whose rows are all marked as lost end with zeros. Texts may have any length.
Only the four columns named are read, so others may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from mnesis.llm.common import slices

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: White space of the contract, and marks that end a text.
SPACE, ENDS = " \t\n\x0b\x0c\r", ".!?"
#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
TURNS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: AHEAD[p][q]: at most so much more than from q does the cheapest way to an end cost from p. From ASSISTANT a system's
#: turn that START could keep is deleted; one turn or two are inserted where the next turn differs.
AHEAD = [
    [0, 0, INSERT, 0],
    [DELETE + 2 * INSERT, 0, INSERT, 2 * INSERT],
    [DELETE + INSERT, INSERT, 0, INSERT],
    [DELETE, 0, INSERT, 0],
]
#: What a conversation still needs at its end, by state.
CLOSING = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
FLUSH_ROWS, FLUSH_BYTES = 4096, 4 << 20


def moves(initial: str) -> list[tuple[int, int, str, int, bool]]:
    """From, to, token, cost and whether the row stays, for a row with this role initial."""
    out = [(q, q, "D", DELETE, False) for q in range(4)]
    for q in range(4):
        at, token = q, ""
        for _ in range(2):  # a second insertion would end where none does
            cost, to = len(token) * INSERT, TURNS[at]
            if initial == ROLE[to][0]:
                out.append((q, to, token + "K", cost + KEEP, True))
            else:
                out.append((q, to, token + "R", cost + REROLE, True))
            at, token = to, token + "I"
    return out + ([(START, SYSTEM, "K", KEEP, True)] if initial == "s" else [])


MOVES = {initial: moves(initial) for initial in ("s", "u", "a", "")}
DELETED = [(q, q, "D", DELETE, False) for q in range(4)]


class Node:
    """An edit of the tree of back pointers: refs counts its children and whether a survivor ends here."""

    __slots__ = ("parent", "token", "state", "row", "refs")

    def __init__(self, parent: Node | None, token: str, state: int, row: tuple | None):
        self.parent, self.token, self.state, self.row, self.refs = parent, token, state, row, 0
        if parent is not None:
            parent.refs += 1


class Decoder:
    """Of one conversation: ``add`` its rows in turn, then ``close``; both return the edits that are settled by then as
    (token letter, row or None, role that it has afterwards or None)."""

    def __init__(self):
        self.root = Node(None, "", START, None)
        self.root.refs = 1
        self.ends = {START: (0, 0, self.root)}  # cost, rank among the survivors' strings, node
        self.held = self.most_held = 0

    def add(self, row: tuple, initial: str, must_go: bool, cut_off: bool) -> list[tuple]:
        best: dict[int, tuple[int, int, str, int]] = {}
        ends, more = self.ends, CUT_OFF if cut_off else 0
        for q, to, token, cost, stays in DELETED if must_go else MOVES.get(initial, MOVES[""]):
            if q in ends:
                at = ends[q]
                found = (at[0] + cost + (more if stays else 0), at[1], token, q)
                if to not in best or found < best[to]:
                    best[to] = found
        kept = {q: x for q, x in best.items() if not any(y[0] + AHEAD[p][q] < x[0] for p, y in best.items())}
        order = sorted(kept, key=lambda q: kept[q][1:3])
        grown = {}
        for rank, q in enumerate(order):
            cost, _, token, came = kept[q]
            node = Node(ends[came][2], token, q, row)
            node.refs = 1
            grown[q] = (cost, rank, node)
        self.held += len(grown)
        for _, _, node in ends.values():
            self.release(node)
        self.ends = grown
        out = self.settled() if self.root.refs == 1 else []
        self.most_held = max(self.most_held, self.held)
        return out

    def release(self, node: Node) -> None:
        node.refs -= 1
        while not node.refs and node is not self.root:
            node, gone = node.parent, node
            gone.parent = None
            node.refs -= 1
            self.held -= 1

    def settled(self) -> list[tuple]:
        """The edits from the root down to the survivors' last common ancestor, which becomes the root."""
        path, node = [], next(iter(self.ends.values()))[2]
        while node is not self.root:
            path.append(node)
            node = node.parent
        out: list[tuple] = []
        leaves = {id(x[2]) for x in self.ends.values()}
        while path and self.root.refs == 1 and id(self.root) not in leaves:
            node = path.pop()
            out += edits(self.root.state, node.token, node.row)
            node.parent = None
            self.root, self.held = node, self.held - 1
        return out

    def close(self) -> tuple[list[tuple], int]:
        cost, _, closing, q = min((x[0] + INSERT * len(CLOSING[q]), x[1], CLOSING[q], q) for q, x in self.ends.items())
        path, node = [], self.ends[q][2]
        while node is not self.root:
            path.append(node)
            node = node.parent
        out, state = [], self.root.state
        for node in reversed(path):
            out += edits(state, node.token, node.row)
            state = node.state
        return out + edits(state, closing, None), cost


def edits(state: int, token: str, row: tuple | None) -> list[tuple]:
    out = []
    for letter in token:
        if letter == "D":
            out.append((letter, row, None))
        elif letter == "K":
            out.append((letter, row, row[1]))
        else:
            out.append((letter, row if letter == "R" else None, ROLE[TURNS[state]]))
        state = TURNS[state]
    return out


class Audit:
    """Counts of one conversation's rows, as they pass."""

    def __init__(self, conv):
        self.conv, self.decoder, self.nth = conv, Decoder(), 0
        self.low = self.high = self.seen = None
        self.distinct = self.illegal = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}

    def take(self, turn, role: str, fault: str | None) -> None:
        initial = role[:1]
        if self.seen is not None and self.seen + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.seen = initial
        if turn is not None:
            if self.high is None:
                self.low = turn
            if turn != self.high:
                self.distinct, self.high = self.distinct + 1, turn
        if fault:
            self.faults[fault] += 1

    def gaps(self) -> int:
        return 0 if self.high is None else self.high - self.low + 1 - self.distinct


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "held"]


def repair_stream(types: pa.Schema):
    """Over batches in order of conversation and turn: the edits of each conversation, then a row ``End`` with its counts."""
    names = {"K": "Keep", "R": "Rerole", "D": "Delete", "I": "Insert"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size, audit = 0, None

        def put(found: list[tuple]) -> int:
            for letter, row, role in found:
                turn, was, text, fault = row or (None, None, "", None)
                out.append((audit.conv, audit.nth, names[letter], turn, was, role, text, fault, *[None] * len(COUNTS)))
                audit.nth += 1
            return sum(len(x[1][2]) if x[1] else 0 for x in found)

        def end() -> None:
            rest, cost = audit.decoder.close()
            put(rest)
            out.append((audit.conv, audit.nth, "End", None, None, None, None, None, audit.gaps(), *audit.faults.values(), audit.illegal, cost, audit.decoder.most_held))

        def flushed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), types, strict=True)], schema=types)
            out.clear()
            return made

        for batch in slices(batches):
            for conv, turn, role, text, fault, lost in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "fault", "lost")], strict=True):
                if audit is None or conv != audit.conv:
                    if audit is not None:
                        end()
                    audit = Audit(conv)
                if lost:
                    continue
                audit.take(turn, role, fault)
                size += put(audit.decoder.add((turn, role, text, fault), role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
                if len(out) >= FLUSH_ROWS or size >= FLUSH_BYTES:
                    size = 0
                    yield flushed()
        if audit is not None:
            end()
        if out:
            yield flushed()

    return run


def digest_stream(types: pa.Schema):
    """One row for each conversation from its edits in order: counts, audit string and hash of what stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sha, first = [], hashlib.sha256(), True
        for batch in batches:
            rows = []
            for conv, edit, role, text, *counts in zip(*[batch.column(c).to_pylist() for c in ("conv", "edit", "role", "text", *COUNTS)], strict=True):
                if edit == "End":
                    rows.append((conv, *counts, "".join(letters), sha.hexdigest()))
                    letters, sha, first = [], hashlib.sha256(), True
                    continue
                letters.append(edit[0])
                if role is not None:
                    sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), types, strict=True)], schema=types)

    return run


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", lost: Column | None = None) -> DataFrame:
    """An edit a row: conv, nth (the edit's place), edit (Keep, Rerole, Delete, Insert), turn and was (the role) of the row
    that it is about, role and text afterwards (role is null where the row is deleted), fault; each conversation ends with
    a row End that has its counts gaps, blank, duplicate, truncated, illegal, cost, and held, the most edits that were
    unresolved at a time. Rows of a conversation follow each other in order within a partition.

    lost: rows that only name their conversation, which may so end up without any."""
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    named = F.col(f"`{conv}`").alias("conv")
    base = rows.select(named, F.col(f"`{turn}`").cast("long").alias("turn"), plain(role).alias("role"), plain(text).alias("text"), (F.lit(False) if lost is None else lost).alias("lost"))
    bare = F.rtrim("text", F.lit(SPACE))
    earlier = Window.partitionBy("conv", "role", "text", "lost").orderBy(F.col("turn").asc_nulls_first())
    fault = F.when(bare == "", "blank").when(F.row_number().over(earlier) > 1, "duplicate").when(~F.right(bare, F.lit(1)).isin(*ENDS), "truncated")
    repeats_last = (F.col("fault") == "duplicate").asc_nulls_first()
    ordered = base.repartition("conv").withColumn("fault", fault).sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text", repeats_last)
    schema = f"conv {rows.select(named).schema[0].dataType.simpleString()}, nth long, edit string, turn long, was string, role string, text string, fault string, " + ", ".join(f"{c} long" for c in COUNTS)
    return ordered.mapInArrow(repair_stream(to_arrow_schema(StructType.fromDDL(schema))), schema)


def digests(edits_in_order: DataFrame) -> DataFrame:
    """From ``repaired`` as it stands (its order is used): a row for each conversation with its counts, audit and repaired_sha256."""
    kind = edits_in_order.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    return edits_in_order.select("conv", "edit", "role", "text", *COUNTS).mapInArrow(digest_stream(to_arrow_schema(StructType.fromDDL(schema))), schema)


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Rows of conversations with faults dealt by crc32 of ``conv_id:turn``, and which of them are lost: of 20 remainders,
    0 loses the row, 1 empties its text, 2 removes its marks of ends, 3 repeats it, 4 gives it to the user."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = rows.select("conv_id", "turn", "role", "text", F.pmod(F.crc32(F.concat_ws(":", plain("conv_id"), plain("turn")).cast("binary")), F.lit(20)).alias("damage"))
    at = F.col("damage")
    return (
        dealt.withColumn("copy", F.explode(F.when(at == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .withColumn("text", F.when(at <= 1, "").when(at == 2, F.translate(plain("text"), ENDS, "")).otherwise(plain("text")))
        .withColumn("role", F.when(at == 4, "user").otherwise(plain("role"))),
        at == 0,
    )


#: DuckDB's SQL for the digests of damaged ``conversations``: the same recursion over whole strings, a row a step.
SQL = r"""
WITH RECURSIVE plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
names AS (SELECT DISTINCT name FROM plain),
crc(name, i, c) AS (
  SELECT name, 0, 4294967295::BIGINT FROM names
  UNION ALL
  SELECT name, i + 1, CASE WHEN i % 9 = 0 THEN xor(c, ascii(substr(name, i // 9 + 1, 1))::BIGINT)
                           ELSE CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END END
  FROM crc WHERE i < 9 * length(name)),
dealt AS (SELECT name, xor(c, 4294967295) % 20 AS damage FROM crc WHERE i = 9 * length(name)),
rows AS (
  SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM plain JOIN dealt USING (name), range(0, 2) t(copy) WHERE damage <> 0 AND (copy = 0 OR damage = 3)),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again, rtrim(text, E' \t\n\x0b\x0c\r') AS bare FROM rows),
placed AS (
  SELECT conv_id, turn, role, text, substr(role, 1, 1) AS r,
         CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) || substr(role, 1, 1) AS pair
  FROM seen),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM placed GROUP BY conv_id),
step(conv_id, i, s0, s1, s2, s3) AS (
  SELECT conv_id, 0::BIGINT, {'c': 0, 'a': '', 't': ''}, {'c': 1000000000, 'a': '', 't': ''}, {'c': 1000000000, 'a': '', 't': ''}, {'c': 1000000000, 'a': '', 't': ''} FROM counts
  UNION ALL
  SELECT s.conv_id, p.i,
    {'c': s0.c + 2, 'a': s0.a || 'D', 't': s0.t},
    list_min([{'c': s1.c + 2, 'a': s1.a || 'D', 't': s1.t}, {'c': s0.c + stay + CASE WHEN r = 's' THEN 0 ELSE 1000000000 END, 'a': s0.a || 'K', 't': s0.t || own}]),
    list_min([{'c': s2.c + 2, 'a': s2.a || 'D', 't': s2.t},
              {'c': s0.c + stay + u, 'a': s0.a || ul, 't': s0.t || ut}, {'c': s1.c + stay + u, 'a': s1.a || ul, 't': s1.t || ut},
              {'c': s3.c + stay + u, 'a': s3.a || ul, 't': s3.t || ut}, {'c': s2.c + 5 + stay + u, 'a': s2.a || 'I' || ul, 't': s2.t || E'\nassistant:' || ut}]),
    list_min([{'c': s3.c + 2, 'a': s3.a || 'D', 't': s3.t},
              {'c': s2.c + stay + a, 'a': s2.a || al, 't': s2.t || ta}, {'c': s0.c + 5 + stay + a, 'a': s0.a || 'I' || al, 't': s0.t || E'\nuser:' || ta},
              {'c': s1.c + 5 + stay + a, 'a': s1.a || 'I' || al, 't': s1.t || E'\nuser:' || ta}, {'c': s3.c + 5 + stay + a, 'a': s3.a || 'I' || al, 't': s3.t || E'\nuser:' || ta}])
  FROM step s JOIN (
    SELECT conv_id, i, r, CASE fault WHEN 'truncated' THEN 5 WHEN '' THEN 0 ELSE 1000000000 END AS stay, E'\n' || role || ':' || text AS own,
           CASE r WHEN 'u' THEN 0 ELSE 1 END AS u, CASE r WHEN 'u' THEN 'K' ELSE 'R' END AS ul, E'\n' || CASE r WHEN 'u' THEN role ELSE 'user' END || ':' || text AS ut,
           CASE r WHEN 'a' THEN 0 ELSE 1 END AS a, CASE r WHEN 'a' THEN 'K' ELSE 'R' END AS al, E'\n' || CASE r WHEN 'a' THEN role ELSE 'assistant' END || ':' || text AS ta
    FROM placed) p ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND p.i = s.i + 1),
ended AS (
  SELECT s.conv_id, list_min([s0, s3, {'c': s2.c + 5, 'a': s2.a || 'I', 't': s2.t || E'\nassistant:'}, {'c': s1.c + 10, 'a': s1.a || 'II', 't': s1.t || E'\nuser:
assistant:'}]) AS e
  FROM step s JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.i)
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.c, 0)::BIGINT AS cost, coalesce(e.a, '') AS audit,
       sha256(coalesce(substr(e.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM k.conv_id LEFT JOIN ended d ON d.conv_id IS NOT DISTINCT FROM k.conv_id
"""
