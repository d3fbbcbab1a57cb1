"""Cheapest repair of a conversation's structure, with an audit of its edits.

Rows are edited from left to right: Keep, Rerole to user or assistant, Delete, or Insert an
empty turn, so that the initials of the roles read (s?(ua)+)?. The DP has four states: no
row yet, after s, after u, after a. Of edits that cost the same the ASCII-least audit wins.
Two inserts in a row never pay (what they bridge is bridged without), so one is tried
before each row and one at the end.

Audits are persistent: a node adds one piece to its parent, and states share their
prefixes. A node has ancestors at powers of two and the rolling hash of its whole text, so
a tie is decided by a search for the longest common prefix, comparing hashes of ancestors;
that the prefixes are equal is then verified up to the node that both share, and a
collision falls back to the texts.

The DP composes: a block of rows has for each state before it and after it a cheapest
audit, and blocks chain like rows. Conversations of usual size are repaired whole inside
one task. Those in hash slots with more than LONG_ROWS rows or LONG_BYTES bytes go by
blocks of rows in many tasks; only the chain of blocks, and the digest over the repaired
rows (a chain over its bytes), stream through one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored

SPACES = " \t\n\x0b\x0c\r"
STOPS = ".!?"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5
NONE, AFTER_S, AFTER_U, AFTER_A = range(4)
OPEN = (NONE, AFTER_S, AFTER_A)  # a user turn may follow
#: Where an edit that makes a user or assistant turn leads.
NEXT = {NONE: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U, AFTER_U: AFTER_A}
LEGAL = frozenset(("su", "ua", "au"))
MOD, BASE = (1 << 61) - 1, 0x1A2B3C4D5E6F7081 % ((1 << 61) - 1)

LONG_ROWS, LONG_BYTES, SLOTS, BLOCK = 1 << 16, 64 << 20, 1 << 20, 8192
EMPTY = hashlib.sha256().hexdigest()


class Audits:
    """Texts as linked pieces; node 0 is the empty one."""

    def __init__(self):
        self.piece, self.size, self.hash, self.tag = [""], [0], [0], [None]
        self.up: list[list[int]] = [[]]

    def add(self, parent: int, piece: str, tag=None) -> int:
        node, h = len(self.piece), self.hash[parent]
        for ch in piece:
            h = (h * BASE + ord(ch)) % MOD
        up, k, at = [parent], 0, parent
        while k < len(self.up[at]):  # the ancestor 2^(k+1) above is 2^k above that at 2^k
            at = self.up[at][k]
            up.append(at)
            k += 1
        self.piece.append(piece)
        self.size.append(self.size[parent] + len(piece))
        self.hash.append(h)
        self.up.append(up)
        self.tag.append(tag)
        return node

    def _cover(self, node: int, length: int) -> int:
        """The highest ancestor (or the node) whose text has at least `length` characters."""
        for k in range(len(self.up[node]) - 1, -1, -1):
            up = self.up[node]
            if k < len(up) and self.size[up[k]] >= length:
                node = up[k]
        return node

    def _prefix_hash(self, node: int, length: int) -> int:
        at = self._cover(node, length)
        if self.size[at] == length:
            return self.hash[at]
        above = self.up[at][0]
        h = self.hash[above]
        for ch in self.piece[at][: length - self.size[above]]:
            h = (h * BASE + ord(ch)) % MOD
        return h

    def char(self, node: int, at: int) -> str:
        node = self._cover(node, at + 1)
        return self.piece[node][at - self.size[node]]  # from the end

    def common(self, x: int, y: int) -> int:
        """Length of the longest common prefix, verified."""
        if x == y:
            return self.size[x]
        low, high = 0, min(self.size[x], self.size[y])
        while low < high:
            mid = (low + high + 1) // 2
            if self._prefix_hash(x, mid) == self._prefix_hash(y, mid):
                low = mid
            else:
                high = mid - 1
        if self._equal(x, y, low):
            return low
        a, b = self.text(x), self.text(y)
        return next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))

    def _equal(self, x: int, y: int, length: int) -> bool:
        """Whether the first `length` characters are equal, back to the node that both share."""
        x, y = self._cover(x, length), self._cover(y, length)
        while length:
            if x == y:
                return True
            floor = max(self.size[self.up[x][0]], self.size[self.up[y][0]])
            a = self.piece[x][floor - self.size[self.up[x][0]] : length - self.size[self.up[x][0]]]
            b = self.piece[y][floor - self.size[self.up[y][0]] : length - self.size[self.up[y][0]]]
            if a != b:
                return False
            length = floor
            x, y = (self.up[n][0] if self.size[self.up[n][0]] == length else n for n in (x, y))
        return True

    def less(self, x: int, tail: str, y: int, other: str) -> bool:
        """Whether text(x) + tail is before text(y) + other, in ASCII order."""
        if x == y:
            return tail < other
        n = self.common(x, y)
        sx, sy = self.size[x], self.size[y]
        if n < sx and n < sy:
            return self.char(x, n) < self.char(y, n)
        rest_x = tail if n == sx else self.text(x)[n:] + tail
        rest_y = other if n == sy else self.text(y)[n:] + other
        return rest_x < rest_y

    def path(self, node: int) -> list[int]:
        out = []
        while node:
            out.append(node)
            node = self.up[node][0]
        return out[::-1]

    def text(self, node: int) -> str:
        return "".join(self.piece[n] for n in self.path(node))


class Best:
    """Cheapest candidate (cost, parent, piece) of each state; ties to the least text."""

    def __init__(self, audits: Audits):
        self.audits, self.found = audits, [None] * 4

    def offer(self, state: int, cost: int, parent: int, piece: str, tag=None) -> None:
        have = self.found[state]
        if have is None or cost < have[0] or cost == have[0] and self.audits.less(parent, piece, have[1], have[2]):
            self.found[state] = (cost, parent, piece, tag)

    def nodes(self) -> list[tuple[int, int] | None]:
        return [c and (c[0], self.audits.add(c[1], c[2], c[3]) if c[2] else c[1]) for c in self.found]


State = list[tuple[int, int] | None]


def with_insert(audits: Audits, state: State, last: bool = False) -> State:
    """The states with one more insert at most; at the end only the one that closes a pair."""
    best = Best(audits)
    for s, at in enumerate(state):
        if at:
            best.offer(s, *at, "")
            if s == AFTER_U or not last:
                best.offer(NEXT[s], at[0] + COST[INSERT], at[1], INSERT)
    return best.nodes()


def step(audits: Audits, state: State, initial: str, must_go: bool, truncated: bool) -> State:
    """One row: an insert before it or none, then its own edit."""
    best, more = Best(audits), TRUNCATED * truncated
    for s, at in enumerate(with_insert(audits, state)):
        if not at:
            continue
        cost, node = at
        best.offer(s, cost + COST[DELETE], node, DELETE)
        if must_go:
            continue
        if initial == "s" and s == NONE:
            best.offer(AFTER_S, cost + more, node, KEEP)
        elif initial == "u" and s in OPEN or initial == "a" and s == AFTER_U:
            best.offer(NEXT[s], cost + more, node, KEEP)
        best.offer(NEXT[s], cost + COST[REROLE] + more, node, REROLE)
    return best.nodes()


def cheapest(audits: Audits, state: State) -> tuple[int, int]:
    """Cost and node of the best whole audit."""
    closed, best = with_insert(audits, state, last=True), Best(audits)
    for s in (NONE, AFTER_A):
        if closed[s]:
            best.offer(NONE, *closed[s], "")
    return best.nodes()[NONE]


def begun(start: int = NONE) -> State:
    return [(0, 0) if s == start else None for s in range(4)]


def is_blank(text: str) -> bool:
    return not text.strip(SPACES)


def is_truncated(text: str) -> bool:
    return text.rstrip(SPACES)[-1:] not in STOPS


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


class Repaired:
    """The digest of the repaired rows, as edits and rows come in."""

    def __init__(self):
        self.digest, self.state, self.empty = hashlib.sha256(), NONE, True

    def _line(self, role: str, text: str) -> None:
        self.digest.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False

    def insert(self) -> None:
        self._line("user" if self.state in OPEN else "assistant", "")
        self.state = NEXT[self.state]

    def row(self, edit: str, role: str, text: str) -> None:
        if edit == DELETE:
            return
        if edit == REROLE:
            role = "user" if self.state in OPEN else "assistant"
        self._line(role, text)
        self.state = AFTER_S if role[:1] == "s" else NEXT[self.state]

    def edit(self, piece: str, at: int, role: str, text: str) -> int:
        """Does the inserts from `at` on, then the row's own edit; where the next begins."""
        while piece[at] == INSERT:
            self.insert()
            at += 1
        self.row(piece[at], role, text)
        return at + 1


RESULT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def repair(rows: list[tuple[int | None, str, str]]) -> tuple:
    """The result columns for one conversation's rows (turn, role, text), in order."""
    audits, state, seen = Audits(), begun(), set()
    faults = [0, 0, 0]
    for _, role, text in rows:
        blank = is_blank(text)
        again = not blank and (role, text) in seen
        cut = not blank and not again and is_truncated(text)
        seen.add((role, text))
        for i, fault in enumerate((blank, again, cut)):
            faults[i] += fault
        state = step(audits, state, role[:1], blank or again, cut)
    cost, node = cheapest(audits, state)
    audit, repaired, at = audits.text(node), Repaired(), 0
    for _, role, text in rows:
        at = repaired.edit(audit, at, role, text)
    for _ in audit[at:]:
        repaired.insert()
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = illegal_pairs([r[:1] for _, r, _ in rows])
    return gaps, *faults, illegal, cost, audit, repaired.digest.hexdigest()


# ---- tables


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage by the checksum of `conv_id:turn`, modulo 20.

    0: the row is dropped (it stays here with a null role), 1: the text is emptied, 2: it
    loses its [.!?], 3: the row is repeated, 4: the role is user. Nulls are one space in
    role, text and checksum; turn and conv_id stay null.
    """
    space = F.lit(" ")
    key = F.concat(*[c for n in ("conv_id", "turn") for c in (F.coalesce(F.col(n).cast("string"), space), F.lit(":"))][:3])
    kind = F.crc32(key) % 20
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        kind.alias("kind"),
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").when(F.col("kind") > 0, F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256
    of every conv_id.

    `rows` has conv_id, turn, role and text; a null role marks a row that only names its
    conversation, a null text counts as empty. Rows are taken by turn (null first), rows of
    one turn by role and text; a row's first fault counts (blank, duplicate, truncated). A
    null conv_id is a conversation of its own. Without rows a conversation has zeros, an
    empty audit and the empty digest. Texts are used whole; other columns are ignored; an
    empty table has an empty result.
    """
    rows = rows.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    slot = F.pmod(F.xxhash64("conv_id"), F.lit(SLOTS)).cast("int")
    sized = rows.select(slot.alias("slot"), F.octet_length("text").alias("size")).groupBy("slot")
    crowded = sized.agg(F.count("*").alias("n"), F.sum("size").alias("b")).where((F.col("n") > LONG_ROWS) | (F.col("b") > LONG_BYTES))
    slots = [(r["slot"],) for r in crowded.select("slot").collect()]  # SLOTS at most
    if not slots:
        return _whole(rows)
    crowded = F.broadcast(rows.sparkSession.createDataFrame(slots, "slot int"))
    split = rows.withColumn("slot", slot)
    rest, long = (split.join(crowded, "slot", how).drop("slot") for how in ("left_anti", "left_semi"))
    return _whole(rest).unionByName(_by_blocks(long))


def _batches(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _streamed(schema: str, key: int, groups: Callable[[], object]):
    """mapInArrow over sorted rows: each group's rows go to a new consumer, whose `end`
    gives the output rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, at, started = None, None, False
        for batch in batches:
            out = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if not started or row[key] != at:
                    if group:
                        out += group.end()
                    group, at, started = groups(), row[key], True
                group.take(row)
            if out:
                yield _batches(out, schema)
        if group:
            yield _batches(group.end(), schema)

    return run


WHOLE = f"conv_id long, {RESULT}"


class _Whole:
    def __init__(self):
        self.rows = []

    def take(self, row):
        self.conv_id = row[0]
        if row[2] is not None:
            self.rows.append(row[1:])

    def end(self):
        return [(self.conv_id, *repair(self.rows))]


def _whole(rows: DataFrame) -> DataFrame:
    order = ["conv_id", "turn", "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_streamed(WHOLE, 0, _Whole), WHOLE)


# ---- long conversations

PLACED = "conv string, conv_id long, part long, seq long, turn long, role string, text string"
CHAINED = "conv string, part long, block long, entry string, cost long, illegal long, audit string"


def _place(batches):
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        extra = {"part": pa.array([part] * n, pa.int64()), "seq": pa.array(range(seq, seq + n), pa.int64())}
        seq += n
        named = dict(zip(batch.schema.names, batch.columns)) | extra
        names = [f.split()[0] for f in PLACED.split(", ")]
        yield pa.record_batch([named[n] for n in names], names)


def _block_rows(frame):
    """One row per state before the block and after it that an audit connects."""
    frame = frame.sort_values("seq")
    first = frame.iloc[0]
    out = []
    rows = list(zip(frame["initial"], frame["must_go"], frame["truncated"]))
    initials = [r[0] for r in rows]
    illegal = illegal_pairs(initials)
    for start in range(4):
        audits, state = Audits(), begun(start)
        for row in rows:
            state = step(audits, state, *row)
        for end, at in enumerate(state):
            if at:
                cost, node = at
                out.append((first["conv"], first["part"], first["block"], start, end, cost, audits.text(node), initials[0], initials[-1], illegal))
    return pd.DataFrame(out, columns=[f.split()[0] for f in BLOCKS.split(", ")])


BLOCKS = "conv string, part long, block long, start long, stop long, cost long, audit string, first string, last string, illegal long"


class _Chain:
    """Chains the blocks of one conversation; gives the chosen piece of each, then the total."""

    def __init__(self):
        self.audits, self.state, self.block, self.best = Audits(), begun(), None, None
        self.illegal, self.last = 0, None

    def _advance(self):
        if self.best:
            self.state = self.best.nodes()

    def take(self, row):
        conv, part, block, start, stop, cost, audit, first, last, illegal = row
        if (part, block) != self.block:
            self._advance()
            self.illegal += illegal + (self.last is not None and self.last + first not in LEGAL)
            self.conv, self.block, self.last, self.best = conv, (part, block), last, Best(self.audits)
        at = self.state[start]
        if at:
            self.best.offer(stop, at[0] + cost, at[1], audit, (part, block))

    def end(self):
        self._advance()
        cost, node = cheapest(self.audits, self.state)
        out = []
        for n in self.audits.path(node):
            part, block = self.audits.tag[n] or (1 << 62, 0)  # the closing insert has no block
            out.append((self.conv, part, block, "piece", None, None, self.audits.piece[n]))
        return [*out, (self.conv, 0, 0, "total", cost, self.illegal, self.audits.text(node))]


class _Digest:
    """Runs the pieces of audits over the rows of one conversation."""

    def __init__(self):
        self.repaired, self.piece, self.at = Repaired(), "", 0

    def take(self, row):
        self.conv, _, _, seq, piece, role, text = row
        if piece is None:
            self.at = self.repaired.edit(self.piece, self.at, role, text)
        else:
            self.piece, self.at = piece, 0
            if row[1] == 1 << 62:
                for _ in piece:
                    self.repaired.insert()

    def end(self):
        return [(self.conv, self.repaired.digest.hexdigest())]


def _by_blocks(rows: DataFrame) -> DataFrame:
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))  # joins on a null, too
    order = ["conv_id", "turn", "role", "text", "copy"]
    named = rows.select(conv.alias("conv"), "*", F.monotonically_increasing_id().alias("copy"))
    sorted_rows = named.where("role IS NOT NULL").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(sorted_rows.drop("copy").mapInArrow(_place, PLACED), "repair-rows")

    body = F.rtrim(F.translate("text", SPACES, " " * len(SPACES)))  # only its last character is looked at
    light = placed.select(
        "conv",
        "part",
        "seq",
        F.floor(F.col("seq") / BLOCK).alias("block"),
        F.substring("role", 1, 1).alias("initial"),
        (F.length(body) == 0).alias("is_blank"),
        (~F.lit(STOPS).contains(F.right(body, F.lit(1)))).alias("open"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256).alias("digest"),
    )
    seen = light.groupBy("conv", "digest").agg(F.min(F.struct("part", "seq")).alias("first"), F.count("*").alias("n"))
    flagged = (
        light.join(seen.where("n > 1").drop("n"), ["conv", "digest"], "left")
        .withColumn("again", F.coalesce(F.struct("part", "seq") > F.col("first"), F.lit(False)) & ~F.col("is_blank"))
        .withColumns({"must_go": F.col("is_blank") | F.col("again"), "truncated": F.col("open") & ~F.col("is_blank") & ~F.col("again")})
        .select("conv", "part", "seq", "block", "initial", "is_blank", "again", "must_go", "truncated")
    )
    flagged = stored(flagged, "repair-flags")
    blocks = flagged.groupBy("conv", "part", "block").applyInPandas(_block_rows, BLOCKS)
    dealt = blocks.repartition("conv").sortWithinPartitions("conv", "part", "block", "start", "stop")
    chained = stored(dealt.mapInArrow(_streamed(CHAINED, 0, _Chain), CHAINED), "repair-chain")

    pieces = chained.where("entry = 'piece'").select(
        "conv", "part", "block", F.lit(-1).cast("long").alias("seq"), F.col("audit").alias("piece"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
    )
    lines = placed.select(
        "conv", "part", F.floor(F.col("seq") / BLOCK).alias("block"), "seq", F.lit(None).cast("string").alias("piece"), "role", "text"
    )
    stream = pieces.unionByName(lines).repartition("conv").sortWithinPartitions("conv", "part", "block", "seq")
    digests = stream.mapInArrow(_streamed("conv string, repaired_sha256 string", 0, _Digest), "conv string, repaired_sha256 string")

    counts = flagged.groupBy("conv").agg(
        F.count_if("is_blank").alias("blank"), F.count_if("again").alias("duplicate"), F.count_if("truncated").alias("truncated")
    )
    spans = placed.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    ids = named.groupBy("conv").agg(F.first("conv_id").alias("conv_id"))
    full = ids
    for part in (spans, counts, chained.where("entry = 'total'").select("conv", "cost", "illegal", "audit"), digests):
        full = full.join(part, "conv", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return full.select(
        "conv_id",
        *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256"),
    )
