"""Trie of rebuilt conversations, by composable fingerprints of their turns.

A turn is two numbers below P = 2^61 - 1. A sequence of turns is, for each of two bases B,
the map x -> x * B^n + s; maps compose, so the fingerprint of a sequence is s, and that of a
joined one follows from its parts. One scan gives s of every prefix of the original
conversations, P(i). A rebuilt conversation has the first k turns of its base and its own
turns after the first h, so its prefix with own turn i has the fingerprint

    P_own(i) + B^(i - h) * (P_base(k) - P_own(h))

which needs three stored numbers and no text. Prefixes of one depth and fingerprint are one
node. Equality is verified, not assumed: a group's rows must have one parent fingerprint,
hence (B and P are fixed) one pair of turn numbers, and each pair of numbers must stand for
one role and text among the stored turns; by depth, all members then have equal turns. If
two things ever share a number, all is done again with other numbers.

The scan is over rows sorted by range, so a conversation may cross tasks: every task takes
prefixes from its own first row on, and the maps of the parts before it (one row per task)
are composed on the driver. Sums over a subtree need no walk: the nodes whose smallest
member is c are a run of depths on c's path, so the sum below a node is its own run's rest
and the whole runs of its other members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored

P = (1 << 61) - 1
#: Per attempt: the seeds of the turn numbers, and the two bases.
ATTEMPTS = (
    (11, 0x0B1A95CC1E2F5D37, 0x16E0C3B2A7F4D90B),
    (211, 0x13C6EF372FE94F82, 0x0A54FF53A5F1D36F),
    (2311, 0x1F83D9ABFB41BD6B, 0x05BE0CD19137E217),
)
HEADS, SPAN = 9, 5
#: Depths of a path that are summed together, before the sums of the blocks.
BLOCK = 4096
IDS_IN_PIECE = 8192
NODE = ["depth", "f1", "f2"]
SMALL_POWERS = 1024


def turn_numbers(seed: int) -> list[Column]:
    return [
        F.pmod(F.xxhash64(F.lit(seed + k), "role", "text"), F.lit(P)).alias(f"t{k + 1}") for k in (0, 1)
    ]


class Powers:
    def __init__(self, base: int):
        self.base, self.small = base, [1]
        for _ in range(SMALL_POWERS):
            self.small.append(self.small[-1] * base % P)

    def __call__(self, n: int) -> int:
        return self.small[n] if n <= SMALL_POWERS else pow(self.base, n, P)


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


# ---- prefixes of the original conversations

SCANNED = "conv_id long, part int, pos long, f1 long, f2 long, p1 long, p2 long, size long"


def _scan(bases: tuple[int, int]):
    """Fingerprints of prefixes from the task's own first row of each conversation on."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, (b1, b2) = TaskContext.get().partitionId(), bases
        at, pos, f1, f2 = None, 0, 0, 0
        for batch in batches:
            out = []
            for conv, t1, t2, size in zip(*_columns(batch, ["conv_id", "t1", "t2", "size"])):
                if conv != at:
                    at, pos, f1, f2 = conv, 0, 0, 0
                before = f1, f2
                pos, f1, f2 = pos + 1, (f1 * b1 + t1) % P, (f2 * b2 + t2) % P
                out.append((conv, part, pos, f1, f2, *before, size))
            yield _batch(out, SCANNED)

    return scan


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _carries(scanned: DataFrame, bases: tuple[int, int]) -> dict[int, tuple[int, int, int, int]]:
    """Per task whose first conversation began in an earlier one: that one's map so far.

    One row per task comes to the driver.
    """
    last = F.max(F.struct("conv_id", "pos", "f1", "f2")).alias("last")
    rows = scanned.groupBy("part").agg(F.min("conv_id").alias("first"), last).orderBy("part").collect()
    carries, open_run = {}, None
    for r in rows:
        conv, pos, f1, f2 = r["last"]
        if open_run and r["first"] < open_run[0]:
            raise RuntimeError("tasks of the scan are not in the order of conversations")
        if open_run and r["first"] == open_run[0]:
            carries[r["part"]] = open_run
            if conv == open_run[0]:
                f1 = (open_run[2] * pow(bases[0], pos, P) + f1) % P
                f2 = (open_run[3] * pow(bases[1], pos, P) + f2) % P
                pos += open_run[1]
        open_run = (conv, pos, f1, f2)
    return carries


def _completed(scanned: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """The prefixes, from the first turn of the conversation on."""
    carries = _carries(scanned, bases)
    if not carries:
        return scanned
    shared = scanned.sparkSession.sparkContext.broadcast(carries)  # one row per task at most

    def complete(batches):
        b1, b2 = (Powers(b) for b in bases)
        for batch in batches:
            out = []
            for row in zip(*_columns(batch, [f.split()[0] for f in SCANNED.split(", ")])):
                conv, part, pos, f1, f2, p1, p2, size = row
                carry = shared.value.get(part)
                if carry and carry[0] == conv:
                    _, before, c1, c2 = carry
                    f1, f2 = (c1 * b1(pos) + f1) % P, (c2 * b2(pos) + f2) % P
                    p1, p2 = (c1 * b1(pos - 1) + p1) % P, (c2 * b2(pos - 1) + p2) % P
                    pos += before
                out.append((conv, part, pos, f1, f2, p1, p2, size))
            yield _batch(out, SCANNED)

    return scanned.mapInArrow(complete, SCANNED)


# ---- prefixes of the rebuilt conversations

REBUILT = "conv_id long, depth long, f1 long, f2 long, p1 long, p2 long, size long, ends boolean"


def _rebuilt(turns: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """A row for each rebuilt conversation and depth, the root included."""
    head = F.when(F.col("pos") < HEADS, F.struct("pos", "f1", "f2", "size"))
    convs = turns.groupBy("conv_id").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(head)).alias("heads")  # eight at most
    )
    owner = F.col("conv_id") - F.col("conv_id") % SPAN
    bases_of = convs.select(F.col("conv_id").alias("base"), F.col("heads").alias("lead"))
    joined = convs.withColumns({"base": owner, "h": F.crc32(F.col("conv_id").cast("string")) % HEADS}).join(
        bases_of, "base", "left"
    )
    plans = joined.select(
        "conv_id",
        "n",
        "h",
        F.coalesce("lead", F.array()).alias("lead"),
        F.least(F.col("h"), F.coalesce(F.size("lead"), F.lit(0))).cast("long").alias("k"),
        F.get("heads", (F.col("h") - 1).cast("int")).alias("own"),
    ).withColumns(
        {
            "length": F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)),
            "at": F.get("lead", (F.col("k") - 1).cast("int")),
        }
    )

    def number(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).cast("long")

    def lead(d: Column, field: str) -> Column:
        return F.coalesce(F.get("lead", (d - 1).cast("int"))[field], F.lit(0)).cast("long")

    def of_base(d: Column) -> Column:
        return F.struct(
            d.alias("depth"),
            *[lead(d, f).alias(f) for f in ("f1", "f2")],
            *[lead(d - 1, f).alias(p) for f, p in (("f1", "p1"), ("f2", "p2"))],
            lead(d, "size").alias("size"),
            (d == F.col("length")).alias("ends"),
        )

    heads = plans.select("conv_id", F.inline(F.transform(F.sequence(F.lit(0).cast("long"), "k"), of_base)))
    shift = plans.where("n > h").select(
        "conv_id", "n", "h", "k", number("at.f1").alias("b1"), number("at.f2").alias("b2"),
        number("own.f1").alias("o1"), number("own.f2").alias("o2"),
    )
    own = turns.join(shift, "conv_id").where("pos > h")
    names = ["conv_id", "pos", "f1", "f2", "p1", "p2", "size", "n", "h", "k", "b1", "b2", "o1", "o2"]

    def compose(batches):
        w1, w2 = (Powers(b) for b in bases)
        for batch in batches:
            out = []
            for conv, pos, f1, f2, p1, p2, size, n, h, k, b1, b2, o1, o2 in zip(*_columns(batch, names)):
                if b1 != o1 or b2 != o2:
                    i = pos - h
                    f1, f2 = (f1 + w1(i) * (b1 - o1)) % P, (f2 + w2(i) * (b2 - o2)) % P
                    p1, p2 = (p1 + w1(i - 1) * (b1 - o1)) % P, (p2 + w2(i - 1) * (b2 - o2)) % P
                out.append((conv, k + pos - h, f1, f2, p1, p2, size, pos == n))
            yield _batch(out, REBUILT)

    return heads.unionByName(own.select(*names).mapInArrow(compose, REBUILT))


# ---- nodes


def _ends(rows: DataFrame) -> DataFrame:
    """Digest of the ids that end at each node, in numeric order.

    Sorted ids become pieces of text in many tasks; only the digest itself, which is a
    chain over its bytes, runs through the pieces of a node in one task, one at a time.
    """
    order = [*NODE, "conv_id"]
    ordered = rows.where("ends").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def pieces(batches):
        for batch in batches:
            out, at, first, ids = [], None, 0, []
            for *node, conv in zip(*_columns(batch, order)):
                if node != at or len(ids) == IDS_IN_PIECE:
                    if ids:
                        out.append((*at, first, ",".join(ids)))
                    at, first, ids = node, conv, []
                ids.append(str(conv))
            if ids:
                out.append((*at, first, ",".join(ids)))
            yield _batch(out, "depth long, f1 long, f2 long, first long, ids string")

    def digests(batches):
        at, chain, schema = None, None, "depth long, f1 long, f2 long, ends_sha256 string"
        for batch in batches:
            out = []
            for *node, ids in zip(*_columns(batch, [*NODE, "ids"])):
                if node != at:
                    if at:
                        out.append((*at, chain.hexdigest()))
                    at, chain = node, hashlib.sha256(ids.encode())
                else:
                    chain.update(b"," + ids.encode())
            yield _batch(out, schema)
        if at:
            yield _batch([(*at, chain.hexdigest())], schema)

    cut = ordered.mapInArrow(pieces, "depth long, f1 long, f2 long, first long, ids string")
    dealt = cut.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return dealt.mapInArrow(digests, "depth long, f1 long, f2 long, ends_sha256 string")


def _one_text_per_number(turns: DataFrame) -> bool:
    """Whether no two stored turns of other role or text have the same numbers."""
    distinct = turns.select("t1", "t2", "role", "text").distinct()
    return distinct.groupBy("t1", "t2").count().where("count > 1").isEmpty()


def _grouped(turns: DataFrame, bases: tuple[int, int]) -> tuple[DataFrame, DataFrame, bool]:
    """Rows of rebuilt prefixes, their nodes, and whether each node has one parent."""
    order = ["conv_id", "turn", "role", "text", "copy"]
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "t1", "t2", "size")
    scanned = stored(ordered.mapInArrow(_scan(bases), SCANNED), "trie-turns")
    rows = stored(_rebuilt(_completed(scanned, bases), bases), "trie-rows")
    least = {c: F.min(c) for c in ("p1", "p2", "size")}
    one = F.lit(True)
    for c in least:
        one = one & (F.min(c) == F.max(c))
    nodes = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        *[v.alias(c) for c, v in least.items()],
        one.alias("one"),
    )
    nodes = stored(nodes, "trie-nodes")
    return rows, nodes.drop("one"), nodes.where(~F.col("one")).isEmpty()


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256 of every node of the trie.

    Turns are ordered by turn (null first), rows of one turn by role and text; a null role
    or text is empty. Repeated rows are turns of their own. Rows without a conv_id belong to
    no conversation and are left out; other columns, whatever their names, are ignored.
    Without conversations there is no node, not even a root. The remainder of a negative
    conv_id is negative, as in SQL.
    """
    kept = conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("copy"),  # deals equal rows to several tasks
    )
    for seed, *bases in ATTEMPTS:
        turns = kept.select("*", *turn_numbers(seed), F.octet_length("text").cast("long").alias("size"))
        if not _one_text_per_number(turns):
            continue
        rows, nodes, sound = _grouped(turns, tuple(bases))
        if sound:
            return _described(rows, nodes)
    raise RuntimeError("unequal conversations share their fingerprints in every attempt")


def _described(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    kids = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2")
    ).agg(F.count("*").alias("n_children"))
    known = nodes.join(kids, NODE, "left").withColumns(
        {
            "n_children": F.coalesce("n_children", F.lit(0)).cast("long"),
            "saved": (F.col("n_convs") - 1) * F.col("size"),
            "block": F.floor(F.col("depth") / BLOCK),
        }
    )
    known = stored(known, "trie-known")

    # A path: the nodes of one smallest member, in blocks of depths.
    leaf = (F.col("n_children") == 0).cast("long")
    blocks = known.groupBy("conv_id", "block").agg(
        F.sum("saved").alias("in_block"), F.sum(leaf).alias("leaves"), F.min("depth").alias("top")
    )
    path = F.sum("in_block").over(_window("conv_id"))
    blocks = blocks.withColumns(
        {
            "after": F.sum("in_block").over(_window("conv_id", F.desc("block"))) - F.col("in_block"),
            "path": path,
            "leaves": F.sum("leaves").over(_window("conv_id")),
            "top": F.min("top").over(_window("conv_id")),
        }
    )
    paths = blocks.groupBy("conv_id").agg(F.max("path").alias("path"), F.max("leaves").alias("leaves"))
    below = rows.join(paths, "conv_id").groupBy(*NODE).agg(F.sum("path").alias("paths"), F.sum("leaves").alias("n_leaves"))

    rest = F.sum("saved").over(_window("conv_id", F.desc("depth"), "block"))
    known = known.join(blocks.select("conv_id", "block", "after", "path", "top"), ["conv_id", "block"])
    known = known.withColumn("rest", rest + F.col("after"))
    # The parent of all nodes of a path but the first is on the same path.
    first = known.where("depth = top AND depth > 1").select("conv_id", "depth", F.col("p1").alias("f1"), F.col("p2").alias("f2"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), "f1", "f2", F.col("conv_id").alias("above"))
    first = first.join(above, NODE).select("conv_id", "depth", "above")
    root = nodes.agg(F.min("conv_id")).first()[0]  # the smallest of all ids
    full = (
        known.join(below, NODE)
        .join(_ends(rows), NODE, "left")
        .join(first, ["conv_id", "depth"], "left")
    )
    parent = F.when(F.col("depth") == 1, F.lit(root)).when(F.col("depth") > 1, F.coalesce("above", "conv_id"))
    return full.select(
        "conv_id",
        "depth",
        parent.alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("rest") + F.col("paths") - F.col("path")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def _window(key: str, order: Column | None = None, *more: str):
    by = Window.partitionBy(key, *more)
    return by if order is None else by.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
