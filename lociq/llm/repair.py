"""Conversation structure repair: damage by rule, faults, and the cheapest edits that give roles (s?(ua)+)?, ties by the ASCII-least audit.

A conversation's rows are ordered by turn (nulls first), then role initial and a hash of role and text. A range sort numbers them, so a conversation
is blocks of at most `BLOCK` rows in their order, a long one many blocks in many tasks; only 32 bytes of hash stand for a text until the end.

States are what the repaired roles so far end with: nothing, s, u or a. Cost DP: a block is a 4 x 4 matrix of least costs (min-plus), blocks of
a long conversation are chained from its end, and then each block knows the cost to go at each of its nodes (row, state). An arc is
optimal where its cost and the cost to go behind it give that of its node.

Prefix-doubling path ranking: arcs that leave a node have different letters (D, I, K, R), so the least letter of a node's optimal arcs ranks
it by its first letter and sets its pointer. Ranks by twice as many letters are those of pairs (own rank, rank at the pointer), pointers are doubled,
until all audits have ended. The least audit is read off by the doubled pointers. A block's pointers map each state on entry to one on exit; chained forward,
they give each block of a long conversation its own.

Hashing a repaired conversation needs its texts in order, so they pass through one task, a row at a time; SHA-256 can't be split. All else of a long
conversation is spread.

Nulls of conv_id, turn, role and text count as one space (so a null text is blank); a null conv_id is a conversation of its own. Rows that repeat are duplicates.
Other roles than system, user and assistant keep their text; only their first character counts. Conversations without rows after damage have zeros, an empty
audit and the empty text's hash. A gap beyond a long is null. An empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, stored

#: The contract's costs, letters in ASCII order, and the roles that edits give.
DELETE, INSERT, REROLE, CUT_OFF = 4, 3, 3, 3
LETTERS = "DIKR"
USER, ASSISTANT = "user", "assistant"
#: Rows of a block at most, and of blocks that are worked on at once.
BLOCK, MANY = 256, 8192
SPACES = " \t\n\x0b\f\r"
#: States: nothing yet, s, u, a; what an inserted or renamed message leads to; where a row kept by its initial leads to (other: -1).
NONE, S, U, A = range(4)
NEXT = np.array([U, U, A, U])
KEPT = {"s": [S, -1, -1, -1], "u": [U, U, -1, U], "a": [-1, -1, A, -1]}
FAR = 1 << 40
FINAL = np.array([0, 2 * INSERT, INSERT, 0], np.int64)


def blanked(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def rows_of(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text, n (equal rows beside each other) after damage; conv and the text hold a space for null."""
    conv, turn = F.col("conv_id"), F.col("turn")
    fault = F.pmod(F.crc32(F.concat(blanked("conv_id"), F.lit(":"), blanked("turn")).cast("binary")), F.lit(20))
    text = F.when(fault == 1, "").when(fault == 2, F.translate(blanked("text"), ".!?", "")).otherwise(blanked("text"))
    role = F.when(fault == 4, USER).otherwise(blanked("role"))
    return conversations.where(fault != 0).select(F.coalesce(conv.cast("string"), F.lit(" ")).alias("conv"), turn.cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.when(fault == 3, 2).otherwise(1).cast("long").alias("n"))


def key() -> Column:
    """Stands for role and text."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))


def faults(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one: conv, turn, key, initial, live (0 or 1 row that may stay), gone (rows that go), blank, duplicate, truncated."""
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = rows.select("conv", "turn", key().alias("key"), F.substring("role", 1, 1).alias("initial"), (end == "").alias("empty"), ~F.substring(end, -1, 1).isin(".", "!", "?") & (end != ""), "n")
    rows = rows.toDF("conv", "turn", "key", "initial", "empty", "open", "n")
    rows = stored(rows.groupBy("conv", "turn", "key", "initial", "empty", "open").agg(F.sum("n").alias("n")))
    # A struct orders nulls first.
    first = rows.where("not empty").groupBy("conv", "key").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1").select("conv", "key", F.col("first.turn").alias("first_turn"), F.lit(True).alias("known"))
    rows = rows.join(first, ["conv", "key"], "left")
    new = F.col("known").isNull() | F.col("turn").eqNullSafe(F.col("first_turn"))
    live = (~F.col("empty") & new).cast("long")
    gone = F.col("n") - live
    return rows.select("conv", "turn", "key", "initial", live.alias("live"), gone.alias("gone"), F.when(F.col("empty"), F.col("n")).otherwise(0).alias("blank"), F.when(F.col("empty"), 0).otherwise(gone).alias("duplicate"), F.when(F.col("open"), live).otherwise(0).alias("truncated"))


def blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv, block, the rows in order as one array, and whether it is the conversation's last and only block."""
    keys = ["conv", F.col("turn").asc_nulls_first(), "initial", "key"]
    at = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()))
    row = F.struct("at", "turn", "key", "initial", "live", "gone", "blank", "duplicate", "truncated")
    found = stored(at.groupBy("conv", F.floor(F.col("at") / block).alias("block")).agg(F.sort_array(F.collect_list(row)).alias("rows")))
    long = found.groupBy("conv").agg(F.max("block").alias("end"), F.count(F.lit(1)).alias("parts")).where("parts > 1").drop("parts")
    return stored(found.join(long, "conv", "left").select("conv", "block", "rows", F.coalesce(F.col("block") == F.col("end"), F.lit(True)).alias("last"), F.col("end").isNull().alias("only")))


class Nodes:
    """The nodes of several blocks: a node row for each row and one behind each block's last, four states each."""

    def __init__(self, rows: pa.ListArray, last: np.ndarray) -> None:
        sizes = pc.list_value_length(rows).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.list_flatten(rows)
        number = lambda c: flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]  # a block's first node row
        self.close, self.last, self.flat, self.n = self.first + sizes, last, flat, int((sizes + 1).sum())
        self.row = np.ones(self.n, bool)
        self.row[self.close] = False  # node rows that hold a row
        self.live, self.gone, self.cut = (np.zeros(self.n, np.int64) for _ in range(3))
        self.live[self.row], self.gone[self.row], self.cut[self.row] = number("live"), number("gone"), number("truncated")
        initial = pc.fill_null(pc.index_in(flat.field("initial"), pa.array(list(KEPT))), len(KEPT)).to_numpy(zero_copy_only=False)
        self.kept = np.full((self.n, 4), -1)
        self.kept[self.row] = np.array([*KEPT.values(), [-1] * 4])[initial]
        self.kept[self.live == 0] = -1

    def steps(self) -> np.ndarray:
        """Least cost of each row's own arcs and the deletions after it, by states before and behind."""
        out = np.full((self.n, 4, 4), FAR, np.int64)
        at, s = np.arange(self.n), np.arange(4)
        out[:, s, s] = np.where(self.live, DELETE, 0)[:, None]
        for a in s:
            out[:, a, NEXT[a]] = np.minimum(out[:, a, NEXT[a]], np.where(self.live, REROLE + CUT_OFF * self.cut, FAR))
            to = np.where(self.kept[:, a] < 0, a, self.kept[:, a])
            out[at, a, to] = np.minimum(out[at, a, to], np.where(self.kept[:, a] < 0, FAR, CUT_OFF * self.cut))
        out += (DELETE * self.gone)[:, None, None]
        return np.minimum((INSERTS[:, :, None] + out[:, None, :, :]).min(axis=2), FAR)

    def suffixes(self) -> np.ndarray:
        """Cost from each node to each state behind its block's last row, by doubling."""
        out = self.steps()
        out[self.close] = CLOSED
        until = np.repeat(self.close, np.diff(np.append(self.first, self.n)))
        reach, at = np.minimum(np.arange(self.n) + 1, until), np.arange(self.n)
        while (reach < until).any():
            more = at[reach < until]
            out[more] = times(out[more], out[reach[more]])
            reach[more] = reach[reach[more]]
        return out

    def paths(self, to_go: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Letter and pointer of each node (flattened; an end points to itself and has letter -1), and the rank of its audit in the block.

        to_go: cost to go at each node.
        """
        flat_cost, ids = to_go.ravel(), np.arange(self.n * 4).reshape(self.n, 4)
        letter, pointer = np.full(self.n * 4, -1), ids.ravel().copy()
        behind = np.minimum(np.arange(self.n) + 1, self.n - 1)
        own, extra = self.row[:, None], DELETE * self.gone[:, None]
        open_end = np.zeros(self.n, bool)
        open_end[self.close] = self.last
        move = np.broadcast_to(NEXT, (self.n, 4))
        arcs = {  # whether there, to, cost; rows that go anyway go with the row before them, or as it
            "D": (own, ids[behind], np.where(self.live[:, None] == 1, DELETE, 0) + extra),
            "I": (own | open_end[:, None], ids[np.arange(self.n)[:, None], move], np.full((self.n, 1), INSERT)),
            "K": (self.kept >= 0, ids[behind[:, None], self.kept], CUT_OFF * self.cut[:, None] + extra),
            "R": (own & (self.live[:, None] == 1), ids[behind[:, None], move], REROLE + CUT_OFF * self.cut[:, None] + extra),
        }
        for k in range(len(LETTERS) - 1, -1, -1):  # the least letter last
            there, to, cost = arcs[LETTERS[k]]
            best = there & (flat_cost[to] + cost == to_go) & (to_go < FAR)
            letter[best.ravel()], pointer[best.ravel()] = k, to[best]
        rank, jump = letter + 1, pointer
        self.jumps = [pointer]
        while (jump != jump[jump]).any():
            _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[jump], return_inverse=True)
            jump = jump[jump]
            self.jumps.append(jump)
        return letter, pointer, rank

    def audits(self, letter: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of each block's least path from its entry state in their order, and their blocks; ends are left out."""
        path = (self.first * 4 + entry)[:, None]
        for jump in self.jumps:  # the first 2**k nodes, moved by 2**k, are the next as many
            path = np.concatenate([path, jump[path]], axis=1)
        some = letter[path] >= 0
        return path[some], np.nonzero(some)[0]


def closure() -> tuple[np.ndarray, np.ndarray]:
    """Least cost of insertions from state to state, and of none."""
    none = np.full((4, 4), FAR, np.int64)
    none[range(4), range(4)] = 0
    out = none.copy()
    for a in range(4):
        state, cost = a, 0
        for _ in range(3):
            state, cost = NEXT[state], cost + INSERT
            out[a, state] = min(out[a, state], cost)
    return out, none


INSERTS, CLOSED = closure()


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus products of matrices."""
    return np.minimum((a[:, :, :, None] + b[:, None, :, :]).min(axis=2), FAR)


def by_rows(batch: pa.RecordBatch, most: int = MANY) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of blocks with about `most` rows together."""
    ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False) + 1)
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def nodes_of(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Nodes]]:
    """Of batches with conv, block, rows, last."""
    for part in by_rows(batch):
        yield part, Nodes(part.column(2), part.column(3).to_numpy(zero_copy_only=False).astype(bool))


def lists(a: pa.Array, width: int = 4) -> np.ndarray:
    return pc.list_flatten(a).to_numpy(zero_copy_only=False).reshape(-1, width)


def to_go(nodes: Nodes, ends: np.ndarray) -> np.ndarray:
    """Cost to go at each node, from that behind each block."""
    end = np.repeat(ends, np.diff(np.append(nodes.first, nodes.n)), axis=0)
    return (nodes.suffixes() + end[:, None, :]).min(axis=2)


def matrices(batch: pa.RecordBatch) -> Iterator[dict]:
    for part, nodes in nodes_of(batch):
        yield {"conv": part.column(0), "block": part.column(1), "last": part.column(3), "m": list(nodes.suffixes()[nodes.first].reshape(-1, 16))}


def exits(batch: pa.RecordBatch) -> Iterator[dict]:
    """The state behind each block by that before it; batches have the cost to go behind it in their last column."""
    for part, nodes in nodes_of(batch):
        nodes.paths(to_go(nodes, lists(part.column(4))))
        yield {"conv": part.column(0), "block": part.column(1), "out": list(nodes.jumps[-1][nodes.first[:, None] * 4 + np.arange(4)] % 4)}


def chained(parts: DataFrame, backward: bool) -> DataFrame:
    """conv, block, state: what goes from block to block of a conversation. Backward: the cost to go behind a block, from its matrix; else the
    state before it, from its exits. A row a block, in a task a conversation."""
    parts = parts.repartition("conv").sortWithinPartitions("conv", F.col("block").desc() if backward else F.col("block"))

    def f() -> object:
        conv, state = None, None

        def g(batch: pa.RecordBatch) -> Iterator[dict]:
            nonlocal conv, state
            steps, out = lists(batch.column(2), 16 if backward else 4), []
            for name, step in zip(batch.column(0).to_pylist(), steps):
                if name != conv:
                    conv, state = name, FINAL if backward else NONE
                out.append(state)
                state = (step.reshape(4, 4) + state).min(axis=1) if backward else int(step[state])
            yield {"conv": batch.column(0), "block": batch.column(1), "state": out}

        return g

    columns = parts.select("conv", "block", "m" if backward else "out")
    return map_arrow(columns, f, f"conv string, block long, state {'array<long>' if backward else 'long'}", once_a_task=True)


EDITED = "conv string, block long, audit string, cost long, blank long, duplicate long, truncated long, illegal long, turns long, first_turn long, last_turn long, least_turn long, first_initial string, last_initial string, places array<long>, roles array<string>, keys array<binary>"


def edited(batch: pa.RecordBatch) -> Iterator[dict]:
    """Of blocks with the cost to go behind and the state before them: audits, repaired rows (place, new role, key of the kept text), counts."""
    for part, nodes in nodes_of(batch):
        entry, flat = part.column(5).to_numpy(zero_copy_only=False), nodes.flat
        cost = to_go(nodes, lists(part.column(4)))
        letter, pointer, _ = nodes.paths(cost)
        path, block = nodes.audits(letter, entry)
        k, row = letter[path], path // 4
        # Rows that go anyway: after the row that they repeat, or in its place.
        gone = np.where(LETTERS.index("I") == k, 0, nodes.gone[row] - ((nodes.live[row] == 0) & nodes.row[row]))
        shown = [LETTERS[x] + "D" * n for x, n in zip(k, gone)]
        cuts = np.searchsorted(block, np.arange(len(nodes.first) + 1))
        audit = ["".join(shown[a:b]) for a, b in zip(cuts, cuts[1:])]
        # Repaired rows: all but deletions.
        stays = k > 0
        path, k, row, behind, of = path[stays], k[stays], row[stays], pointer[path[stays]] % 4, block[stays]
        source = np.cumsum(nodes.row) - 1  # a node row's place among the rows; that behind the last row takes the last's
        rows_at = flat.field("at").to_numpy(zero_copy_only=False)[np.maximum(source[row], 0)]
        inserted = LETTERS.index("I") == k
        order = np.where(inserted, np.where(nodes.row[row], 0, 4) + np.where(np.append(False, inserted[:-1] & (row[1:] == row[:-1])), 1, 0), 3)
        kept = LETTERS.index("K") == k
        keys = pc.if_else(pa.array(inserted), pa.scalar(None, pa.binary()), flat.field("key").take(pa.array(np.maximum(source[row], 0))))
        roles = pc.if_else(pa.array(kept), pa.scalar(None, pa.string()), pa.array(np.array(["", "", USER, ASSISTANT], object)[behind], pa.string()))
        offsets = pa.array(np.searchsorted(of, np.arange(len(nodes.first) + 1)).astype(np.int32))
        each = lambda x: pa.ListArray.from_arrays(offsets, x)
        yield {"conv": part.column(0), "block": part.column(1), "audit": audit, "cost": cost.ravel()[nodes.first * 4 + entry], "places": each(pa.array(rows_at * 8 + order)), "roles": each(roles), "keys": each(keys)} | counts(nodes)


def counts(nodes: Nodes) -> dict:
    """A block's faults, and what its ends need to be joined to the blocks beside it."""
    flat, begins = nodes.flat, nodes.first - np.arange(len(nodes.first))
    ends = nodes.close - np.arange(len(nodes.close)) - 1
    total = lambda x: np.add.reduceat(np.asarray(x, np.int64), begins)
    number = lambda c: flat.field(c).to_numpy(zero_copy_only=False)
    initial = np.array(flat.field("initial").to_pylist(), object)
    inside = np.ones(len(initial), bool)
    inside[begins] = False
    pairs = np.append([""], initial[:-1]) + initial
    turn, known = pc.fill_null(flat.field("turn"), 0).to_numpy(zero_copy_only=False), pc.is_valid(flat.field("turn")).to_numpy(zero_copy_only=False)
    new = known & ~(inside & np.append(False, known[:-1] & (turn[1:] == turn[:-1])))
    turns = flat.field("turn")
    first_known = np.minimum(begins + total(~known), ends)  # nulls come first
    return {
        **{c: total(number(c)) for c in ("blank", "duplicate", "truncated")},
        "illegal": total(inside & ~np.isin(pairs.astype(str), ["su", "ua", "au"])) + total(number("live") + number("gone") - 1), "turns": total(new), "first_turn": turns.take(pa.array(begins)), "last_turn": turns.take(pa.array(ends)), "least_turn": turns.take(pa.array(first_known)),
        "first_initial": pa.array(initial[begins], pa.string()), "last_initial": pa.array(initial[ends], pa.string()),
    }


def hashed(messages: DataFrame) -> DataFrame:
    """conv, repaired_sha256 of messages(conv, place, role, text): a conversation's messages in order, a row at a time. A place that repeats counts once."""
    messages = messages.repartition("conv").sortWithinPartitions("conv", "place")

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, last, state = None, None, None
        out: list[tuple[str, str]] = []
        for batch in batches:
            for name, place, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if name != conv:
                    if state:
                        out.append((conv, state.hexdigest()))
                    conv, last, state = name, None, hashlib.sha256()
                if place != last:
                    state.update((b"" if last is None else b"\n") + role.encode() + b":" + text.encode())
                    last = place
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*out)], names=["conv", "repaired_sha256"])
                out = []
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([state.hexdigest()])], names=["conv", "repaired_sha256"])

    return messages.mapInArrow(f, "conv string, repaired_sha256 string")


def repaired_blocks(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    all_blocks = blocks(faults(rows_of(conversations)), block)
    long = all_blocks.where("not only").drop("only")
    ends = stored(chained(map_arrow(long, matrices, "conv string, block long, last boolean, m array<long>"), True))
    long = long.join(ends, ["conv", "block"])
    entries = stored(chained(map_arrow(long, exits, "conv string, block long, out array<long>"), False).withColumnRenamed("state", "entry"))
    whole = all_blocks.where("only").drop("only").select("*", F.array(*(F.lit(int(x)).cast("long") for x in FINAL)).alias("state"), F.lit(NONE).cast("long").alias("entry"))
    return stored(map_arrow(whole.unionByName(long.join(entries, ["conv", "block"])), edited, EDITED))


def repaired_rows(conversations: DataFrame, done: DataFrame) -> DataFrame:
    """conv, place, role, text of the repaired conversations; a place may come more than once, with equal values."""
    some = done.select("conv", F.explode(F.arrays_zip("places", "roles", "keys")).alias("m")).select("conv", F.col("m.places").alias("place"), F.col("m.roles").alias("new_role"), F.col("m.keys").alias("key"))
    texts = rows_of(conversations).select(F.col("conv").alias("of"), key().alias("text_key"), "role", "text")
    found = some.join(texts, (F.col("conv") == F.col("of")) & (F.col("key") == F.col("text_key")), "left")
    return found.select("conv", "place", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def repair(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation."""
    done = repaired_blocks(conversations, block)
    before = Window.partitionBy("conv").orderBy("block")
    lag = lambda c: F.lag(c).over(before)
    joined = done.drop("places", "roles", "keys").withColumn("pair", lag("last_initial")).withColumn("turn_before", lag("last_turn"))
    illegal = F.col("illegal") + (F.col("pair").isNotNull() & ~F.concat("pair", "first_initial").isin("su", "ua", "au")).cast("long")
    turns = F.col("turns") - F.coalesce(F.col("turn_before") == F.col("first_turn"), F.lit(False)).cast("long")
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")] + [F.sum(illegal).alias("illegal"), F.max("cost").alias("cost")]
    wide = lambda c: c.cast("decimal(38,0)")
    gaps = F.coalesce(wide(F.max("last_turn")) - wide(F.min("least_turn")) + 1 - wide(F.sum(turns)), F.lit(0))
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "")
    each = joined.groupBy("conv").agg(gaps.try_cast("long").alias("gaps"), F.lit(True).alias("there"), *sums, audit.alias("audit"))
    every = conversations.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    out = every.join(each, "conv", "left").join(hashed(repaired_rows(conversations, done)), "conv", "left")
    zero = lambda c: F.when(F.col("there"), F.col(c)).otherwise(0).cast("long").alias(c)
    return out.select("conv_id", *(zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
