"""Least-cost repair of conversations whose turns are blank, repeated, cut off or out of order.

Turns are kept, given the role that is due (`user` or `assistant`), deleted, and empty turns inserted, until
the roles read `(s?(ua)+)?` by their initials. Prefix-doubling path ranking: a dynamic programme gives
every node (turns consumed, state of the grammar) its cost to the end, and the arcs that lie on cheapest
paths remain. Nodes are ranked by their least audits of 1, 2, 4, ... letters: the rank of twice the
length comes from a node's rank and that of the node its doubled pointer leads to, until whole audits
are ranked. Ranks choose a node's arc, and doubled pointers walk the least path. No two arcs of a node
share a letter (the role that an edit gives follows from the state), so a least audit of any length ends in
one node, and what follows a block never changes the choice inside it.

Scale: turns are numbered over many tasks and cut into blocks of at most BLOCK; a block is a row of one
small code per turn. Blocks of a long conversation are joined by doubling too: their 4 x 4 cost matrices
give each block its costs to the end, and their maps from entry to exit state give it its entry. First
appearances of repeated turns are combined before the shuffle. Texts move twice and are never gathered: the
last step reads each conversation in order, feeds the repaired turns to a running SHA-256 and holds only the
audit. That pass is one task per conversation, however long, since SHA-256 of a text is sequential and
the audit is one value.

Edge cases: NULL role or text counts as one space, in the repaired text too. NULL turns come first; turns
with equal numbers are ordered by role, then by the SHA-256 of their text, so repeated rows are adjacent
and interchangeable. A NULL conversation id is a conversation. Roles other than the three are judged by their
first character and can be kept if that is s, u or a; an empty role has none. Texts may be of any
length. Each conversation of the input has its row, also if damage left nothing. An empty table gives an
empty result; other columns are ignored, whatever they are called.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.support import numbered, written

BLOCK = 1024
TURNS_AT_ONCE = 50_000
BLANKS = " \t\n\x0b\f\r"
FAR = 1 << 40  # more than any cost; sums of a few stay far below 2**63
# states of the grammar: nothing yet, after s, after u, after a
KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])  # by initial s, u, a, other
DUE = np.array([2, 2, 3, 2])  # the state after the role that is due
END_COST = np.array([0, 6, 3, 0])  # inserts that finish a conversation
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)  # in ASCII order; 0 marks a block's end
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
COSTS = {"D": 4, "I": 3, "K": 0, "R": 3}
CUT_OFF = 3  # for a turn that stays truncated
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)


def last_character(text: Column) -> Column:
    return F.substring(F.rtrim(text, F.lit(BLANKS)), -1, 1)


def fault(last: Column, seen: Column) -> Column:
    """The first fault of a turn, as a number, by its last character that isn't blank ("" for none)."""
    cut_off = ~last.isin(".", "!", "?")
    return F.when(last == "", BLANK).when(seen, DUPLICATE).when(cut_off, TRUNCATED).otherwise(NONE)


def initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


class Lattice:
    """Nodes (turn, state) of many blocks: a block of n turns has 4 (n + 1) nodes, its last four are its end."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray) -> None:
        self.lengths = lengths
        self.first = np.cumsum(lengths + 1) - (lengths + 1)  # a block's first row of nodes
        rows = int((lengths + 1).sum())
        self.is_end = np.zeros(rows, bool)
        self.is_end[self.first + lengths] = True
        code = np.zeros(rows, np.int64)
        code[~self.is_end] = codes
        self.initial, self.fault = code >> 2, code & 3
        open_ = np.where(self.fault == TRUNCATED, CUT_OFF, 0)
        open_ = np.where((self.fault == BLANK) | (self.fault == DUPLICATE), FAR, open_)
        self.kept = KEPT[:, self.initial].T  # row, state -> state or -1
        self.keep_cost = np.where(self.kept >= 0, open_[:, None], FAR)
        self.role_cost = np.minimum(open_ + COSTS["R"], FAR)[:, None] + np.zeros((1, 4), np.int64)

    def costs(self, ends: np.ndarray) -> np.ndarray:
        """Cost to the end of every node (row, state), for `ends` (block, state) at the blocks' ends.

        A step per turn, counted from the end, over all blocks at once.
        """
        cost = np.full((len(self.is_end), 4), FAR, np.int64)
        cost[self.first + self.lengths] = ends
        order = np.argsort(-self.lengths, kind="stable")
        last, longest = (self.first + self.lengths)[order], self.lengths[order]
        for back in range(1, int(longest[0]) + 1 if len(longest) else 0):
            row = last[: np.searchsorted(-longest, -back, "right")] - back
            after = cost[row + 1]
            kept = np.take_along_axis(after, np.maximum(self.kept[row], 0), 1) + self.keep_cost[row]
            best = np.minimum(after + COSTS["D"], np.minimum(kept, after[:, DUE] + self.role_cost[row]))
            for _ in range(2):  # more inserts in a row never help
                best = np.minimum(best, best[:, DUE] + COSTS["I"])
            cost[row] = np.minimum(best, FAR)
        return cost

    def arcs(self, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Targets (node, letter - 1) of the arcs on cheapest paths, -1 for none, and which nodes are ends."""
        rows = np.arange(len(self.is_end))[:, None]
        after = np.concatenate([cost[1:], np.full((1, 4), FAR)])
        below = np.minimum(rows + 1, len(rows) - 1)
        state = np.arange(4)[None, :]
        target = np.full((len(rows), 4, 4), -1, np.int64)
        kept = np.take_along_axis(after, np.maximum(self.kept, 0), 1) + self.keep_cost
        for letter, spent, to in (
            (DELETE, after + COSTS["D"], 4 * below + state),
            (INSERT, cost[:, DUE] + COSTS["I"], 4 * rows + DUE[None, :]),
            (KEEP, kept, 4 * below + np.maximum(self.kept, 0)),
            (REROLE, after[:, DUE] + self.role_cost, 4 * below + DUE[None, :]),
        ):
            target[:, :, letter - 1] = np.where((spent == cost) & (cost < FAR), to, -1)
        target[self.is_end] = -1
        return target.reshape(-1, 4), np.repeat(self.is_end, 4)


def ranked_paths(target: np.ndarray, is_end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The chosen letter of every node, pointers of 1, 2, 4, ... steps along the least audits, and their lengths.

    `target` has a node's arcs by letter. Ends and nodes without arcs point to themselves and have letter 0.
    """
    nodes = len(target)
    stay = np.arange(nodes)
    has = target >= 0
    letter = np.where(has.any(1), has.argmax(1) + 1, 0)
    pointer = np.where(letter > 0, target[stay, np.maximum(letter - 1, 0)], stay)
    rank, span = letter.astype(np.int64), pointer
    while True:  # ranks of twice the length
        new = np.unique(rank * (nodes + 1) + rank[span], return_inverse=True)[1]
        settled = bool((is_end[span] | (span == stay)).all())
        rank, span = new, span[span]
        if settled:
            break
    # of a node's arcs, the least letter and then the least audit behind it
    cost = np.where(has, (np.arange(4) + 1) * (nodes + 1) + rank[np.maximum(target, 0)], np.iinfo(np.int64).max)
    choice = cost.argmin(1)
    letter = np.where(has.any(1), choice + 1, 0)
    pointers = [np.where(letter > 0, target[stay, choice], stay)]
    steps = (letter > 0).astype(np.int64)
    while (pointers[-1] != pointers[-1][pointers[-1]]).any():
        steps = steps + steps[pointers[-1]]
        pointers.append(pointers[-1][pointers[-1]])
    return letter, pointers, steps


def audits(lattice: Lattice, ends: np.ndarray, entry: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Each block's least cheapest audit from its entry state, and the state it ends in."""
    letter, pointers, steps = ranked_paths(*lattice.arcs(lattice.costs(ends)))
    start = 4 * lattice.first + entry
    length = steps[start]
    node = np.repeat(start, length)
    nth = np.arange(len(node)) - np.repeat(np.cumsum(length) - length, length)
    for bit, pointer in enumerate(pointers):
        node = np.where(nth >> bit & 1 == 1, pointer[node], node)
    text = LETTERS[letter[node]].tobytes().decode()
    stop = np.cumsum(length)
    return [text[b - n : b] for b, n in zip(stop, length, strict=True)], pointers[-1][start] % 4


def _portions(batches: Iterator[pa.RecordBatch], most: int = TURNS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The blocks of the batches, about `most` turns at a time."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column("codes")).to_numpy(zero_copy_only=False)
        portion = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(portion)) + 1), len(sizes)]
        for begin, end in zip(cuts, cuts[1:]):
            if end > begin:
                yield batch.slice(begin, end - begin)


def _lattice(batch: pa.RecordBatch) -> Lattice:
    codes = batch.column("codes")
    return Lattice(
        codes.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
        pc.list_value_length(codes).to_numpy(zero_copy_only=False).astype(np.int64),
    )


def _lists(values: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values.reshape(-1), pa.int64()), values.shape[1]).cast(pa.list_(pa.int64()))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs from each state at a block's start to each at its end."""
    for batch in _portions(batches):
        lattice = _lattice(batch)
        to = [lattice.costs(np.where(np.arange(4) == end, 0, FAR) + np.zeros((len(batch), 1), int)) for end in range(4)]
        found = np.stack([cost[lattice.first] for cost in to], 2).reshape(-1, 16)
        yield pa.record_batch([*batch.select(["conv_id", "block"]).columns, _lists(found)], ["conv_id", "block", "m"])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which a block ends, for each it may be entered in."""
    for batch in _portions(batches):
        lattice, ends = _lattice(batch), _ends(batch)
        found = np.stack([audits(lattice, ends, np.full(len(batch), entry))[1] for entry in range(4)], 1)
        yield pa.record_batch([*batch.select(["conv_id", "block"]).columns, _lists(found)], ["conv_id", "block", "m"])


def _ends(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("ends").flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _portions(batches):
        entry = batch.column("entry").to_numpy(zero_copy_only=False).astype(np.int64)
        text, out = audits(_lattice(batch), _ends(batch), entry)
        # the inserts behind the last turn
        last = batch.column("last").to_pylist()
        text = [one + "I" * (END_COST[q] // 3) * is_last for one, q, is_last in zip(text, out, last, strict=True)]
        names = ["conv_id", "block", "entry", "codes"]
        yield pa.record_batch([*batch.select(names).columns, pa.array(text, pa.string())], [*names, "audit"])


def _doubled(parts: DataFrame, most: int, step: int, product: str) -> DataFrame:
    """`m` of each block combined with those of all blocks before (step -1) or after it (step 1)."""
    reach = 1
    while reach < most:
        other = parts.select(
            F.col("conv_id").alias("_conv"), (F.col("block") - step * reach).alias("_block"), F.col("m").alias("n")
        )
        same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
        combined = F.when(F.col("n").isNull(), F.col("m")).otherwise(F.expr(product))
        parts = written(parts.join(other, same, "left").select("conv_id", "block", combined.alias("m")), "doubled-blocks")
        reach *= 2
    return parts


# costs through a block and then through those after it; states through earlier blocks and then a block
THROUGH = (
    f"transform(sequence(0, 15), x -> least({FAR}L, array_min(transform(sequence(0, 3), j -> "
    "m[cast(x div 4 as int) * 4 + j] + n[j * 4 + x % 4]))))"
)
THEN = "transform(n, x -> m[cast(x as int)])"
TO_END = f"transform(sequence(0, 3), q -> array_min(transform(sequence(0, 3), j -> n[q * 4 + j] + array({','.join(map(str, END_COST))})[j])))"


def _joined_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks with `ends`, the costs from their end to that of the conversation, and `entry`, the state before them."""
    finish = F.array(*[F.lit(int(cost)).cast("bigint") for cost in END_COST])
    alone = blocks.where("blocks = 1").select("*", finish.alias("ends"), F.lit(0).cast("bigint").alias("entry"))
    most = blocks.agg(F.max("blocks")).first()[0] or 0
    if most <= 1:
        return alone
    several = blocks.where("blocks > 1")
    key = several.schema["conv_id"]
    kind = T.StructType([key, T.StructField("block", T.LongType()), T.StructField("m", T.ArrayType(T.LongType()))])

    def beside(found: DataFrame, shift: int) -> DataFrame:
        """Each of `several` with the `m` of the block `shift` after it, as n."""
        other = found.select(F.col("conv_id").alias("_conv"), (F.col("block") - shift).alias("_block"), F.col("m").alias("n"))
        same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
        return several.join(other, same, "left").drop("_conv", "_block")

    matrices = written(several.select("conv_id", "block", "codes").mapInArrow(_matrices, kind), "block-costs")
    after = beside(_doubled(matrices, most, 1, THROUGH), 1)
    ends = F.when(F.col("n").isNull(), finish).otherwise(F.expr(TO_END))
    several = written(after.withColumn("ends", ends).drop("n"), "block-ends")
    exits = written(several.select("conv_id", "block", "codes", "ends").mapInArrow(_exits, kind), "block-exits")
    before = beside(_doubled(exits, most, -1, THEN), -1)
    return alone.unionByName(before.withColumn("entry", F.coalesce(F.col("n")[0], F.lit(0))).drop("n"))


ROLES = {2: "user", 3: "assistant"}


class _Repair:
    """One conversation's running figures and hash."""

    def __init__(self) -> None:
        self.low = self.high = self.turn = None
        self.turns, self.faults, self.illegal, self.cost = 0, [0] * 4, 0, 0
        self.before: str | None = None  # initial of the turn before
        self.audit: list[str] = []
        self.hash, self.any_line = hashlib.sha256(), False
        self.letters, self.codes, self.at, self.state = "", [], 0, 0

    def line(self, text: str) -> None:
        self.hash.update((("\n" if self.any_line else "") + text).encode())
        self.any_line = True

    def block(self, audit: str, codes: list[int], entry: int) -> None:
        self.audit.append(audit)
        self.letters, self.codes, self.at, self.state = audit, iter(codes), 0, entry
        self.cost += sum(audit.count(letter) * cost for letter, cost in COSTS.items())

    def inserts(self) -> None:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.state = int(DUE[self.state])
            self.line(f"{ROLES[self.state]}:")
            self.at += 1

    def row(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        if self.before is not None:
            self.illegal += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        self.inserts()
        code, letter = next(self.codes), self.letters[self.at]
        self.at += 1
        self.faults[code & 3] += 1
        if letter != "D":
            self.state = int(KEPT[self.state, code >> 2] if letter == "K" else DUE[self.state])
            self.line(f"{role if letter == 'K' else ROLES[self.state]}:{text}")
            self.cost += CUT_OFF * (code & 3 == TRUNCATED)
        self.inserts()

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        audit = "".join(self.audit)
        return (gaps, *self.faults[1:], self.illegal, self.cost, audit, self.hash.hexdigest())


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation from its sorted parts: a header, then each block's audit before its turns."""
    held: tuple | None = None  # the open conversation: its id, its state

    def closed(done: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        names = [part.split()[0] for part in RESULT.split(", ")]
        kinds = [pa.string() if name in ("audit", "repaired_sha256") else pa.int64() for name in names]
        columns = [pa.array([one[0] for one in done], key)]
        for i, kind in enumerate(kinds):
            columns.append(pa.array([one[1][i] for one in done], kind))
        return pa.record_batch(columns, ["conv_id", *names])

    key = pa.null()
    for batch in batches:
        done, key = [], batch.column("conv_id").type
        for conv, place, kind, turn, role, text, audit, codes, entry in zip(*[column.to_pylist() for column in batch.columns]):
            if place < 0:
                if held is not None:
                    done.append((held[0], held[1].result()))
                held = (conv, _Repair())
            elif kind == 0:
                held[1].block(audit, codes, entry)
            else:
                held[1].row(turn, role, text)
        if done:
            yield closed(done, key)
    if held is not None:
        yield closed([(held[0], held[1].result())], key)


def repaired(turns: DataFrame, conversations: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """A row per conversation: its faults, the cost and audit of its repair, and the repaired text's SHA-256.

    `turns` has conv_id, turn, role and text. `conversations` has the conv_id to report, by default those of
    `turns`; ones without turns get a row too.
    """
    slim = turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    slim = slim.select("*", F.sha2("text", 256).alias("text_id"), last_character(F.col("text")).alias("last"))
    placed = numbered(written(slim, "turns"), ["conv_id"], ["turn", "role", "text_id"], "ordered-turns")
    placed = written(placed.drop("size"), "numbered-turns")

    same = ["conv_id", "role", "text_id"]
    firsts = placed.groupBy(*same).agg(F.min("place").alias("earliest"), F.count(F.lit(1)).alias("n"))
    firsts = written(firsts.where("n > 1").drop("n").withColumnsRenamed({name: f"_{name}" for name in same}), "repeated-turns")
    meets = F.col("conv_id").eqNullSafe(F.col("_conv_id"))
    meets &= (F.col("role") == F.col("_role")) & (F.col("text_id") == F.col("_text_id"))
    judged = placed.select("conv_id", "place", "role", "text_id", "last").join(firsts, meets, "left")
    seen = F.coalesce(F.col("place") > F.col("earliest"), F.lit(False))
    code = (initial(F.col("role")) * 4 + fault(F.col("last"), seen)).cast("int")
    coded = judged.select("conv_id", "place", code.alias("code"))
    listed = coded.groupBy("conv_id", F.expr(f"place div {block}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "code")))["code"].alias("codes")
    )
    listed = written(listed, "turn-blocks")
    sizes = listed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("blocks"))
    sizes = written(sizes.withColumnRenamed("conv_id", "_conv"), "conversation-blocks")
    blocks = listed.join(sizes, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    blocks = _joined_blocks(written(blocks, "sized-blocks"))

    key = turns.schema["conv_id"]
    kind = T.StructType(
        [key, *T.StructType.fromDDL("block bigint, entry bigint, codes array<int>, audit string").fields]
    )
    is_last = (F.col("block") == F.col("blocks") - 1).alias("last")
    solved = blocks.select("conv_id", "block", "entry", "codes", "ends", is_last).mapInArrow(_audits, kind)

    def part(df: DataFrame, **columns: Column) -> DataFrame:
        kinds = T.StructType.fromDDL(
            "place bigint, kind int, turn bigint, role string, text string, audit string, codes array<int>, entry bigint"
        )
        given = {f.name: columns.get(f.name, F.lit(None)).cast(f.dataType) for f in kinds}
        return df.select("conv_id", *[value.alias(name) for name, value in given.items()])

    wanted = (turns if conversations is None else conversations).select("conv_id").distinct()
    heads = part(wanted, place=F.lit(-1), kind=F.lit(0))
    audited = part(
        solved, place=F.col("block") * block, kind=F.lit(0), audit=F.col("audit"), codes=F.col("codes"), entry=F.col("entry")
    )
    rows = part(placed, place=F.col("place"), kind=F.lit(1), turn=F.col("turn"), role=F.col("role"), text=F.col("text"))
    parts = heads.unionByName(audited).unionByName(rows)
    parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "place", "kind")
    return parts.mapInArrow(_stream, T.StructType([key, *T.StructType.fromDDL(RESULT).fields]))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns damaged by the CRC-32 of `conv_id:turn` modulo 20: 0 drops one, 1 empties its text, 2 removes
    its sentence ends, 3 repeats it, 4 gives it to the user."""
    names = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    fate = F.crc32(F.concat(names[0], F.lit(":"), names[1])) % 20
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    hurt = F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text)
    rows = turns.where(fate != 0).select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        hurt.alias("text"),
        F.when(fate == 3, 2).otherwise(1).alias("times"),
    )
    copies = rows.select("conv_id", "turn", "role", "text", F.explode(F.expr("sequence(1, times)")).alias("copy"))
    return copies.drop("copy")
