"""Merkle manifest, multi-index near copies and turn repair, each against a plain Python version."""

import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from oracle_check import difference

from tierline.llm import merkle, multi_index, turn_repair
from tierline.llm.oracle import ORACLE
from tierline.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
HEAD = "doc_id bigint, source string, lang string, n_chars int, text string, leaf int, `my place-a` map<string, int>"


@pytest.mark.parametrize(
    ("name", "table"),
    [("op11_merkle_manifest", "documents"), ("op12_multi_index", "embeddings"), ("op13_turn_repair", "conversations")],
)
def test_queries_equal_their_twins(spark, name, table):
    connection = duckdb.connect()
    connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    assert difference(QUERIES[name](spark, SF_DIR), connection, ORACLE[name]) is None


# merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def marked(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climbed(hashes, fanout):
    """The root of a list of digests, and each one's steps (left, right)."""
    steps, owner = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for i, at in enumerate(owner):
            first = at // fanout * fanout
            steps[i].append(("".join(hashes[first:at]), "".join(hashes[at + 1 : first + fanout])))
        hashes = [sha("".join(hashes[i : i + fanout])) for i in range(0, len(hashes), fanout)]
        owner = [at // fanout for at in owner]
    return hashes[0], steps


def documents(sizes):
    rows = []
    for source, size in sizes.items():
        for i in range(size):
            rows.append((i * 7 % 101, source, "en", i, f"text\n{source} {i}", 1, {"a": 1}))
    if None in sizes:  # without id, equal in all columns, of one id, without text, empty
        rows += [(None, None, None, None, None, 1, None), (None, None, None, None, None, 2, None), (3, None, None, 0, "", 3, None)]
        rows += [(3, None, None, 0, "other", 3, None), (3, None, None, 0, None, 3, None)]
    return rows


@pytest.mark.parametrize("sizes", [{None: 4, "": 1, "b": 40, "é": 9, "a": 3}, {"one": 1}, {"only": 30}])
@pytest.mark.parametrize(("fanout", "depth"), [(3, 4), (2, 2)])
def test_manifest_equals_a_plain_tree(spark, sizes, fanout, depth):
    rows = documents(sizes)
    frame = spark.createDataFrame(rows, HEAD).repartition(5)
    leaves = frame.select("doc_id", "source", merkle.digest(*[frame[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]).alias("leaf"))
    found = merkle.manifest(leaves, fanout=fanout, depth=depth)
    got = found.select("doc_id", "source", "leaf", "subroot", "root", merkle.siblings(found["proof"]), merkle.folded(found["leaf"], found["proof"]))

    def nulls_first(value):
        return (value is not None, value.encode() if isinstance(value, str) else value)

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0], marked(*row[:5])))
    trees = {}
    for source, members in groups.items():
        members.sort(key=lambda m: (nulls_first(m[0]) if m[0] is not None else (False, 0), m[1]))
        trees[source] = members, *climbed([digest for _, digest in members], fanout)
    order = sorted(trees, key=lambda s: nulls_first(s) if s is not None else (False, b""))
    root, upper = climbed([trees[s][1] for s in order], fanout)
    wanted = []
    for source, above in zip(order, upper, strict=True):
        members, subroot, steps = trees[source]
        for (doc_id, leaf), below in zip(members, steps, strict=True):
            proof = "".join(left + right for left, right in below + above)
            wanted.append((doc_id, source, leaf, subroot, root, proof, root))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, wanted))


def test_a_changed_leaf_does_not_fold_to_the_root(spark):
    frame = spark.createDataFrame([(i, "a", sha(str(i))) for i in range(10)], "doc_id int, source string, leaf string")
    found = merkle.manifest(frame)
    other = merkle.folded(merkle.F.sha2("leaf", 256), found["proof"])
    assert found.where(other == found["root"]).count() == 0


def test_manifest_of_nothing(spark):
    found = merkle.manifest(spark.createDataFrame([], "doc_id int, source string, leaf string"))
    assert found.columns == ["doc_id", "source", "leaf", "subroot", "root", "proof"] and found.count() == 0


# near copies by multi-index


def vectors():
    chance = np.random.default_rng(4)
    centre = chance.normal(size=(6, 16))
    rows = [(i, chance.normal(size=16), i % 3) for i in range(400)]
    rows += [(1000 + i, centre[i % 6] + 0.2 * chance.normal(size=16), i % 2) for i in range(300)]  # chains of near copies
    rows += [(2000 + i, centre[0], 1) for i in range(300)]  # one vector, a third of a label
    rows += [(3000, centre[0] * 1e200, 1), (3001, centre[0] * 1e-200, 1), (3002, centre[0], None), (5, centre[0], 1)]
    rows = [(i, [float(x) for x in v], label) for i, v, label in rows]
    rows += [(4000, [0.0] * 16, 1), (4001, None, 1), (4002, [], 1), (4003, [float("nan")] * 16, 1), (4004, [1.0, None], 1)]
    return rows + [(None, rows[420][1], 1), (4005, [2.0, 1.0], 1), (4006, [4.0, 2.0], 1), (4007, [2.0], 1), (4008, [3.0], 1)]


def brute_force(rows, threshold):
    def good(row):
        return None not in row[::2] and row[1] and all(x is not None and np.isfinite(x) for x in row[1]) and any(row[1])

    where = [i for i, row in enumerate(rows) if good(row)]
    links = {i: set() for i in where}
    scaled = {i: np.array(rows[i][1]) / np.abs(rows[i][1]).max() for i in where}
    for a in where:
        for b in where:
            if a < b and rows[a][2] == rows[b][2] and len(scaled[a]) == len(scaled[b]):
                x, y = scaled[a], scaled[b]
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    part = {i: i for i in where}
    for i in where:  # flood
        if part[i] == i:
            todo, group = [i], {i}
            while todo:
                for other in links[todo.pop()] - group:
                    group.add(other)
                    todo.append(other)
            least = min(rows[j][0] for j in group)
            part |= {j: ("done", least) for j in group}
    out = []
    for i, row in enumerate(rows):
        component = part[i][1] if i in part else row[0]
        out.append((row[0], len(links.get(i, ())), component, row[0] == component))
    return sorted(map(repr, out))


@pytest.mark.parametrize(("occupancy", "block"), [(64, 1024), (4, 1024), (4, 16)])
def test_near_vectors_equal_brute_force(spark, occupancy, block):
    rows = vectors()
    kind = "vec_id bigint, embedding array<double>, label int, node string, kept string"
    frame = spark.createDataFrame([(*row, "x", "y") for row in rows], kind).repartition(4)
    got = multi_index.near_vectors(frame, recall=1.0, occupancy=occupancy, block=block)
    assert sorted(map(repr, map(tuple, got.collect()))) == brute_force(rows, 0.93)


def test_recall_of_the_grid_is_what_was_asked(spark):
    chance = np.random.default_rng(8)
    units = multi_index.unit(chance.normal(size=(6000, 64)))
    grid = multi_index.fitted(units, 16, 0.93, 0.99)
    assert grid.visits < 64  # of 256 cells
    some = units[:2000]  # partners at the threshold that the fit has not seen
    aside = chance.normal(size=some.shape)
    aside -= (aside * some).sum(1)[:, None] * some
    other = 0.93 * some + np.sqrt(1 - 0.93**2) * multi_index.unit(aside)
    mine, theirs = grid.nearest_cells(some, grid.visits), grid.nearest_cells(other, grid.visits)
    met = (mine == theirs[:, :1]).any(1) | (theirs == mine[:, :1]).any(1)
    assert met.mean() > 0.975


def test_cells_come_nearest_first():
    chance = np.random.default_rng(5)
    grid = multi_index.Grid(chance.normal(size=(9, 3)), chance.normal(size=(7, 4)), 1)
    points = chance.normal(size=(50, 7))
    away = multi_index.distances(points[:, :3], grid.left)[:, :, None] + multi_index.distances(points[:, 3:], grid.right)[:, None, :]
    assert (grid.nearest_cells(points, 20) == np.argsort(away.reshape(50, -1), axis=1)[:, :20]).all()


def test_near_vectors_of_nothing(spark):
    got = multi_index.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int"))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"] and got.count() == 0


# turn repair


def repair(rows):
    """Forward over turns, the least (cost, audit, lines) of each state; `rows` are in order."""
    due = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    after = {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}
    seen, faults, best = set(), [], {"": (0, "", [])}

    def inserted(best):
        for _ in range(2):
            for state, (cost, audit, lines) in list(best.items()):
                new = cost + 3, audit + "I", [*lines, f"{due[state]}:"]
                best[due[state][0]] = min(best.get(due[state][0], new), new)
        return best

    for role, text in rows:
        blank = not re.search(r"[^\x20\x09-\x0D]", text)
        fault = 1 if blank else 2 if (role, text) in seen else 0
        if fault == 0 and re.findall(r"[^\x20\x09-\x0D]", text)[-1] not in ".!?":
            fault = 3
        faults.append(fault)
        seen.add((role, text))
        options = {}
        for state, (cost, audit, lines) in inserted(best).items():
            ways = [(state, 4, "D", [])]
            if fault in (0, 3):
                extra = 3 if fault == 3 else 0
                ways.append((due[state][0], 3 + extra, "R", [f"{due[state]}:{text}"]))
                if (state, role[:1]) in after:
                    ways.append((role[:1], extra, "K", [f"{role}:{text}"]))
            for to, spent, letter, line in ways:
                new = cost + spent, audit + letter, lines + line
                options[to] = min(options.get(to, new), new)
        best = options
    cost, audit, lines = min(done for state, done in inserted(best).items() if state in ("", "a"))
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(rows, rows[1:]))
    return (*[faults.count(f) for f in (1, 2, 3)], illegal, cost, audit, sha("\n".join(lines)))


def conversations():
    chance = random.Random(6)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "usher"]
    texts = ["Yes.", "No!", "Why", "so?  \n", " ", "", None, "a. b", "é？", "end. "]
    rows = []
    for conv in range(120):
        for turn in range(chance.choice([0, 1, 2, 3, 5, 9, 30])):
            text = chance.choice(texts) if chance.random() < 0.6 else f"{chance.random()}{chance.choice(['.', ''])}"
            rows.append((conv, chance.choice([turn, turn, turn, turn + 3, None]), chance.choice(roles[: chance.choice([2, 9])]), text))
    rows += [(None, turn, "user", "x" * 50_000 + ".") for turn in range(3)]
    rows += [(500, None, "user", "Same.")] * 40  # rows that repeat
    return rows


@pytest.mark.parametrize("block", [1024, 4, 1])
def test_repair_equals_a_plain_programme(spark, block):
    rows = conversations()
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    got = turn_repair.repaired(frame.withColumn("place", turn_repair.F.lit("x")), block=block)
    wanted = []
    for conv in {row[0] for row in rows}:
        mine = [(turn, " " if role is None else role, " " if text is None else text) for c, turn, role, text in rows if c == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha(r[2])))
        turns = [turn for turn, _, _ in mine if turn is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        wanted.append((conv, gaps, *repair([row[1:] for row in mine])))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, wanted))


def test_damage(spark):
    rows = [(conv, turn, role, "A. b! c?") for conv in range(30) for turn in range(4) for role in ("system",)]
    rows += [(None, 1, "user", "x."), (7, None, None, None)]
    got = turn_repair.damaged(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    wanted = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        wanted += [(conv, turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, wanted))


def test_conversations_without_turns_and_none_at_all(spark):
    kind = "conv_id bigint, turn bigint, role string, text string"
    rows = spark.createDataFrame([(1, 0, "user", "Hi."), (2, 0, "user", "Hi.")], kind)
    got = turn_repair.repaired(rows.where("conv_id = 1"), rows).where("conv_id = 2").first()
    assert tuple(got) == (2, 0, 0, 0, 0, 0, 0, "", sha(""))
    assert turn_repair.repaired(rows.where("conv_id = 3")).count() == 0


def test_ranks_choose_the_least_path():
    """Ties in cost: deleting (4) and keeping a cut-off turn with an insert, in any order, by ASCII."""
    lattice = turn_repair.Lattice(np.array([3, 3, 3]) + 4 * np.array([1, 1, 1]), np.array([3]))
    (audit,), out = turn_repair.audits(lattice, np.array([turn_repair.END_COST]), np.array([0]))
    paths = repair([("user", "a"), ("user", "b"), ("user", "c")])
    assert (audit + "I" * (turn_repair.END_COST[out[0]] // 3), turn_repair.END_COST[out[0]] >= 0) == (paths[5], True)
