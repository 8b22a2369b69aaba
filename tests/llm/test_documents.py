"""Operators on documents against brute force: mixing, exact and near dedup, suffix dedup, packing, counts."""

import collections
import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierline.llm import chosen_path, exact_dedup, mixing, packing, suffix_dedup, token_counts

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, count bigint, size bigint, recipe string"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
BASE = " ".join(f"w{i * 7919 % 1009}" for i in range(300))


def texts() -> list:
    """(doc_id, text, source): NULLs, empties, repeated rows, ties, near copies, a very long text."""
    near = BASE.replace("w5 ", "changed ", 1)
    rows = [
        (1, BASE, "a"), (2, BASE.upper(), "a"), (3, BASE, "b"), (3, BASE, "b"), (4, near, "b"),
        (5, None, None), (6, "", "c"), (None, "no id here at all", "c"), (None, None, "a"), (7, LONG, "hot"),
        (8, "   ", "hot"), (9, "É é ÀÉ", "hot"), (10, "é é Àé", "hot"), (11, "one two", None), (12, "one  two", "é"),
        (13, "a" * 900, "hot"), (14, "<|endoftext|> and ▁ odd  spaces", "hot"), (15, "x" * 199, "a"), (16, "x" * 200, "a"),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", s, None, 9, 9, "r") for i, t, s in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def lowered(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# mixing


def water_filled(sizes: dict) -> dict:
    """Targets by the rule as it is worded: share, stop at the cap, share the rest again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8"))
    order += [None] if None in sizes else []
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * sizes[s] + 1e-9}
        if not over:
            return target | {s: weight[s] * level for s in open_}
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2.0 * sizes[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("salted", [False, True])
def test_mixing_follows_the_targets(docs, corpus, monkeypatch, salted):
    if salted:
        monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    for frame in (docs, corpus):
        found = mixing.mixed_sizes(frame).toPandas().astype(object)
        found = found.where(found.notna(), None)
        sizes = collections.Counter()
        for row in found.itertuples():
            sizes[row.source] += row.size
        wanted = water_filled(sizes)
        for row in found.itertuples():
            assert row.source_size == sizes[row.source]
            assert row.target == pytest.approx(wanted[row.source])
            assert np.floor(row.rate) <= row.copies <= np.ceil(row.rate) <= 2
    taken = collections.Counter()
    for row in found.itertuples():
        taken[row.source] += row.copies * row.size
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.1)


def test_mix_emits_what_it_says_and_agrees_with_itself(docs, empty):
    copies = mixing.mixed_sizes(docs).groupBy("doc_id").sum("copies").collect()
    rows = mixing.mix(docs)
    assert rows.columns == docs.columns and mixing.mix(empty).count() == 0 == mixing.mixed_sizes(empty).count()
    counted = collections.Counter(row["doc_id"] for row in rows.collect())
    wanted = {row["doc_id"]: row["sum(copies)"] for row in copies if row["sum(copies)"]}
    assert counted == wanted
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, mixing.mix(docs).collect()))


@pytest.mark.parametrize("parts", ["3", "40"])
def test_many_sources_are_summed_in_ranges(spark, parts):
    chance = random.Random(4)
    names = [f"s{i}" for i in range(500)] + ["\u00e9", "\uff5e", "\U0001f600", "", None]
    sizes = {name: chance.choice([0, 7, 7, 50, chance.randrange(1, 3000)]) for name in names}
    rows = [(name, part) for name, size in sizes.items() for part in (size - size // 3, size // 3)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = mixing.source_rates(spark.createDataFrame(rows, "source string, size bigint")).collect()
        again = mixing.source_rates(spark.createDataFrame(rows[::-1], "source string, size bigint")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    wanted = water_filled(sizes)
    assert sorted(found, key=repr) == sorted(again, key=repr) and len(found) == len(sizes)
    for row in found:
        assert row["source_size"] == sizes[row["source"]] and row["target"] == pytest.approx(wanted[row["source"]])
    assert sum(row["target"] for row in found) == pytest.approx(1.5 * sum(sizes.values()))


# exact dedup


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_groups(docs, corpus, bits, monkeypatch):
    monkeypatch.setattr(exact_dedup, "CUT", r"(?s).{8,63}?[a-z][ \n][a-m]|.{1,64}")
    for frame in (docs, corpus) if bits == 64 else (docs,):
        rows = [(row["doc_id"], lowered(row["text"])) for row in frame.collect()]
        members = collections.defaultdict(list)
        for i, text in rows:
            members[text].append(i)
        found = exact_dedup.exact_groups(frame, bits=bits).collect()
        assert len(found) == len(rows)
        wanted = collections.Counter()
        for i, text in rows:
            keep = max((m for m in members[text] if m is not None), default=None)
            wanted[(i, keep, len(members[text]), hashlib.sha256(text.encode()).hexdigest())] += 1
        assert collections.Counter((r[0], r[1], r[2], r[4]) for r in found) == wanted
        assert sum(r["kept"] for r in found) == len(members)


@pytest.mark.parametrize(
    "word, gap",
    [
        (lambda c: "".join(c.choices("abcdefghijklmnopqrstuvwxyz", k=6)), " "),
        (lambda c: str(c.randrange(10**6)), " "),
        (lambda c: "".join(map(chr, c.choices(range(0x430, 0x450), k=7))), " "),
        (lambda c: "".join(map(chr, c.choices(range(0x4E00, 0x9000), k=9))), "\u3002"),
    ],
)
def test_shifted_copies_share_chunks_in_any_script(spark, word, gap):
    chance = random.Random(6)
    text = gap.join(word(chance) for _ in range(3000))
    frame = spark.createDataFrame([(1, text), (2, "shift " + text)], "doc_id bigint, text string")
    of = [r[0] for r in frame.orderBy("doc_id").select(exact_dedup.chunks(F.col("text"))).collect()]
    assert "".join(of[0]) == text and len(of[0]) >= 15
    assert len(set(of[0]) & set(of[1])) > 0.8 * len(of[0])


def test_rows_equal_in_id_and_text_never_meet(spark):
    rows = [(7, "Same text", i) for i in range(300)] + [(None, "same text", i) for i in range(40)]
    rows += [(None, "no id", i) for i in range(50)] + [(3, "alone", 0)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, keep_row int").repartition(5)
    groups = exact_dedup.exact_groups(frame)
    assert "Window" not in groups._jdf.queryExecution().executedPlan().toString()
    kept = collections.Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in groups.collect() if r["kept"])
    assert kept == {(7, 7, 340): 1, (None, None, 50): 1, (3, 3, 1): 1} and groups.count() == len(rows)
    assert sorted(map(repr, [r["doc_id"] for r in exact_dedup.exact_dedup(frame).collect()])) == ["3", "7", "None"]


def test_chunks_are_the_text(docs):
    cut = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    cut = cut.withColumn("chunks", exact_dedup.chunks(F.col("text")))
    assert all("".join(row["chunks"]) == row["text"] for row in cut.collect())


def test_exact_dedup_keeps_one_of_each(docs, empty):
    kept = exact_dedup.exact_dedup(docs)
    found = [lowered(row["text"]) for row in kept.collect()]
    assert kept.columns == docs.columns
    assert sorted(found) == sorted({lowered(t) for _, t, _ in texts()})
    assert {row["doc_id"] for row in kept.collect()} >= {3, 4, 7, 8, 9, 10, 11, 12}
    assert exact_dedup.exact_dedup(empty).count() == 0 == exact_dedup.exact_groups(empty).count()


# near dedup


def near_brute(rows: list) -> list:
    words = [tuple((t or "").split()) for _, t in rows]
    of = {w: frozenset(w[k : k + 5] for k in range(max(1, len(w) - 4))) if w else frozenset() for w in set(words)}
    parent = {w: w for w in of}

    def find(w):
        while parent[w] != w:
            w = parent[w]
        return w

    links = collections.Counter()
    unique = [w for w in of if w]
    holders = collections.defaultdict(list)
    for w in unique:
        for shingle in of[w]:
            holders[shingle].append(w)
    shared = collections.Counter()
    for held in holders.values():
        for i, a in enumerate(held):
            for b in held[i + 1 :]:
                shared[(a, b)] += 1
    for (a, b), n in shared.items():
        if n >= 0.8 * (len(of[a]) + len(of[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            parent[find(a)] = find(b)
    members = collections.defaultdict(list)
    for (i, _), w in zip(rows, words, strict=True):
        members[find(w)].append(i)
    copies = collections.Counter(words)
    return [
        (i, min((m for m in members[find(w)] if m is not None), default=None), len(members[find(w)]), links[w], copies[w])
        for (i, _), w in zip(rows, words, strict=True)
    ]


def near_copies(count: int) -> list:
    chance = random.Random(5)
    words = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(count):
        copy = list(words)
        for at in chance.sample(range(120), i % 4):
            copy[at] = f"n{chance.random()}"
        rows.append((1000 + i, " ".join(copy)))
    return rows


@pytest.mark.parametrize("limits", [{}, {"small": 4, "block": 8}])
def test_near_classes(spark, docs, corpus, limits):
    hot = spark.createDataFrame(near_copies(60), "doc_id bigint, text string")
    for frame in (docs, hot, corpus) if not limits else (hot,):
        rows = [(row["doc_id"], row["text"]) for row in frame.select("doc_id", "text").collect()]
        found = [tuple(row) for row in chosen_path.near_classes(frame, **limits).collect()]
        assert sorted(found, key=repr) == sorted(near_brute(rows), key=repr)


def test_near_dedup_keeps_one_of_each_class(docs, empty):
    kept = chosen_path.near_dedup(docs)
    assert kept.columns == docs.columns
    ids = collections.Counter(row["doc_id"] for row in kept.collect())
    assert ids[1] == 1 and not ids[3] and not ids[4] and ids[2] == 1 and ids[7] == 1 and ids[11] == 1 and not ids[12]
    assert chosen_path.near_dedup(empty).count() == 0 == chosen_path.near_classes(empty).count()


def test_near_dedup_decides_by_row(spark):
    a, b = BASE, " ".join(f"v{i}" for i in range(90))
    near_a, near_b = a + " more", b + " more"
    rows = [
        (5, "", 0), (None, None, 1), (None, "no id here at all", 2), (None, "clean, without id", 3), (3, a, 4), (3, b, 5), (1, near_b, 6),
        (7, "one line", 7), (7, "one  line", 8), (7, "another line", 9), (8, a + " x", 10), (None, near_a, 11),
        (None, "twice without id", 12), (None, "twice  without id", 13), (9, "p " + b[:200], 14), (9, "q p " + b[:200], 15),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n int").repartition(3)
    kept = [tuple(row) for row in chosen_path.near_dedup(frame).collect()]
    class_of = {i: c for i, c, *_ in near_brute([(n, text) for _, text, n in rows])}
    wanted = {c: min((rows[n][0] for n in class_of if class_of[n] == c and rows[n][0] is not None), default=None) for c in class_of.values()}
    assert sorted((class_of[n], i) for i, _, n in kept) == sorted(wanted.items())
    assert {rows[n] for _, _, n in kept} == set(kept)
    assert {2, 3, 4, 6} <= {n for _, _, n in kept} and 5 not in {n for _, _, n in kept}


def test_runs_follow_the_recall():
    assert chosen_path.runs_needed(0.8, 0.9999, 1) < chosen_path.runs_needed(0.8, 0.9999, 3)
    assert 1 - (1 - 0.8**3) ** chosen_path.runs_needed(0.8, 0.9999, 3) >= 0.9999


# suffix dedup


def suffix_brute(found: list) -> list:
    length = suffix_dedup.LENGTH
    data = [(t or "").encode() for t in found]
    seen = collections.Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [4096, 2])
def test_suffix_dedup(spark, docs, corpus, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "MOST_BLOCKS", crowd)
    monkeypatch.setattr(suffix_dedup, "SLICE", 5000)
    chance = random.Random(3)
    base = "".join(chance.choice("abcdé gh ") for _ in range(2500))
    cut = ["abc" * 200, ("abc" * 200)[1:500], base, base[:1200] + "X" + base[1200:], "x" + base[100:299], base[300:700] * 2]
    cut += [base[chance.randint(0, 500) : chance.randint(800, 2500)] for _ in range(15)]
    made = spark.createDataFrame([(i, t) for i, t in enumerate(cut)], "doc_id bigint, text string")
    for frame in (docs.where("doc_id is null or doc_id <> 7"), made, corpus.where("n_chars < 1500")):
        rows = frame.select("doc_id", "text").collect()
        cleaned = suffix_dedup.without_repeats(frame).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        wanted = [(r[0], *w) for r, w in zip(rows, suffix_brute([r[1] for r in rows]), strict=True)]
        assert sorted(map(tuple, cleaned.collect()), key=repr) == sorted(wanted, key=repr)


def test_refinement_by_later_offsets_is_exact():
    chance = random.Random(12)
    length = suffix_dedup.LENGTH
    data = bytearray("".join(chance.choice("ab") for _ in range(700)).encode() * 3 + b"a" * 900)
    data[1000] ^= 1
    places = np.arange(len(data) - length + 1)
    found = suffix_dedup.string_ranks(np.frombuffer(bytes(data), np.uint8), places)
    strings = [bytes(data[i : i + length]) for i in places]
    assert len(set(found.tolist())) == len(set(strings)) == len(set(zip(found.tolist(), strings, strict=True)))
    assert len(suffix_dedup.string_ranks(np.zeros(0, np.uint8), places[:0])) == 0


def test_a_weak_hash_of_grams_joins_buckets_but_never_texts(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "named", lambda x, y: (x * np.uint64(31) + y) << np.uint64(60))
    chance = random.Random(13)
    base = "".join(chance.choice("abcde ") for _ in range(1500))
    texts = [base, base[:700] + "X" + base[700:], "y" + base[300:900], base]
    batch = pa.record_batch([pa.array(range(4)), pa.array(range(4)), pa.array(texts)], ["row_id", "tag", "text"])
    kinds = {}
    for block in pa.Table.from_batches(suffix_dedup._blocks(1 << 20)([batch])).to_pylist():
        text = texts[block["row_id"]].encode()
        whole = text[block["start"] : block["start"] + block["strings"] + suffix_dedup.LENGTH - 1]
        assert kinds.setdefault((block["block"], block["more"]), whole) == whole
    assert 1 < len(kinds) == len(set(kinds.values()))


def test_suffix_dedup_gives_bytes_and_spans(docs, empty):
    row = next(r for r in suffix_dedup.without_repeats(docs).collect() if r["doc_id"] == 13)
    assert row["kept"] == b"" and [tuple(span) for span in row["removed"]] == [(0, 900)]
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_spans_of_copies_are_gathered_once(spark):
    chance = random.Random(8)
    text = "".join(chance.choice("abcde fgh") for _ in range(900))
    rows = [(None, text)] * 40 + [(1, text)] * 40 + [(2, text[100:500])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    cleaned = suffix_dedup.without_repeats(frame)
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [row_id" in plan and "start" in [
        key.split("#")[0].strip() for line in plan.splitlines() if "Aggregate [" in line and "collect" not in line
        for key in line.split("[")[1].split("]")[0].split(",")
    ]
    found = [tuple(r) for r in cleaned.select("n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(found) == sorted(suffix_brute([t for _, t in rows]))


def test_long_texts_are_cut_into_slices(spark, monkeypatch, tmp_path):
    chance = random.Random(9)
    base = "".join(chance.choice("abcdé gh ") for _ in range(9000))
    rows = [(1, base), (2, "x" + base[500:8000]), (None, base[3000:]), (None, "y" + base[:2500]), (1, base[:400])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    cut = suffix_dedup.slices

    def noted(starts, most):
        for group in cut(starts, most):
            (tmp_path / f"{most}-{group[0][1]}").touch()
            yield group

    batch = pa.record_batch([pa.array([1]), pa.array([1], pa.int32()), pa.array([base])], ["row_id", "tag", "text"])
    monkeypatch.setattr(suffix_dedup, "slices", noted)
    assert sum(map(len, suffix_dedup._blocks(700)([batch]))) >= sum(map(len, suffix_dedup._blocks(1 << 20)([batch])))
    assert len(list(tmp_path.glob("700-*"))) > 10
    monkeypatch.setattr(suffix_dedup, "slices", cut)
    monkeypatch.setattr(suffix_dedup, "SLICE", 700)
    found = suffix_dedup.without_repeats(frame).select("n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, found)) == sorted(suffix_brute([t for _, t in rows]))


# packing


def test_packing_covers_every_id_once(docs, corpus, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    for frame in (docs, corpus):
        ids = collections.defaultdict(list)
        for row in frame.collect():
            ids[row["doc_id"]].append([*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 1])
        pieces = packing.pack(frame, path, with_ids=True).collect()
        wanted = collections.Counter(x for lists in ids.values() for one in lists for x in one)
        assert collections.Counter(x for p in pieces for x in p["ids"]) == wanted
        sequences = collections.defaultdict(list)
        for p in pieces:
            assert any(list(p["ids"]) == one[p["start"] : p["start"] + p["length"]] for one in ids[p["doc_id"]])
            assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
            assert any(len(one) == p["doc_tokens"] for one in ids[p["doc_id"]])
            sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        total = sum(wanted.values())
        for placed in sequences.values():
            end = 0
            for offset, length in sorted(placed):
                assert offset == end
                end += length
            assert end <= packing.CAPACITY
        assert len(sequences) <= total / packing.CAPACITY * 1.02 + 2
    assert packing.pack(empty, path).count() == 0


def test_words_are_encoded_in_small_lots(monkeypatch):
    lots = []
    encoded = packing.WordIds._encoded
    monkeypatch.setattr(packing.WordIds, "_encoded", lambda self, texts: lots.append(len(texts)) or encoded(self, texts))
    chance = random.Random(3)
    words = ["".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(24_000)]
    encoder = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    texts = [" ".join(words[:16_000]), " ".join(words[8000:])]
    whole = [encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert [memoryview(ids).cast("I").tolist() for ids in encoder.ids(texts)] == whole
    assert sum(lots) == len(set(words)) and max(lots) <= 8192


def test_cut_and_best_fit():
    for tokens in [*range(1, 5000, 7), 2047, 2048, 2049, 4096]:
        lengths = packing.cut(tokens)
        assert sum(lengths) == tokens and all(0 < n <= packing.CAPACITY for n in lengths)
    placed = packing.best_fit([1500, 600, 500, 400, 100], 2048)
    assert len(set(placed)) == 2 and packing.best_fit([], 2048) == []
    assert packing.leftover_bound() < 10_000


def fuzz(alphabet: list, count: int) -> list:
    chance = random.Random(11)
    return ["".join(chance.choice(alphabet) for _ in range(chance.randint(0, 25))) for _ in range(count)]


def test_word_ids_are_the_tokenizers():
    encoder = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    alphabet = [*"aAbB'sSt \t\n\x0b\x1c\x85\xa0éİßſ12²½.,!̀Σς’字\x00_-", "<|endoftext|>", "'re", "  "]
    for text in fuzz(alphabet, 3000):
        ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids([text])[0], "<u4").tolist() == ids, repr(text)


# token counts


def test_token_counts(docs, corpus, empty, monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = token_counts.load(path)
    monkeypatch.setattr(token_counts, "HEAD", 50)
    for frame in (docs, corpus.where("n_chars < 3000")):
        wanted = collections.Counter(
            (r["doc_id"], len((r["text"] or "").encode()), len(model.encode(r["text"] or ""))) for r in frame.collect()
        )
        assert collections.Counter(map(tuple, token_counts.token_counts(frame, path).collect())) == wanted
    assert token_counts.token_counts(empty, path).count() == 0


def test_pre_tokens_add_up():
    model = token_counts.load(public_tokenizers.path("piece_bpe_32k.model"))
    for text in fuzz([*"ab é字\n\t.,▁", "  ", "</s>", "<unk>", " the"], 3000):
        counts = token_counts.piece_counts(model, token_counts.pre_tokens(text))
        assert sum(counts) == len(model.encode(text)), repr(text)
