"""Rows that share an id, keys that collide in 32 bits, odd columns, and the pipeline as a whole on such rows."""

import hashlib
import random
import string
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tierline.llm import toxicity
from tierline.llm.exact_dedup import exact_dedup
from tierline.llm.chosen_path import near_dedup
from tierline.llm.suffix_dedup import LENGTH, without_repeats
from tierline.llm.support import remove_written, scratch_folder, settled, written
from tierline.llm.token_counts import token_counts


def colliding(spark, text, key):
    """Two texts that a 32-bit hash cannot tell apart."""
    rows = spark.range(400_000).select(text.alias("text")).withColumn("key", key)
    pair = rows.groupBy("key").agg(F.collect_list("text").alias("texts")).where("size(texts) > 1").first()
    return pair["texts"][:2]


def removed(texts):
    """(n_bytes, n_removed) of each text by counting all strings of LENGTH bytes."""
    data = [text.encode() for text in texts]
    count = {}
    for one in data:
        for i in range(len(one) - LENGTH + 1):
            count[one[i : i + LENGTH]] = count.get(one[i : i + LENGTH], 0) + 1
    out = []
    for one in data:
        gone = bytearray(len(one))
        for i in range(len(one) - LENGTH + 1):
            if count[one[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        kept = bytes(b for b, g in zip(one, gone, strict=True) if not g)
        out.append((len(one), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup_tells_colliding_texts_of_one_id_apart(spark):
    passage = "".join(random.Random(1).choices(string.ascii_letters, k=260))
    body = F.concat(F.lit(passage), F.col("id").cast("string"))
    first, second = colliding(spark, body, F.hash("text", F.lit(1)))
    texts = [first, second, passage, "other " * 10]
    for ids in ([5, 5, 6, 7], [5, 15, 6, 7], [None, None, None, 7]):
        frame = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id bigint, text string").repartition(3)
        got = without_repeats(frame).select("n_bytes", "n_removed", "kept_sha256")
        assert sorted(map(tuple, got.collect())) == sorted(removed(texts))


def test_suffix_dedup_takes_ids_of_any_type(spark):
    frame = spark.createDataFrame([("a", "x" * 300), ("b", "y")], "doc_id string, text string")
    assert sorted(row["doc_id"] for row in without_repeats(frame).collect()) == ["a", "b"]


def test_token_counts_tell_colliding_texts_of_one_id_apart(spark):
    body = F.when(F.col("id") % 2 == 0, F.concat(F.lit("one two "), F.col("id").cast("string")))
    body = F.coalesce(body, F.concat(F.lit("antidisestablishmentarianism "), F.hex("id"), F.lit(" zq"), F.col("id").cast("string")))
    texts = [*colliding(spark, body, F.hash("text")), "one two", "", None]
    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[1]), (None, texts[0]), (None, texts[2]), (6, ""), (6, None)]
    got = token_counts(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), model)
    wanted = [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, wanted))


@pytest.mark.parametrize("head", [0, 7, 100_000])
def test_token_counts_do_not_depend_on_the_head(spark, monkeypatch, head):
    from tierline.llm import token_counts as module

    monkeypatch.setattr(module, "HEAD", head)
    chance = random.Random(2)
    rows = [(i, " ".join(chance.choices("a bb ccc dd e ff g the of".split(), k=chance.randrange(40)))) for i in range(60)]
    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    got = token_counts(spark.createDataFrame(rows, "doc_id bigint, text string"), model)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got.collect()) == [(i, len(library.encode(t))) for i, t in rows]


def test_toxicity_sample_is_bounded_whatever_rows_share_an_id(spark, monkeypatch):
    docs = spark.range(4000).selectExpr("if(id < 3000, 1, id) as doc_id", "concat('word', id % 7, ' rude', id % 3) as text")
    labels = spark.range(4000).selectExpr("id as doc_id", "cast(id % 3 = 0 as int) as toxic")
    seen = {}

    def kept(df, name):
        out = original(df, name)
        seen[name] = out.count()
        return out

    original = toxicity.written
    monkeypatch.setattr(toxicity, "written", kept)
    model = toxicity.fit(docs, labels, sample_rows=400)
    assert 0 < seen["toxicity-sample"] <= 400 and len(model.weights) > 0


ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, `my col-a` string, m map<string, int>, score double"


def odd_rows():
    chance = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        text = " ".join(chance.choices(words, k=60))
        rows.append((i, text, "en", f"s{i % 3}", len(text), "c", {"k": i}, 0.5))
        if i % 5 == 0:  # repeated rows, the same id and text with another map, a near copy, a copy without id
            rows += [rows[-1], (i, text, "en", f"s{i % 3}", len(text), "d", {"k": -i}, 0.5)]
            rows.append((1000 + i, text + " more", "en", "s0", 5, None, None, None))
            rows.append((None, text.upper(), "en", None, 5, None, {}, None))
    return [*rows, (None, None, None, None, None, None, None, None), (2000, "", "en", "s1", 0, "", None, None), (5, "short", "en", "s2", 5, "", None, None)]


def test_every_stage_and_the_run_take_odd_rows(spark, tmp_path):
    rows = odd_rows()
    spark.createDataFrame(rows, ODD).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(60).selectExpr("id as doc_id", "1 as quality", "cast(id % 9 = 0 as int) as toxic").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    # exact dedup: of each text, lower-cased, one row of the largest id
    def norm(text):
        return (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))

    best = {}
    for row in rows:
        best[norm(row[1])] = max(best.get(norm(row[1]), (False, 0)), (row[0] is not None, row[0] or 0))
    exact = exact_dedup(docs)
    assert exact.dtypes == docs.dtypes
    got = sorted((norm(r["text"]), (r["doc_id"] is not None, r["doc_id"] or 0)) for r in exact.collect())
    assert got == sorted(best.items())

    # near dedup: the near copies go with their originals; one row per class
    near = near_dedup(docs)
    assert near.dtypes == docs.dtypes
    texts = [r["text"] for r in near.collect()]
    assert sum(t is not None and t.endswith(" more") for t in texts) == 0 and len(texts) == len(set(texts))

    # toxicity: the rows that the model scores below the threshold, and no others
    model = toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    clean = toxicity.non_toxic(docs, model)
    voters = toxicity.Voters(model.lexicon)
    wanted = [r for r in rows if model.score(voters.votes(r[1] or "")) < toxicity.THRESHOLD]
    assert clean.dtypes == docs.dtypes and sorted(map(repr, map(tuple, clean.collect()))) == sorted(map(repr, wanted))

    # the run: what survives every stage is packed whole, and no stage but the last before packing leaves files
    folder = Path(scratch_folder(spark))
    before = set(folder.iterdir()) if folder.exists() else set()
    kept = corpus_pipeline.kept_by(spark, str(tmp_path), corpus_pipeline.STAGES[:-1])
    assert [p.name.split("-")[1] for p in set(folder.iterdir()) - before] == ["mixing"] and kept.dtypes == docs.dtypes
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert packed and {r["doc_id"] for r in packed} <= {r[0] for r in rows}
    for sequence in {r["sequence_id"] for r in packed}:
        pieces = sorted((r["offset"], r["length"]) for r in packed if r["sequence_id"] == sequence)
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 2048


def test_run_over_empty_tables(spark, tmp_path):
    spark.createDataFrame([], ODD).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_what_a_dead_driver_left_can_be_removed(spark):
    folder = Path(scratch_folder(spark, "app-of-the-past"))
    (folder / "chunks-1").mkdir(parents=True)
    remove_written(spark, "app-of-the-past")
    assert not folder.exists()
    frame = settled(spark, "outer", lambda: written(spark.range(5), "inner").where("id > 1"))
    assert frame.count() == 3 and "outer-" in frame.inputFiles()[0]
