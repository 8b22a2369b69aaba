"""Nearest neighbours, URL filter, preference pairs, toxicity, the shared helpers, the pipeline."""

import collections
import hashlib
import math
import os
import random
import re
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from tierline.llm import preference, support, toxicity, url_filter, vantage
from tierline.llm.oracle import ORACLE
from tierline.llm.queries import QUERIES, URL_RULES
from tierline.llm.suffix_dedup import LENGTH
from tierline.llm.support import sorted_runs

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
INF = float("inf")


# nearest neighbours


def vectors(spark):
    chance = np.random.default_rng(2)
    rows = [(i, [float(x) for x in chance.normal(size=8) * (1 + i % 3)], "x") for i in range(600)]
    rows += [(1000 + i, rows[5][1], "copy") for i in range(300)]  # a third are one vector
    rows += [(5, rows[5][1], "again"), (None, rows[6][1], "no id"), (2000, None, ""), (2020, [0.0] * 8, "")]
    rows += [(2040, [1.0, None] + [0.0] * 6, ""), (2060, [INF] + [0.0] * 7, ""), (2080, [float("nan")] * 8, "")]
    rows += [(2100, [1.0, 2.0], "short"), (2101, [2.0, 1.0], "short")]
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string").repartition(4)


def exact_neighbours(rows, ids, k):
    good = {i: v for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = set()
    for q in ids & good.keys():
        scored = []
        for i, v in good.items():
            if i != q and len(v) == len(good[q]):
                score = 0.0
                for a, b in zip(good[q], v, strict=True):
                    score += a * b
                scored.append((-score, i))
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.mark.parametrize("sizes", [(8192, 4096), (100, 16)])
def test_factor_one_is_exact(spark, sizes):
    rows, frame = vectors(spark)
    ids = {i for i, _, _ in rows if i is not None and i % 20 == 0}
    found = vantage.nearest(frame, frame.where("vec_id % 20 = 0"), 10, 1.0, shard_rows=sizes[0], block_rows=sizes[1])
    assert {tuple(row) for row in found.collect()} == exact_neighbours(rows, ids, 10)


def test_larger_factors_visit_less_and_production_recall_is_high():
    chance = np.random.default_rng(1)
    points = chance.normal(size=(3000, 4))
    tree = vantage.Tree.build(np.arange(3000), points, leaf=32)
    queries = chance.normal(size=(50, 4))
    exact, _, all_visits = tree.search(queries, 10, 1.0)
    rough, _, few_visits = tree.search(queries, 10, 4.0)
    assert few_visits < all_visits < 50 * (tree.children[:, 0] < 0).sum()
    top = np.argsort(-(queries @ points.T), axis=1)[:, :10]
    for q in range(50):
        assert set(top[q]) <= set(tree.ids[tree.id_starts[exact[q]]])
    assert np.mean([len(set(top[q]) & set(tree.ids[tree.id_starts[rough[q]]])) for q in range(50)]) > 3


def test_queries_visit_only_cells_that_their_bound_reaches(spark, monkeypatch):
    chance = np.random.default_rng(6)
    centres = chance.normal(size=(12, 6)) * 10
    points = np.repeat(centres, 200, 0) + chance.normal(size=(2400, 6))
    rows = [(i, [float(x) for x in point], "x") for i, point in enumerate(points)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string").repartition(3)
    visits, build = [], vantage.written

    def noted(df, name):
        out = build(df, name)
        if name == "visits":
            visits.append(out.count())
        return out

    monkeypatch.setattr(vantage, "written", noted)
    asked = frame.where("vec_id % 20 = 0")
    exact = exact_neighbours(rows, {i for i, _, _ in rows if i % 20 == 0}, 10)
    found = {tuple(r) for r in vantage.nearest(frame, asked, 10, 1.0, shard_rows=200, block_rows=16).collect()}
    assert found == exact
    assert visits[0] == 120 and sum(visits) < 120 * 12 / 2  # of twelve cells each
    wanted = {(q, i) for q, _, i, _ in exact}
    rough = vantage.nearest(frame, asked, 10, shard_rows=200, block_rows=16).collect()
    assert len({(r["query_id"], r["vec_id"]) for r in rough} & wanted) >= 0.9 * len(wanted)


def test_ties_go_to_the_smaller_id():
    chance = np.random.default_rng(3)
    points = np.column_stack([np.ones(600), chance.integers(0, 50, (600, 3))]).astype(float)  # all tie for the query
    tree = vantage.Tree.build(chance.permutation(600), points, leaf=32)
    found = vantage.best_of_shard(tree, np.array([1000]), np.array([[1.0, 0, 0, 0]]), 5, 1.0)
    assert found.column("vec_id").to_pylist() == [0, 1, 2, 3, 4]


def test_rows_of_an_id_meet_before_they_are_dealt(spark, monkeypatch):
    sizes = []
    build = vantage.written

    def noted(frame, name):
        sizes.append((name, frame._jdf.queryExecution().optimizedPlan().toString()))
        return build(frame, name)

    monkeypatch.setattr(vantage, "written", noted)
    rows = [(7, [2.0, float(i)]) for i in range(50)] + [(i, [1.0, float(i)]) for i in range(8, 12)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = vantage.nearest(frame, frame.where("vec_id = 8"), 4).collect()
    assert sorted((r["vec_id"], r["score"]) for r in found) == [(7, 2.0), (9, 73.0), (10, 81.0), (11, 89.0)]
    assert "Aggregate" in dict(sizes)["trees"]


def test_empty_vectors(spark):
    _, frame = vectors(spark)
    assert vantage.nearest(frame.limit(0), frame.limit(0), 5).count() == 0


# URL filter


def judged(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        path = rest[end:]
        path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://NET/", "http://a.Example.NET/en/x?y#z", "https://example.net/de/", "x://y://net/",
    "http://example.com/de/1", "http://example.com/dex", "http://notexample.com/de/1", "http://a.org/fr/é", "http://net", "http://.net/",
    "http://net?x=/", "http://a.net#/", "http://" + "a." * 40 + "net/" + "p" * 3000, "http://\n.net/\n", "ftp://É.NET/",
]


@pytest.mark.parametrize("limits", [{}, {"BROADCAST_BLOCKS": 0, "BROADCAST_RULES": 0, "KEYS_PER_BLOCK": 4}])
def test_url_verdicts(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(url_filter, name, value)
    chance = random.Random(4)
    listed = [*URL_RULES] + [(f"h{i}.test", f"/{'p' * (i % 5)}", chance.choice(["allow", "block"])) for i in range(200)]
    urls = URLS + [f"http://s.h{chance.randint(0, 250)}.test/{'p' * chance.randint(0, 6)}" for _ in range(300)]
    rules = spark.createDataFrame([*listed, (None, "/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls)], "page_id bigint, url string, key string")
    found = {r["page"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, rules).collect()}
    assert found == {i: judged(u, listed) for i, u in enumerate(urls)}
    kept = url_filter.allowed_pages(pages, rules)
    assert kept.columns == pages.columns and kept.count() == sum(v[3] == "allow" for v in found.values())


def test_url_rules_of_any_length(spark):
    deep, wide = "/" + "p" * 9000, "h." * 3000 + "test"
    listed = [("a.test", deep, "block"), (wide, "/", "block"), ("test", "/", "allow"), ("test", "/p", "block"), ("test", "/p", "allow")]
    urls = ["http://a.test" + deep, "http://a.test" + deep[:-1], f"x://s.{wide}/q", f"x://{wide[2:]}/q", "x://test/p", "x://b.test/x", None]
    rules = spark.createDataFrame(listed, "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id bigint, url string, host string, rule string")
    found = {r["page"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, rules).collect()}
    assert found == {i: judged(u, listed) for i, u in enumerate(urls)}


@pytest.mark.parametrize("hot", [None, "http://www.net/x"])
def test_a_hot_url_is_split(spark, hot):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    kept = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        urls = [hot if i % 3 == 0 else f"http://h{i}.org/fr/{i}" for i in range(6000)]
        pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string").repartition(12)
        rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
        answers = url_filter.judge_urls(pages, rules)
        found = {r["page"]["page_id"]: r["rule"] for r in answers.collect()}
        assert found == {i: judged(u, URL_RULES)[2] for i, u in enumerate(urls)}
        assert "skew=true" in answers._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in kept.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_url_filter_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a/b")], "page_id bigint, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert [r["verdict"] for r in url_filter.judge_urls(pages, rules).collect()] == ["allow"]
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(4000).selectExpr("concat('k', id) as key")
    blocks = 4000 // url_filter.KEYS_PER_BLOCK
    bloom = url_filter.bloom_filter(keys, blocks)
    assert url_filter.possible_hits(keys, bloom, blocks).count() == 4000
    others = spark.range(4000).selectExpr("concat('other', id) as key")
    assert url_filter.possible_hits(others, bloom, blocks).count() < 80


# preference pairs


def test_preferences(spark):
    kind = "pair_id bigint, turn bigint, role string, text string, count int"
    chosen = [(1, 0, "user", "hi"), (1, 1, "assistant", "good"), (2, 0, None, None), (2, 1, "user", "q"), (3, 0, "user", "same"),
              (4, 0, "user", "only left"), (None, 0, "user", "no pair"), (1, 1, "assistant", "good"), (6, 0, "user", "x" * 50_000)]
    rejected = [(1, 5, "user", "hi"), (1, 6, "assistant", "bad"), (2, 0, None, None), (3, 0, "user", "same"), (5, 0, "assistant", "é")]
    left, right = (spark.createDataFrame([(*r, 1) for r in rows], kind) for rows in (chosen, rejected))
    found = {r["pair_id"]: r for r in preference.format_preferences(left, right).collect()}
    assert set(found) == {1, 2, 3, 4, 5, 6}
    one = found[1]
    assert one["prompt"] == "<|user|>\nhi<|end|>\n" and one["chosen"] == "<|assistant|>\ngood<|end|>\n"
    assert one["rejected"] == "<|assistant|>\nbad<|end|>\n" and one["chosen_mask"] == "14:0,12:1"
    assert (found[2]["prompt_turns"], found[2]["chosen_turns"], found[2]["rejected_turns"]) == (1, 1, 0)
    assert found[2]["prompt"] == "<||>\n<|end|>\n" and found[2]["chosen_mask"] == "9:0,9:0"
    assert (found[3]["chosen"], found[3]["rejected"], found[3]["prompt_turns"]) == ("", "", 1)
    assert found[4]["prompt"] == "" == found[4]["rejected"] and found[5]["rejected_mask"] == "14:0,9:1"
    for row in found.values():
        for side in ("chosen", "rejected"):
            lengths = [int(run.split(":")[0]) for run in row[f"{side}_mask"].split(",") if run]
            assert sum(lengths) == len(row[side])
    assert preference.format_preferences(left.limit(0), right.limit(0)).count() == 0


# toxicity


def test_held_out_scores(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = QUERIES["op9_toxicity"](spark, SF_DIR).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    table = collections.Counter((labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels)
    assert table[(1, 1)] > table[(1, 0)] and table[(0, 1)] <= 0.05 * table[(0, 0)]


def test_held_out_labels_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} vile{i % 3}x text" if i % 2 else f"plain{i} text here") for i in range(200)], "doc_id bigint, text string")
    told = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    turned = told.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - toxic else toxic end as toxic")
    assert toxicity.fit(docs, told) == toxicity.fit(docs, turned)
    model = toxicity.fit(docs, told)
    scores = {r["doc"]["doc_id"]: r["score"] for r in toxicity.toxicity_scores(docs, model).collect()}
    assert min(s for i, s in scores.items() if i % 2) > 0.5 > max(s for i, s in scores.items() if i % 2 == 0)


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (None, "a", 1.0), (3, "b " * 50_000, 1.0), (3, "c", 2.0)], "doc_id bigint, text string, score double")
    for rows in ([], [(1, 1)], [(1, None), (2, 7), (None, 1)], [(2, 0), (2, 1), (3, 0)]):
        labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
        scored = toxicity.toxicity_scores(docs, toxicity.fit(docs, labels))
        assert all(0 <= r["score"] <= 1 for r in scored.collect()) and scored.count() == 5
    assert toxicity.non_toxic(docs, toxicity.ToxicityModel([], [0.0] * 8 + [-5.0])).columns == docs.columns
    assert toxicity.toxicity_scores(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_candidates_come_from_all_labelled_rows(spark, monkeypatch, broadcast):
    monkeypatch.setattr(toxicity, "BROADCAST_LABELS", broadcast)
    seen = []
    counted = toxicity._candidates
    monkeypatch.setattr(toxicity, "_candidates", lambda texts: seen.append(counted(texts)) or seen[-1])
    head = "x" * 24
    docs = spark.createDataFrame([(i, f"vile t{i}" + f" {head}bad" * (i < 80) if i % 2 else f"plain t{i} {head}good") for i in range(200)], "doc_id bigint, text string")
    told = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    toxicity.fit(docs, told, sample_rows=2)
    assert {"vile", f"{head}bad"} <= set(seen[0]) and head not in seen[0]


def test_upper_case_counts_over_the_whole_text():
    calm, loud = "quiet words " * 200, "LOUD WORDS " * 600
    assert toxicity.patterns(calm + loud, 1600)[0] == 1  # shouting starts after 2000 characters
    assert toxicity.patterns(loud[:2400] + calm * 4, 1000)[0] == 0
    assert toxicity.patterns("", 0)[0] == 0


def test_label_model_recovers_hidden_labels():
    chance = np.random.default_rng(0)
    hidden = chance.random(4000) < 0.2
    rates = [(0.5, 0.02), (0.4, 0.03), (0.3, 0.01), (0.2, 0.2)]
    votes = np.column_stack([np.where(hidden, chance.random(4000) < a, chance.random(4000) < b) for a, b in rates])
    votes = np.column_stack([votes, votes[:, 0]])  # a voter that only echoes another
    noisy = np.where(chance.random(4000) < 0.1, ~hidden, hidden).astype(int)
    posterior = toxicity.label_model(noisy, votes, prior=0.2)
    assert ((posterior > 0.5) == hidden).mean() > 0.85
    assert posterior[hidden].mean() > 0.6 > 0.3 > posterior[~hidden].mean()


def plain_fit(rows, labels):
    """The toxicity model as its docstring words it, with plain loops."""
    told = {}
    for i, toxic in labels:
        if i is not None and toxic in (0, 1) and zlib.crc32(str(i).encode()) % 4 != 2:
            told[i] = max(toxic, told.get(i, 0))
    labelled = {(text or "", told[i]) for i, text in rows if i in told}
    counts = {0: collections.Counter(), 1: collections.Counter()}
    total = collections.Counter(toxic for _, toxic in labelled)
    for text, toxic in labelled:
        words = set(re.findall(r"[^\W\d_]+", text.lower()))
        counts[toxic].update({w for w in words} | {w[:n] + "*" for w in words for n in (3, 4, 5, 6) if len(w) >= n})
    lift = {u: (n / total[1]) / ((counts[0][u] + 0.5) / total[0]) for u, n in counts[1].items() if n >= 3}
    units = sorted((u for u in lift if lift[u] >= 4), key=lambda u: (-counts[1][u] * math.log(lift[u]), u))

    by_id = {}
    for i, text in rows:
        if i in told:
            by_id.setdefault(i, []).append(text or "")
    sample = [(min(texts, key=lambda t: hashlib.sha256(t.encode()).hexdigest()), told[i]) for i, texts in by_id.items()]
    fires = [{u for u in units if unit_fires(u, text)} for text, _ in sample]
    chosen, short = [], [3] * len(sample)
    while True:
        gain = {
            u: sum(short[k] > 0 and u in fires[k] for k in range(len(sample)) if sample[k][1])
            - 2 * sum(u in fires[k] for k in range(len(sample)) if not sample[k][1])
            for u in units if u not in chosen
        }
        best = max(gain, key=gain.get, default=None)
        if best is None or gain[best] <= 0:
            break
        chosen.append(best)
        short = [n - (best in fired) for n, fired in zip(short, fires, strict=True)]

    known = [toxic for _, toxic in sample]
    votes = [[u in fired for u in chosen] + [bool(v) for v in toxicity.patterns(text, len(re.findall(r"[^\W\d_]+", text)))]
             for (text, _), fired in zip(sample, fires, strict=True)]
    n, m = len(votes), len(votes[0])
    posterior = [0.9 * toxic + 0.05 for toxic in known]
    for _ in range(20):
        soft = [(p + toxic) / 2 for p, toxic in zip(posterior, known, strict=True)]
        share = sum(soft) / n
        spread, rates = [[0.0] * m for _ in range(m)], []
        for weight in (soft, [1 - s for s in soft]):
            rate = [min(max((sum(w for w, v in zip(weight, votes, strict=True) if v[j]) + 0.1) / (sum(weight) + 0.2), 1e-6), 1 - 1e-6) for j in range(m)]
            rates.append(rate)
            for j in range(m):
                for k in range(m):
                    both = sum(w for w, v in zip(weight, votes, strict=True) if v[j] and v[k])
                    spread[j][k] += both - sum(weight) * rate[j] * rate[k]
        scale = [math.sqrt(max(spread[j][j], 1e-9)) for j in range(m)]
        near = [[min(max(spread[j][k] / scale[j] / scale[k], 0), 1) for k in range(m)] for j in range(m)]
        near = [[x if x >= 0.3 else 0 for x in line] for line in near]
        posterior = []
        for v in votes:
            logit = math.log(share / (1 - share))
            for j in range(m):
                if v[j]:
                    logit += math.log(rates[0][j] / rates[1][j]) / max(1, sum(near[k][j] for k in range(m) if v[k]))
                else:
                    logit += math.log((1 - rates[0][j]) / (1 - rates[1][j])) / max(1, sum(near[j]))
            posterior.append(1 / (1 + math.exp(-min(max(logit, -30), 30))))

    inputs = np.array([plain_inputs(chosen, text) for text, _ in sample])
    weights, ridge = np.zeros(inputs.shape[1]), np.full(inputs.shape[1], 0.5)
    ridge[-1] = 1e-3
    for _ in range(200):  # Newton steps to the optimum of the ridge-penalised likelihood
        p = 1 / (1 + np.exp(-inputs @ weights))
        slope = inputs.T @ (p - posterior) + ridge * weights
        weights = weights - np.linalg.solve((inputs.T * (p * (1 - p))) @ inputs + np.diag(ridge), slope)
    return chosen, weights


def unit_fires(unit, text):
    words = re.findall(r"[^\W\d_]+", text.lower())
    return any(w.startswith(unit[:-1]) for w in words) if unit.endswith("*") else unit in words


def plain_inputs(lexicon, text):
    words = re.findall(r"[^\W\d_]+", text.lower())
    hits = sum(any(unit_fires(u, w) for u in lexicon) for w in words)
    return [*[unit_fires(u, text) for u in lexicon], hits > 0, math.log1p(hits), *toxicity.patterns(text, len(words)), 1.0]


def test_scores_equal_a_plain_programme(spark):
    chance = random.Random(9)
    mild, vile = [f"calm{chr(97 + i)}" for i in range(20)], ["vilebrat", "vilely", "scum", "rotter", "grub"]
    rows, labels = [], []
    for i in range(160):
        toxic = i % 4 == 0
        words = chance.choices(mild, k=25) + chance.sample(vile, chance.choice([2, 3])) * toxic
        words += chance.choices(vile, k=1) * (chance.random() < 0.05)
        chance.shuffle(words)
        text = " ".join(words).upper() if toxic and i % 3 == 0 else " ".join(words)
        rows.append((i, text + "!!" * (toxic and i % 5 == 0)))
        labels.append((i, int(toxic) if chance.random() < 0.95 else int(not toxic)))
    rows += [rows[0], rows[3], (4, "another text of four, you scum, you"), (None, "vilely no id"), (500, None), (501, ""), (502, "grub " * 3000)]
    labels += [(8, 0), (500, 0), (None, 1), (12, None), (900, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    lexicon, weights = plain_fit(rows, labels)
    assert model.lexicon == lexicon and len(lexicon) > 3
    wanted = sorted((repr(r), 1 / (1 + math.exp(-float(np.dot(plain_inputs(lexicon, r[1] or ""), weights))))) for r in rows)
    found = sorted((repr((r["doc"]["doc_id"], r["doc"]["text"])), r["score"]) for r in toxicity.toxicity_scores(docs, model).collect())
    assert [key for key, _ in found] == [key for key, _ in wanted]
    assert [s for _, s in found] == pytest.approx([s for _, s in wanted], abs=2e-3)


# helpers


def test_sorted_runs_never_split_a_key():
    keys = [1, 1, 2, 3, 3, 3, 3, 3, 4, 5, 5]
    for size in (1, 2, 3, 20):
        batches = [pa.record_batch([pa.array(keys[i : i + size])], ["k"]) for i in range(0, len(keys), size)]
        runs = [table.column("k").to_pylist() for table in sorted_runs([*batches, pa.record_batch([pa.array([], pa.int64())], ["k"])], ["k"])]
        assert sum(runs, []) == keys
        assert all(a[-1] != b[0] for a, b in zip(runs, runs[1:], strict=False))
    assert list(sorted_runs([], ["k"])) == []


def test_text_bytes_of_slices_and_nulls():
    column = pa.array(["ab", None, "é", ""])
    for part, texts in ((column, ["ab", "", "é", ""]), (column.slice(1, 2), ["", "é"]), (column.slice(0, 0), [])):
        data, starts = support.text_bytes(part)
        assert [bytes(data[a:z]).decode() for a, z in zip(starts, starts[1:], strict=False)] == texts


def test_shared_folder_must_be_named_on_a_cluster():
    def session(master, settings):
        conf = SimpleNamespace(get=lambda name, default: settings.get(name, default))
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert support.shared_folder(session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    assert support.shared_folder(session("local", {})) == support.shared_folder(session("local[2]", {}))
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="checkpoint"):
            support.shared_folder(session(master, {}))


# queries and pipeline


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_twins(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations", "embeddings"):
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    wanted = connection.execute(ORACLE[name])
    names = [column[0] for column in wanted.description]
    found = QUERIES[name](spark, SF_DIR).select(*names)
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, wanted.fetchall()))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 300").cache()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    counts = [docs.count()]
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = support.written(stage(spark, frame, SF_DIR), f"test-{name}")
        assert frame.columns == docs.columns
        counts.append(frame.count())
        if name == "exact_dedup":
            texts = [r["text"] for r in frame.select("text").collect()]
            assert len(texts) == len({t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for t in texts})
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0.8 * counts[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, SF_DIR)
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in frame.select("doc_id").collect()}
    assert public_tokenizers.path(corpus_pipeline.TOKENIZER) and LENGTH == 200
