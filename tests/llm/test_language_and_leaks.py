"""Held-out accuracy of the language identifier, recall of the decontamination, and the pipeline's stages."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumenprep.llm import decon, langid
from lumenprep.llm.q_langid import op6_langid

SF = "/root/testdata/sf0.01"


def test_accuracy_and_contract(spark):
    got = op6_langid(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97


def test_mixtures_and_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    de, fr = (docs.filter((F.col("lang") == x) & (F.length("text") > 3000)).first()["text"][:2000] for x in ("de", "fr"))
    rows = [(1, de + " " + fr, 0.1), (2, None, 0.2), (3, "", 0.3), (4, "123 !?", 0.4), (5, de, 0.5), (5, de, 0.5), (None, "é" * 100_000, 0.6)]
    got = langid.predict(spark.createDataFrame(rows, "doc_id long, text string, score double"), model).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and set(by[1]["languages"]) == {"de", "fr"} and 0.35 < by[1]["score"] < 0.65
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (2, 3, 4)) and by[5]["languages"] == ["de"] and by[None]["lang_pred"] in model.labels
    nothing = langid.train(docs.limit(0))
    assert [r["lang_pred"] for r in langid.predict(docs.limit(2), nothing).collect()] == ["und", "und"]
    assert langid.predict(docs.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        langid.train(docs.withColumn("lang", F.col("doc_id").cast("string")), most_labels=5)


def plant(rng, text, edits):
    z = list(text)
    for _ in range(edits):
        k, how = rng.randrange(len(z)), rng.random()
        if how < 0.34:
            z[k] = rng.choice("abcdefg")
        elif how < 0.67 and len(z) > 1:
            del z[k]
        else:
            z.insert(k, rng.choice("abcdefg "))
    return "".join(z)


def test_leaks(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars < 1500").orderBy("doc_id").limit(150).collect()]
    rng, rows, planted = random.Random(4), [], set()
    for d in range(120):
        i, t = rng.choice(items)
        leak = plant(rng, t, rng.randrange(int(0.12 * len(t))))
        leak = leak.upper().replace(" ", "  \n") if d % 5 == 0 else leak
        rows.append((d, rng.choice(clean) + " " + leak + " " + rng.choice(clean), "x"))
        if 1 - decon.best_infix(decon.normalise(t).strip(), decon.normalise(rows[-1][1]))[0] / len(decon.normalise(t).strip()) >= 0.85:
            planted.add((d, i))
    rows += [(900, None, "x"), (901, "", "x"), (None, items[0][1], "x"), (902, items[1][1], "x"), (902, items[1][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([*items, (None, "x"), (999, None), (998, ""), (997, "qqzz"), items[0]], "item_id long, text string")
    got = decon.matches(docs, bench).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert len(planted & found) >= 0.97 * len(planted) > 90
    assert (None, items[0][0]) in found and sum(r["doc_id"] == 902 and r["item_id"] == items[1][0] for r in got) == 2
    text = dict((d, t) for d, t, _ in rows)
    for r in got:
        part = decon.normalise(text[r["doc_id"]][r["char_start"] : r["char_end"]]).strip()
        assert r["similarity"] >= 0.85 and abs(len(part) - len(decon.normalise(dict(items)[r["item_id"]]).strip())) <= 2 * r["distance"] + 2
    assert decon.matches(docs.limit(0), bench).count() == 0 and decon.matches(docs, bench.limit(0)).count() == 0
    assert {(r["doc_id"], r["item_id"]) for r in decon.matches(docs, bench, block_chars=2000).collect()} == found
    left = [r["doc_id"] for r in decon.decontaminate(docs, bench).collect()]
    assert set(left).isdisjoint(d for d, _ in planted & found) and {900, 901} <= set(left)


def test_embedding_keeps_equal_strings_together():
    a = decon.code_points("the quick brown fox")[None, :]
    e = decon.cgk(np.concatenate([a, a]), np.array([19, 19]), 60, np.array([3, 3]))
    assert (e[0] == e[1]).all() and (e[0] != decon.cgk(a, np.array([19]), 60, np.array([4]))[0]).any()
    assert decon.repetitions(0.99, 0.5, 2) == 17


def test_pipeline(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = docs.dtypes
    extra = spark.createDataFrame([(9001, "123", "en", "s", 3), (9002, None, "en", "s", None)], docs.schema)
    bench = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    kept = docs.unionByName(extra)
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = corpus_pipeline.save(stage(spark, before, "/root/testdata/sf0.001"), "t")
        if name != "byte-level BPE":
            assert kept.dtypes == columns, name
            assert kept.select("doc_id").exceptAll(before.select("doc_id")).count() == 0
        if name == "language ID":
            assert {r[0] for r in before.select("doc_id").subtract(kept.select("doc_id")).collect()} == {9001, 9002}
        if name == "MinHash near-dedup":
            from lumenprep.llm import minhash

            firsts = {r["class_id"] for r in minhash.classes(before).collect()}
            assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(firsts)
        if name == "benchmark decontamination":
            assert not any(decon.normalise(b).strip() in decon.normalise(r["text"]) for r in kept.select("text").collect() for b in bench)
        if name == "byte-level BPE":
            assert kept.count() == before.count() and kept.filter("n_tokens <> size(ids)").count() == 0


@pytest.mark.parametrize("similarity", [0.85, 0.86, 0.88, 0.9])
@pytest.mark.parametrize("spread", [True, False])
def test_leaks_at_the_threshold(similarity, spread):
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("etaoinshr ") for _ in range(n))
    rows = [(i, decon.normalise("x" + text(n - 2) + "x")) for i, n in enumerate([20, 40, 60, 95, 100, 150, 200, 300, 400] * 4)]
    leaks = []
    for i, t in rows:
        z, k = list(t), int((1 - similarity) * len(t) + 1e-9)
        places = [int((j + 0.5) * len(t) / k) for j in range(k)] if spread else rng.sample(range(len(t)), k)
        for p in sorted(places, reverse=True):
            how = rng.randrange(3)
            z[p : p + (how != 1)] = [] if how == 0 else ["#"]
        leaks.append(text(200) + "".join(z) + text(200))
    items = decon.Items(rows, similarity)
    near = {(t, i) for t, leak in enumerate(leaks) for i, item in rows if decon.best_infix(item, decon.normalise(leak))[0] <= (1 - similarity) * len(item) + 1e-9}
    assert len(near) >= 30 and {m[:2] for m in items.matches(leaks)} == near


def test_every_text_of_an_item_and_short_items(spark):
    one, other = "the first text of an item that has two", "a wholly different passage under one id"
    docs = spark.createDataFrame([(1, f"before {one} after"), (2, f"before {other} after"), (3, "say abzdefg now"), (4, "say abcdefg now"), (5, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, one), (7, other), (7, one), (8, "abcdefg")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["distance"]) for r in decon.matches(docs, bench).collect())
    assert got == [(1, 7, 0), (2, 7, 0), (3, 8, 1), (4, 8, 0)]
    assert [r["doc_id"] for r in decon.decontaminate(docs, bench).collect()] == [5]
