"""Boundary rows of the operators, and greedy dedup, ranks and word splitting against plain Python."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from lumenprep.config import BinningConfig, Config, FilterConfig, from_mapping, normalised_ratios
from lumenprep.functions import geometry as G
from lumenprep.functions import text as X
from lumenprep.operators import binning as B
from lumenprep.operators import dedup as D
from lumenprep.operators import features as E
from lumenprep.operators import filters as K
from lumenprep.operators import metrics as M
from lumenprep.operators import package as P
from lumenprep.operators import retry as R
from lumenprep.operators import scorers
from lumenprep.operators import synthesis as S
from lumenprep.operators import validation as V
from lumenprep.operators.rank import with_rank


def column(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}").orderBy("i").select(expr).collect()]


def greedy(rows, t):
    kept, out = [], []
    for o, h in sorted(rows):
        if h is None or all(bin((h ^ k) & (2**64 - 1)).count("1") >= t for k in kept):
            out.append(o)
            if h is not None:
                kept.append(h)
    return out


@pytest.mark.parametrize("blocks", [8, 10])
def test_greedy_dedup(spark, blocks):
    rng = random.Random(blocks)
    base = [rng.getrandbits(64) for _ in range(12)]
    rows = []
    for i in range(150):
        h = rng.choice(base)
        for b in rng.sample(range(64), rng.choice([0, 2, 4, 7, 8])):
            h ^= 1 << b
        rows.append((i, h - 2**64 if h >= 2**63 else h))
    rows += [(200, None), (201, None), (202, -1), (203, -1)]
    df = spark.createDataFrame(rows, "ordinal long, phash long")
    assert sorted(r[0] for r in D.greedy_dedup(df, blocks=blocks).select("ordinal").collect()) == greedy(rows, 8)


def test_greedy_dedup_chain_and_seen(spark):
    a, b, c = 0, (1 << 7) - 1, (1 << 14) - 1  # 7 apart, the ends 14
    df = spark.createDataFrame([(1, a), (2, b), (3, c)], "ordinal long, phash long")
    assert sorted(r[0] for r in D.greedy_dedup(df).select("ordinal").collect()) == [1, 3]
    seen = spark.createDataFrame([(b,)], "phash long")
    assert D.greedy_dedup(df, seen=seen).count() == 0
    assert D.greedy_dedup(df.limit(0)).count() == 0


def test_cascade_order(spark):
    bad = [("NSFW", 0.9)]
    df = spark.createDataFrame([(1, 300, 300, bad, 5), (2, 300, 300, [], 5), (3, 255, 4000, [], 99), (4, -1, -1, [], 123456789)], "ordinal long, width int, height int, predictions array<struct<label:string,score:double>>, phash long")
    assert [r[0] for r in K.cascade(df).select("ordinal").collect()] == [2]
    assert K.cascade(df, FilterConfig(order=("resolution", "dedup", "nsfw"))).count() == 0
    assert [r[0] for r in K.cascade(df.withColumn("path", F.lit("p")), FilterConfig(order=("resolution",)), 1).select("ordinal").collect()] == [1]


def test_predicates(spark):
    preds = "p array<struct<label:string,score:double>>, e boolean"
    rows = [([("nsfw", 0.5)], False), ([("NSFW", 0.5001)], False), ([], False), (None, False), ([], True)]
    assert column(spark, K.nsfw_ok(0.5, "p", "e"), rows, preds) == [True, False, True, True, False]
    assert column(spark, K.watermark_ok(0.3, "r"), [([0.3, 0.1],), ([0.31],), (None,)], "r array<double>") == [True, False, True]
    assert column(spark, K.resolution_ok(256, 4000, "w", "h"), [(256, 256), (255, 999), (None, 300), (300, 4001)], "w int, h int") == [True, False, False, False]


def test_oversample_is_exact(spark):
    df = spark.range(100).select(F.col("id").alias("ordinal"), F.col("id").cast("string").alias("path"))
    got = K.oversample(df, 10)
    assert sorted(r["ordinal"] for r in got.collect()) == list(range(20)) and got.select("path").distinct().count() == 20
    assert K.oversample(df, 50).count() == 100 and K.oversample(df, -1).count() == 100


def test_words_are_str_split(spark):
    rng = random.Random(1)
    marks = ["a", "b", ".", " ", "\t", "\n", "\x1c", "\x85", "\xa0", " ", " ", " ", "　", "​", "é"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(30))) for _ in range(300)]
    assert column(spark, X.tokens(F.col("s")), [(t,) for t in texts], "s string") == [t.split() for t in texts]
    assert column(spark, X.strip(F.col("s")), [(t,) for t in texts], "s string") == [t.strip() for t in texts]


def test_paths(spark):
    from pathlib import PurePosixPath as Q

    paths = ["/a/b.tar.gz", "/a/.hidden", "/a/none", "x.PNG"]
    assert column(spark, X.stem(F.col("s")), [(p,) for p in paths], "s string") == [Q(p).stem for p in paths]
    assert column(spark, X.suffix(F.col("s")), [(p,) for p in paths], "s string") == [Q(p).suffix for p in paths]


def test_boxes(spark):
    box = "b array<struct<x1:double,y1:double,x2:double,y2:double>>, w double, h double"
    rows = [(None, 10.0, 10.0), ([], 10.0, 10.0), ([(0.0, 0.0, 10.0, 10.0), (10.0, 10.0, 0.0, 0.0)], 10.0, 10.0), ([(0.0, 0.0, 1.0, 1.0)], 0.0, 5.0)]
    assert column(spark, G.text_area_ratio(F.col("b"), F.col("w"), F.col("h")), rows, box) == [0.0, 0.0, 2.0, 0.0]
    got = column(spark, G.polygon_box(F.col("p")), [([(1.0, 5.0), (3.0, 2.0)],)], "p array<struct<x:double,y:double>>")[0]
    assert tuple(got) == (1.0, 2.0, 3.0, 5.0)
    areas = spark.createDataFrame([(1, 5.0)] + [(2, 3.0)] * 4 + [(3, float(x)) for x in range(12)], "k int, area double")
    assert {r["k"]: r["unique_classes"] for r in E.area_classes(areas, "k").collect()} == {1: 1, 2: 1, 3: 10}
    assert column(spark, E.class_names(F.col("c"), {0: "cat"}), [([0, 7, 0],)], "c array<int>") == [["cat", "class_7"]]
    assert column(spark, E.text_content(F.col("t")), [([" a ", "", "b"],)], "t array<string>") == ["a b"]


FEATURES = "ordinal long, num_boxes int, text_area_ratio double, unique_classes int, num_objects int, dispersion double, similarity double"


def test_rule_bins(spark):
    rows = [(1, 2, 0.2, 3, 5, 0.9, 0.25), (2, 3, 0.0, 9, 9, 0.0, 0.0), (3, 0, 0.2001, 0, 0, 0.0, 0.0), (4, 0, 0.0, 4, 0, 0.0, 0.0), (5, 0, 0.0, 0, 6, 0.0, 0.0)]
    df = spark.createDataFrame(rows, FEATURES)
    assert [r[0] for r in df.orderBy("ordinal").select(B.rule_bin()).collect()] == ["C", "A", "A", "B", "B"]


@pytest.mark.parametrize("n", [1, 5, 12, 40])
def test_rank_bins_is_the_chained_sort(spark, n):
    rng = random.Random(n)
    rows = [(i, 0, rng.choice([0.0, 0.1, 0.5]), 0, rng.choice([1, 2]), 0.0, rng.choice([0.1, 0.2])) for i in range(n)]
    left = sorted(rows, key=lambda r: r[2], reverse=True)
    want = []
    for name, ratio, key in (("A", 0.4, 2), ("B", 0.4, 4), ("C", 0.2, 6)):
        left.sort(key=lambda r: r[key], reverse=True)
        k = int(n * ratio)
        want += [(name, i + 1, r[0]) for i, r in enumerate(left[:k])]
        left = left[k:]
    got = B.rank_bins(spark.createDataFrame(rows, FEATURES))
    assert sorted((r["bin"], r["bin_rank"], r["ordinal"]) for r in got.collect()) == sorted(want)
    assert B.rank_bins(spark.createDataFrame(rows, FEATURES), size=0).count() == 0
    assert B.rank_bins(spark.createDataFrame(rows, FEATURES), size=100 * n).count() == n


def test_rank_and_criteria(spark):
    df = spark.range(1000).withColumn("h", F.xxhash64("id"))
    got = with_rank(df, [F.col("h").desc(), F.col("id")], "r").orderBy("r").collect()
    assert [r["r"] for r in got] == list(range(1, 1001)) and all(a["h"] >= b["h"] for a, b in zip(got, got[1:]))
    out = B.with_criteria(spark.range(2), {"odd": F.col("id") % 2 == 1, "broken": lambda d: d["no_such"], "unknown": F.lit(None).cast("boolean")}).orderBy("id").collect()
    assert [tuple(r)[1:] for r in out] == [("FAIL", "ERROR", "ERROR"), ("PASS", "ERROR", "ERROR")]
    assert normalised_ratios((2, 2, 1)) == (0.4, 0.4, 0.2) and normalised_ratios((0.4, 0.4, 0.205)) == (0.4, 0.4, 0.205)
    c = from_mapping(Config, {"filtering": {"min_resolution": 100, "unread": 1}, "binning": {"object_count_threshold": 2}})
    assert c.filtering.min_resolution == 100 and c.binning.object_count_threshold == 2 and c.binning.unique_objects_threshold == BinningConfig().unique_objects_threshold


def test_validator(spark):
    w = lambda n: " ".join(["w"] * n)
    good = ("What is it now then?", "red", "the thing is red and one two three four five six")
    rows = [good, ("", "a", "b"), (None, "a", "b"), ("what " + w(3), *good[1:]), ("what " + w(199), *good[1:]), ("what " + w(200), *good[1:]),
            ("What\xa0is\x1cit now then?", *good[1:]), ("what is it all about", "a terror", good[2] + " terror"), ("it ends with a mark? ", *good[1:]), (good[0], "the of", good[2]), (good[0], "blue green", good[2])]
    got = column(spark, V.reject_reason(), rows, "question string, answer string, reasoning string")
    assert got == [None, "required", "required", "length", None, "length", None, "content", "content", None, "grounding"]
    df = spark.createDataFrame([(1, "ab", "c"), (2, "a", "bc"), (3, "x", None), (4, "x", "")], "ordinal long, question string, answer string")
    assert sorted(r[0] for r in D.remove_exact(df).select("ordinal").collect()) == [1, 3]


def test_requests():
    calls, waits = iter([(429, ""), (503, ""), (200, '{"ok": 1}')]), []
    assert S.request(lambda: next(calls), sleep=waits.append) == {"ok": 1} and waits == [2.0, 2.0, 0.5]
    for reply in ((404, "no"), (200, "{"), (200, '{"error": "x"}')):
        with pytest.raises(RuntimeError):
            S.request(lambda reply=reply: reply, sleep=waits.append)
    with pytest.raises(RuntimeError, match="no response"):
        S.request(lambda: (None, ""), sleep=waits.append)


def test_model_calls_keep_errors(spark):
    def send(p):
        if p == "bad":
            raise ValueError("no")
        return p.upper()

    got = S.call_model(spark.createDataFrame([(1, "bad"), (2, "fine")], "ordinal long, prompt string"), "prompt", send).orderBy("ordinal").collect()
    assert [(r["response"], r["error"]) for r in got] == [(None, "no"), ("FINE", None)]
    text, error = S.description(F.col("r"))
    rows = [('{"choices":[{"message":{"content":" hi "}}]}',), ('{"choices":[{"message":{"content":" "}}]}',), ('{"error":"x"}',), ("{}",)]
    assert column(spark, text, rows, "r string") == ["hi", None, None, None]
    assert [bool(e) for e in column(spark, error, rows, "r string")] == [False, True, True, True]


def test_retry(spark):
    a = spark.createDataFrame([("k1", "old", 1), ("k2", "x", 2), (None, "n", 3), ("k1", "new", 4)], "path string, v string, line_no long")
    assert {(r["path"], r["v"], r["line_no"], r["copies"]) for r in R.last_wins(a).collect()} == {("k1", "new", 1, 2), ("k2", "x", 2, 1)}
    b = spark.createDataFrame([("k2", "y", 1), ("k3", "z", 2)], "path string, v string, line_no long")
    assert {(r["path"], r["v"], r["origin"]) for r in R.merge(a, b).collect()} == {("k1", "new", "original"), ("k2", "y", "conflict"), ("k3", "z", "retry")}
    assert {(r["path"], r["v"]) for r in R.merge(a, b, prefer="original").collect()} == {("k1", "new"), ("k2", "x"), ("k3", "z")}
    assert [r["path"] for r in R.merge(a, b).orderBy("place").collect()] == ["k1", "k2", "k3"]
    assert R.failure_counts(a.limit(0), b).first()["failed_pct"] == 0.0
    full = '{"path":1,"id":2,"ocr_text":null,"detected_objects":[],"bin":"A","reasoning_description":"d"}'
    rows = [(full,), (full.replace('"d"', '" "'),), (full.replace('"bin":"A",', ""),), ("{",)]
    got = column(spark, R.entry_error(F.col("s")), rows, "s string")
    assert got[0] is None and "reasoning_description" in got[1] and got[2] == "missing field: bin" and got[3] == "no JSON"


def test_package(spark, tmp_path):
    out = str(tmp_path / "t")
    assert P.replace_table(spark.range(3), out) is None
    assert P.replace_table(spark.range(5), out, 7) == f"{out}.backup_7"
    assert spark.read.json(out).count() == 5 and spark.read.json(f"{out}.backup_7").count() == 3
    got = column(spark, P.fitted(F.col("w"), F.col("h")), [(840, 100), (1680, 1), (1000, 501)], "w int, h int")
    assert [tuple(x) for x in got] == [(840, 100), (840, 0), (840, 421)]
    files = spark.createDataFrame([("a", b"x"), ("b", b"")], "path string, content binary")
    rows = spark.createDataFrame([("a", "p"), ("b", "q"), ("c", "r")], "image string, problem string")
    assert [bytes(r["image"]["bytes"]) for r in P.embed_images(rows, files).collect()] == [b"x"]
    (tmp_path / "f.jpg").write_bytes(b"1")
    found, missing = P.collect(spark.createDataFrame([("i1", str(tmp_path / "f.jpg")), ("i2", "gone")], "id string, path string"), spark.createDataFrame([(str(tmp_path / "f.jpg"),)], "path string"))
    P.copy_files(found, str(tmp_path / "out"))
    assert (tmp_path / "out/images/i1.jpg").read_bytes() == b"1" and missing.count() == 1
    assert M.value_counts(spark.createDataFrame([("a",), ("a",), ("b",)], "x string"), "x").first()["count"] == 2


def test_scorers(spark):
    import pandas as pd

    s = scorers.BatchScorer(lambda p: pd.DataFrame({"score": p["id"] * 2.0}), ("id",), "score double", batch=3)
    scorers.register("nsfw", "vit", s)
    assert scorers.scorer("nsfw", "other") is s and scorers.scorer("qa", "none") is None
    assert {(r["id"], r["score"]) for r in s.apply(spark.range(7)).collect()} == {(i, 2.0 * i) for i in range(7)}
    assert scorers.ConstantScorer(x="id + 1").apply(spark.range(1)).first()["x"] == 1


def test_run_logger(tmp_path):
    import logging

    from lumenprep.log import run_logger

    log = run_logger("lumenprep-test", str(tmp_path / "logs"))
    assert run_logger("lumenprep-test", str(tmp_path / "logs")) is log and len(log.handlers) == 2
    log.info("three of four kept")
    assert "lumenprep-test - INFO - three of four kept" in next((tmp_path / "logs").glob("*.log")).read_text()
    for h in list(log.handlers):
        h.close()
        log.removeHandler(h)
    assert logging.getLogger("lumenprep-test") is log


def test_first_entries(spark):
    from lumenprep.operators.synthesis import first_entries

    df = spark.createDataFrame([(i, f"e{i}") for i in (3, 1, 2)], "ordinal long, e string")
    assert [r["e"] for r in first_entries(df, 2).collect()] == ["e1", "e2"]
    assert first_entries(df, 0).count() == first_entries(df, -1).count() == 3


def test_word_count_and_histogram_read_once(spark):
    white = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    texts = [None, "", " ", white, "a", f"{white}a{white}b​ c{white}", "é à　中 \x7f !~", *[f"x{w}y{w}{w}z" for w in white]]
    assert column(spark, X.word_count(F.col("t")), [(t,) for t in texts], "t string") == [None if t is None else len(t.split()) for t in texts]
    seen = spark.sparkContext.accumulator(0)

    def length(t):
        seen.add(1)
        return None if t is None else len(t)

    df = spark.createDataFrame([(t,) for t in ["", "a", "b" * 40, "c" * 39, None]], "t string").select(F.udf(length, "long")("t").alias("n"))
    assert {r["bin"]: r["n"] for r in M.length_histogram(df, "n", 20).collect()} == {0: 2, 19: 2}
    assert seen.value == 5


def test_greedy_dedup_of_a_large_cluster_writes_no_pairs(spark, monkeypatch):
    rows = [(i, sum(1 << b for b in c)) for i, c in enumerate(combinations(range(20), 3))]  # 1,140 hashes, at most 6 apart
    rows += [(2000 + i, (1 << 40) - 1 << 24 ^ 1 << b) for i, b in enumerate(range(64))]
    rows = [(i, h - 2**64 if h >= 2**63 else h) for i, h in rows]
    written, write = [], D.save

    def save(df, name):
        out = write(df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(D, "save", save)
    df = spark.createDataFrame(rows, "ordinal long, phash long")
    assert sorted(r[0] for r in D.greedy_dedup(df).select("ordinal").collect()) == greedy(rows, 8)
    assert sum(written) <= 2 * len(rows)


def test_greedy_dedup_any_hash_over_blocks(spark):
    rng = random.Random(3)
    base = [[rng.getrandbits(63) for _ in range(3)] for _ in range(10)]
    rows = [(i, *[None if rng.random() < 0.1 else x ^ sum(1 << b for b in rng.sample(range(63), rng.choice([0, 3, 6, 12, 30]))) for x in rng.choice(base)]) for i in range(300)]
    kept, want = [], []
    for i, *h in rows:
        if not any(a is not None and b is not None and bin(a ^ b).count("1") < 8 for k in kept for a, b in zip(h, k, strict=True)):
            want.append(i)
            kept.append(h)
    df = spark.createDataFrame(rows, "ordinal long, h0 long, h1 long, h2 long")
    for blocks in (1, 4, None):
        assert sorted(r[0] for r in D.greedy_dedup(df, ["h0", "h1", "h2"], blocks=blocks).select("ordinal").collect()) == want


@pytest.mark.parametrize("blocks", [1, 3, None])
def test_near_pairs(spark, blocks):
    rng = random.Random(7)
    base = [rng.getrandbits(63) for _ in range(6)]
    rows = [(i, *[None if rng.random() < 0.1 else rng.choice(base) ^ sum(1 << b for b in rng.sample(range(63), rng.choice([0, 3, 5]))) for _ in range(2)]) for i in range(200)]
    rows += [(1000 + i, 5, None) for i in range(40)]
    want = {}
    for a, b in combinations(rows, 2):
        d = [bin(x ^ y).count("1") for x, y in zip(a[1:], b[1:], strict=True) if x is not None and y is not None]
        if d and min(d) < 8:
            want[a[0], b[0]] = min(d)
    got = D.near_pairs(spark.createDataFrame(rows, "ordinal long, h0 long, h1 long"), ["h0", "h1"], "ordinal", 8, blocks)
    found = got.collect()
    assert len(found) == len(want) and {(r["first"], r["second"]): r["distance"] for r in found} == want
    # Rows are dealt once; pairs are not shuffled.
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Repartition") == 1
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_simhashes(spark):
    from hashlib import md5

    from lumenprep.functions.hashing import simhashes

    texts = [None, "", " \n", "a b a\nc", " ".join(f"w{i}" for i in range(20000)) + " a" * 9000, "é\tü é"]
    for salts in (("",), ("", "a")):
        for text, got in zip(texts, simhashes(texts, salts), strict=True):
            words = [w for w in (text or "").replace("\n", " ").split(" ") if w]
            if not words:
                assert got is None
                continue
            for salt, h in zip(salts, got.tolist(), strict=True):
                each = [int.from_bytes(md5((salt + w).encode()).digest()[:8]) for w in words]
                assert h & 2**64 - 1 == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in each) > len(each))
