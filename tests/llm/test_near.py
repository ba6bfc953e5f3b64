"""Near-duplicate operators against brute force over small corpora, with nulls, empties, repeats and clashing names."""

import hashlib
import itertools
import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenprep.llm import lines, links, minhash, shingles, spotsigs
from lumenprep.llm.edits import best_infix, edit_distance, maybe_within
from lumenprep.llm.q_spotsigs import op4_spotsigs

VOCABULARY = [a + b for a in ("ka", "lo", "mi", "nu", "the", "of", "und", "re") for b in ("", "ta", "ren", "sol", "vik", "dor")]


def text_of(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def corpus(seed=0):
    rng = random.Random(seed)
    rows = []
    for base in (text_of(rng, 120) for _ in range(12)):
        rows.append(base)
        for _ in range(rng.randrange(4)):
            w = base.split()
            for _ in range(rng.randrange(12)):
                w[rng.randrange(len(w))] = rng.choice(VOCABULARY)
            rows.append(" ".join(w).upper() if rng.random() < 0.3 else " ".join(w))
    rows += [rows[0], rows[0], "", None, "...", "one", "one", "two words", text_of(rng, 6000)]
    return [(i * 3, t, "x", i) for i, t in enumerate(rows)] + [(None, rows[0], "x", 1), (0, rows[0], "x", 1)]


def unions(ids, pairs):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def five(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_minhash_classes(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, node string, keys int")
    sets = {d: five(t) for d, t, *_ in rows if d is not None}
    near = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = unions(sets, near)
    got = minhash.classes(df).collect()
    assert len(got) == len(rows) and {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None} == want
    assert all(r["class_id"] is None for r in got if r["doc_id"] is None)
    assert minhash.classes(df.limit(0)).count() == 0


def test_dart_estimates():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 60).astype(np.uint64)
    weights = (rng.integers(0, 6, 60), rng.integers(0, 6, 60))
    agree = []
    for r in range(60):
        mixed = shingles.mix(h + np.uint64(r))
        s = minhash.signatures(np.tile(mixed, 2), np.concatenate(weights), np.repeat([0, 1], 60), 2)
        agree.append((s[0] == s[1]).mean())
    assert np.mean(agree) == pytest.approx(np.minimum(*weights).sum() / np.maximum(*weights).sum(), abs=0.03)
    assert (minhash.signatures(np.empty(0, np.uint64), np.empty(0), np.empty(0, int), 1) == 0).all()


def test_darts_of_many_short_texts_take_little_memory():
    h, n, of = shingles.shingles([f"line {i}" for i in range(20000)])
    tracemalloc.start()
    many = minhash.signatures(h, n, of, 20000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * many.nbytes + 32e6
    assert (many[19000:19100] == minhash.signatures(h[19000:19100], n[19000:19100], of[19000:19100] - 19000, 100)).all()


def test_links_of_a_large_bucket(spark):
    points = [(i, x) for i, x in enumerate([0] * 3 + list(range(0, 300, 3)) + [1000, 1001, 5000])]
    rows = spark.createDataFrame([(b, i, (x,)) for i, x in points for b in (1, 2)], "key long, id long, at struct<x:long>")
    place = spark.createDataFrame(points, "id long, x long")

    def verify(pairs):
        a, b = place.select(F.col("id").alias("a"), F.col("x").alias("p")), place.select(F.col("id").alias("b"), F.col("x").alias("q"))
        return pairs.join(a, "a").join(b, "b").filter(F.abs(F.col("p") - F.col("q")) <= 3).select("a", "b")

    near = links.link(links.members_of(rows), [F.col("at.x")], lambda x, y: F.abs(x["x"] - y["x"]) <= 3, verify)
    got = {r["id"]: r["root"] for r in links.components(near).collect()}
    want = unions([i for i, _ in points], [(a[0], b[0]) for a, b in itertools.combinations(points, 2) if abs(a[1] - b[1]) <= 3])
    assert {i: got.get(i, i) for i, _ in points} == want


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance():
    rng = random.Random(2)
    for _ in range(400):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(14))) for _ in range(2))
        d = levenshtein(a, b)
        for most in (0, 2, 20):
            assert edit_distance(a, b, most) == (d if d <= most else None)
        least, x, y = best_infix(a, b)
        assert least == min(levenshtein(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1)) == levenshtein(a, b[x:y])


COMMON = set(spotsigs.COMMON)


def spots(text):
    w, out = re.findall(r"[^\W_]+", (text or "").lower()), set()
    for i, x in enumerate(w):
        c = [y for y in w[i + 1 : i + 13] if y not in COMMON][:2]
        if x in COMMON and len(c) == 2:
            out.add((x, *c))
    return out or ({tuple(w[i : i + 2]) for i in range(max(1, len(w) - 1))} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_spotsigs(spark, tmp_path):
    rows = [r for r in corpus(3) if r[0] is not None and r[:2] != (0, "x")][:-1]
    df = spark.createDataFrame([(*r[:2], "x", 1) for r in rows] + [(None, "a null id of all", "x", 1)], "doc_id long, text string, s string, next int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in op4_spotsigs(spark, str(tmp_path)).collect()}
    order = sorted([r[:2] for r in rows], key=lambda r: -r[0]) + [(None, "a null id of all")]
    assert len(got) == len(order)
    for (d, t), (_, following) in zip(order, order[1:] + order[:1]):
        t, following = t or "", following or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        assert got[d]["n_chars"] == len(t) and got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[d]["near_edited"] == pytest.approx(jaccard(spots(t), spots(edited))) and got[d]["near_next"] == pytest.approx(jaccard(spots(t), spots(following)))
    assert got[0]["fingerprint"] == next(got[r[0]]["fingerprint"] for r in rows[1:] if r[1] == rows[0][1])
    classes = {r["doc_id"]: r["class_id"] for r in spotsigs.classes(df.filter("doc_id IS NOT NULL")).collect()}
    sets = {d: spots(t) for d, t, *_ in rows}
    near = [(a, b) for a, b in itertools.combinations(sets, 2) if (sets[a] or sets[b] or True) and (sets[a] == sets[b] or sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.44)]
    assert classes == unions(sets, near)
    (tmp_path / "e").mkdir()
    df.limit(0).write.parquet(str(tmp_path / "e/documents.parquet"))
    assert op4_spotsigs(spark, str(tmp_path / "e")).count() == 0
    df.limit(1).write.parquet(str(tmp_path / "f/documents.parquet"))
    assert op4_spotsigs(spark, str(tmp_path / "f")).first()["near_next"] == 1.0


def typed(rng, text, edits):
    z = list(text)
    for _ in range(edits):
        k, how = rng.randrange(len(z)), rng.random()
        if how < 0.34:
            z[k] = rng.choice("aeiou")
        elif how < 0.67:
            del z[k]
        else:
            z.insert(k, rng.choice("aeiou"))
    return lines.normalise("".join(z))


def line_recall(spark, bases, copies):
    """Pairs by brute force on edit similarity alone, and those of them that end in one group: of lines, each a document."""
    texts = sorted({*bases, *copies} - {""})
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near = [(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(texts), 2) if edit_distance(a, b, int(0.1 * max(len(a), len(b)) + 1e-9)) is not None]
    kept = {r["doc_id"] for r in lines.dedup_lines(df).collect() if not r["removed"]}
    return near, unions(range(len(texts)), near), kept


def test_short_lines_by_brute_force(spark):
    rng = random.Random(7)
    bases = [lines.normalise(text_of(rng, 5)[: rng.randrange(5, 27)]) for _ in range(250)] + ["page 1 of 9 next", "(c) 2019 by acme"]
    copies = [typed(rng, b, rng.choice((1, 1, 2))) for b in bases] + ["page 2 of 9 next", "(c) 2020 by acme", "(c) 2018 by acme", "abcdefghi", "abcdefghij"]
    near, root, kept = line_recall(spark, bases, copies)
    assert len(near) > 150 and kept == set(root.values())


def test_line_typos_by_brute_force(spark):
    rng = random.Random(8)
    bases = [text_of(rng, n) for n in (10, 20, 30, 50, 120) for _ in range(40)]
    few = [typed(rng, b, rng.choice((1, 2))) for b in bases]
    near, root, kept = line_recall(spark, bases, few)
    assert len(near) >= 195 and len(kept) <= len(set(root.values())) + 1 and set(root.values()) <= kept
    many = [typed(rng, b, int(0.1 * len(b))) for b in bases]
    near, root, kept = line_recall(spark, bases, many)
    found = 1 - (len(kept) - len(set(root.values()))) / (len(root) - len(set(root.values())))
    assert len(near) >= 150 and found >= 0.75


def passage_lines(rng):
    """Lines that hold one passage, and a copy of each with edits so spread that only the passage's keys are shared."""
    passage = text_of(rng, 70)[:300]
    heads = [text_of(rng, 60)[:150] for _ in range(60)]
    copies = ["".join("_" if k % 5 == 2 else c for k, c in enumerate(h)) for h in heads]
    return [lines.normalise(h + passage) for h in heads], [lines.normalise(c + passage) for c in copies]


def test_lines_of_a_common_passage_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lines, "BLOCK", 50)
    near, root, kept = line_recall(spark, *passage_lines(random.Random(9)))
    assert len(near) >= 60 and len(set(root.values())) >= 50 and kept == set(root.values())


def test_maybe_within_refutes_only_what_is_too_far():
    rng = random.Random(11)
    for chars in (4, 60, 400, 900):
        bases = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(chars // 2, chars))) for _ in range(8)] + [""]
        texts = bases + [typed(rng, b, rng.randrange(1, 2 + chars // 5)) for b in bases[:-1] for _ in range(3) if b]
        a, b = np.array(list(itertools.permutations(range(len(texts)), 2))).T
        most = np.array([max(len(texts[i]), len(texts[j])) // 10 for i, j in zip(a, b)])
        near = [edit_distance(texts[i], texts[j], m) is not None for i, j, m in zip(a, b, most.tolist())]
        assert any(near) and not all(near) and maybe_within(texts, a, b, most)[near].all()
        assert maybe_within(texts, a, b, most).sum() < len(near) / 2 or chars == 4


def test_apart_pairs_has_all_near_pairs():
    rng = random.Random(12)
    bases, copies = passage_lines(rng)
    texts = bases + copies + [typed(rng, b, e) for b in bases[:20] for e in (3, 20, 45)] + ["la " * n for n in (9, 10, 300, 320)]
    n = len(texts)
    keys = [np.array([5, 6 + i % 3]) for i in range(n)]
    x, y = (np.concatenate(v) for v in zip(*(lines.apart_pairs(texts, np.arange(n), np.ones(n, bool), np.arange(n), keys, k, 0.9) for k in (5,))))
    other = {(i, j) for k in (6, 7, 8) for m in [[i for i in range(n) if k in keys[i]]] for p, q in zip(*lines.apart_pairs([texts[i] for i in m], np.array(m), np.ones(len(m), bool), np.array(m), [keys[i] for i in m], k, 0.9)) for i, j in [(m[p], m[q])]}
    found = {frozenset(p) for p in zip(x.tolist(), y.tolist())} | {frozenset(p) for p in other}
    near = {frozenset(p) for p in itertools.combinations(range(n), 2) if edit_distance(texts[p[0]], texts[p[1]], lines.deletions(0.9, max(len(texts[i]) for i in p))) is not None}
    assert len(near) > 100 and near <= found


def test_rows_of_large_buckets_grow_as_their_members(spark, monkeypatch):
    monkeypatch.setattr(lines, "BLOCK", 100)
    rng = random.Random(13)
    chars = [rng.randrange(30, 400) for _ in range(3000)]
    left = spark.createDataFrame([(1, i, i) for i in range(3000)] + [(2, i, i) for i in range(100)], "key long, id long, root long")
    classes = spark.createDataFrame(list(enumerate(chars)), "id long, chars int").withColumn("class", lines.length_class(F.col("chars"), 0.9))
    rows = lines.dealt(left, classes).collect()
    assert len(rows) == 3000 * (lines.STEPS + 1) + 100
    units = {}
    for r in rows:
        units.setdefault((r["key"], r["unit"]), ([], []))[r["own"]].append(r["id"])
    meet = {(a, b) for guests, own in units.values() for b in own for a in guests + own}
    assert all((a, b) in meet for a in range(1500) for b in range(1500) if chars[a] <= chars[b] and chars[a] >= 0.9 * chars[b] - 1e-9)


def test_line_dedup_holds_what_it_still_reads(spark, monkeypatch):
    live, at = {}, {}

    def save(df, name, write=lines.save):
        at[name] = {n for n, _ in live.values()}
        out = write(df, name)
        live[id(out)] = name, out
        return out

    def drop(*saved, delete=lines.drop):
        delete(*saved)
        for df in saved:
            live.pop(id(df), None)

    monkeypatch.setattr(lines, "save", save)
    monkeypatch.setattr(lines, "drop", drop)
    bases, copies = passage_lines(random.Random(9))
    assert lines.dedup_lines(spark.createDataFrame(list(enumerate(bases + copies)), "doc_id long, text string")).count() == len(bases + copies)
    assert {"line-met", "line-found", "line-ids", "line-alike", "line-words"}.isdisjoint(at["line-across"])
    assert {"line-texts", "line-known", "line-units"}.isdisjoint(at["line-last"])
    assert {n for n, _ in live.values()} == {"removed"}


def test_line_dedup_by_edit_similarity_alone(spark):
    rng = random.Random(5)
    pool = [text_of(rng, 60) for _ in range(8)]
    pool += [p.replace(p.split()[7], "zz", 1) for p in pool] + [p[:-1] + "q" for p in pool] + ["short", "Short ", "", "  "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(6)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, rows[3][1]), (3, rows[3][1]), (None, "short\nonly here and nowhere else in all of this")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, line string, row int")
    key = lambda d: (d is not None, d or 0)
    seen = sorted({(key(d), j, lines.normalise(x)) for d, t in rows for j, x in enumerate((t or "").split("\n")) if lines.normalise(x)})
    nodes = sorted({n for *_, n in seen})
    near = [(a, b) for a, b in itertools.combinations(nodes, 2) if edit_distance(a, b, int(0.1 * max(len(a), len(b)) + 1e-9)) is not None]
    assert near
    root = unions(nodes, near)
    first = {}
    for k, j, n in seen:
        first.setdefault(root[n], (k, j))
    got = lines.dedup_lines(df).collect()
    assert len(got) == len(rows)
    for r in got:
        t = next(t for d, t in rows if d == r["doc_id"])
        kept = [x for j, x in enumerate((t or "").split("\n")) if not lines.normalise(x) or first[root[lines.normalise(x)]] == (key(r["doc_id"]), j)]
        assert r["text"] == (None if t is None else "\n".join(kept))
    assert lines.dedup_lines(df.limit(0)).count() == 0
