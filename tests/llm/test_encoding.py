"""BPE against the tiktoken library and exact round trips; token counts by brute force."""

import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenprep.llm import bpe, counts
from lumenprep.llm.q_bpe import digests

RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
MARKS = ["a", "s", "t", "'", "'s", "'re", "'ll", "'r", " ", "  ", "\n", "\t", "1", "٣", "é", "ß", "中", "!", "...", "😀", "\x85", "\x1c", "D", "́", " '", "<|endoftext|>"]


def split_ids(texts):
    ids, n, _, pieces = bpe.encoder().encode(texts)
    out, at, k = [], 0, 0
    for p in pieces:
        size = int(n[k : k + p].sum())
        out.append(ids[at : at + size].tolist())
        at, k = at + size, k + p
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(MARKS), max_size=30).map("".join), max_size=5))
def test_ids_are_tiktokens(texts):
    assert split_ids(texts) == [REFERENCE.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_round_trip_of_any_text(text):
    assert bpe.encoder().decode(split_ids([text])[0]) == text.encode()


def test_long_slices():
    for text in ("a" * 3000, "é" * 500, " " * 2000 + "x", "ab" * 1000, "!" * 777):
        assert split_ids([text]) == [REFERENCE.encode_ordinary(text)]


def test_query_and_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "it's  fine\n\n", "x"), (3, "it's  fine\n\n", "x"), (None, "z" * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = digests(docs).collect()
    want = sorted((str(d), len(REFERENCE.encode_ordinary(t or "")), hashlib.sha256((t or "").encode()).hexdigest()) for d, t, _ in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["decoded_sha256"]) for r in got) == want
    ids = " ".join(map(str, REFERENCE.encode_ordinary("it's  fine\n\n")))
    assert {r["ids_sha256"] for r in got if r["doc_id"] == 3} == {hashlib.sha256(ids.encode()).hexdigest()}
    assert digests(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(docs, keep=("doc_id", "ids"))
    assert bpe.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")).orderBy("doc_id").select("decoded").collect()[0][0] is None


def brute(text, sections, rule):
    ids, offsets = REFERENCE.encode_ordinary(text), []
    data, at = text.encode(), 0
    chars = [i for i, c in enumerate(text) for _ in c.encode()]
    out = {k: 0.0 for k in range(-1, len(sections))}
    for i in ids:
        size = len(REFERENCE.decode_single_token_bytes(i))
        span = sorted(set(chars[at : at + size]))
        at += size
        where = [next((k for k, (a, b) in enumerate(sections) if a <= c < b), -1) for c in span]
        if rule == "fraction":
            for w in where:
                out[w] += 1 / len(where)
        else:
            out[{"start": where[0], "end": where[-1], "majority": max(where, key=lambda w: (where.count(w), -where.index(w)))}[rule]] += 1
    assert at == len(data)
    return out


@pytest.mark.parametrize("rule", counts.RULES)
def test_attribution(spark, rule):
    texts = {1: "Hello world\n\n\nit's 日本語 here\nlast", 2: "", 3: "\n", 4: "one line", 5: None, 6: "😀" * 20}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    pieces = lambda t: [(i, min(i + 3, len(t))) for i in range(1, len(t), 5)]
    for split in (counts.lines_of, pieces):
        got = {(r["doc_id"], r["section"]): r["n_tokens"] for r in counts.attribute(docs, split, rule).collect()}
        for d, t in texts.items():
            for k, n in brute(t or "", split(t or ""), rule).items():
                assert got.get((d, k), 0) == pytest.approx(n), (d, k)
    assert counts.attribute(docs.limit(0), rule=rule).count() == 0


def test_fields(spark):
    rows = spark.createDataFrame([(1, "a title", "and a body"), (2, None, "body")], "doc_id long, title string, body string")
    got = counts.attribute_fields(rows, ("title", "body")).groupBy("doc_id").agg(F.sum("n_tokens")).collect()
    assert {r[0]: r[1] for r in got} == {1: len(REFERENCE.encode_ordinary("a title\nand a body")), 2: len(REFERENCE.encode_ordinary("\nbody"))}
    with pytest.raises(ValueError):
        counts.attribute(rows, rule="best")
