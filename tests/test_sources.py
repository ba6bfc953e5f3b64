"""Images, JSON lines, archives, streams and the resumable pipeline on files made here."""

import io
import json
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenprep.functions import hashing as H
from lumenprep.operators.scorers import image_hashes
from lumenprep.plans.pipeline import CurationPipeline, main
from lumenprep.sources import hub, images, jsonl
from lumenprep.streaming import manifests


def png(a):
    h, w = a.shape
    part = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    raw = b"".join(b"\0" + bytes(r) for r in a.astype(np.uint8))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    rng = np.random.default_rng(0)
    for d, names in (("one", ["a.png", "b.PNG", "note.txt"]), ("two", ["a.png"])):
        (root / d / "train" / "deep").mkdir(parents=True)
        for n in names:
            (root / d / "train" / n).write_bytes(png(rng.integers(0, 255, (40, 60))))
        (root / d / "train" / "deep" / "z.png").write_bytes(png(np.zeros((9, 9))))
    (root / "three").mkdir()
    (root / "one" / "train" / "broken.png").write_bytes(b"nothing")
    return str(root)


def test_images(spark, corpus):
    got = images.load_images(spark, corpus).orderBy("ordinal").collect()
    assert [(r["dataset"], r["filename"]) for r in got] == [("one", "a.png"), ("one", "b.PNG"), ("one", "broken.png"), ("two", "a.png")]
    assert [r["ordinal"] for r in got] == [0, 1, 2, 3] and len({r["uid"] for r in got}) == 4 and len({r["id"] for r in got}) == 3
    assert images.load_images(spark, corpus + "/nowhere").count() == 0
    decoded = {r["path"].rsplit("/", 1)[1]: (r["width"], r["height"]) for r in images.decode(spark, corpus).filter("path LIKE '%/one/%'").collect()}
    assert decoded == {"a.png": (60, 40), "b.PNG": (60, 40), "broken.png": (-1, -1)}
    hashed = {r["path"].rsplit("/", 1)[1]: r["phash"] for r in image_hashes(images.decode(spark, corpus).filter("path LIKE '%/one/%'")).collect()}
    assert hashed["broken.png"] is None and hashed["a.png"] != hashed["b.PNG"]
    sizes = {r["path"].rsplit("/", 1)[1]: r["width"] for r in images.with_sizes(spark.read.format("binaryFile").load(corpus + "/one/train/*.*")).collect()}
    assert sizes == {"a.png": 60, "b.PNG": 60, "note.txt": 60, "broken.png": -1}


def test_headers():
    n = struct.pack
    assert images.header_size(b"GIF89a" + n("<HH", 7, 8)) == (7, 8)
    assert images.header_size(b"BM" + bytes(16) + n("<ii", 7, -8)) == (7, 8)
    assert images.header_size(b"RIFF\0\0\0\0WEBPVP8X" + bytes(8) + n("<I", 6)[:3] + n("<I", 7)[:3]) == (7, 8)
    assert images.header_size(b"\xff\xd8\xff\xe0" + n(">H", 4) + b"\0\0\xff\xc0" + n(">HBHH", 17, 8, 8, 7)) == (7, 8)
    assert images.header_size(b"II*\0" + n("<I", 8) + n("<H", 2) + n("<HHIHH", 256, 3, 1, 7, 0) + n("<HHII", 257, 4, 1, 8)) == (7, 8)
    assert images.header_size(b"") is None and images.header_size(b"\xff\xd8\xff") is None


def test_hashes():
    rng = np.random.default_rng(3)
    a = np.kron(rng.integers(0, 255, (8, 8)), np.ones((16, 16)))
    near = np.clip(a + rng.normal(0, 2, a.shape), 0, 255)
    for f in (H.average_hash, H.difference_hash, H.perceptual_hash, H.wavelet_hash):
        d = bin((f(a) ^ f(near)) & (2**64 - 1)).count("1")
        far = bin((f(a) ^ f(a.T[::-1])) & (2**64 - 1)).count("1")
        assert d < 8 < far, f.__name__
    assert H.edge_fraction(np.zeros((20, 20))) == 0 and H.edge_fraction(np.kron(np.indices((5, 5)).sum(0) % 2 * 255, np.ones((4, 4)))) > 0.1
    assert H.corner_edges(np.zeros((3, 3))) == [] and len(H.corner_edges(np.zeros((40, 40)))) == 4


def test_jsonl(spark, tmp_path):
    f = tmp_path / "x.jsonl"
    f.write_text('{"path":"a","v":1}\n\n{bad\n{"path":"b","v":2}\n{"path":"a","v":3}\n{"path":null,"v":4}\n')
    schema = "path string, v int"
    assert jsonl.read_lenient(spark, str(f), schema).count() == 4 and jsonl.skipped(spark, str(f)) == 1
    assert {(r["path"], r["v"], r["copies"]) for r in jsonl.read_keyed(spark, str(f), schema).collect()} == {("a", 3, 2), ("b", 2, 1)}
    with pytest.raises(Exception):
        jsonl.read_strict(spark, str(f), schema).collect()
    d = jsonl.read_dynamic(spark, str(f)).select(F.try_variant_get("entry", "$.path", "variant").isNull().alias("missing"), F.is_variant_null(F.try_variant_get("entry", "$.path", "variant")).alias("null")).collect()
    assert sorted((r[0], bool(r[1])) for r in d) == [(False, False)] * 3 + [(False, True)]
    jsonl.write(spark.createDataFrame([("a", None)], schema), str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0]) == {"path": "a", "v": None}


def test_hub(spark):
    df = spark.createDataFrame([(2, (b"x", None)), (1, (None, "u"))], "i int, pic struct<bytes:binary,path:string>")
    assert hub.detect_image_column(df.schema) == "pic"
    assert hub.detect_image_column(spark.createDataFrame([], "a_long_image_name string, image int, other int").schema) == "image"
    with pytest.raises(ValueError):
        hub.detect_image_column(spark.range(1).schema)
    assert [(r[0], bytes(r[1])) for r in hub.export_split(df, "org/set", ["i"]).collect()] == [("org__set/train/000001.jpg", b"x")]
    got = hub.export_split(df, "org/set", ["i"], spark.createDataFrame([("org__set/train/000001.jpg",)], "path string"), lambda s: s.encode()).collect()
    assert [(r[0], bytes(r[1])) for r in got] == [("org__set/train/000000.jpg", b"u")]
    rows = [("zip://a.zip::in/x.png",), ("d/a.zip/x.png",), ("x.png",), ("https://h/x.png",), (None,)]
    kinds = [(r[0], r[1]) for r in spark.createDataFrame(rows, "v string").select(hub.value_kind(F.col("v")), hub.zip_member(F.col("v"))).collect()]
    assert [k[0] for k in kinds] == ["zip", "zip", "path", "url", None] and tuple(kinds[0][1]) == ("a.zip", "in/x.png") and tuple(kinds[1][1]) == ("d/a.zip", "x.png")
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("ok.txt", "1")
        z.writestr("../bad.txt", "2")
    files = spark.createDataFrame([("p", b.getvalue()), ("q", b"no zip")], "path string, content binary")
    assert [(r["member"], bytes(r["content"])) for r in hub.extract_zips(files).collect()] == [("ok.txt", b"1")]


def _features(df):
    return df.select("*", F.lit(300).alias("width"), F.lit(300).alias("height"), F.array().cast("array<struct<label:string,score:double>>").alias("predictions"), F.xxhash64("path").alias("phash"),
        F.lit(0).alias("num_boxes"), F.lit(0.0).alias("text_area_ratio"), F.lit(1).alias("num_objects"), F.lit(1).alias("unique_classes"), F.lit(0.0).alias("dispersion"), F.lit(0.5).alias("similarity"))


def _generate(df):
    pair = lambda n: F.struct(F.concat(F.lit(f"What is number {n} of "), "path", F.lit("?")).alias("question"), F.array(*map(F.lit, "wxyz")).alias("options"), F.lit("one two three four five six seven eight nine ten red").alias("reasoning_trace"), F.lit("red").alias("answer"))
    return df.withColumn("qa_pairs", F.array(pair(1), pair(2)))


def test_pipeline_resumes(spark, tmp_path):
    rows = spark.range(10).select(F.col("id").alias("ordinal"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("path"))
    p = CurationPipeline(spark, str(tmp_path / "run"), _features, _generate)
    out, metrics = p.run(rows)
    assert metrics == {"filtered_count": 10, "bins": {"A": 4, "B": 4, "C": 2}, "generated_qa": 20, "validated_qa": 20} and out.count() == 20
    assert p.summary().first()["removal_rate_percent"] == 0.0

    def never(df):
        raise AssertionError("a stage ran again")

    assert CurationPipeline(spark, str(tmp_path / "run"), never, never).run(rows)[1] == metrics
    assert CurationPipeline(spark, str(tmp_path / "three"), _features, _generate).run(rows, wanted=3)[1]["filtered_count"] == 3
    assert main(["--data", "x", "--out", "y", "--bins-ratio", "2", "2", "1", "--dry-run"], never, never)["ratios"] == (0.4, 0.4, 0.2)


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = {"question": "What is this thing here?", "answer": "red", "reasoning": "one two three four five six seven eight nine red", "image": "i", "bin": "A"}
    (tmp_path / "in/1.json").write_text(json.dumps(good) + "\n" + json.dumps(good | {"answer": ""}) + "\n")
    manifests.write_valid(manifests.validated(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
