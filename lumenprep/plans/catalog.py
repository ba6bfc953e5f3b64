"""Named queries over the driver's tables and the SQL that each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FilterConfig
from ..functions import geometry as G
from ..functions import text as X
from ..operators import binning as B
from ..operators import dedup as D
from ..operators import features as E
from ..operators import filters as K
from ..operators import metrics as M
from ..operators import package as P
from ..operators import retry as R
from ..operators import synthesis as S
from ..operators import validation as V
from ..sources import hub as H
from . import proxies as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def values(rows: list[tuple], names: str) -> str:
    """A VALUES table of Python rows for DuckDB."""

    def lit(x: object) -> str:
        if x is None:
            return "NULL"
        if isinstance(x, list):
            return "[" + ", ".join(map(lit, x)) + "]"
        return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else repr(x)

    return "(VALUES " + ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows) + f") AS v({names})"


IMAGES = """images AS (SELECT d.doc_id AS ordinal, d.source || '/train/' || d.doc_id AS path, d.source AS dataset, d.n_chars AS side, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
FEATURES = """features AS (SELECT l_orderkey AS ordinal, count(*) FILTER (l_returnflag = 'R') AS num_boxes,
  CAST(coalesce(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) FILTER (l_returnflag = 'R'), 0) AS DOUBLE) / 1e8 AS text_area_ratio,
  count(*) AS num_objects, count(DISTINCT p_type) AS unique_classes,
  (max(l_quantity) - min(l_quantity)) * CAST(max(CAST(round(l_extendedprice * 100) AS BIGINT)) - min(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 5e8 AS dispersion,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) % 1000 AS DOUBLE) / 1000.0 AS similarity
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)"""
RULE = """CASE WHEN num_boxes > 2 OR text_area_ratio > 0.2 THEN 'A' WHEN unique_classes > 3 OR num_objects > 5 THEN 'B' ELSE 'C' END"""


# Stage 1: filters


@query(f"WITH {IMAGES} SELECT ordinal, path FROM images WHERE side >= 256")
def filter_resolution(spark, sf_dir):
    return T.images(spark, sf_dir).filter(K.resolution_ok(256)).select("ordinal", "path")


@query(f"WITH {IMAGES} SELECT ordinal, path FROM images WHERE coalesce(toxic, 0) <> 1")
def filter_nsfw(spark, sf_dir):
    return T.images(spark, sf_dir).filter(K.nsfw_ok()).select("ordinal", "path")


@query(
    f"""WITH {IMAGES}, c AS (SELECT count(*) AS n_in, count(*) FILTER (side >= 256) AS n_resolution, count(*) FILTER (side >= 256 AND coalesce(toxic, 0) <> 1) AS n_nsfw FROM images)
SELECT *, round(100.0 * CAST(n_resolution AS DOUBLE) / n_in, 4) AS pct_resolution, round(100.0 * CAST(n_nsfw AS DOUBLE) / n_in, 4) AS pct_nsfw FROM c"""
)
def filter_cascade_funnel(spark, sf_dir):
    return K.funnel(T.images(spark, sf_dir))


@query(f"WITH {FEATURES} SELECT ordinal FROM features WHERE unique_classes > 3 OR num_objects > 5 OR dispersion > 0.3")
def complexity_filter(spark, sf_dir):
    return T.features(spark, sf_dir).filter(K.complexity_ok()).select("ordinal")


@query(f"WITH {FEATURES} SELECT ordinal, num_objects, abs(num_objects - 5) AS distance FROM features WHERE abs(num_objects - 5) <= 2 AND text_area_ratio > 0.1")
def near_threshold(spark, sf_dir):
    near = F.abs(F.col("num_objects") - 5)
    return T.features(spark, sf_dir).filter((near <= 2) & (F.col("text_area_ratio") > 0.1)).select("ordinal", "num_objects", near.alias("distance"))


@query(
    """SELECT page_id, url LIKE 'http://%' OR url LIKE 'https://%' AS is_url, CASE WHEN url LIKE 'http://%' OR url LIKE 'https://%' THEN 'url' ELSE 'path' END AS kind,
  replace(url, '/', '__') AS safe_name FROM pages"""
)
def image_value_kinds(spark, sf_dir):
    return T.table(spark, sf_dir, "pages").select("page_id", X.is_url(F.col("url")).alias("is_url"), H.value_kind(F.col("url")).alias("kind"), X.sanitize_repo_id(F.col("url")).alias("safe_name"))


# Stage 1: near-duplicates


def _bits(salt: str, n: int) -> str:
    word = f"md5('{salt}' || w)"
    return f"""h{n} AS (SELECT ordinal, CAST(sum(CASE WHEN s > 0 THEN CASE WHEN b = 0 THEN -9223372036854775808::HUGEINT ELSE 1::HUGEINT << (63 - b) END ELSE 0 END) AS BIGINT) AS h{n}
  FROM (SELECT ordinal, b, sum(CASE WHEN (CAST('0x' || substr({word}, CAST(8 * (b // 32) + 1 AS INT), 8) AS BIGINT) >> (31 - b % 32)) & 1 = 1 THEN 1 ELSE -1 END) AS s
    FROM words, (SELECT unnest(range(64)) AS b) GROUP BY ordinal, b) GROUP BY ordinal)"""


WORDS = "words AS (SELECT doc_id AS ordinal, unnest(regexp_extract_all(text, '[^ \\n]+')) AS w FROM documents)"
GREEDY = """ordered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY ordinal) AS step FROM hashed),
pass AS (SELECT 0::BIGINT AS step, []::BIGINT[] AS kept, []::BIGINT[] AS ids
  UNION ALL SELECT o.step, CASE WHEN dup THEN kept ELSE list_append(kept, o.h) END, CASE WHEN dup THEN ids ELSE list_append(ids, o.ordinal) END
  FROM (SELECT o.*, p.kept, p.ids, len(list_filter(p.kept, lambda k: bit_count(xor(k, o.h)) < 8)) > 0 AS dup FROM pass p JOIN ordered o ON o.step = p.step + 1) o)"""


@query(f"WITH {WORDS}, {_bits('', 0)} SELECT a.ordinal AS first, b.ordinal AS second, CAST(bit_count(xor(a.h0, b.h0)) AS BIGINT) AS distance FROM h0 a JOIN h0 b ON a.ordinal < b.ordinal AND bit_count(xor(a.h0, b.h0)) < 8")
def near_dup_pairs(spark, sf_dir):
    from ..tables import save

    return D.near_pairs(save(T.hashes(spark, sf_dir), "hashes"), ["h0"], "ordinal", 8)


@query(f"WITH RECURSIVE {WORDS}, {_bits('', 0)}, hashed AS (SELECT ordinal, h0 AS h FROM h0), {GREEDY} SELECT unnest(ids) AS ordinal FROM (SELECT ids FROM pass ORDER BY step DESC LIMIT 1)")
def near_dup_greedy(spark, sf_dir):
    from ..tables import save

    return D.greedy_dedup(save(T.hashes(spark, sf_dir), "hashes"), "h0", "ordinal", 8).select("ordinal")


ANY_SALTS = ("", "a", "b", "c")
ANY = ", ".join(_bits(s, i) for i, s in enumerate(ANY_SALTS))


@query(
    f"""WITH RECURSIVE {WORDS}, {ANY}, hashed AS (SELECT ordinal, h0, h1, h2, h3 FROM h0 JOIN h1 USING (ordinal) JOIN h2 USING (ordinal) JOIN h3 USING (ordinal)),
ordered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY ordinal) AS step FROM hashed),
pass AS (SELECT 0::BIGINT AS step, []::STRUCT(a BIGINT, b BIGINT, c BIGINT, d BIGINT)[] AS kept, []::BIGINT[] AS ids
  UNION ALL SELECT o.step, CASE WHEN dup THEN kept ELSE list_append(kept, {{'a': o.h0, 'b': o.h1, 'c': o.h2, 'd': o.h3}}) END, CASE WHEN dup THEN ids ELSE list_append(ids, o.ordinal) END
  FROM (SELECT o.*, p.kept, p.ids, len(list_filter(p.kept, lambda k: bit_count(xor(k.a, o.h0)) < 8 OR bit_count(xor(k.b, o.h1)) < 8 OR bit_count(xor(k.c, o.h2)) < 8 OR bit_count(xor(k.d, o.h3)) < 8)) > 0 AS dup
    FROM pass p JOIN ordered o ON o.step = p.step + 1) o)
SELECT unnest(ids) AS ordinal FROM (SELECT ids FROM pass ORDER BY step DESC LIMIT 1)"""
)
def near_dup_any_hash(spark, sf_dir):
    from ..tables import save

    return D.greedy_dedup(save(T.hashes(spark, sf_dir, ANY_SALTS), "hashes"), ["h0", "h1", "h2", "h3"], "ordinal", 8).select("ordinal")


@query(
    f"""WITH RECURSIVE {IMAGES}, {WORDS}, {_bits('', 0)}, hashed AS (SELECT ordinal, h0 AS h FROM h0 JOIN images USING (ordinal) WHERE side >= 256 AND coalesce(toxic, 0) <> 1), {GREEDY}
SELECT unnest(ids) AS ordinal FROM (SELECT ids FROM pass ORDER BY step DESC LIMIT 1)"""
)
def filter_cascade(spark, sf_dir):
    from ..tables import save

    rows = T.images(spark, sf_dir).join(T.hashes(spark, sf_dir).withColumnRenamed("h0", "phash"), "ordinal", "left")
    return K.cascade(save(rows, "images"), FilterConfig()).select("ordinal")


@query(
    f"""WITH RECURSIVE {IMAGES}, {WORDS}, {_bits('', 0)}, hashed AS (SELECT ordinal, h0 AS h FROM h0 JOIN images USING (ordinal) WHERE side >= 256), {GREEDY}
SELECT ordinal FROM (SELECT unnest(ids) AS ordinal FROM (SELECT ids FROM pass ORDER BY step DESC LIMIT 1)) JOIN images USING (ordinal) WHERE coalesce(toxic, 0) <> 1"""
)
def filter_cascade_dedup_first(spark, sf_dir):
    from ..tables import save

    rows = T.images(spark, sf_dir).join(T.hashes(spark, sf_dir).withColumnRenamed("h0", "phash"), "ordinal", "left")
    return K.cascade(save(rows, "images"), FilterConfig(order=("resolution", "dedup", "nsfw"))).select("ordinal")


# Stage 2: features


@query(
    """SELECT l_orderkey AS image, count(*) AS num_objects, count(DISTINCT p_type) AS unique_classes,
  (max(l_quantity) - min(l_quantity)) * (max(l_extendedprice) - min(l_extendedprice)) / 5000000.0::DOUBLE AS dispersion
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey"""
)
def dispersion_bbox(spark, sf_dir):
    d = T.detections(spark, sf_dir)
    return d.groupBy("image").agg(F.count("*").alias("num_objects"), F.countDistinct("cls").alias("unique_classes"), G.dispersion(F.col("cx"), F.col("cy"), T.WIDTH, T.HEIGHT).alias("dispersion"))


@query(
    """SELECT o_orderkey AS image, coalesce(n, 0) AS num_objects, coalesce(c, 0) AS unique_classes, coalesce(d, 0.0) AS dispersion FROM orders LEFT JOIN (
  SELECT l_orderkey, count(*) AS n, count(DISTINCT p_type) AS c, (max(l_quantity) - min(l_quantity)) * (max(l_extendedprice) - min(l_extendedprice)) / 5000000.0::DOUBLE AS d
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey) ON l_orderkey = o_orderkey"""
)
def object_features(spark, sf_dir):
    images = T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image"), F.lit(T.WIDTH).alias("width"), F.lit(T.HEIGHT).alias("height"))
    out = E.object_features(images, T.detections(spark, sf_dir), "image")
    return out.select("image", "num_objects", "unique_classes", "dispersion")


@query("SELECT l_orderkey AS image, CASE WHEN count(*) <= 1 THEN 0.0 ELSE round((stddev_pop(l_quantity) + stddev_pop(l_extendedprice)) / 2 / 100000.0, 9) END AS dispersion FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey")
def dispersion_std(spark, sf_dir):
    return T.detections(spark, sf_dir).groupBy("image").agg(F.round(G.dispersion_std(F.col("cx"), F.col("cy"), 100000.0), 9).alias("dispersion"))


@query(
    """WITH d AS (SELECT l_orderkey AS image, l_quantity * 10 AS area FROM lineitem JOIN part ON l_partkey = p_partkey),
b AS (SELECT image, count(*) AS n, min(area) AS lo, max(area) AS hi FROM d GROUP BY image)
SELECT image, max(n) AS num_objects, count(DISTINCT CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor((area - lo) / (hi - lo) * least(10, n)) AS BIGINT), least(10, n) - 1) END) AS unique_classes
FROM d JOIN b USING (image) GROUP BY image"""
)
def area_hist_classes(spark, sf_dir):
    return E.area_classes(T.detections(spark, sf_dir), "image")


@query(
    """SELECT o_orderkey AS image, coalesce(n, 0) AS num_boxes, coalesce(round(a / 5000000.0::DOUBLE, 9), 0.0) AS text_area_ratio FROM orders LEFT JOIN (
  SELECT l_orderkey, count(*) AS n, sum(abs(l_quantity) * abs(l_extendedprice)) AS a FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) ON l_orderkey = o_orderkey"""
)
def text_area_ratio(spark, sf_dir):
    zero = F.lit(0.0)
    box = F.struct(zero.alias("x1"), zero.alias("y1"), F.col("l_quantity").alias("x2"), F.col("l_extendedprice").alias("y2"))
    boxes = T.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("image")).agg(F.collect_list(box).alias("boxes"))
    images = T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image"), F.lit(T.WIDTH).alias("width"), F.lit(T.HEIGHT).alias("height"))
    out = E.with_text_features(images.join(boxes, "image", "left"))
    return out.select("image", F.col("num_boxes").cast("long").alias("num_boxes"), F.round("text_area_ratio", 9).alias("text_area_ratio"))


CAPTIONS = values(T.CAPTIONS, "id, caption, w, h")


@query(
    f"""WITH b AS (SELECT id, w, h, unnest(list_filter(regexp_extract_all(caption, '\\[\\d+,\\d+,\\d+,\\d+\\]'), lambda s: s <> '[0,0,999,999]')) AS box FROM {CAPTIONS}),
p AS (SELECT id, w, h, list_transform(string_split(box[2:-2], ','), lambda x: CAST(x AS DOUBLE)) AS c FROM b)
SELECT CAST(id AS BIGINT) AS id, round(c[1] * w / 1000, 6) AS x1, round(c[2] * h / 1000, 6) AS y1, round(c[3] * w / 1000, 6) AS x2, round(c[4] * h / 1000, 6) AS y2 FROM p"""
)
def grounded_boxes(spark, sf_dir):
    rows = spark.createDataFrame(T.CAPTIONS, "id long, caption string, w double, h double")
    out = rows.select("id", F.explode(G.grounded_boxes(F.col("caption"), F.col("w"), F.col("h"))).alias("b"))
    return out.select("id", *[F.round(f"b.{c}", 6).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query(
    f"""SELECT CAST(id AS BIGINT) AS id, array_to_string(list_sort(list_distinct(regexp_extract_all(caption, '(\\w+(?:\\s+\\w+)*)\\[\\d+,\\d+,\\d+,\\d+\\]', 1))), '|') AS labels,
  trim(regexp_replace(caption, '\\[\\d+,\\d+,\\d+,\\d+\\]', '', 'g')) AS caption FROM {CAPTIONS}"""
)
def label_extract(spark, sf_dir):
    rows = spark.createDataFrame(T.CAPTIONS, "id long, caption string, w double, h double")
    return rows.select("id", F.array_join(G.grounded_labels(F.col("caption")), "|").alias("labels"), E.caption_unified(F.col("caption")).alias("caption"))


@query(
    """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), u AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
c AS (SELECT label, list(m ORDER BY i) AS centre FROM (SELECT label, i, avg(x) AS m FROM u GROUP BY label, i) GROUP BY label)
SELECT vec_id, round(list_cosine_similarity(v, centre), 5) AS similarity FROM e JOIN c USING (label)"""
)
def caption_similarity(spark, sf_dir):
    e = T.table(spark, sf_dir, "embeddings")
    centre = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    centres = centre.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centre"))
    return e.join(centres, "label").select("vec_id", F.round(E.caption_similarity(F.col("embedding"), F.col("centre"), F.lit("a caption")), 5).alias("similarity"))


# Stage 2: bins


@query(f"WITH {FEATURES} SELECT ordinal, {RULE} AS bin FROM features")
def rule_binning(spark, sf_dir):
    return T.features(spark, sf_dir).select("ordinal", B.rule_bin().alias("bin"))


def _ranked(size: str) -> str:
    return f"""n AS (SELECT {size} AS n FROM features),
a AS (SELECT *, row_number() OVER (ORDER BY text_area_ratio DESC, ordinal) AS bin_rank FROM features QUALIFY bin_rank <= (SELECT trunc(n * 0.4::DOUBLE) FROM n)),
b AS (SELECT *, row_number() OVER (ORDER BY num_objects DESC, text_area_ratio DESC, ordinal) AS bin_rank FROM features WHERE ordinal NOT IN (SELECT ordinal FROM a) QUALIFY bin_rank <= (SELECT trunc(n * 0.4::DOUBLE) FROM n)),
c AS (SELECT *, row_number() OVER (ORDER BY similarity DESC, num_objects DESC, text_area_ratio DESC, ordinal) AS bin_rank FROM features
  WHERE ordinal NOT IN (SELECT ordinal FROM a) AND ordinal NOT IN (SELECT ordinal FROM b) QUALIFY bin_rank <= (SELECT trunc(n * 0.2::DOUBLE) FROM n)),
ranked AS (SELECT ordinal, 'A' AS bin, bin_rank FROM a UNION ALL SELECT ordinal, 'B', bin_rank FROM b UNION ALL SELECT ordinal, 'C', bin_rank FROM c)"""


def _features(spark, sf_dir):
    from ..tables import save

    return save(T.features(spark, sf_dir), "features")


@query(f"WITH {FEATURES}, {_ranked('count(*)')} SELECT ordinal, bin, bin_rank FROM ranked")
def rank_binning(spark, sf_dir):
    return B.rank_bins(_features(spark, sf_dir)).select("ordinal", "bin", "bin_rank")


@query(f"WITH {FEATURES}, {_ranked('1001')} SELECT ordinal, bin, bin_rank FROM ranked".replace("SELECT 1001 AS n FROM features", "SELECT 1001 AS n"))
def rank_binning_capped(spark, sf_dir):
    return B.rank_bins(_features(spark, sf_dir), size=1001).select("ordinal", "bin", "bin_rank")


@query(f"WITH {FEATURES}, {_ranked('count(*)')}, t AS (SELECT count(*) AS t FROM ranked) SELECT ordinal, bin, bin_rank FROM ranked, t WHERE bin_rank <= trunc(t * (CASE WHEN bin = 'C' THEN 0.2 ELSE 0.4 END)::DOUBLE)")
def balance_strict(spark, sf_dir):
    return B.balance_bins(B.rank_bins(_features(spark, sf_dir)).select("ordinal", "bin", "bin_rank"), strict=True)


@query(f"WITH {FEATURES}, r AS (SELECT {RULE} AS bin FROM features) SELECT v.bin, count(r.bin) AS n FROM (VALUES ('A'), ('B'), ('C')) AS v(bin) LEFT JOIN r USING (bin) GROUP BY v.bin")
def bin_counts(spark, sf_dir):
    return M.bin_counts(T.features(spark, sf_dir).withColumn("bin", B.rule_bin()))


@query(f"WITH {FEATURES}, r AS (SELECT ordinal, {RULE} AS bin FROM features) SELECT ordinal, bin FROM r QUALIFY row_number() OVER (PARTITION BY bin ORDER BY ordinal) <= 2")
def top2_per_bin(spark, sf_dir):
    return M.head_per_bin(T.features(spark, sf_dir).select("ordinal", B.rule_bin().alias("bin")))


@query(
    f"""WITH {FEATURES} SELECT 'img/' || ordinal AS image_path, CAST(ordinal AS VARCHAR) AS filename, {RULE} AS assigned_bin, num_boxes > 2 AS text_boxes_passes, text_area_ratio > 0.2 AS text_area_passes,
  num_objects > 5 AS object_count_passes, unique_classes > 3 AS unique_classes_passes, dispersion > 0.3 AS dispersion_passes, similarity >= 0.25 AS similarity_passes, {RULE} = 'C' AS c_passes FROM features"""
)
def bin_details(spark, sf_dir):
    f = T.features(spark, sf_dir).withColumns({"path": F.concat(F.lit("img/"), F.col("ordinal").cast("string")), "caption": F.lit("")})
    wide = B.flatten(f.select(B.details().alias("details")))
    return wide.select(
        "image_path", "filename", "assigned_bin", F.col("bin_a_text_boxes_passes").alias("text_boxes_passes"), F.col("bin_a_text_area_passes").alias("text_area_passes"),
        F.col("bin_b_object_count_passes").alias("object_count_passes"), F.col("bin_b_unique_classes_passes").alias("unique_classes_passes"),
        F.col("bin_b_spatial_dispersion_passes").alias("dispersion_passes"), F.col("bin_c_similarity_passes").alias("similarity_passes"), F.col("bin_c_overall_passes").alias("c_passes"),
    )


@query(f"WITH {FEATURES} SELECT ordinal, CASE WHEN num_objects > 10 AND dispersion > 0.5 THEN 'PASS' ELSE 'FAIL' END AS crowded, CASE WHEN text_area_ratio = 0 THEN 'ERROR' WHEN num_objects / text_area_ratio > 20 THEN 'PASS' ELSE 'FAIL' END AS dense FROM features")
def user_criteria(spark, sf_dir):
    crowded = (F.col("num_objects") > 10) & (F.col("dispersion") > 0.5)
    dense = lambda df: F.col("num_objects") / F.nullif("text_area_ratio", F.lit(0.0)) > 20
    return B.with_criteria(T.features(spark, sf_dir), {"crowded": crowded, "dense": dense}).select("ordinal", "crowded", "dense")


@query(
    f"""WITH {FEATURES}, n AS (SELECT ordinal, num_objects, (SELECT min(num_objects) FROM features) AS lo, (SELECT max(num_objects) FROM features) AS hi FROM features)
SELECT CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor((num_objects - lo) / (hi - lo) * 20) AS BIGINT), 19) END AS bin, count(*) AS n FROM n GROUP BY 1"""
)
def object_histogram(spark, sf_dir):
    return M.length_histogram(T.features(spark, sf_dir), "num_objects", 20)


# Stages 3 and 4

QA = """qa AS (SELECT conv_id * 1000 + turn AS ordinal, text AS question, string_split(next_text, '.')[1] AS answer, next_text AS reasoning FROM (
  SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND next_role = 'assistant')"""
STOP = "[" + ", ".join(f"'{w}'" for w in V.STOP_WORDS) + "]"


def _split(c: str) -> str:
    return f"regexp_extract_all({c}, '[^{X.WHITE}]+')"


def _meaning(c: str) -> str:
    return f"list_filter(list_distinct({_split(f'lower({c})')}), lambda x: NOT list_contains({STOP}, x))"


OVERLAP = f"CASE WHEN len({_meaning('answer')}) = 0 THEN 1.0 ELSE CAST(len(list_intersect({_meaning('answer')}, {_meaning('reasoning')})) AS DOUBLE) / len({_meaning('answer')}) END"
REASON = f"""CASE WHEN coalesce(question, '') = '' OR coalesce(answer, '') = '' OR coalesce(reasoning, '') = '' THEN 'required'
  WHEN len({_split('question')}) NOT BETWEEN 5 AND 200 OR len({_split('answer')}) NOT BETWEEN 1 AND 500 OR len({_split('reasoning')}) < 10 THEN 'length'
  WHEN {" OR ".join(f"contains(lower(answer), '{p}')" for p in V.PLACEHOLDERS)} OR NOT (lower(question) LIKE '%?' OR regexp_matches(lower(question), '^({"|".join(V.STEMS)})')) THEN 'content'
  WHEN {OVERLAP} < 0.3 THEN 'grounding' END"""
QA_ROWS = values(T.QA_ROWS, "ordinal, question, answer, reasoning")


def _qa_rows(spark):
    return spark.createDataFrame(T.QA_ROWS, "ordinal long, question string, answer string, reasoning string")


@query(f"WITH {QA} SELECT coalesce({REASON}, 'valid') AS reason, count(*) AS n FROM qa GROUP BY 1")
def qa_reject_reasons(spark, sf_dir):
    return T.qa(spark, sf_dir).groupBy(F.coalesce(V.reject_reason(), F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"SELECT CAST(ordinal AS BIGINT) AS ordinal, {REASON} AS reason FROM {QA_ROWS}")
def qa_validate(spark, sf_dir):
    return _qa_rows(spark).select("ordinal", V.reject_reason().alias("reason"))


@query(f"WITH {QA}, v AS (SELECT * FROM qa WHERE {REASON} IS NULL) SELECT ordinal FROM v QUALIFY row_number() OVER (PARTITION BY md5(question || answer) ORDER BY ordinal) = 1")
def validation_stage(spark, sf_dir):
    return V.validation_stage(T.qa(spark, sf_dir)).select("ordinal")


@query(f"WITH {QA}, a AS (SELECT * FROM qa UNION ALL SELECT * FROM {QA_ROWS}) SELECT ordinal, round({OVERLAP}, 6) AS overlap FROM a")
def qa_grounding(spark, sf_dir):
    both = T.qa(spark, sf_dir).unionByName(_qa_rows(spark))
    return both.select("ordinal", F.round(V.grounding(), 6).alias("overlap"))


@query(f"WITH {QA} SELECT ordinal, CAST(len({_split('question')}) AS BIGINT) AS question_words, CAST(len({_split('answer')}) AS BIGINT) AS answer_words, CAST(len({_split('reasoning')}) AS BIGINT) AS reasoning_words FROM qa")
def word_lengths(spark, sf_dir):
    return T.qa(spark, sf_dir).select("ordinal", *[X.word_count(F.col(c)).alias(f"{c}_words") for c in ("question", "answer", "reasoning")])


@query(
    f"""WITH d AS (SELECT doc_id, CAST(len({_split('text')}) AS BIGINT) AS w FROM documents), b AS (SELECT min(w) AS lo, max(w) AS hi FROM d)
SELECT CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor((w - lo) / (hi - lo) * 20) AS BIGINT), 19) END AS bin, count(*) AS n FROM d, b GROUP BY 1"""
)
def length_histogram(spark, sf_dir):
    return M.length_histogram(T.table(spark, sf_dir, "documents").select(X.word_count(F.col("text")).alias("w")), "w", 20)


@query("SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text || coalesce(lang, '')) ORDER BY doc_id) = 1")
def exact_dedup_keep_first(spark, sf_dir):
    return D.remove_exact(T.table(spark, sf_dir, "documents"), "text", "lang", "doc_id").select("doc_id")


ANSWERS = values(T.ANSWERS, "id, answer")


def _answers(spark):
    pairs, error = S.qa_pairs(F.col("answer"))
    return spark.createDataFrame(T.ANSWERS, "id long, answer string").select("id", pairs.alias("qa_pairs"), error.alias("error"))


@query(
    "SELECT CAST(id AS BIGINT) AS id, error FROM (VALUES (1, NULL), (2, NULL), (3, NULL), (4, 'expected 2 samples, got 1'), (5, 'answer is not A to D'), (6, 'expected 4 options'), (7, 'missing question'), (8, 'no JSON in the response'), (9, 'empty response'), (10, 'blank option')) AS v(id, error)"
)
def qa_extract_json(spark, sf_dir):
    return _answers(spark).select("id", "error")


@query(
    f"""WITH j AS (SELECT id, CAST(CASE id WHEN 2 THEN answer[9:-5] WHEN 3 THEN answer[13:-11] ELSE answer END AS JSON) AS j FROM {ANSWERS} WHERE id <= 3),
s AS (SELECT id, CASE WHEN json_type(j) = 'ARRAY' THEN j ELSE j -> 'samples' END AS s FROM j), p AS (SELECT id, i, s -> CAST(i AS INT) AS x FROM s, (VALUES (0), (1)) AS v(i))
SELECT CAST(id AS BIGINT) AS id, CAST(i AS BIGINT) AS pair_no, x ->> 'question' AS question, array_to_string(CAST(x -> 'options' AS VARCHAR[]), '|') AS options, x ->> 'reasoning_trace' AS reasoning_trace, upper(trim(x ->> 'answer')) AS answer FROM p"""
)
def qa_explode(spark, sf_dir):
    out = S.explode_pairs(S.successes(S.results(_answers(spark), order="id")).withColumnRenamed("index", "id"))
    return out.select("id", F.col("pair_no").cast("long").alias("pair_no"), "question", F.array_join("options", "|").alias("options"), "reasoning_trace", "answer")


@query("SELECT 10::BIGINT AS total, 3::BIGINT AS succeeded, 7::BIGINT AS failed, 30.0::DOUBLE AS success_pct")
def success_rate(spark, sf_dir):
    return M.success_rate(S.results(_answers(spark), order="id"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path(spark, sf_dir):
    return T.table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


# Retries


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def failed_rows(spark, sf_dir):
    return R.failed(T.table(spark, sf_dir, "documents"), T.table(spark, sf_dir, "labels"), "doc_id").select("doc_id")


@query(
    """SELECT count(*) AS total, count(l.doc_id) AS succeeded, count(*) - count(l.doc_id) AS failed, round(100.0 * CAST(count(*) - count(l.doc_id) AS DOUBLE) / count(*), 2) AS failed_pct
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id"""
)
def failure_counts(spark, sf_dir):
    return R.failure_counts(T.table(spark, sf_dir, "documents"), T.table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, min(event_id) AS event_id, count(*) AS copies FROM events WHERE user_id IS NOT NULL GROUP BY user_id")
def keyed_last_wins(spark, sf_dir):
    return R.last_wins(T.table(spark, sf_dir, "events").select("user_id", "event_type", "event_id"), "user_id", "event_id")


def _merge(prefer: str) -> str:
    a, b = ("r", "o") if prefer == "retry" else ("o", "r")
    return f"""WITH o AS (SELECT doc_id, n_chars AS v FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 0)), r AS (SELECT doc_id, -quality AS v FROM labels)
SELECT doc_id, CASE WHEN {a}.doc_id IS NOT NULL THEN {a}.v ELSE {b}.v END AS v, CASE WHEN o.doc_id IS NULL THEN 'retry' WHEN r.doc_id IS NULL THEN 'original' ELSE 'conflict' END AS origin
FROM o FULL JOIN r USING (doc_id)"""


def _merged(spark, sf_dir, prefer):
    # What a first run has failed at: the documents labelled with quality 0.
    failed = T.table(spark, sf_dir, "labels").filter("quality = 0").select("doc_id")
    original = T.table(spark, sf_dir, "documents").join(failed, "doc_id", "left_anti").select("doc_id", F.col("n_chars").alias("v"), F.col("doc_id").alias("line_no"))
    retried = T.table(spark, sf_dir, "labels").select("doc_id", (-F.col("quality")).cast("long").alias("v"), F.col("doc_id").alias("line_no"))
    return R.merge(original, retried, "doc_id", prefer=prefer).select("doc_id", "v", "origin")


@query(_merge("retry"))
def merge_retry_priority(spark, sf_dir):
    return _merged(spark, sf_dir, "retry")


@query(_merge("original"))
def merge_original_priority(spark, sf_dir):
    return _merged(spark, sf_dir, "original")


@query("SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 25")
def first_entries(spark, sf_dir):
    return S.first_entries(T.table(spark, sf_dir, "documents").select("doc_id", "n_chars"), 25, "doc_id")


@query(
    """SELECT doc_id, CASE WHEN source IS NULL THEN 'missing field: path' WHEN text IS NULL THEN 'missing field: ocr_text' WHEN lang IS NULL THEN 'missing field: detected_objects'
  WHEN quality IS NULL THEN 'missing field: bin' WHEN toxic = 1 THEN 'missing or empty reasoning_description' END AS error FROM documents LEFT JOIN labels USING (doc_id)"""
)
def entry_errors(spark, sf_dir):
    rows = T.table(spark, sf_dir, "documents").join(T.table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")
    described = F.when(F.col("toxic") == 1, " ").otherwise("seen")
    raw = F.to_json(F.struct(F.col("source").alias("path"), F.col("doc_id").alias("id"), F.col("text").alias("ocr_text"), F.col("lang").alias("detected_objects"), F.col("quality").alias("bin"), described.alias("reasoning_description")))
    return rows.select("doc_id", R.entry_error(raw).alias("error"))


@query("SELECT doc_id AS path, CASE WHEN quality = 1 THEN 'first' ELSE 'again' END AS reasoning_description FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def repaired(spark, sf_dir):
    labels = T.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("path"), "quality")
    inputs = T.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.col("doc_id").alias("line_no"))
    outputs = inputs.join(labels.filter("quality = 1"), "path").select("path", F.lit("first").alias("reasoning_description"), "line_no")

    def again(failed):
        return failed.join(labels, "path", "left").select("path", F.when(F.col("quality").isNotNull(), "again").alias("reasoning_description"), "line_no")

    return R.repair(inputs, outputs, again).select("path", "reasoning_description")


@query("SELECT l_orderkey AS ordinal, min(l_quantity) AS x1, min(l_discount) AS y1, max(l_quantity) AS x2, max(l_discount) AS y2 FROM lineitem GROUP BY l_orderkey")
def polygon_boxes(spark, sf_dir):
    points = T.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("ordinal")).agg(F.collect_list(F.struct(F.col("l_quantity").alias("x"), F.col("l_discount").alias("y"))).alias("points"))
    return points.select("ordinal", G.polygon_box(F.col("points")).alias("box")).select("ordinal", "box.*")


@query(
    f"""WITH c AS ({SQL["filter_cascade_funnel"]}), o AS (SELECT count(*) AS n_out FROM ({SQL["filter_cascade"]}))
SELECT c.*, n_out, n_nsfw - n_out AS n_duplicates, coalesce(round(100.0 * (n_nsfw - n_out) / nullif(n_in, 0), 4), 0) AS pct_duplicates, coalesce(round(100.0 * n_out / nullif(n_in, 0), 4), 0) AS pct_out FROM c, o"""
)
def filter_cascade_funnel_to_end(spark, sf_dir):
    from ..tables import save

    rows = T.images(spark, sf_dir).join(T.hashes(spark, sf_dir).withColumnRenamed("h0", "phash"), "ordinal", "left")
    return K.funnel_to_end(save(rows, "images"), FilterConfig())


# Packaging and metrics

MCQ = values(T.MCQ, "id, answer, options")


@query(
    f"""WITH m AS (SELECT id, trim(coalesce(answer, '')) AS a, coalesce(options, []) AS o FROM {MCQ})
SELECT CAST(id AS BIGINT) AS id, 'Image Description:' || chr(10) || 'd' || chr(10) || chr(10) || 'Reasoning Trace:' || chr(10) || 'r' || chr(10) || chr(10) || 'Final Answer:' || chr(10) ||
  CASE WHEN a IN ('A', 'B', 'C', 'D') THEN coalesce(o[ascii(a) - 64], 'Option ' || a) ELSE a END AS solution FROM m"""
)
def build_solution(spark, sf_dir):
    rows = spark.createDataFrame(T.MCQ, "id long, answer string, options array<string>")
    return rows.select("id", P.solution(F.lit(" d "), F.lit("r\n"), F.col("answer"), F.col("options")).alias("solution"))


@query("SELECT source AS path, count(*) AS count FROM documents GROUP BY source HAVING count(*) > 2")
def duplicate_path_report(spark, sf_dir):
    return P.duplicate_paths(T.table(spark, sf_dir, "documents").select(F.col("source").alias("path")))


@query(
    """WITH s AS (SELECT p_partkey, p_size * 97 AS w, p_size * 31 + 7 AS h FROM part)
SELECT p_partkey, CAST(CASE WHEN greatest(w, h) <= 840 THEN w ELSE round_even(w * (840.0::DOUBLE / greatest(w, h)), 0) END AS BIGINT) AS width,
  CAST(CASE WHEN greatest(w, h) <= 840 THEN h ELSE round_even(h * (840.0::DOUBLE / greatest(w, h)), 0) END AS BIGINT) AS height FROM s"""
)
def resized_sides(spark, sf_dir):
    out = T.table(spark, sf_dir, "part").select("p_partkey", P.fitted(F.col("p_size") * 97, F.col("p_size") * 31 + 7).alias("s"))
    return out.select("p_partkey", F.col("s.width").cast("long").alias("width"), F.col("s.height").cast("long").alias("height"))


@query("SELECT doc_id, 'images/' || lang || '/' || doc_id || '.jpg' AS path FROM documents")
def collected_paths(spark, sf_dir):
    rows = T.table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("bin"), F.concat("source", F.lit("/x.jpg")).alias("path"))
    return rows.select("doc_id", P.collected_path(by_bin=True).alias("path"))


@query("SELECT round(100.0 * CAST(count(*) - count(*) FILTER (n_chars >= 256) AS DOUBLE) / count(*), 2) AS removal_rate FROM documents")
def removal_rate(spark, sf_dir):
    return T.table(spark, sf_dir, "documents").agg(M.removal_rate(F.count("*"), F.count_if(F.col("n_chars") >= 256)).alias("removal_rate"))


@query("SELECT lang, count(*) AS count FROM documents GROUP BY lang")
def value_counts(spark, sf_dir):
    return M.value_counts(T.table(spark, sf_dir, "documents"), "lang")


@query("SELECT count(DISTINCT source) AS datasets FROM documents")
def distinct_datasets(spark, sf_dir):
    return T.images(spark, sf_dir).agg(F.countDistinct("dataset").alias("datasets"))


@query("SELECT event_type AS model_name, count(*) AS images, round(avg(value), 6) AS mean_latency, round(sum(value), 4) AS total_latency, count(*) FILTER (value > 50) AS passed FROM events GROUP BY event_type")
def model_comparison(spark, sf_dir):
    rows = T.table(spark, sf_dir, "events").select(F.col("event_type").alias("model_name"), F.col("value").alias("latency"), (F.col("value") > 50).alias("passes_filter"))
    return M.model_comparison(rows).withColumns({"mean_latency": F.round("mean_latency", 6), "total_latency": F.round("total_latency", 4)})


