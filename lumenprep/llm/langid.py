"""Language identification as a mixture: EM estimates each document's language proportions, a penalised likelihood picks the set.

Model: add-alpha probabilities of character trigrams (hashed to 2**bits buckets) for each label, from a sample of about
`sample` labelled rows of each label (chosen by a hash of doc_id; the sample's size is the only bound). The model has
labels x 2**bits numbers, whatever the input's size, and is what executors receive; more than `most_labels` labels is an
error. A document's units are its words (runs of letters); log P(word | language) is the sum over its trigrams, tempered
by `temper` because they overlap. For k = 1, 2, .. the k languages of largest share are refitted by EM and the set of least
-2 log-likelihood + penalty * (k - 1) * log(words) wins. lang_pred is the language of largest share.

Defined results: null text, or one without a letter: `und`, score 0, no languages; ties go to the first label in sorted
order; a null lang teaches nothing; repeated rows each have their result; without any labelled row every text is `und`;
other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, code_points, hold, ship

UNDEFINED = "und"
LETTERS = np.empty(0, np.uint32)


def _letters() -> np.ndarray:
    """From a code point to its small letter, 0 for what is no letter. One a process."""
    global LETTERS
    if not len(LETTERS):
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if unicodedata.category(chr(c))[0] == "L":
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        LETTERS = table
    return LETTERS


def trigrams(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each trigram, first trigram of each word, words of each text); a word has a blank on either side."""
    low = _letters()[code_points("\x00".join(texts) + "\x00")]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    is_letter = low > 0
    before = np.concatenate([[False], is_letter[:-1]])
    starts = np.flatnonzero(is_letter & ~before)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    # Trigrams centred on each letter: the neighbours of a letter are letters or blanks (0).
    middle = np.flatnonzero(is_letter)
    left = np.where(middle > 0, low[middle - 1], 0).astype(np.uint64)
    code = (left * np.uint64(0x9E3779B97F4A7C15) + low[middle].astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F) + low[middle + 1].astype(np.uint64)
    bucket = ((code * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(64 - bits)).astype(np.int64)
    of = np.searchsorted(np.cumsum(lengths), starts, side="right")
    return bucket, np.searchsorted(middle, starts), np.bincount(of, minlength=len(texts))


class Model:
    """labels (sorted) and log-probabilities float32 (2**bits, labels)."""

    def __init__(self, labels: list[str], log_p: np.ndarray, bits: int, temper: float, penalty: float, most: int, rounds: int):
        self.labels, self.log_p, self.bits, self.temper, self.penalty, self.most, self.rounds = labels, log_p, bits, temper, penalty, most, rounds

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(proportions (texts, labels), whether the text has a letter)."""
        bucket, first, words = trigrams(texts, self.bits)
        there = words > 0
        out = np.zeros((len(texts), len(self.labels)))
        if not len(bucket) or not self.labels:
            return out, there & bool(self.labels)
        like = np.add.reduceat(self.log_p[bucket], first, axis=0) * self.temper
        top = like.max(axis=1, keepdims=True)
        like = np.exp(np.maximum(like - top, -60.0))
        n = words[there]
        begin = np.cumsum(n) - n
        of = np.repeat(np.arange(len(n)), n)

        def fit(allowed: np.ndarray, pi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            pi = np.where(allowed, np.maximum(pi, 1e-3), 0)
            pi /= pi.sum(axis=1, keepdims=True)
            for _ in range(self.rounds):
                joint = like * pi[of].astype(np.float32)
                joint /= joint.sum(axis=1, keepdims=True) + 1e-30
                pi = np.add.reduceat(joint, begin, axis=0) / n[:, None]
            return pi, np.add.reduceat(np.log((like * pi[of].astype(np.float32)).sum(axis=1) + 1e-30), begin)

        full, _ = fit(np.ones((len(n), len(self.labels)), bool), np.full((len(n), len(self.labels)), 1 / len(self.labels)))
        rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1)
        best, cost = np.zeros_like(full), np.full(len(n), np.inf)
        for k in range(1, min(self.most, len(self.labels)) + 1):
            pi, log_like = fit(rank < k, full) if k < len(self.labels) else (full, fit(np.ones_like(rank, bool), full)[1])
            new = -2 * log_like + self.penalty * (k - 1) * np.log(np.maximum(n, 2))
            better = new < cost
            best[better], cost[better] = pi[better], new[better]
        out[there] = best
        return out, there


def crc_part(doc_id: Column) -> Column:
    """crc32 of doc_id as text, mod 3 (a null doc_id counts as the text "")."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(3))


def train(docs: DataFrame, sample: int = 3000, bits: int = 16, alpha: float = 0.1, temper: float = 0.5, penalty: float = 4.0, most: int = 3, rounds: int = 8, most_labels: int = 256) -> Model:
    """Learns from docs (doc_id, text, lang): about `sample` rows of each label by hash, counted where they lie."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy("lang").limit(most_labels + 1).collect()}
    if len(sizes) > most_labels:
        raise ValueError(f"more than {most_labels} labels")
    labels = sorted(sizes)
    if not labels:
        return Model([], np.zeros((1 << bits, 0), np.float32), bits, temper, penalty, most, rounds)
    share = F.create_map(*(x for k, v in sizes.items() for x in (F.lit(k), F.lit(min(1.0, sample / v)))))
    drawn = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(__name__)
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for a, _, texts in chunks(batch, "text", 1 << 18):
                for i, text in enumerate(texts):
                    counts.setdefault(langs[a + i], np.zeros(1 << bits, np.int64))
                    counts[langs[a + i]] += np.bincount(trigrams([text], bits)[0], minlength=1 << bits)
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(c[at])], names=["lang", "bucket", "n"])

    counted = rows.filter(drawn).select("text", "lang").mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.full((1 << bits, len(labels)), alpha)
    table[counted["bucket"].to_numpy(), counted["lang"].map({k: i for i, k in enumerate(labels)}).to_numpy(int)] += counted["n"].to_numpy()
    return Model(labels, np.log(table / table.sum(axis=0)).astype(np.float32), bits, temper, penalty, most, rounds)


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep`, lang_pred string, score double (its share), languages array<string>, shares array<double> (of the chosen set, largest first)."""
    ship(docs.sparkSession)
    source = docs.select(*keep, docs["text"].alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(__name__)
        for batch in batches:
            for a, b, texts in chunks(batch, "__text", 1 << 18):
                shares, there = model.shares(texts)
                order = np.argsort(-shares, axis=1, kind="stable")
                chosen = [[j for j in row if s[j] > 0.01] if ok else [] for row, s, ok in zip(order.tolist(), shares, there, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(a, b - a).columns[:-1],
                        pa.array([model.labels[c[0]] if c else UNDEFINED for c in chosen]),
                        pa.array([float(min(1.0, s[c[0]])) if c else 0.0 for c, s in zip(chosen, shares, strict=True)]),
                        pa.array([[model.labels[j] for j in c] for c in chosen], pa.list_(pa.string())),
                        pa.array([[float(s[j]) for j in c] for c, s in zip(chosen, shares, strict=True)], pa.list_(pa.float64())),
                    ],
                    names=[*keep, "lang_pred", "score", "languages", "shares"],
                )

    return source.mapInArrow(run, f"{kinds}{', ' if kinds else ''}lang_pred string, score double, languages array<string>, shares array<double>")
