"""Scorers: what models add to rows, behind one interface, with a registry that falls back to a default."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import average_hash, corner_edges, difference_hash, perceptual_hash, wavelet_hash


class Scorer(Protocol):
    """Adds the columns of `adds` (DDL) to a DataFrame that has the columns `needs`."""

    needs: tuple[str, ...]
    adds: str

    def apply(self, df: DataFrame) -> DataFrame: ...


class BatchScorer:
    """A Python function over batches of rows: f(pandas of needs) -> pandas of the added columns, in the same order."""

    def __init__(self, f: Callable[[pd.DataFrame], pd.DataFrame], needs: tuple[str, ...], adds: str, batch: int = 16):
        self.f, self.needs, self.adds, self.batch = f, needs, adds, batch

    def apply(self, df: DataFrame) -> DataFrame:
        f, needs, size = self.f, list(self.needs), self.batch

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for i in range(0, len(b), size):
                    part = b.iloc[i : i + size].reset_index(drop=True)
                    yield pd.concat([part, f(part[needs]).reset_index(drop=True)], axis=1)

        kinds = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in df.schema.fields)
        return df.mapInPandas(run, f"{kinds}, {self.adds}")


class ConstantScorer:
    """Stands in for a model that isn't there: constants, or SQL expressions over the row."""

    def __init__(self, **values: str):
        self.needs, self.values = (), values
        self.adds = ""

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({k: F.expr(v) for k, v in self.values.items()})


REGISTRY: dict[str, dict[str, Scorer]] = {"detector": {}, "captioner": {}, "ocr": {}, "nsfw": {}, "embedder": {}, "qa": {}}
DEFAULTS = {"detector": "yolo", "captioner": "blip", "ocr": "paddle", "nsfw": "vit", "embedder": "clip", "qa": "chat"}


def register(kind: str, name: str, scorer: Scorer) -> None:
    REGISTRY[kind][name] = scorer


def scorer(kind: str, name: str) -> Scorer | None:
    """The scorer of that name, else the default of its kind, else None (the feature's default applies)."""
    return REGISTRY[kind].get(name) or REGISTRY[kind].get(DEFAULTS[kind])


def image_hashes(df: DataFrame, pixels: str = "image") -> DataFrame:
    """df with phash, ahash, dhash, whash (bigint) and edge_ratios (array<double>) of a column of Spark's image struct; undecodable: null."""
    import numpy as np

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for h, w, n, data in zip(b["__h"], b["__w"], b["__n"], b["__d"], strict=True):
                if h is None or w is None or h <= 0 or w <= 0 or data is None:
                    rows.append((None,) * 5)
                    continue
                p = np.frombuffer(data, np.uint8).reshape(int(h), int(w), int(n)).astype(float)
                # Blue, green, red (and alpha): luma.
                grey = p[:, :, 0] if n == 1 else np.round(0.114 * p[:, :, 0] + 0.587 * p[:, :, 1] + 0.299 * p[:, :, 2])
                rows.append((perceptual_hash(grey), average_hash(grey), difference_hash(grey), wavelet_hash(grey), corner_edges(grey)))
            got = pd.DataFrame(rows, columns=["phash", "ahash", "dhash", "whash", "edge_ratios"]).astype({c: "Int64" for c in ("phash", "ahash", "dhash", "whash")})
            yield pd.concat([b.drop(columns=["__h", "__w", "__n", "__d"]), got], axis=1)

    others = [c for c in df.columns if c != pixels]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*others).schema.fields)
    flat = df.select(*others, F.col(f"{pixels}.height").alias("__h"), F.col(f"{pixels}.width").alias("__w"), F.col(f"{pixels}.nChannels").alias("__n"), F.col(f"{pixels}.data").alias("__d"))
    return flat.mapInPandas(run, f"{kinds}, phash bigint, ahash bigint, dhash bigint, whash bigint, edge_ratios array<double>")
