"""The four stages as one lazy plan each, with resume from the latest stage that was written."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, load, normalised_ratios
from ..operators.binning import bin_stage
from ..operators.filters import cascade, oversample
from ..operators.metrics import removal_rate, run_metrics
from ..operators.synthesis import explode_pairs, for_validation
from ..operators.validation import validation_stage
from ..sources.images import load_images

STAGES = ("filtered", "binned", "generated", "validated")


class CurationPipeline:
    """features(images) adds sizes, predictions, hashes and the bins' features; generate(binned) adds qa_pairs.

    Each stage is Parquet below `out`, complete where _SUCCESS is. The latest complete one is where a run resumes, an empty one
    too; other settings or inputs don't invalidate it unless fingerprint=True.
    """

    def __init__(self, spark: SparkSession, out: str, features: Callable[[DataFrame], DataFrame], generate: Callable[[DataFrame], DataFrame], config: Config = Config(), fingerprint: bool = False):
        self.spark, self.out, self.features, self.generate, self.config = spark, out.rstrip("/"), features, generate, config
        if fingerprint:
            import hashlib

            self.out += f"/{hashlib.sha256(repr(config).encode()).hexdigest()[:16]}"

    def path(self, stage: str) -> str:
        return f"{self.out}/{stage}"

    def read(self, stage: str) -> DataFrame | None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(stage)}/_SUCCESS")
        return self.spark.read.parquet(self.path(stage)) if p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p) else None

    def write(self, stage: str, df: DataFrame) -> DataFrame:
        (df.write.mode("overwrite").partitionBy("bin") if stage == "binned" else df.write.mode("overwrite")).parquet(self.path(stage))
        return self.spark.read.parquet(self.path(stage))

    def filter_stage(self, images: DataFrame, wanted: int = -1, seed: int = 0) -> DataFrame:
        return cascade(self.features(oversample(images, wanted, seed)), self.config.filtering, wanted)

    def run(self, images: DataFrame, wanted: int = -1, size: int | None = None, ratios: tuple[float, float, float] | None = None, only_complex: bool = False) -> tuple[DataFrame, dict]:
        """(validated rows, metrics of the stages that ran or were found)."""
        binning = self.config.binning
        if ratios is not None:
            from dataclasses import replace

            binning = replace(binning, ratios=normalised_ratios(ratios))
        done: dict[str, DataFrame | None] = {s: self.read(s) for s in STAGES}
        last = max((i for i, s in enumerate(STAGES) if done[s] is not None), default=-1)
        make: list[Callable[[], DataFrame]] = [
            lambda: self.filter_stage(images, wanted),
            lambda: bin_stage(done["filtered"], binning, size, only_complex),
            lambda: for_validation(explode_pairs(self.generate(done["binned"]))),
            lambda: validation_stage(done["generated"], self.config.validation),
        ]
        for i, stage in enumerate(STAGES):
            if i > last:
                done[stage] = self.write(stage, make[i]())
        return done["validated"], run_metrics(done["filtered"], done["binned"], done["generated"], done["validated"])

    def summary(self) -> DataFrame:
        """original_count, validated_count, removed_count, removal_rate_percent of the last stage."""
        before, after = self.read("generated"), self.read("validated")
        n = before.agg(F.count("*").alias("original_count")).crossJoin(after.agg(F.count("*").alias("validated_count")))  # one row each
        return n.withColumn("removed_count", F.col("original_count") - F.col("validated_count")).withColumn("removal_rate_percent", removal_rate(F.col("original_count"), F.col("validated_count")))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Curates an image corpus: filter, bin, synthesise, validate.")
    p.add_argument("--config")
    p.add_argument("--data", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--num-images", type=int, default=-1)
    p.add_argument("--dataset-size", type=int)
    p.add_argument("--bins-ratio", type=float, nargs=3, default=(0.4, 0.4, 0.2))
    p.add_argument("--filter-by-complexity", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    return p


def main(argv: list[str] | None, features: Callable[[DataFrame], DataFrame], generate: Callable[[DataFrame], DataFrame]) -> dict:
    """A command line around run(); the scorers come from the caller."""
    a = parser().parse_args(argv)
    config = load(a.config) if a.config else Config()
    plan = {"data": a.data, "out": a.out, "num_images": a.num_images, "dataset_size": a.dataset_size, "ratios": normalised_ratios(tuple(a.bins_ratio))}
    if a.dry_run:
        print(json.dumps(plan))
        return plan
    spark = SparkSession.builder.getOrCreate()
    pipeline = CurationPipeline(spark, a.out, features, generate, config)
    _, metrics = pipeline.run(load_images(spark, a.data), a.num_images, a.dataset_size, tuple(a.bins_ratio), a.filter_by_complexity)
    print(json.dumps(metrics))
    return metrics
