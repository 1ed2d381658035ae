"""Scoring a stream with trained models that may change between batches.

``ModelShelf`` keeps fitted pipelines by version in a shared folder; a small
file for each publication says which came last.  ``ModelScorer`` is a scorer
for the sink: a batch takes the version published last when it first ran and
notes it, so a replayed batch is scored by the same model; each version is
loaded once.
"""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from cartflow.learn import models as L
from cartflow.streaming.metrics import write_text


class ModelShelf:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._loaded: dict[str, PipelineModel] = {}

    def _names(self, sub: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{sub}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def publish(self, model: PipelineModel, version: str) -> None:
        """Store a fitted pipeline and make it the current one."""
        if not re.fullmatch(r"[A-Za-z0-9._-]+", version):
            raise ValueError("a version is made of letters, digits, dots, dashes and underscores")
        L.save_model(model, f"{self.folder}/models/{version}")
        write_text(self.spark, f"{self.folder}/published/{len(self._names('published')):09d}-{version}", "")

    def current(self) -> str:
        names = self._names("published")
        if not names:
            raise LookupError("no model has been published")
        return names[-1].split("-", 1)[1]

    def load(self, version: str) -> PipelineModel:
        if version not in self._loaded:
            self._loaded[version] = L.load_model(f"{self.folder}/models/{version}")
        return self._loaded[version]

    def of_batch(self, run: str, batch_id: int) -> str:
        """The version noted for a batch of a run, or the current one, which is noted."""
        noted = [n for n in self._names(f"used/{run}") if n.startswith(f"{batch_id}-")]
        version = noted[0].split("-", 1)[1] if noted else self.current()
        if not noted:
            write_text(self.spark, f"{self.folder}/used/{run}/{batch_id}-{version}", "")
        return version


class ModelScorer:
    """Scores session records as batch ``score`` does, with the model of the batch."""

    def __init__(self, shelf: ModelShelf, run: str):
        self.shelf, self.run = shelf, run

    def __call__(self, records: DataFrame, batch_id: int) -> DataFrame:
        version = self.shelf.of_batch(self.run, batch_id)
        return L.score(L.training_frame(records), self.shelf.load(version), version)
