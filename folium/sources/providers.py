"""Model and image steps behind one interface, with stubs that are deterministic.

A provider sees Arrow batches of requests and gives one answer per request; what
it runs (recognition, vision, language models) is outside this library.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class Provider(Protocol):
    name: str

    def answer(self, requests: pd.DataFrame) -> pd.Series: ...


class Echo:
    """Gives the prompt back: a stub for tests and dry runs."""

    name = "echo"

    def answer(self, requests: pd.DataFrame) -> pd.Series:
        return requests["prompt"]


class Canned:
    """Answers by the hash of the prompt from a fixed map; others get a default."""

    name = "canned"

    def __init__(self, answers: dict[str, str], default: str = ""):
        self.answers, self.default = answers, default

    def answer(self, requests: pd.DataFrame) -> pd.Series:
        return requests["prompt"].map(lambda p: self.answers.get(hashlib.sha256((p or "").encode()).hexdigest(), self.default))


def ask(df: DataFrame, request_id: str, prompt: str, provider: Provider) -> DataFrame:
    """request_id, provider, answer: one call per Arrow batch, no shuffle."""
    kind = df.schema[request_id].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"request_id": f["request_id"], "provider": provider.name, "answer": provider.answer(f)})

    return df.selectExpr(f"{request_id} AS request_id", f"{prompt} AS prompt").mapInPandas(run, f"request_id {kind}, provider string, answer string")
