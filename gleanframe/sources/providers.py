"""Seams for what Spark can't do itself: parsing binary documents and reading figures by a model.

A provider is any picklable callable. Calls run on the executors, and every answer is recorded in a
ledger (``ledger``), failures with their ``error``: no question is asked twice.
"""

from __future__ import annotations

import asyncio
import random
from collections.abc import Awaitable, Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ledger import ask, question, recorded


def parse_with(parse: Callable, options: dict | None) -> Callable[[list[dict]], list[tuple[str | None, str | None]]]:
    """Answers to files (path, content): a response, or an error; options, if any, are the parser's third argument."""

    def answer(rows: list[dict]) -> list[tuple[str | None, str | None]]:
        out = []
        for x in rows:
            try:
                out.append((parse(x["path"], x["content"], options) if options else parse(x["path"], x["content"]), None))
            except Exception as e:  # one document never fails the batch
                out.append((None, str(e)[:200] or type(e).__name__))
        return out

    return answer


def parsed_by(files: DataFrame, parse: Callable[..., str], record: str, options: dict | None = None, retry_failed: bool = False) -> DataFrame:
    """(doc, digest, response, error) of files (path, content), asked once a content and options and recorded at ``record``."""
    digest = F.sha2(F.coalesce("content", F.lit(b"")), 256)
    asked = files.select("path", "content", digest.alias("digest")).withColumn("key", question(F.lit("parse"), F.col("digest"), options=options))
    ask(asked, record, parse_with(parse, options), retry_failed)
    said = recorded(files.sparkSession, record).withColumnRenamed("raw", "response")
    return asked.drop("content").join(said, "key", "left").select(F.col("path").alias("doc"), "digest", "response", "error")


def as_json(path: str, content: bytes) -> str:
    """The default parser: the file is a response already."""
    return content.decode("utf-8-sig")


async def with_retries(call: Callable[[], Awaitable[str]], attempts: int = 8, first_delay: float = 2.0, jitter: float = 0.5, retry: Callable[[Exception], bool] = lambda e: True) -> str:
    """The call's result, after up to ``attempts`` tries with doubling delays."""
    for n in range(attempts):
        try:
            return await call()
        except Exception as e:
            if n + 1 == attempts or not retry(e):
                raise
            await asyncio.sleep(first_delay * 2**n + random.uniform(0, jitter))
    raise ValueError("attempts must be positive")


def read_with(read: Callable[[dict], Awaitable[str]], concurrent: int = 8, attempts: int = 8, first_delay: float = 2.0) -> Callable[[list[dict]], list[tuple[str | None, str | None]]]:
    """Answers of a model to rows; ``concurrent`` calls are in flight in a task."""

    async def all_of(rows: list[dict]) -> list[tuple[str | None, str | None]]:
        gate = asyncio.Semaphore(concurrent)

        async def one(row: dict) -> tuple[str | None, str | None]:
            async with gate:
                try:
                    return await with_retries(lambda: read(row), attempts, first_delay), None
                except Exception as e:
                    return None, str(e)[:200] or type(e).__name__

        return await asyncio.gather(*map(one, rows))

    return lambda rows: asyncio.run(all_of(rows))


def read_by_model(
    figures: DataFrame, read: Callable[[dict], Awaitable[str]], record: str, concurrent: int = 8, attempts: int = 8, first_delay: float = 2.0,
    options: dict | None = None, retry_failed: bool = False,
) -> DataFrame:
    """(doc, pos, raw, error) of figures; ``read`` gets a row as a dict (with prompt and examples, if any).

    A figure is asked once for its row and the options: the row holds what tells its content
    (a digest of its document, its place, its image) and the prompt, if they may change.
    """
    asked = figures.withColumn("key", question(F.lit("read"), *[F.col(c) for c in sorted(figures.columns)], options=options))
    ask(asked, record, read_with(read, concurrent, attempts, first_delay), retry_failed)
    return asked.select("doc", "pos", "key").join(recorded(figures.sparkSession, record), "key", "left").select("doc", "pos", "raw", "error")


class Replay:
    """Answers recorded before, by document and position; for tests and for runs without a model."""

    def __init__(self, answers: dict[tuple[str, int], str]):
        self.answers = answers

    async def __call__(self, row: dict) -> str:
        return self.answers[row["doc"], row["pos"]]
