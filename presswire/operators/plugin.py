"""User annotators run in bulk, with their expensive state built once per worker."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from presswire.sources.files import at_least

_POOL: dict[str, Any] = {}


class SharedInstance:
    """An object built lazily once per Python worker process and shared by its tasks."""

    def __init__(self, build: Callable[[], Any]):
        self.build = build
        self.name = uuid.uuid4().hex

    def get(self) -> Any:
        if self.name not in _POOL:
            _POOL[self.name] = self.build()
        return _POOL[self.name]


class TaskInstance(SharedInstance):
    """An object built once per task."""

    def get(self) -> Any:
        return self.build()


def batched(function: Callable[[Any, pd.Series], Any]) -> Callable[[Any, pd.Series], Any]:
    """Marks an annotator that scores a series of texts at once."""
    function.takes_batches = True
    return function


def _whole(function: Callable, instance: Any, texts: pd.Series) -> list | None:
    try:
        values = list(function(instance, texts))
    except Exception:  # noqa: BLE001 - the texts are tried one by one next
        return None
    return values if len(values) == len(texts) else None


def _one(function: Callable, instance: Any, value: str) -> Any:
    if getattr(function, "takes_batches", False):
        return list(function(instance, pd.Series([value])))[0]
    return function(instance, value)


def annotate_with(
    df: DataFrame,
    shared: SharedInstance,
    annotators: dict[str, tuple[Callable[[Any, str], Any], T.DataType | str]],
    text: str,
) -> DataFrame:
    """Adds one column per annotator plus ``errors array<string>``.

    ``annotators`` maps a column to ``(function(instance, text), type)``; a function
    marked by ``batched`` gets ``(instance, series of texts)`` instead and returns as
    many values. A failing annotator leaves null and an entry in ``errors``; the
    others still fill. A batched one that fails is asked again text by text.
    Batches stream through the worker; nothing is grouped.
    """
    names = list(annotators)
    kinds = {
        n: T._parse_datatype_string(k) if isinstance(k, str) else k
        for n, (_, k) in annotators.items()
    }
    functions = {n: f for n, (f, _) in annotators.items()}
    schema = T.StructType(
        df.schema.fields
        + [T.StructField(n, kinds[n]) for n in names]
        + [T.StructField("errors", T.ArrayType(T.StringType()))]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            instance, broken = shared.get(), None
        except Exception as problem:  # noqa: BLE001 - reported per row
            instance, broken = None, problem
        for batch in batches:
            errors: list[list[str]] = [[] for _ in range(len(batch))]
            extra = {}
            for n in names:
                values = None
                if broken is None and getattr(functions[n], "takes_batches", False):
                    values = _whole(functions[n], instance, batch[text])
                if values is None:
                    values = []
                    for k, value in enumerate(batch[text]):
                        try:
                            if broken is not None:
                                raise broken
                            values.append(_one(functions[n], instance, value))
                        except Exception as problem:  # noqa: BLE001 - one annotator must not stop the rest
                            values.append(None)
                            errors[k].append(f"{n}: {type(problem).__name__}: {problem}")
                extra[n] = pd.Series(values, index=batch.index, dtype=object)
            yield batch.assign(**extra, errors=pd.Series(errors, index=batch.index, dtype=object))

    return df.mapInPandas(run, schema)


def spread(df: DataFrame, factor: int = 2, always: bool = False) -> DataFrame:
    """Even out partitions ahead of a costly annotator, where the scan has too few.

    With ``always``, ``factor`` times the scan's splits are dealt row by row in any
    case, so that long documents, and copies of one text, do not share a task; that
    moves every text once.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    if always:
        return df.repartition(max(least, factor * df.rdd.getNumPartitions()))
    return at_least(df, factor * least)
