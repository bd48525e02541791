"""Foreign parsers and mappers (H3, H4): Python callables run on distinct inputs, with failures kept to their own rows.

A parser takes a label text and returns its ingredient names; a mapper takes a list of names and returns ranked candidates for
each. Both see every distinct input once, in Arrow batches. An exception, or a result of another shape, is an error text beside
that input and nothing else: the other inputs keep their results. A mapper's failing list is halved until the names that
make it fail stand alone.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelcorpus.operators import evaluate as E

# The functions travel to the executors by value, so that workers need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARSED = "text string, predicted array<string>, error string"
MAPPED = "name string, rank int, candidate string, error string"
#: Names that a mapper gets at once.
NAMES_AT_ONCE = 1_000


def _strings(value, what: str) -> list[str]:
    if isinstance(value, (str, bytes)) or not all(isinstance(x, str) for x in value):
        raise TypeError(f"{what} must be strings")
    return list(value)


def _parse_batches(batches: Iterator[pa.RecordBatch], parser) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0).to_pylist()
        predicted, errors = [], []
        for text in texts:
            try:
                names, error = _strings(parser(text), "ingredient names"), None
            except Exception as e:  # noqa: BLE001  (whatever the foreign code raises stays with its row)
                names, error = None, f"{type(e).__name__}: {e}"
            predicted.append(names)
            errors.append(error)
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(predicted, pa.list_(pa.string())),
                                          pa.array(errors, pa.string())], names=["text", "predicted", "error"])


def _map_names(names: list[str], mapper) -> Iterator[tuple]:
    try:
        said = mapper(names)
        rows = [(n, rank, c, None) for n in names for rank, c in enumerate(_strings(said.get(n) or [], "candidates"), 1)]
    except Exception as e:  # noqa: BLE001
        if len(names) == 1:
            yield names[0], None, None, f"{type(e).__name__}: {e}"
            return
        half = len(names) // 2
        yield from _map_names(names[:half], mapper)
        yield from _map_names(names[half:], mapper)
        return
    yield from rows


def _map_batches(batches: Iterator[pa.RecordBatch], mapper) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.column(0).to_pylist()
        for at in range(0, len(names), NAMES_AT_ONCE):
            rows = list(_map_names(names[at:at + NAMES_AT_ONCE], mapper))
            if rows:
                cols = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.string()))],
                                                 names=["name", "rank", "candidate", "error"])


def run_parser(texts: DataFrame, parser: Callable[[str], Sequence[str]], text_col: str = "ingredient_text") -> DataFrame:
    """(text, predicted, error) for every distinct text; null is parsed as an empty text."""
    distinct = texts.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    return distinct.mapInArrow(lambda b: _parse_batches(b, parser), PARSED)


def evaluate_parser(samples: DataFrame, parser: Callable[[str], Sequence[str]], truth_col: str = "truth_names",
                    text_col: str = "ingredient_text") -> DataFrame:
    """E1 with a foreign parser: the samples with their metrics and ``parser_error``; a failed sample has null metrics, which
    averages skip."""
    parsed = run_parser(samples, parser, text_col).withColumnRenamed("text", "_text")
    j = samples.withColumn("_key", F.coalesce(F.col(text_col), F.lit(""))).join(parsed, F.col("_key") == F.col("_text")).drop("_key", "_text")
    j = j.withColumnRenamed("predicted", "_pred").withColumnRenamed("error", "parser_error")
    j = j.withColumns({"_gl": E._norm_list(F.col(truth_col)), "_pl": E._norm_list(F.col("_pred"))})
    good = F.col("parser_error").isNull()
    metrics = E.parsing_metrics(F.col("_gl"), F.col("_pl"), normalized=True)
    return j.select("*", *[F.when(good, v).alias(k) for k, v in metrics.items()]).drop("_pred", "_gl", "_pl")


def run_mapper(names: DataFrame, mapper: Callable[[list[str]], dict[str, Sequence[str]]], name_col: str = "name"
               ) -> tuple[DataFrame, DataFrame]:
    """(predictions: name, rank, candidate; failures: name, error) over the distinct names, for ``evaluate.evaluate_mapping``.

    A name that the mapper does not answer has no rows and counts as not found, like one that fails.
    """
    from labelcorpus.session import materialize
    said = materialize(names.select(F.col(name_col).alias("name")).where("name IS NOT NULL").distinct()
                       .mapInArrow(lambda b: _map_batches(b, mapper), MAPPED))
    return said.where("error IS NULL").select("name", "rank", "candidate"), said.where("error IS NOT NULL").select("name", "error")
