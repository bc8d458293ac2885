"""A splitter of one's own as a table function (T7): ``LATERAL split(doc_id, text)`` in SQL.

A splitter is any function from a text to its chunks. ``register_splitter`` wraps it as a Python table function whose
``analyze`` checks the arguments and fixes the schema, so the rows are those of T7 whatever the splitter:
``chunk_id, doc_id, chunk_index, content``, numbered densely from 0 over the chunks that are not empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ragloom.functions.text import WS_CHARS
from ragloom.params import ChunkParams
from ragloom.session import ship_package

CHUNK_ROW = T.StructType([T.StructField("chunk_id", T.StringType()), T.StructField("doc_id", T.StringType()),
                          T.StructField("chunk_index", T.LongType()), T.StructField("content", T.StringType())])


def windows_of(params: ChunkParams = ChunkParams()) -> Callable[[str], list[str]]:
    """T1 for one text, as a splitter."""
    size, step, least = params.size, params.step, params.min_chars

    def split(text: str) -> list[str]:
        t = text.strip(WS_CHARS)
        ends = range(0, max(0, -(-(len(t) - size) // step)) + 1)
        return [c for c in (t[i * step:i * step + size].strip(WS_CHARS) for i in ends) if len(c) >= least]

    return split


def table_splitter(split: Callable[[str], list[str]]):
    """The table function of a splitter."""

    class Splitter:
        @staticmethod
        def analyze(doc_id: AnalyzeArgument, text: AnalyzeArgument) -> AnalyzeResult:
            for name, arg in (("doc_id", doc_id), ("text", text)):
                if not isinstance(arg.dataType, (T.StringType, T.NullType)):
                    raise ValueError(f"{name} must be a string, got {arg.dataType.simpleString()}")
            return AnalyzeResult(CHUNK_ROW)

        def eval(self, doc_id: str, text: str):
            for i, chunk in enumerate(c for c in split(text or "") if c):
                yield f"{doc_id}:{i}", doc_id, i, chunk

    return udtf(Splitter)


def register_splitter(spark: SparkSession, name: str, split: Callable[[str], list[str]]) -> None:
    """Make ``name(doc_id, text)`` a table function of the session."""
    ship_package(spark)
    spark.udtf.register(name, table_splitter(split))
