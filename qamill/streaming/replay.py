"""Read a split as a stream of question payloads and score each one (ST3, P8).

The source is the JSON Lines output of the offline job (``pos`` carried in
every row); inside a batch rows are scored in ``pos`` order.  ``score_fn`` is
the user's function from a pandas Series of JSON payloads to a Series of
response texts; it is called once for each record, inside ``mapInPandas``.  A
failure on one record is reported in that record's row, the stream goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

RESULT_SCHEMA = T.StructType([
    T.StructField("pos", T.LongType()),
    T.StructField("payload", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("response", T.StringType()),
    T.StructField("error", T.StringType()),
])


def payloads(df: DataFrame, question: str = "question", pos: str = "pos") -> DataFrame:
    """Reduce each record to its request payload ``{"question": ...}``."""
    return df.select(F.col(pos).cast("bigint").alias("pos"),
                     F.to_json(F.struct(F.col(question).alias("question"))).alias("payload"))


def score(df: DataFrame, score_fn: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """Apply ``score_fn`` to payloads; per-record errors become rows (ST3)."""
    from qamill.session import ship_package  # noqa: PLC0415

    ship_package(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.sort_values("pos")
            rows = []
            for payload in pdf["payload"]:
                try:
                    rows.append(("ok", score_fn(pd.Series([payload])).astype("string").iloc[0], None))
                except Exception as e:  # noqa: BLE001 - the scorer is the user's
                    rows.append(("error", None, f"{type(e).__name__}: {e}"))
            out = pdf.assign(status=[x[0] for x in rows], response=[x[1] for x in rows], error=[x[2] for x in rows])
            yield out[["pos", "payload", "status", "response", "error"]]

    return df.mapInPandas(run, RESULT_SCHEMA)


def start_replay(spark: SparkSession, src: str, schema: T.StructType, score_fn,
                 sink: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Stream ``src``, score, append results to ``sink`` (Parquet).
    ``available_now=True`` drains everything present and stops.
    """
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").json(src)
    scored = score(payloads(stream), score_fn)
    w = (scored.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def word_count_score(payload: pd.Series) -> pd.Series:
    """A pure scorer for tests: the number of words of the question."""
    import json  # noqa: PLC0415

    return payload.map(lambda p: str(len((json.loads(p)["question"] or "").split())))
