"""Command line for the jobs (X1-X6), for ``spark-submit`` or ``python -m``.

    python -m qamill.plans.cli land     --src DIR --format arrow --dest SNAPSHOT
    python -m qamill.plans.cli offline  --raw SNAPSHOT --out SPLIT_ROOT
    python -m qamill.plans.cli ingest   --src DROP --base VERSIONS --archive ARCHIVE [--stream CKPT]
    python -m qamill.plans.cli train-feed   --offline SPLIT_ROOT --out FEED
    python -m qamill.plans.cli retrain-feed --base VERSIONS --out FEED
    python -m qamill.plans.cli report   --offline SPLIT_ROOT --out REPORT [--base VERSIONS]
    python -m qamill.plans.cli replay   --src SPLIT_ROOT/production --out RESULTS --checkpoint CKPT
                                        --score module:function

Paths are required (S8).  The session comes from the environment
(``spark-submit`` configuration); only the time zone is pinned to UTC.
"""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("qamill").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _score_fn(spec: str):
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="qamill")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("land")
    p.add_argument("--src", required=True)
    p.add_argument("--dest", required=True)
    p.add_argument("--format", default="parquet")
    p.add_argument("--split", default="train")
    p = sub.add_parser("offline")
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--key", default="id")
    p.add_argument("--seed", type=int, default=42)
    p = sub.add_parser("ingest")
    p.add_argument("--src", required=True)
    p.add_argument("--base", required=True)
    p.add_argument("--archive", required=True)
    p.add_argument("--quarantine")
    p.add_argument("--stream", metavar="CHECKPOINT", help="run as an availableNow stream")
    p.add_argument("--single-object", default="skip", choices=("skip", "ingest"))
    for name in ("train-feed", "retrain-feed"):
        p = sub.add_parser(name)
        p.add_argument("--offline" if name == "train-feed" else "--base", required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--max-len", type=int, default=512)
        p.add_argument("--max-vocab", type=int, default=None)
        p.add_argument("--batch-size", type=int, default=8)
        p.add_argument("--epochs", type=int, default=2)
        p.add_argument("--workers", type=int, default=2)
    p = sub.add_parser("report")
    p.add_argument("--offline", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--base")
    p.add_argument("--types", nargs="*", default=[])
    p.add_argument("--keyword", default="")
    p.add_argument("--version", default="latest")
    p = sub.add_parser("replay")
    p.add_argument("--src", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--score", required=True, help="module:function, pandas Series -> Series")
    p.add_argument("--available-now", action="store_true")
    a = ap.parse_args(argv)

    spark = _session()
    from qamill.plans import jobs  # noqa: PLC0415
    from qamill.sources import io  # noqa: PLC0415

    if a.cmd == "land":
        io.land_raw(spark, a.src, a.dest, a.format, split=a.split)
    elif a.cmd == "offline":
        res = jobs.offline_prepare(spark, spark.read.parquet(a.raw), a.out, key=a.key, seed=a.seed)
        print(json.dumps(res.__dict__))
    elif a.cmd == "ingest":
        if a.stream:
            from qamill.streaming.ingest import run_ingest_once  # noqa: PLC0415

            run_ingest_once(spark, a.src, a.base, a.archive, a.stream, quarantine_path=a.quarantine,
                            single_object=a.single_object)
        else:
            from qamill.operators.versions import ingest_dir  # noqa: PLC0415

            r = ingest_dir(spark, a.src, a.base, a.archive, quarantine_path=a.quarantine,
                           single_object=a.single_object)
            print(json.dumps({"version": r.version, "record_count": r.record_count}))
    elif a.cmd in ("train-feed", "retrain-feed"):
        kw = dict(max_len=a.max_len, max_vocab=a.max_vocab, batch_size=a.batch_size,
                  epochs=a.epochs, workers=a.workers)
        if a.cmd == "train-feed":
            jobs.training_feed(spark, a.offline, a.out, **kw)
        else:
            print(json.dumps({"version": jobs.retraining_feed(spark, a.base, a.out, **kw)}))
    elif a.cmd == "report":
        jobs.report(spark, a.offline, a.out, base=a.base, types=tuple(a.types), keyword=a.keyword, version=a.version)
    elif a.cmd == "replay":
        from qamill.sources.io import QA_SCHEMA  # noqa: PLC0415
        from qamill.streaming.replay import start_replay  # noqa: PLC0415
        from pyspark.sql import types as T  # noqa: PLC0415

        schema = T.StructType(list(QA_SCHEMA.fields) + [T.StructField("pos", T.LongType())])
        q = start_replay(spark, a.src, schema, _score_fn(a.score), a.out, a.checkpoint,
                         available_now=a.available_now)
        q.awaitTermination()


if __name__ == "__main__":
    main()
