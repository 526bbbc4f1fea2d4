"""Command line: build the processed table, train and evaluate.

    python -m zonecast.cli prepare  --raw RAW --out PROCESSED [--partition-by game_date]
    python -m zonecast.cli train    --processed PROCESSED --models DIR --metrics BASE --keys k1,k2,...
    python -m zonecast.cli evaluate --processed PROCESSED --models DIR --metrics BASE --keys k1,k2,...
"""

from __future__ import annotations

import argparse

from zonecast.plans.dataset import prepare_dataset
from zonecast.plans.training import DEFAULT_MODELS, evaluate_saved_models, train_and_evaluate
from zonecast.session import build_session, drop_tables
from zonecast.sources.pitch_io import load_pitches


def main(argv=None):
    ap = argparse.ArgumentParser(prog="zonecast")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("prepare")
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--partition-by", default="")
    for name in ("train", "evaluate"):
        t = sub.add_parser(name)
        t.add_argument("--processed", required=True)
        t.add_argument("--models", required=True)
        t.add_argument("--metrics", required=True)
        t.add_argument("--keys", required=True, help="comma-separated columns that identify a row")
        if name == "train":
            t.add_argument("--model-names", default=",".join(DEFAULT_MODELS))
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    if a.cmd == "prepare":
        parts = [c for c in a.partition_by.split(",") if c]
        out = prepare_dataset(spark, a.raw, a.out, parts)
        print(f"processed rows: {out.count()}")
    else:
        processed = load_pitches(spark, a.processed, required=["is_strike"])
        keys = [k for k in a.keys.split(",") if k]
        if a.cmd == "train":
            res = train_and_evaluate(spark, processed, keys, a.model_names.split(","), models_dir=a.models,
                                     metrics_base=a.metrics)
            res["metrics_test"].show(truncate=False)
        else:
            evaluate_saved_models(spark, processed, keys, a.models, a.metrics).show(truncate=False)
    drop_tables(spark)  # everything asked for is written or shown


if __name__ == "__main__":
    main()
