"""Command line: run one analysis over record files.

    python -m tidemark list
    python -m tidemark order-timeout --orders OrderLog.csv [--method pattern] [--out result_dir]
    python -m tidemark tx-match --orders OrderLog.csv --receipts ReceiptLog.csv --mode key
    python -m tidemark hot-items --behavior UserBehavior.csv --report-text
    python -m tidemark stream hot-items --behavior incoming_dir --out results --checkpoint state [--once]

With ``--out`` the whole result is written as parquet (or csv/json with ``--format``); without it a preview of
the first rows is printed, which says so. ``stream`` runs the streaming form of a job over line files that come
into a folder, or with ``--source kafka`` over topics. On a cluster, submit with spark-submit and pass no
``--master``.
"""

from __future__ import annotations

import argparse
import inspect
import sys

from tidemark.plans.files import JOBS
from tidemark.session import build_session


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    if not argv or argv[0] in ("list", "-h", "--help"):
        for name, (fn, inputs) in JOBS.items():
            print(f"{name:22s} inputs: {', '.join('--' + i.replace('_', '-') for i in inputs)}")
        return 0
    if argv[0] == "stream":
        return stream(argv[1:])
    name, rest = argv[0], argv[1:]
    fn, inputs = JOBS[name]
    ap = argparse.ArgumentParser(prog=f"tidemark {name}")
    for i in inputs:
        ap.add_argument("--" + i.replace("_", "-"), dest=i, required=True)
    params = inspect.signature(fn).parameters
    for p in list(params)[1 + len(inputs):]:
        default = params[p].default
        if isinstance(default, bool):
            ap.add_argument("--" + p.replace("_", "-"), dest=p, action="store_true")
        else:
            ap.add_argument("--" + p.replace("_", "-"), dest=p, default=default,
                            type=type(default) if default is not None else str)
    ap.add_argument("--out")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--master")
    ap.add_argument("--show", type=int, default=50)
    args = vars(ap.parse_args(rest))
    out, fmt, master, show = args.pop("out"), args.pop("format"), args.pop("master"), args.pop("show")
    spark = build_session(master)
    df = fn(spark, **args)
    if out:
        df.write.mode("overwrite").format(fmt).save(out)
    else:
        print(f"preview of at most {show} rows; --out writes all")
        df.show(show, truncate=False)
    return 0


def stream(argv: list[str]) -> int:
    from tidemark.streaming.wiring import STREAM_JOBS, start
    if not argv or argv[0] not in STREAM_JOBS:
        for name, (inputs, _) in STREAM_JOBS.items():
            print(f"stream {name:22s} inputs: {', '.join('--' + i.replace('_', '-') for i in inputs)}")
        return 0 if not argv else 2
    job = argv[0]
    ap = argparse.ArgumentParser(prog=f"tidemark stream {job}")
    for i in STREAM_JOBS[job][0]:
        ap.add_argument("--" + i.replace("_", "-"), dest=i, required=True, help="folder of line files, or topic")
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint", required=True)
    ap.add_argument("--source", default="text", choices=["text", "kafka"])
    ap.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="source option")
    ap.add_argument("--once", action="store_true", help="take what is there and end")
    ap.add_argument("--master")
    args = ap.parse_args(argv[1:])
    query = start(build_session(args.master), job, {i: getattr(args, i) for i in STREAM_JOBS[job][0]}, args.out,
                  args.checkpoint, args.source, dict(o.split("=", 1) for o in args.option), args.once)
    query.awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
