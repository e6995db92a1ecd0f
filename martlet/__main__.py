"""Command-line entry: ``python -m martlet ...`` locally, or on a cluster
``spark-submit --py-files martlet.zip martlet/__main__.py ...``:

    python -m martlet stages preprocess clusterize write \\
        --wide products --mart products_proc --base /shared/marts --key code \\
        --features fat_100g,carbohydrates_100g,sugars_100g,proteins_100g,salt_100g,sodium_100g
    python -m martlet wordcount --input /data/reviews --format parquet \\
        --text-col Translated_Review --output /shared/out/word_counts [--top 20]

Stage names are case-insensitive and run in chain order; the first failing stage
stops the chain (non-zero exit). Session settings come from spark-submit.
A JSON report is printed on success.
"""

from __future__ import annotations

import argparse
import json
import sys

from martlet.operators import text
from martlet.plans import jobs
from martlet.session import build_session
from martlet.sources import files, jdbc


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="martlet")
    sub = p.add_subparsers(dest="command", required=True)
    st = sub.add_parser("stages", help="run preprocess / clusterize / write over catalog tables")
    st.add_argument("stages", nargs="+")
    st.add_argument("--wide", required=True, help="wide source table name")
    st.add_argument("--mart", required=True, help="mart table name")
    st.add_argument("--base", required=True, help="shared folder for published versions")
    st.add_argument("--key", default=jobs.MART_KEY)
    st.add_argument("--features", default=",".join(jobs.MART_FEATURES))
    st.add_argument("--k", type=int, default=5)
    st.add_argument("--seed", type=int, default=42)
    st.add_argument("--no-range", action="store_true", help="skip the [0, 100) bounds")
    st.add_argument("--repeatable", action="store_true", help="repeatable k-means fit (layout by key)")
    st.add_argument("--resume", action="store_true", help="go on at the first stage that these inputs and parameters have not been through")
    for side, what in (("source", "read it from"), ("sink", "also write it to")):
        for t in ("wide", "mart"):
            st.add_argument(f"--{t}-{side}", metavar="FORMAT", help=f"format to {what} instead of the catalog alone")
            st.add_argument(f"--{t}-{side}-option", action="append", default=[], metavar="KEY=VALUE")
    wc = sub.add_parser("wordcount", help="word frequencies of a text column")
    wc.add_argument("--input", required=True)
    wc.add_argument("--format", default="parquet")
    wc.add_argument("--text-col", required=True)
    wc.add_argument("--output", required=True)
    wc.add_argument("--top", type=int, default=0, help="keep only the top N words (0 = all)")
    wc.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                    help="reader option, repeatable (e.g. header=true, sep=\\t)")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = build_session(app_name=f"martlet-{args.command}")
    if args.command == "stages":
        names = {"wide": args.wide, "mart": args.mart}
        given = {side: {name: (fmt, dict(o.split("=", 1) for o in getattr(args, f"{t}_{side}_option")))
                        for t, name in names.items() if (fmt := getattr(args, f"{t}_{side}"))}
                 for side in ("source", "sink")}
        for _, options in given["source"].values():
            if "numPartitions" in options:     # as the studied command line: 1 to 100
                jdbc.validate_partitions(options["numPartitions"], hi=100)
        cfg = jobs.MartConfig(wide_table=args.wide, mart_table=args.mart, base_dir=args.base,
                                   key=args.key, features=[c for c in args.features.split(",") if c],
                                   k=args.k, seed=args.seed, apply_range=not args.no_range,
                                   repeatable=args.repeatable, sources=given["source"], sinks=given["sink"])
        report = jobs.run_stages(spark, args.stages, cfg, resume=args.resume)
    else:
        options = dict(o.split("=", 1) for o in args.option)
        df = files.read_source(spark, args.format, args.input, **options)
        out = text.word_topk(df, args.text_col, k=args.top) if args.top else text.word_count(df, args.text_col)
        out.write.mode("error").parquet(args.output)
        report = {"output": args.output}
    print(json.dumps(report, default=str))
    return report


if __name__ == "__main__":
    try:
        main()
    except Exception as exc:  # noqa: BLE001 - report and fail the submit
        print(f"martlet: {type(exc).__name__}: {exc}", file=sys.stderr)
        sys.exit(1)
