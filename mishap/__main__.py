"""``python -m mishap STAGE --input PATH --folder PATH``: run one stage, or all of them."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from mishap.plans import run

STAGES = {
    "clean": run.run_cleaning,
    "engineer": run.run_engineering,
    "hotspots": run.run_hotspots,
    "risk": run.run_risk,
}


def main() -> None:
    parser = argparse.ArgumentParser(prog="mishap")
    parser.add_argument("stage", choices=[*STAGES, "all", "export", "predict"])
    parser.add_argument("--input", help="raw incidents as CSV (clean), a clustered table (predict)")
    parser.add_argument(
        "--multi-line", action="store_true", help="fields of the input hold line breaks: one task per file"
    )
    parser.add_argument("--folder", required=True, help="folder of the stage and result tables")
    parser.add_argument("--output", help="folder for CSV copies (export) or predictions (predict)")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("mishap").getOrCreate()
    if args.stage == "export":
        run.export_csv(spark, args.folder, args.output)
        return
    if args.stage == "predict":
        print("predict", run.run_prediction(spark, args.folder, args.input, args.output))
        return
    for name in STAGES if args.stage == "all" else [args.stage]:
        clean = (args.input, args.folder, args.multi_line)
        paths = clean if name == "clean" else (args.folder,)
        print(name, STAGES[name](spark, *paths))


if __name__ == "__main__":
    main()
