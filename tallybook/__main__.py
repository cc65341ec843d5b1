"""python -m tallybook generate | etl | report | calibrate"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tallybook")
    p.add_argument("--data-dir", default="data")
    sub = p.add_subparsers(dest="command", required=True)
    g = sub.add_parser("generate")
    g.add_argument("--seed", type=int, default=42)
    g.add_argument("--start-year", type=int, default=2015)
    g.add_argument("--end-year", type=int, default=2024)
    sub.add_parser("etl")
    r = sub.add_parser("report")
    r.add_argument("--out", default="report.html")
    r.add_argument("--truth", help="a folder of ground truth to score the load against")
    r.add_argument("--readme", help="a text file with marks for a block of results")
    c = sub.add_parser("calibrate")
    c.add_argument("--chart", help="an SVG file for precision and recall over thresholds")
    a = p.parse_args(argv)
    if a.command == "generate":
        from tallybook.plans.synthetic import generate

        print(generate(a.data_dir, a.seed, a.start_year, a.end_year))
        return 0
    spark = SparkSession.builder.appName(f"tallybook {a.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "etl":
        from tallybook.plans.load import run_load

        print(run_load(spark, f"{a.data_dir}/books", f"{a.data_dir}/tables"))
    elif a.command == "report":
        from tallybook.plans.reports import build_report, update_text

        numbers = build_report(spark, f"{a.data_dir}/tables", a.out, a.out.rsplit(".", 1)[0] + ".json", a.truth)
        print(numbers)
        if a.readme:
            print("updated" if update_text(a.readme, numbers) else "unchanged", a.readme)
    else:
        from tallybook.plans.calibrate import calibrate, sweep
        from tallybook.plans.reports import sweep_chart

        table = sweep(spark)
        table.show(100)
        auto, review = calibrate(spark)
        print("auto, review:", (auto, review))
        if a.chart:
            with open(a.chart, "w") as f:
                f.write(sweep_chart([(r["threshold"], r["precision"], r["recall"]) for r in table.collect()], auto))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
