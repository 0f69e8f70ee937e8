"""Command line: the warehouse's two runs.

``python -m wardmart build --raw DIR --seed FILE [--out DIR]``
    load the raw CSV files (typed, ids padded), write them and every table
    model into a run folder, run the 52 declared tests and publish the run;
    prints the load and build audits and the test report as JSON lines.
    Exits non-zero when an error-severity test fails; the run is then not
    published, and readers keep seeing the one before.

``python -m wardmart etl --raw DIR [--out DIR]``
    the script-built staging tables: cleaned hospital info, de-duplicated
    cost report, hospital geography, census uninsured rate; each written
    with its row count (and unmatched-CBSA count for the geography), and
    published together under ``<out>/staging``.

``python -m wardmart retire --out DIR [--keep N]``
    delete the runs that no reader can see or still holds.

``DIR`` holds ``medicare_inpatient.csv``, ``cost_report.csv``,
``hospital_general_info.csv``, ``census_acs.csv`` and
``zip_cbsa_crosswalk.csv`` (or folders of that name). ``--out`` defaults to
the warehouse root under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

RAW_TABLES = ["medicare_inpatient", "cost_report", "hospital_general_info", "census_acs",
              "zip_cbsa_crosswalk"]


def _paths(raw_dir: str) -> dict[str, str]:
    out = {}
    for t in RAW_TABLES:
        for cand in (os.path.join(raw_dir, f"{t}.csv"), os.path.join(raw_dir, t)):
            if os.path.exists(cand):
                out[t] = cand
                break
        else:
            raise FileNotFoundError(f"no {t}.csv or {t}/ under {raw_dir}")
    return out


def run_build(spark, raw_dir: str, seed_path: str, out: str | None = None,
              tie_break: tuple[str, ...] = (), min_volume: float = 30) -> dict:
    from .plans.build import build_all
    from .plans.load import load_raw_csv
    from .plans.views import staging_views
    from .plans.warehouse import Warehouse
    from .sources import publish, scan_csv
    raw = load_raw_csv(spark, _paths(raw_dir))
    seed = scan_csv(spark, seed_path)
    wh = Warehouse(raw, seed, cost_tie_break=tie_break, min_volume=min_volume)
    result = build_all(spark, wh, root=out, enforce=False, load=True)
    result["tests"] = [r.asDict() for r in result["report"].collect()]
    if not any(t["status"] == "fail" for t in result["tests"]):
        result["version"] = publish(spark, result["root"], result["run_id"], result["entries"],
                                    staging_views(wh.cost_tie_break, wh.cost_nulls_win))
    return result


def run_etl(spark, raw_dir: str, out: str | None = None, tie_break: tuple[str, ...] = ()) -> dict:
    from .plans import etl
    from .plans.load import load_raw_csv
    from .session import warehouse_root
    from .sources import begin, entry_of, materialize, new_run_id, publish
    raw = load_raw_csv(spark, _paths(raw_dir))
    root = os.path.join(out or warehouse_root(spark), "staging")
    run_id = new_run_id()
    begin(spark, root, run_id)
    audits, entries = {}, {}

    def write(name: str, df, audit_nulls=()):
        written, audits[name] = materialize(spark, df, root, name, run_id, audit_nulls=audit_nulls)
        entries[name] = entry_of(written, root, name, run_id, audits[name])
        return written

    clean = write("hospital_general_info_clean", etl.clean_hospital_info(raw["hospital_general_info"]))
    write("cost_report_dedup", etl.dedup_cost_report(raw["cost_report"], tie_break))
    write("hospital_geo", etl.build_hospital_geo(clean, raw["zip_cbsa_crosswalk"]), ["cbsa_code"])
    write("census_uninsured_clean", etl.build_census_uninsured(raw["census_acs"]))
    return {"run_id": run_id, "root": root, "audits": audits, "version": publish(spark, root, run_id, entries)}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="wardmart")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--raw", required=True)
    b.add_argument("--seed", required=True)
    b.add_argument("--out")
    b.add_argument("--min-volume", type=float, default=30)
    e = sub.add_parser("etl")
    e.add_argument("--raw", required=True)
    e.add_argument("--out")
    r = sub.add_parser("retire")
    r.add_argument("--out")
    r.add_argument("--keep", type=int, default=2)
    r.add_argument("--master")
    for sp in (b, e):
        sp.add_argument("--master", help="e.g. local[8]; omit under spark-submit")
        sp.add_argument("--cost-tie-break", action="append", default=[],
                        help="raw cost-report column deciding between filings with the same "
                             "fiscal-year end (highest wins); repeatable")
    args = p.parse_args(argv)
    from .session import build_session
    spark = build_session(args.master)
    if args.cmd == "retire":
        from .session import warehouse_root
        from .sources import retire
        out = args.out or warehouse_root(spark)
        print(json.dumps({r: retire(spark, r, args.keep) for r in (out, os.path.join(out, "staging"))}))
        return 0
    if args.cmd == "build":
        res = run_build(spark, args.raw, args.seed, args.out, tuple(args.cost_tie_break),
                        min_volume=args.min_volume)
        print(json.dumps({k: res[k] for k in ("run_id", "root", "version", "audits")}))
        for row in res["tests"]:
            print(json.dumps(row))
        return 1 if any(r["status"] == "fail" for r in res["tests"]) else 0
    res = run_etl(spark, args.raw, args.out, tuple(args.cost_tie_break))
    print(json.dumps(res))
    return 0


if __name__ == "__main__":
    sys.exit(main())
