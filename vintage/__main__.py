"""Run a whole comparison job and print its manifest.

    python -m vintage profiles --data /path/to/dataset [--out /shared/results] [--database name] --master 'local[*]'
    spark-submit --py-files vintage.zip vintage/__main__.py postings --data hdfs:///dataset

Without ``--master`` the master and all sizes are those of the submitted
session; the job sets neither. The session's ``spark.checkpoint.dir`` is used
for staging and, without ``--out``, for the results; it must be set unless
the master is local.
"""

from __future__ import annotations

import argparse
import sys

from vintage.plans import publish
from vintage.session import build_session

JOBS = {"profiles": publish.publish_profile_matrix, "postings": publish.publish_postings,
        "overlap": publish.publish_overlap, "export": publish.publish_export_bundle}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="vintage")
    ap.add_argument("job", choices=list(JOBS))
    ap.add_argument("--data", required=True, help="dataset directory (one parquet file per table)")
    ap.add_argument("--out", default=None, help="result folder (default: under spark.checkpoint.dir)")
    ap.add_argument("--database", default=None, help="register the written tables under this name")
    ap.add_argument("--master", default=None, help="only for runs that are not submitted, such as local[*]")
    args = ap.parse_args(argv)
    spark = build_session(args.master, shuffle_partitions=8 if args.master else None)
    rows = JOBS[args.job](spark, args.data, args.out, args.database).collect()
    for r in rows:
        print(f"{r.artifact}\t{r.status}\t{r.rows}\t{r.path}" + (f"\t{r.error}" if r.error else ""))
    spark.stop()
    return 0 if all(r.status in ("ok", "kept") for r in rows) else 1


if __name__ == "__main__":
    sys.exit(main())
