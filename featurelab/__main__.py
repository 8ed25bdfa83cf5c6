"""Command line: list or run registered queries.

    python -m featurelab list
    python -m featurelab run <query> <sf_dir> [<out_parquet_dir>]
    python -m featurelab explain <query> <sf_dir>
"""

from __future__ import annotations

import sys


def main(argv: list[str]) -> int:
    from featurelab.plans.registry import load_all
    queries = load_all()
    if not argv or argv[0] not in ("list", "run", "explain"):
        print(__doc__)
        return 2
    if argv[0] == "list":
        for name, q in queries.items():
            print(f"{name:28s} {' '.join(q.ids):28s} {'sql' if q.sql else 'rows-only'}")
        return 0
    if len(argv) < 3 or argv[1] not in queries:
        print(__doc__)
        return 2
    from featurelab.session import build_session
    spark = build_session()
    df = queries[argv[1]].fn(spark, argv[2])
    if argv[0] == "explain":
        df.explain("formatted")
    elif len(argv) > 3:
        df.write.mode("overwrite").parquet(argv[3])
    else:
        df.show(20, truncate=80)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
