"""Run registered queries against their SQL: python tests/check_queries.py [folder] [name or module ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from importlib import import_module  # noqa: E402

import oracle  # noqa: E402

from gavel.queries.registry import registered  # noqa: E402
from gavel.session import local_session  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = local_session("8")
    con = oracle.connect(folder)
    every = registered()
    wanted = []
    for n in names or list(every):
        wanted += [n] if n in every else list(import_module(f"gavel.queries.{n}").QUERIES)
    bad = 0
    for n in wanted:
        fn, sql = every[n]
        t = time.time()
        try:
            df = fn(spark, folder)
            ok, msg = oracle.compare(df, con, sql) if sql else (True, f"{df.count()} rows (no sql)")
        except Exception as e:  # report and go on
            ok, msg = False, "ERROR " + str(e)[:1500]
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {n} {time.time() - t:.1f}s {msg}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]) else 0)
