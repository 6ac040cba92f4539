"""Compare registered queries with their SQL: python tests/run_oracles.py [sf_dir] [name part ...]."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from corpus_ledger.session import local_session  # noqa: E402
from tests.compare import difference, oracle_connection  # noqa: E402


def main(sf_dir: str, parts: list[str]) -> int:
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, job in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            if name in oracles:
                verdict = difference(job(spark, sf_dir), con, oracles[name])
                n = len(con.execute(oracles[name]).fetchall())
            else:
                verdict, n = None, job(spark, sf_dir).count()
        except Exception as problem:  # noqa: BLE001
            verdict, n = f"{type(problem).__name__}: {str(problem)[:700]}", -1
            if "--trace" in sys.argv:
                traceback.print_exc()
        bad += verdict is not None
        print(f"{'ok ' if verdict is None else 'BAD'} {name} rows={n} {time.time() - start:.2f}s {'' if name in oracles else '(rows only)'} {verdict or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    folder = args[0] if args and "/" in args[0] else "/root/testdata/sf0.01"
    sys.exit(min(main(folder, [a for a in args if "/" not in a]), 1))
