"""Command line: compare registered queries with their SQL. ``check.py SF_DIR [name ...]``."""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.oracle import compare, connect  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from clipsift.session import build_session

    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    plans, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or plans:
        start = time.time()
        try:
            df = plans[name](spark, sf_dir)
            if name in sqls:
                problems = compare(df, con, sqls[name])
            else:
                n = df.count()
                problems = [] if n else ["no rows"]
        except Exception as err:
            problems = [f"{type(err).__name__}: {str(err)[:600]}"]
            if names:
                traceback.print_exc()
        bad += bool(problems)
        kind = "sql" if name in sqls else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {name} [{kind}] {time.time() - start:.1f}s", *problems, flush=True)
    print(f"{bad} of {len(names or plans)} failed")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
