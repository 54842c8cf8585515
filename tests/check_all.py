"""Run every query against its SQL counterpart: python tests/check_all.py <folder> [name ...]"""

from __future__ import annotations

import sys
import time
import tempfile
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from tests.compare import connect, differences


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", f"{root}/warehouse")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            problem = differences(fn(spark, sf_dir), con, sqls[name]) if name in sqls else "no SQL"
        except Exception:
            problem = traceback.format_exc()[-1500:]
        bad += problem is not None
        print(f"{name:28s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
