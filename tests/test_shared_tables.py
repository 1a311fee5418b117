"""Scopes of written tables: by thread, and gone when the driver ends."""

import os
import subprocess
import sys
import textwrap
import threading
import time
from pathlib import Path

from sievemill.sources import shared_tables


def test_scopes_of_threads_are_their_own(spark):
    inside, ended, found = threading.Event(), threading.Event(), {}

    def scoped():
        with shared_tables.only(spark):
            shared_tables.written(spark.range(5), "mine")
            inside.set()
            ended.wait(60)

    other = threading.Thread(target=scoped)
    other.start()
    inside.wait(60)
    df, path = shared_tables.written(spark.range(7), "free")
    with shared_tables.only(spark) as keep:
        kept = keep(*shared_tables.written(spark.range(8), "kept"))
    ended.set()
    other.join()
    found["free"], found["kept"] = df.count(), kept.count()
    assert found == {"free": 7, "kept": 8} and shared_tables._SCOPES.get() == ()


def test_queries_run_at_once(spark, sf):
    from sievemill.plans import catalog_queries as Q

    names, results, faults = ["candidate_pool", "duplicate_components", "run_batches_global"], {}, []
    alone = {n: sorted(map(str, Q.QUERIES[n](spark, sf).collect())) for n in names}

    def run(name):
        try:
            results[name] = sorted(map(str, Q.QUERIES[name](spark, sf).collect()))
        except Exception as e:
            faults.append(e)

    threads = [threading.Thread(target=run, args=(n,)) for n in names]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not faults and results == alone


def test_nothing_is_left_when_the_driver_ends(tmp_path):
    code = f"""
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
        from sievemill.sources import shared_tables
        df, path = shared_tables.written(spark.range(3), "numbers")
        assert df.count() == 3 and path.startswith("file://{tmp_path}/shared/sievemill-")
        spark.stop()
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, timeout=300, env=os.environ | {"PYTHONPATH": str(Path(__file__).parents[1])}, capture_output=True)
    until = time.time() + 30
    ours = lambda: list((tmp_path / "shared").glob("sievemill-*"))  # noqa: E731  Spark leaves an empty folder of its own
    while time.time() < until and ours():
        time.sleep(0.5)
    assert (tmp_path / "shared").exists() and not ours()
