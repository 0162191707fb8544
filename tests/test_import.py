"""The driver calls queries()/oracle_sql() possibly before any session exists."""

import subprocess
import sys


def test_contract_imports_without_spark():
    code = ("import __spark_entry__ as E; q = E.queries(); o = E.oracle_sql(); "
            "assert set(o) <= set(q) and len(q) > 40; print(len(q))")
    r = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                       cwd=__file__.rsplit("/tests/", 1)[0])
    assert r.returncode == 0, r.stderr[-2000:]


def test_checkpoint_fallback_when_session_names_none(tmp_path):
    import os

    code = ("from pyspark.sql import SparkSession\n"
            "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled','false').getOrCreate()\n"
            "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
            "from quarry.session import ensure_checkpoint_dir\n"
            "a = ensure_checkpoint_dir(spark); b = ensure_checkpoint_dir(spark)\n"
            "assert a == b and spark.sparkContext.getCheckpointDir() == a\n"
            "print(a)\n")
    env = dict(os.environ, SPARK_CONF_DIR=str(tmp_path))  # no spark-defaults.conf
    r = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env=env,
                       cwd=__file__.rsplit("/tests/", 1)[0])
    assert r.returncode == 0, r.stderr[-2000:]
