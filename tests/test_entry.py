"""The driver's contract and the bench."""

import json
import os
import re
import subprocess
import sys

import __spark_entry__ as entry_module


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["current_import_date", "code"]


def test_same_keys():
    """Only corpus operators, where they are installed, may lack SQL."""
    corpus = {k for k in entry_module.queries() if re.match(r"op\d+_|pipeline$", k)}
    assert set(entry_module.queries()) - corpus == set(entry_module.oracle_sql()) - corpus
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "2", "BENCH_RUNS": "1"}
    out = subprocess.run(
        [sys.executable, "bench.py", "price_changes"], capture_output=True, text=True, env=env, timeout=300,
        cwd=os.path.dirname(entry_module.__file__),
    ).stdout.strip()
    line = json.loads(out)
    assert line["sf"] == "0.001" and line["queries"]["price_changes"] > 0
