"""The job command line end to end, each job in its own process (as spark-submit runs it)."""

import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def _run(*args, cwd):
    env = dict(os.environ, PYTHONPATH=ROOT)
    r = subprocess.run([sys.executable, "-m", "obslake", *args], cwd=cwd, env=env,
                       capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]


def test_bootstrap_records_trends(spark, tmp_path):
    from obslake import fixtures
    from obslake.plans import jobs

    src = str(tmp_path / "json")
    fixtures.history_records(spark, SF_SMALL).write.json(src)
    daily, rec, tr = (str(tmp_path / n) for n in ("daily", "records", "trends"))
    _run("bootstrap", "--json", src, "--daily", daily, cwd=tmp_path)
    _run("records", "--daily", daily, "--out", rec, cwd=tmp_path)
    _run("trends", "--daily", daily, "--out", tr, cwd=tmp_path)
    assert jobs.read_products(spark, rec, trends=False).count() == 12
    t = jobs.read_products(spark, tr, trends=True)
    assert t.count() == 72 and t.filter("trend IS NULL").count() == 0
