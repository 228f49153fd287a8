"""The jobs CLI end to end in a child process (argument wiring, JSON output)."""

import json
import os
import subprocess
import sys
import tempfile

from tests.conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    out = subprocess.run([sys.executable, "-m", "keelson.plans.jobs", *args], cwd=REPO,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_register_and_featurize_from_the_command_line():
    work = tempfile.mkdtemp(prefix="keelson-cli-")
    reg = f"{work}/registry"
    assert _run("register", "--registry", reg, "--name", "fs1",
                "--path", f"{SF_SMALL}/orders.parquet") == {"version": 1}
    out = _run("featurize", "--registry", reg, "--input", "fs1", "--output", f"{work}/feat",
               "--name", "featurized", "--drop", "o_custkey", "--impute", "o_totalprice",
               "--unique-fast-path", "--run-id", "cli")
    assert out["version"] == 1
    assert out["shapes"]["featurized"][0] == out["shapes"]["fs1"][0]
