"""One account with a third of all rows must not land in one task."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize(("mode", "share"), [("account", "0.25"), ("day", "0.15"), ("null", "0.15"), ("minute", "0.15")])
def test_hot_account_is_spread_over_tasks(mode, share):
    # own process: the check needs Spark's event log, set at session start
    run = subprocess.run(
        [sys.executable, "tools/skew_check.py", f"/root/testdata/{'sf0.01' if mode == 'account' else 'sf0.1'}", "4", share, mode],
        cwd=ROOT, capture_output=True, text=True, timeout=900,
    )
    assert "hot account rows" in run.stdout, run.stdout + run.stderr[-2000:]
    assert run.returncode == 0, run.stdout
