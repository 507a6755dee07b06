"""Loads survive task failures: retried tasks leave no duplicate rows or counts."""

from __future__ import annotations

import os
import subprocess
import sys


def test_loads_survive_task_retries():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fault_job.py")
    proc = subprocess.run(
        [sys.executable, script], capture_output=True, text=True, timeout=600
    )
    assert "FAULT-TOLERANCE-OK" in proc.stdout, proc.stdout[-2000:] + proc.stderr[-4000:]
