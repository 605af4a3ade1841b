"""Each module by itself in a fresh process, as a task's worker imports it."""

import os
import subprocess
import sys
from glob import glob

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_each_module_alone():
    names = sorted(os.path.relpath(p, ROOT)[:-3].replace(os.sep, ".").removesuffix(".__init__") for p in glob(f"{ROOT}/sparkwharf/*/*.py") if f"{os.sep}llm{os.sep}" not in p)
    runs = {n: subprocess.Popen([sys.executable, "-c", f"import {n}"], cwd=ROOT, stderr=subprocess.PIPE, text=True) for n in names}
    assert {n: r.stderr.read()[-300:] for n, r in runs.items() if r.wait(120)} == {}


def test_names_are_given_once():
    from sparkwharf.plans.register import query
    from sparkwharf.plans.registry import FLAGSHIP

    with pytest.raises(ValueError, match="already"):
        query(FLAGSHIP)(print)
