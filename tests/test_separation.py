"""The rest works without the text subpackage, and nothing in it is imported from outside."""

import os
import re
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_rest_works_with_both_folders_deleted(tmp_path):
    at = tmp_path / "repo"
    shutil.copytree(REPO, at, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "*.parquet"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'p2_found' in q and 'p1_found' not in q; e.oracle_sql(); import foliant.__main__"
    subprocess.run([sys.executable, "-c", code], cwd=at, check=True, env=os.environ | {"PYTHONPATH": str(at)})
    got = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=at, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(at)})
    assert got.returncode == 0, got.stdout[-2000:]


def test_a_broken_import_inside_is_no_absence(tmp_path):
    at = tmp_path / "repo"
    shutil.copytree(REPO, at, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests"))
    if not (at / "foliant/llm").exists():
        return
    (at / "foliant/llm/registry.py").write_text("import no_such_module_at_all\n")
    got = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=at, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(at)})
    assert got.returncode != 0 and "no_such_module_at_all" in got.stderr


def test_nothing_outside_imports_the_text_subpackage():
    for d, _, files in os.walk(os.path.join(REPO, "foliant")):
        if os.path.basename(d) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(d, f)) as h:
                    assert not re.search(r"foliant\.llm|from foliant import llm|from \.+llm", h.read()), f
