"""The driver's contract, and the engine without the optional subpackage."""

import os
import subprocess
import sys

import __spark_entry__ as entry


def test_entry_and_registry(spark, sf):
    assert entry.entry(spark).count() == 5
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) > 70


def test_imports_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('meshquilt.llm'):\n"
        "            raise ModuleNotFoundError(name)\n"
        "import importlib.util as u\n"
        "real = u.find_spec\n"
        "u.find_spec = lambda n, *a: None if n == 'corpus_pipeline' or n.startswith('meshquilt.llm') else real(n, *a)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 70 and not any(k.startswith('op') and k[2:3].isdigit() for k in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_nothing_else_imports_the_subpackage():
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "meshquilt")
    for folder, _, names in os.walk(root):
        if "llm" not in os.path.relpath(folder, root).split(os.sep):
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(folder, n)) as f:
                        assert "meshquilt.llm" not in f.read(), n
