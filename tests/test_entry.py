"""The entry without the training-data subpackage, and without an extra package that it needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["tiktoken", "public_tokenizers", "ledgerline.llm"])
def test_the_other_queries_are_there(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None; sys.path.insert(0, {ROOT!r})\n"
            "import __spark_entry__ as E\n"
            "q = E.queries(); print(len([n for n in q if n.startswith('q_')]), len([n for n in q if n.startswith('op') or n == 'pipeline']))")
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert int(out[-2]) >= 100 and int(out[-1]) == 0


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "ledgerline")):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    assert "ledgerline.llm" not in open(os.path.join(folder, n)).read() and "from .llm" not in open(os.path.join(folder, n)).read(), n
