"""The library without the folders of training-data operators: the entry point imports and keeps all other queries."""
import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAYS = "import __spark_entry__ as e; print('N', *sorted(e.queries())); print('O', *sorted(e.oracle_sql()))"


def names(root):
    out = subprocess.run([sys.executable, "-B", "-c", SAYS], cwd=root, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": root})
    assert out.returncode == 0, out.stderr
    lines = {line[0]: set(line.split()[1:]) for line in out.stdout.splitlines() if line[:2] in ("N ", "O ")}
    return lines["N"], lines["O"]


@pytest.mark.parametrize("drop", [["gridpanel/llm"], ["gridpanel/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_entry_without_the_llm_folders(tmp_path, drop):
    from gridpanel.plans import catalog
    root = str(tmp_path / "copy")
    skip = shutil.ignore_patterns("__pycache__", ".git", "llm" if "gridpanel/llm" in drop else "-", *[d for d in drop if d.endswith(".py")])
    shutil.copytree(ROOT, root, ignore=skip)
    queries, oracles = names(root)
    own = set(catalog.queries())
    assert own <= queries and set(catalog.oracle_sql()) <= oracles <= queries
    if "gridpanel/llm" in drop:
        assert queries == own
        os.makedirs(f"{root}/gridpanel/llm")            # an emptied folder is like none
        assert names(root)[0] == own
    else:
        assert "pipeline" not in queries and any(q.startswith("op1_") for q in queries) or not os.path.isdir(f"{ROOT}/gridpanel/llm")


def test_library_does_not_import_the_subpackage():
    for folder, _, files in os.walk(os.path.join(ROOT, "gridpanel")):
        if os.path.basename(folder) not in ("llm", "__pycache__"):
            for f in files:
                if f.endswith(".py"):
                    text = open(os.path.join(folder, f)).read()
                    assert "llm" not in text.replace("__all__", ""), f
