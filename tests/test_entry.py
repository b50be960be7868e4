import os
import re
import shutil
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_works_without_the_text_operators(tmp_path):
    shutil.copy(f"{HERE}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{HERE}/tributary", tmp_path / "tributary", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert len(q) > 30 and set(s) <= set(q); assert not [n for n in q if n.startswith('op') or n == 'pipeline']"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, check=True, timeout=120)


def test_nothing_else_imports_the_text_operators():
    found = []
    for folder, _, names in os.walk(f"{HERE}/tributary"):
        if f"{os.sep}llm" not in folder:
            found += [n for n in names if n.endswith(".py") and re.search(r"\bllm\b", open(os.path.join(folder, n)).read())]
    assert found == []
