"""The driver's entry module, with and without the text operators."""

import os
import subprocess
import sys

import __spark_entry__ as entry

HIDE = """
import sys

class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["obsflow", "llm"] or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
print(*entry.queries())
assert set(entry.oracle_sql()) <= set(entry.queries())
"""


def test_without_text_operators():
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    names = subprocess.run([sys.executable, "-c", HIDE], cwd=top, capture_output=True, text=True, check=True).stdout.split()
    assert "process_tables" in names and not any(n.startswith("op") or n == "pipeline" for n in names)


def test_errors_inside_are_not_hidden(tmp_path, monkeypatch):
    (tmp_path / "broken_module.py").write_text("import no_such_thing_anywhere\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    assert entry._if_there("no_such_module") is None
    try:
        entry._if_there("broken_module")
    except ModuleNotFoundError as missing:
        assert missing.name == "no_such_thing_anywhere"
    else:
        raise AssertionError("a broken module passed for a missing one")
