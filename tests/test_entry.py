"""The driver's entry without the optional training-data operators."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_CODE = """
import sys
for name in {absent!r}:
    sys.modules[name] = None
sys.path.insert(0, {repo!r})
import __spark_entry__ as E
print("QUERIES", len(E.queries()), len(E.oracle_sql()), "merge_apply" in E.queries())
"""


@pytest.mark.parametrize("absent", [["xxhash"], ["zstandard"], ["tokenizers"], ["tidemark.llm"], ["corpus_pipeline"]])
def test_entry_without_optional_parts(absent):
    out = subprocess.run([sys.executable, "-c", _CODE.format(absent=absent, repo=REPO)], capture_output=True, text=True, timeout=120)
    line = [x for x in out.stdout.splitlines() if x.startswith("QUERIES")]
    assert line and line[0].endswith("True"), out.stderr[-2000:]
