"""The usage examples in README.md run as written (on sf0.01)."""

import os
import re

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _python_blocks():
    text = open(os.path.join(ROOT, "README.md")).read()
    return re.findall(r"```python\n(.*?)```", text, re.S)


def test_readme_examples_run(spark, capsys):
    blocks = _python_blocks()
    assert len(blocks) >= 2
    for code in blocks:
        code = code.replace("/root/testdata/sf0.1", "/root/testdata/sf0.01")
        code = code.replace("spark = build_session()", "")  # reuse the test session
        exec(compile(code, "README.md", "exec"), {"spark": spark, "v": None} | _namespace(spark))
    out = capsys.readouterr().out
    assert "customer_id" in out and "device_type" in out


def _namespace(spark):
    from tvlens.sources import load_views

    return {"v": load_views(spark, "/root/testdata/sf0.01")}
