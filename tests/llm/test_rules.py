"""Rules of the subpackage that can be read from its source."""

import re
from collections import Counter
from pathlib import Path

import hirelake.llm

HOME = Path(hirelake.llm.__file__).parent
#: Modules whose main path is DataFrame expressions only.
NATIVE = ("mixing", "url_filter", "simhash", "chat", "line_dedup", "graph")


def sources():
    return {p.stem: p.read_text(encoding="utf-8") for p in HOME.glob("*.py")}


def test_what_is_collected_is_bounded():
    """Training rows (their number is a constant), label counts, and the
    spread of two verdicts; nothing else leaves the executors as rows."""
    found = {n: Counter(re.findall(r"\.(collect|toLocalIterator|toPandas|localCheckpoint|crossJoin)\(", t)) for n, t in sources().items()}
    assert {n: dict(c) for n, c in found.items() if c} == {
        "language_id": {"collect": 1}, "toxicity": {"collect": 1, "toLocalIterator": 1}, "url_filter": {"collect": 1}}


def test_native_operators_import_no_python_execution():
    for name in NATIVE:
        assert not re.search(r"numpy|pyarrow|pandas|\.rdd\b|mapIn|applyIn|\budf\b", sources()[name]), name


def test_nothing_else_imports_the_subpackage():
    for p in HOME.parent.rglob("*.py"):
        if p.parent != HOME:
            assert "llm" not in re.sub(r'""".*?"""', "", p.read_text(encoding="utf-8"), flags=re.S), p
