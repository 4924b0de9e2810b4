"""What the entry file does without what the text queries need, and the shared folder."""

import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from blotter.sources.shared import shared_folder

ROOT = str(Path(__file__).resolve().parent.parent)


@pytest.mark.parametrize("package", ["public_tokenizers", "tokenizers", "zstandard"])
def test_the_other_queries_stand_without_a_text_package(package):
    code = (
        f"import sys; sys.path.insert(0, {ROOT!r}); sys.modules[{package!r}] = None\n"
        "import __spark_entry__ as e\n"
        "assert 'monthly' in e.queries() and 'pipeline' not in e.queries()\n"
        "assert e.queries().keys() == e.oracle_sql().keys()\n"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    if Path(ROOT, "blotter", "llm").exists() and Path(ROOT, "corpus_pipeline.py").exists():
        assert package in done.stderr


def test_a_cluster_needs_a_named_shared_folder():
    undefined = SimpleNamespace(isDefined=lambda: False)
    context = SimpleNamespace(
        master="spark://somewhere:7077",
        _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: undefined)),
    )
    spark = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(spark)
