"""The driver's contract, and that nothing else needs the subpackage llm."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 874
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_rest_works_without_llm(tmp_path):
    import shutil

    shutil.copytree(f"{ROOT}/corpuscle", tmp_path / "corpuscle", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and set(e.oracle_sql()) <= set(q) and not any(k.startswith('op1_') or k == 'pipeline' for k in q)"
    run = lambda: subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    run()
    shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)  # the folders gone, the pipeline still there
    run()


def test_broken_pipeline_is_not_hidden(tmp_path):
    import shutil

    shutil.copytree(f"{ROOT}/corpuscle", tmp_path / "corpuscle", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module\n")
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert out.returncode and "no_such_module" in out.stderr
