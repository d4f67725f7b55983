"""The package reaches Python workers that start elsewhere."""
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
import __spark_entry__
from docloom.functions.text import nfkc
from docloom.session import ship
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
print(ship(spark).sql("select '\\u2460' as t").select(nfkc(F.col("t")).alias("t")).first().t)
"""


def test_session_started_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONIOENCODING": "utf-8"}
    out = subprocess.run([sys.executable, "-c", CODE, REPO], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert out.stdout.strip() == "1", out.stderr[-2000:]


def test_the_llm_subpackage_is_optional(tmp_path):
    code = "import sys; sys.path.insert(0, sys.argv[1]); import builtins; real = builtins.__import__\n" + """
def held(name, *a, **k):
    if name.startswith('docloom.llm') or name == 'corpus_pipeline':
        raise ModuleNotFoundError(name, name=name)
    return real(name, *a, **k)
builtins.__import__ = held
import __spark_entry__ as e
print(len([q for q in e.queries() if q.startswith('op') or q == 'pipeline']), len(e.queries()) > 100)
"""
    out = subprocess.run([sys.executable, "-c", code, REPO], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == ["0", "True"], out.stderr[-2000:]


def test_small_files_of_large_tables_are_not_broadcast(spark, tmp_path, monkeypatch):
    import __spark_entry__ as entry

    path = str(tmp_path / "ids")
    spark.range(400_000).selectExpr("id div 10 as doc_id", "'u' || lpad(cast(id % 10 as string), 6, '0') as unit_id").write.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "ids").glob("*.parquet"))
    assert size < 10 << 20 < 400_000 * 40
    monkeypatch.setattr(entry, "QUERIES", {"q": lambda spark, sf: spark.read.parquet(path).join(spark.read.parquet(path), ["doc_id", "unit_id"])})
    monkeypatch.setattr(entry, "LLM_QUERIES", {"op": lambda spark, sf: spark.range(1)})
    given = spark.conf.get("spark.sql.sources.fileCompressionFactor")
    try:
        plan = entry.queries()["q"](spark, "")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    finally:
        entry.queries()["op"](spark, "")
    assert float(spark.conf.get("spark.sql.sources.fileCompressionFactor")) == float(given)
