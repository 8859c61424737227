"""The tabular library stays on the JVM path: no Python UDFs, no RDD code, no local
checkpoints (the corpus subpackage, free in its style, may use Arrow functions
inside tasks, but no RDD code, driver-side pandas or local checkpoints; joint training counts histograms and sums in Arrow
batches, one row a block); scans read only the columns a query needs."""

import os
import re

ROOT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tabforge")
FORBIDDEN = [r"\budf\(", r"pandas_udf", r"mapInPandas", r"applyInPandas", r"\.rdd\b", r"localCheckpoint",
             r"toPandas\("]
EVERYWHERE = [r"\.rdd\b", r"localCheckpoint", r"toPandas\("]


def test_no_python_udfs_or_rdds():
    hits = []
    for root, _, files in os.walk(ROOT):
        for f in files:
            if f.endswith(".py"):
                src = open(os.path.join(root, f)).read()
                corpus = os.path.relpath(root, ROOT).split(os.sep)[0] == "llm"
                hits += [(f, p) for p in (EVERYWHERE if corpus else FORBIDDEN) if re.search(p, src)]
    assert hits == []


def test_scan_prunes_columns(spark):
    from tests.conftest import SF_SMALL
    import __spark_entry__ as E
    df = E.queries()["q_b7_null_predicates"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("o_comment" not in s and "o_orderdate" not in s for s in schemas)
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
