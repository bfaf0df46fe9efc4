"""The cheap catalog queries against their SQL on the small tables; all of them run in
``python -m catalog.check``."""

import pytest

import __spark_entry__ as entry
from catalog import MODULES, check

SF = "/root/testdata/sf0.001"
QUICK = ["clean_text", "anonymize", "keywords", "demographic_groups", "trait_findings",
         "mann_whitney", "mann_whitney_p", "individual_fairness", "paired_cases", "intersection_cases",
        "template_sentences", "preprocess", "read_text_csv", "stream_alerts", "swap_gender", "skew_score",
        "equalized_odds_difference", "bias_amplification", "vocabulary_top", "detect_language", "validate_texts", "swap_names",
         "alert_candidates", "rate_limit", "running_totals"]


def test_every_query_has_sql():
    own = {name for module in MODULES for name in module.QUERIES}
    assert own <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    problem, rows = check.compare(spark, check.duck(SF), entry.queries()[name],
                                  entry.oracle_sql()[name], SF)
    assert problem is None
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_python_workers_need_no_path(tmp_path):
    """A query with Python workers, started from another folder."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    code = (f"import sys; sys.path.append({str(root)!r})\n"
            "import __spark_entry__ as entry\n"
            "from pyspark.sql import SparkSession\n"
            "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
            ".config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
            f"print(entry.queries()['individual_fairness'](spark, {SF!r}).count())\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True,
                          text=True, timeout=300)
    assert done.stdout.strip().endswith("1"), done.stderr[-2000:]
