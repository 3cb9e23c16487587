import subprocess
import sys

import __spark_entry__ as e


def test_entry_and_names(spark):
    df = e.entry(spark)
    assert df.count() > 0 and df.columns == ["game_id", "slot", "cx", "cy", "cz", "ticks"]
    assert set(e.oracle_sql()) <= set(e.queries())


def test_the_rest_stands_without_the_training_data_operators():
    code = "import sys; sys.modules['tickforge.llm'] = None; sys.modules['corpus_pipeline'] = None\nimport __spark_entry__ as e\nprint(sorted(n for n in e.queries() if n.startswith('op') and n[2].isdigit() or n == 'pipeline'))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert out.stdout.strip().endswith("[]")
