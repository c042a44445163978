import math
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from reelgauge.plans.batch import QUERIES
from reelgauge.plans.live import STREAMS
from reelgauge.plans.oracle import ORACLE

ROOT = Path(contract.__file__).parent
SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


def test_every_query_has_an_oracle():
    assert {*QUERIES, *STREAMS} == set(ORACLE) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_imports_without_the_text_folder(tmp_path):
    shutil.copytree(ROOT / "reelgauge", tmp_path / "reelgauge", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "reelgauge" / "llm" / "__pycache__").mkdir(parents=True)  # what a deletion may leave behind
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True, check=True)
    assert said.stdout.split() == [str(len(ORACLE))] * 2


@needs_data
def test_entry_runs(spark):
    rows = contract.entry(spark).collect()
    assert rows and {"subset", "n_media", "n_clips", "n_windows"} == set(rows[0].asDict())


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return repr(value)


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    base = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        base.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = contract.queries()[name](spark, SF)
    cursor = base.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    mine = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    assert mine == sorted(tuple(map(plain, r)) for r in cursor.fetchall())
