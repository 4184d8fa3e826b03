import ast
import os
import subprocess
import sys

import pytest

import corpus_pipeline
from barlens.llm import language_id
from barlens.llm.common import table
from barlens.llm.queries import oracle_sql, queries
from barlens.sinks import materialize
from tests.llm.conftest import SF
from tests.llm.test_near_dup import brute
from tests.llm.test_sharding import jump

REPO = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


def test_run_against_brute_force(spark, documents, texts):
    """Every stage restated by definition, on what its predecessor kept."""
    rows = {r["doc_id"]: r for r in documents.collect()}
    model = language_id.train(documents, language_id.F.lit(True))
    scores = {r["doc_id"]: r for r in language_id.predict(documents.select("doc_id", "text"), model).collect()}
    kept = {i: t for i, t in texts.items()
            if scores[i]["lang_pred"] != "und" and scores[i]["score"] >= corpus_pipeline.MIN_LANGUAGE_SCORE}
    kept = {i: kept[i] for i, (_, head) in brute(kept).items() if i == head}
    import re
    plain = lambda t: " ".join(re.findall(r"[^\W\d_]+|[0-9]+", t.lower()))
    items = [plain(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    kept = {i: t for i, t in kept.items() if not any(x in plain(t) for x in items)}
    clean = documents.filter(documents["doc_id"].isin(*kept))
    copies = {r["doc_id"]: r["taken"] // r["size"] for r in corpus_pipeline.mixing.digest(clean).collect() if r["size"]}
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, n in copies.items() for _ in range(n))
    assert all(tuple(r)[:5] == tuple(rows[r["doc_id"]]) and r["shard"] == jump(r["doc_id"], 8) for r in got)


def test_stages_keep_odd_rows_and_empty_tables(spark, odd, empty):
    for start in (odd, empty):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialize(stage(spark, docs, SF), "test-stage")
            assert docs.columns == start.columns
        out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert sorted(out.columns) == sorted(start.columns)  # the extra column ``shard`` gives way
        assert (out.count() == 0) == (start is empty)


def test_every_operator_is_registered():
    names = set(queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(oracle_sql()) <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mix", "shard"]


@pytest.mark.parametrize("name", ["op2_mixing", "op4_license_scan", "op5_decontamination", "op7_near_dup", "op9_topk", "op10_chat",
                                  "op12_line_dedup", "op13_spelling"])
def test_oracles(spark, name):
    import duckdb
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries()[name](spark, SF)
    columns = sorted(df.columns)
    own = sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))
    other = c.execute(f"SELECT {', '.join(columns)} FROM ({oracle_sql()[name]})").fetchall()
    assert own == sorted(map(repr, other))


def test_library_does_without(tmp_path):
    """Without the subpackage and the pipeline, the entry point imports and registers the rest."""
    for folder, _, files in os.walk(os.path.join(REPO, "barlens")):
        if os.sep + "llm" in folder or "__pycache__" in folder:
            continue
        to = tmp_path / os.path.relpath(folder, REPO)
        to.mkdir(parents=True)
        for f in files:
            if f.endswith(".py"):
                (to / f).write_bytes(open(os.path.join(folder, f), "rb").read())
    (tmp_path / "__spark_entry__.py").write_bytes(open(os.path.join(REPO, "__spark_entry__.py"), "rb").read())
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries()), len(e.oracle_sql()))"],
                          cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    assert "sma_backtest" in said.stdout and "op1_" not in said.stdout and "pipeline" not in said.stdout


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(os.path.join(REPO, "barlens")):
        for f in files:
            if f.endswith(".py") and os.sep + "llm" not in folder:
                tree = ast.parse(open(os.path.join(folder, f)).read())
                names = [a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names]
                names += [n.module or "" for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)]
                assert not any(n.startswith(("barlens.llm", "corpus_pipeline")) for n in names), (folder, f)
