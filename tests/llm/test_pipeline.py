import os
import subprocess
import sys

import corpus_pipeline

from packetflow.llm import jaccard_join, queries
from packetflow.llm.common import table

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_every_operator_has_a_query():
    assert [int(name[2:].split("_")[0]) for name in queries.QUERIES] == list(range(1, 14))


def test_stages_do_what_their_operators_say(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").cache()
    left = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, sf_dir).cache()
        if number < len(corpus_pipeline.STAGES) - 1:
            assert result.schema.names == docs.schema.names
            before = {r.doc_id for r in docs.select("doc_id").collect()}
            left[name] = before, {r.doc_id for r in result.select("doc_id").collect()}
            assert left[name][1] <= before
            docs = result
        else:
            pieces = result.collect()
    rules = queries.op6_quality_rules(spark, sf_dir).collect()
    assert left["quality_rules"][1] == {r.doc_id for r in rules if r.kept}
    before, after = left["ngram_jaccard_join"]
    rows = table(spark, sf_dir, "documents")
    rows = rows.filter(rows.doc_id.isin(sorted(before)))
    assert after == {r.component_id for r in jaccard_join.linked_documents(rows).collect()}
    held = {r.doc_id for r in queries.op1_decontamination(spark, sf_dir).collect()}
    before, after = left["benchmark_decontamination"]
    assert after == before - held and before & held
    assert {p.doc_id for p in pieces} == after
    run = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, pieces))


def test_entry_without_the_subpackage(tmp_path):
    """The other queries can be imported where this package and the pipeline are missing."""
    os.symlink(f"{ROOT}/__spark_entry__.py", tmp_path / "__spark_entry__.py")
    (tmp_path / "packetflow").mkdir()
    for name in os.listdir(f"{ROOT}/packetflow"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/packetflow/{name}", tmp_path / "packetflow" / name)
    code = (
        "import importlib.util, os, sys; sys.path.insert(0, os.getcwd());"
        "p = importlib.util.spec_from_file_location('e', '__spark_entry__.py').loader;"
        "import __spark_entry__ as e; print(sum(n.startswith('op') for n in e.queries()), len(e.queries()))"
    )
    entry = (tmp_path / "__spark_entry__.py")
    text = entry.read_text()
    entry.unlink()
    entry.write_text(text)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert done.stdout.split()[0] == "0" and int(done.stdout.split()[1]) > 50, done.stderr
