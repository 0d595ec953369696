"""The pipeline's stages on the smallest tables, each against a plain version on its own input."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline as P
from panelwright.llm import toxicity
from panelwright.session import store
from test_text_operators import plain_groups, plain_lines

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = [docs]
    for name, stage in P.STAGES:
        made.append(store(stage(spark, made[-1], SF), name))
    return made


def by_id(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_are_named_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_all_but_the_last_return_documents(stages):
    for df in stages[1:-1]:
        assert df.columns == list(P.COLUMNS)


def test_rejected_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bad = {r.doc_id for r in toxicity.scores(stages[0], labels).where("predicted = 1").collect()}
    assert by_id(stages[1]) == {i: t for i, t in by_id(stages[0]).items() if i not in bad}


def test_later_lines_go(stages):
    before, gone = by_id(stages[1]), plain_lines([(r.doc_id, r.text) for r in stages[1].collect()])
    want = {}
    for i, text in before.items():
        kept = [x for n, x in enumerate(text.split("\n")) if (i, n) not in gone]
        if any(x.strip() for x in kept) or not any((i, n) in gone for n in range(text.count("\n") + 1)):
            want[i] = "\n".join(kept)
    assert by_id(stages[2]) == want
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_one_of_each_group_stays(stages):
    before = by_id(stages[2])
    groups = plain_groups(list(before.items()), 5, 80)
    assert by_id(stages[3]) == {i: t for i, t in before.items() if groups[i] == i}


def test_contaminated_documents_go(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    after = by_id(stages[4])
    for i, text in by_id(stages[3]).items():
        holds = any(x in text for x in items)
        assert not (holds and i in after)
        words = set(text.split())
        if not any(len(words & set(x.split())) > 0.5 * len(set(x.split())) for x in items):
            assert i in after


def test_every_token_is_packed(stages):
    pieces = stages[5].collect()
    sizes = {}
    for p in pieces:
        sizes.setdefault(p.doc_id, [p.doc_tokens, 0])[1] += p.length
    assert set(sizes) == set(by_id(stages[4])) and all(a == b for a, b in sizes.values())


def test_rows_with_nulls_pass_through(spark):
    rows = [(None, None, None, None, None), (None, "some text here", "en", "s", 14), (1, None, "en", "s", None), (2, "", None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in P.STAGES[1:-1]:
        assert sorted(map(repr, stage(spark, docs, SF).collect())) == sorted(map(repr, docs.collect())), name
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_the_rest_works_without_this_subpackage():
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('panelwright.llm'):\n"
            "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert e.queries() and 'pipeline' not in e.queries() and not any(q.startswith('op1_') for q in e.queries())\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
