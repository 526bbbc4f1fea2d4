"""The pipeline's stages against brute-force versions of each, on each stage's own input."""

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from test_neardup import brute as brute_components  # noqa: E402
from test_token_files import brute as brute_tokens  # noqa: E402

import corpus_pipeline as pipeline  # noqa: E402
from zonecast.llm import decontam, mixing, quality  # noqa: E402
from zonecast.llm.common import settled  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output, from one run."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in pipeline.STAGES:
        after = settled(stage(spark, docs, SF), "test-stage")
        out[name] = (docs, after)
        docs = after
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_and_order(stages):
    assert list(stages) == ["quality", "near_duplicates", "decontaminate", "mixing", "token_files"]
    first = stages["quality"][0]
    for name in list(stages)[:4]:
        assert stages[name][1].columns == first.columns
        assert 0 < stages[name][1].count() < stages[name][0].count()


def test_quality_stage(spark, stages):
    before, after = stages["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = quality.quality_report(before, labels).where("predicted = 1")
    assert ids(after) == ids(good)
    wrong = labels.where("quality = 0").join(after, "doc_id", "left_semi").count()
    assert wrong <= 0.1 * labels.where("quality = 0").count()


def test_near_duplicate_stage(stages):
    before, after = stages["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
    assert ids(after) == [d for d, _, _, kept in brute_components(rows, 5) if kept]


def brute_template(text):
    t = re.sub(r"([^\W_]|[,;:])( )([A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?: [A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)*)", r"\1 §name", text)
    t = re.sub(decontam.QUANTITY, " §num §unit ", t)
    t = re.sub(decontam.NUMBER, " §num ", t)
    return re.findall(r"(?:[^\W_]|§)+", t.lower())


def brute_windows(text):
    w = brute_template(text)
    return {i: tuple(w[i : i + 5]) for i in range(len(w) - 4) if sum(x[0] != "§" for x in w[i : i + 5]) >= 3}


def test_decontamination_stage(spark, stages):
    before, after = stages["decontaminate"]
    items = {r.item_id: brute_windows(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    gone = set()
    for r in before.collect():
        have = set(brute_windows(r.text).values())
        if any(w and sum(x in have for x in w.values()) >= 0.5 * len(w) for w in items.values()):
            gone.add(r.doc_id)
    assert gone and ids(after) == [d for d in ids(before) if d not in gone]


def test_mixing_stage(stages):
    before, after = stages["mixing"]
    rows = mixing.mix(before, fraction=0.5).collect()
    assert ids(after) == sorted(r.doc_id for r in rows if r.selected)


def test_token_stage(stages):
    before, after = stages["token_files"]
    rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in after.collect()), key=lambda r: r[1])
    assert got == brute_tokens(rows)


def test_run_equals_the_stages(spark, stages):
    assert sorted(map(tuple, pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages["token_files"][1].collect()))


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = settled(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0
