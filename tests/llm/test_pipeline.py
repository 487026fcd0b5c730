"""The corpus pipeline: each stage's decision on its input, against plain statements of it."""

import zlib

import numpy as np
import pytest

import corpus_pipeline
from tests.conftest import SF001
from tests.llm.test_jaccard import plain as plain_components
from tests.llm.test_mixing import WORD, plain_targets
from tests.llm.test_packing import check_pieces
from tidemark.llm import pseudonyms, quality
from tidemark.llm.common import Stages
from tidemark.llm.queries import PSEUDONYM_KEY


@pytest.fixture(scope="module")
def steps(workers):
    """The documents before each stage, and the result."""
    stages, docs = Stages(workers, "t"), workers.read.parquet(f"{SF001}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(stages.put(stage(workers, out[-1], SF001), f"s{k}"))
    return out


def test_names_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "PII", "mixing", "packing"]
    assert all(df.columns == steps[0].columns for df in steps[:-1])


def test_quality(steps, workers):
    labels = workers.read.parquet(f"{SF001}/labels.parquet")
    predicted = {r.doc_id: r.predicted for r in quality.classify(steps[0], labels).collect()}
    assert {r.doc_id for r in steps[1].collect()} == {i for i, p in predicted.items() if p}
    known = {r.doc_id: r.quality for r in labels.collect()}
    good = [i for i, q in known.items() if q == 1]
    assert np.mean([predicted[i] for i in good]) > 0.97


def test_near_copies(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    assert {r.doc_id for r in steps[2].collect()} == {i for i, _, component in plain_components(rows) if i == component}


def test_near_copies_by_five_words_and_four_fifths(workers):
    """Links between 0.80 and 0.85 of five-word shingles: 20% of text appended, and scattered edits."""
    base = [[f"w{g}x{k}" for k in range(200)] for g in range(5)]
    edited = list(base[1])
    for k in (30, 80, 130, 180):
        edited[k] = "other"
    less = list(base[2])
    for k in range(10, 200, 30):
        less[k] = "other"
    texts = {1: base[0], 2: base[0] + [f"more{k}" for k in range(40)], 3: base[1], 4: edited, 5: base[2], 6: less, 7: base[3]}
    sets = {i: {tuple(t[k:k + 5]) for k in range(len(t) - 4)} for i, t in texts.items()}
    near = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert 0.8 <= near(1, 2) < 0.85 and 0.8 <= near(3, 4) < 0.85 and near(5, 6) < 0.8
    df = workers.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.jaccard_join(workers, df, SF001).collect()}
    assert kept == {b for b in texts if not any(near(a, b) >= 0.8 for a in texts if a < b)}


def test_pii(steps):
    f = pseudonyms.Feistel(PSEUDONYM_KEY)
    before = {r.doc_id: r.text for r in steps[2].collect()}
    for r in steps[3].collect():
        assert r.text == pseudonyms.pseudonymise(before[r.doc_id], f)[0] and r.n_chars == len(r.text)


def test_mix(steps):
    count = lambda rows: {s: sum(len(WORD.findall(r.text)) for r in rows if r.source == s) for s in {r.source for r in rows}}
    sizes, taken = count(steps[3].collect()), count(steps[4].collect())
    target = plain_targets(sizes)
    assert all(abs(taken.get(s, 0) - target[s]) <= 1 for s in sizes)
    texts = {r.doc_id: r.text for r in steps[3].collect()}
    assert all(texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text) for r in steps[4].collect())


def test_packed(steps):
    texts = [(r.doc_id, r.text) for r in steps[4].collect()]
    check_pieces(steps[5].collect(), texts, 4096)


def test_run_and_entry(workers):
    import __spark_entry__ as entry
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    out = corpus_pipeline.run(workers, SF001)
    assert out.count() > 0 and zlib.crc32(bytes(out.first().ids)) >= 0


@pytest.mark.parametrize("k", range(5))
def test_stages_take_awkward_rows(workers, messy, no_rows, k):
    _, stage = corpus_pipeline.STAGES[k]
    out = stage(workers, messy.drop("private", "component_id"), SF001)
    assert out.count() > 0 and (k == 4 or out.columns == messy.drop("private", "component_id").columns)
    assert stage(workers, no_rows.drop("private", "component_id"), SF001).count() == 0
