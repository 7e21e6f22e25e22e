"""The pipeline against its operators' brute-force counterparts, stage by stage."""

import corpus_pipeline
from cairn.llm import classifier
from cairn.llm.common import staged
from cairn.session import read_table
from tests.conftest import SF_SMALL
from tests.llm.test_dedup import expected_cuts, groups, shingles
from tests.llm.test_filters import rule_counts


def test_stages(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    verdict = {r.doc_id: r.kept for r in classifier.score(docs, read_table(spark, SF_SMALL, "labels")).collect()}
    inputs = [{r.doc_id: r for r in docs.collect()}]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF_SMALL))
        assert docs.columns == corpus_pipeline.COLUMNS
        inputs.append({r.doc_id: r for r in docs.collect()})
    start, judged, ruled, single, cut = inputs
    assert judged.keys() == {i for i in start if verdict[i]}
    assert ruled.keys() <= {i for i in judged if not rule_counts(judged[i].text)[-1]}
    sets = {i: shingles(r.text) for i, r in ruled.items()}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert single.keys() == {i for i, c in groups(ids, links).items() if i == c}
    rows = [(i, r.text) for i, r in single.items()]
    for (i, text), (n, gone, _) in zip(rows, expected_cuts(rows), strict=True):
        assert cut[i].text == text if not gone else len(cut[i].text.split(" ") if cut[i].text else []) == n - gone
        assert cut[i].n_chars == (len(cut[i].text) if gone else single[i].n_chars)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert {r.doc_id for r in packed} == cut.keys()
    assert sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}.values())
