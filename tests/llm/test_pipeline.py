import corpus_pipeline
from posttrend.llm import lines, mixing, quality
from posttrend.llm.common import stored, table
from tests_llm_brute import components_of, hits_of


def test_stages_against_plain_python(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    rows = {r.doc_id: r.asDict() for r in docs.collect()}

    good = stored(corpus_pipeline.quality_rules(spark, docs, sf_small), "step")
    verdict = {r.doc_id: r.kept for r in quality.measure_quality(docs).collect()}
    assert {r.doc_id for r in good.collect()} == {d for d, k in verdict.items() if k}
    rows = {d: r for d, r in rows.items() if verdict[d]}

    clean = stored(corpus_pipeline.line_dedup(spark, good, sf_small), "step")
    seen, left = set(), {}
    for d in sorted(rows):
        body = rows[d]["text"].encode()
        parts, at = [], 0
        for a, b, chunk in lines.chunks(body):
            if chunk in seen:
                parts.append(body[at:a])
                at = b
            seen.add(chunk)
        text = b"".join([*parts, body[at:]]).decode()
        if text.strip(" ") or not at:
            left[d] = text
    assert {r.doc_id: r.text for r in clean.collect()} == left
    assert clean.columns == docs.columns

    single = stored(corpus_pipeline.near_dedup(spark, clean, sf_small), "step")
    found = components_of(left, 5, 80)
    left = {d: t for d, t in left.items() if found[d] == d}
    assert {r.doc_id for r in single.collect()} == set(left)

    fresh = stored(corpus_pipeline.benchmark_decontamination(spark, single, sf_small), "step")
    items = [r.text for r in table(spark, sf_small, "benchmark").collect()]
    want = {}
    for d, text in left.items():
        total, hit = hits_of(text, items, 10)
        if len(hit) <= 0.5 * total:
            want[d] = bool(hit)
    got = {r.doc_id: r.text for r in fresh.collect()}
    assert set(got) == set(want) and all((got[d] != left[d]) == want[d] for d in got)
    assert not any(hits_of(t, items, 10)[1] for d, t in got.items() if want[d] and t == left[d])

    taken = stored(corpus_pipeline.mix_sources(spark, fresh, sf_small), "step")
    copies = {r.doc_id: r.copies for r in mixing.mixture(fresh).collect() if r.copies}
    assert {r.doc_id: r.copies for r in taken.collect()} == copies
    whole = corpus_pipeline.run(spark, sf_small)
    assert {r.doc_id: r.copies for r in whole.collect()} == copies


def test_pipeline_on_no_rows(spark, sf_small, make):
    docs = make([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_small), "step")
        assert docs.count() == 0, name
