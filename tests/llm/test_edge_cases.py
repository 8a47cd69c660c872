"""Every operator over odd rows and over none."""

import pytest

from annomerge.llm import decontam, langid, licenses, ngram_join, packing, pii, quality, suffix_dedup, toxicity, warc
from annomerge.llm.common import fresh_path
from annomerge.llm.queries import tokenizer_path


def own_columns_stay(got, docs, *results):
    """Columns of the input keep names and values, but for those that results take the place of."""
    assert [c for c in got.columns if c not in results] == [c for c in docs.columns if c not in results and c in got.columns]
    assert all(r[c] == "mine" for r in got.collect() for c in ("key", "row", "c0", "dropped", "lic_text") if c not in results)


@pytest.fixture(params=["odd", "empty"])
def docs(request, odd):
    return odd if request.param == "odd" else odd.limit(0)


def test_quality(docs, labels):
    got = quality.judge(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(r.q_base_failed and not r.q_kept for r in got if not (r.text or "").strip(" .!\n"))
    assert quality.keep_good(docs, labels).columns == docs.columns
    own_columns_stay(quality.keep_good(docs, labels), docs)
    own_columns_stay(quality.judge(docs, labels, keep_text=False), docs, *(f"q_{c}" for c in (*quality.COUNTS, "score", "base_failed", "kept")))
    assert quality.judge(docs, labels.limit(0)).count() == docs.count()


def test_language(docs):
    got = langid.predict(docs, langid.fit(docs)).collect()
    assert len(got) == docs.count()
    own_columns_stay(langid.predict(docs, langid.fit(docs), keep_text=True), docs, "l_pred", "l_score", "l_ambiguous")
    none = [r for r in got if r.doc_id in (3, 4, 6)]
    assert all(r.l_pred == "und" and r.l_score == 0 for r in none)


def test_toxicity(docs, labels):
    got = toxicity.predict(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == docs.count() and all(0 <= r.t_score <= 1 for r in got)
    own_columns_stay(toxicity.predict(docs, None), docs, "t_score")


def test_licenses(docs):
    own_columns_stay(licenses.detect(docs), docs, "lic_n_words", "lic_base", "lic_found", "lic_score")
    got = licenses.digest(licenses.detect(docs)).collect()
    assert len(got) == docs.count() and all(r.n_base == 0 and r.labels == "" and r.first_word is None for r in got)


def test_pii(docs):
    got = pii.pseudonymise(docs, "k")
    assert got.columns == [*(c for c in docs.columns if c != "pii_found"), "pii_found"]
    assert sorted(str(r.text) for r in got.collect()) == sorted(str(r.text) for r in docs.collect())


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (None, "kaba"), (3, "one two")], "item_id long, text string")
    got = decontam.mark_leaks(docs, items).collect()
    assert {r.doc_id for r in got if r.leaks} <= {7} and len(got) == docs.count()
    assert decontam.drop_leaks(docs, items).columns == docs.columns
    own_columns_stay(decontam.drop_leaks(docs, items), docs)
    own_columns_stay(decontam.mark_leaks(docs, items, block_bytes=5), docs, "leaks")
    assert {(r.doc_id, len(r.leaks)) for r in decontam.mark_leaks(docs, items, block_bytes=5).collect() if r.leaks} == {(r.doc_id, len(r.leaks)) for r in got if r.leaks}
    assert decontam.drop_leaks(docs, items.limit(0)).count() == docs.count()


def test_join(docs):
    got = ngram_join.similar(docs).collect()
    assert len(got) == docs.count()
    own_columns_stay(ngram_join.keep_first(docs), docs)
    own_columns_stay(ngram_join.keep_first(docs.dropDuplicates(["doc_id"])), docs)
    if got:
        known = {(r.doc_id, r.class_id, r.n_links) for r in got}
        assert {(1, 1, 3), (2, 1, 3), (8, 1, 3), (3, 3, 0), (4, 4, 0), (9, 9, 0), (None, None, 0)} <= known
        kept = [r.doc_id for r in ngram_join.keep_first(docs).collect()]
        assert sorted(x for x in kept if x is not None) == [1, 3, 4, 5, 6, 7, 9] and kept.count(None) == 2


def test_repeats(docs):
    got = {(r.doc_id, r.start_word, r.n_words, r.first_doc) for r in suffix_dedup.repeated_spans(docs).collect()}
    assert got == ({(1, 0, 300, 1), (2, 0, 300, 1), (8, 0, 300, 1)} if docs.count() else set())


def test_packing(docs):
    got = packing.pack_documents(docs, tokenizer_path(), with_ids=True).collect()
    assert sum(r.length for r in got if r.doc_id == 4) == (1 if got else 0)
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0) and len(r.ids) == r.length
        ends[r.sequence_id] = r.offset + r.length
    assert all(n <= 4096 for n in ends.values())
    assert len({r.sequence_id for r in got}) >= sum(ends.values()) / 4096


def test_warc(spark, docs):
    uri = fresh_path(spark, "warc")
    warc.write_warc(docs, uri, "doc_id", "source", "text").collect()
    if not docs.count():
        return
    got = warc.read_warc(spark, uri, split_bytes=1000).collect()
    assert len(got) == docs.count() and all(r.digest_ok for r in got)
    assert {r.page_id for r in got if r.record_type == "revisit"} <= {1, 2, None}
    assert next(r for r in got if r.page_id == 2).refers_to == 1
