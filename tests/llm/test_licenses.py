import random

import pytest

from assay.llm import licenses


def test_bands_find_what_they_promise():
    for shingles in range(1, 400):
        assert licenses.miss_probability(shingles, 1.0) < 1e-4
        assert licenses.miss_probability(shingles) < 1e-2


@pytest.mark.parametrize("shingles", range(1, 40))
def test_an_occurrence_lies_inside_a_window(shingles):
    w = licenses.windows_for(shingles)
    for at in range(200):
        start = at // w.stride * w.stride
        assert start <= at and at + shingles <= start + w.span


def test_notices_anywhere_in_a_text(docs_of):
    source = random.Random(2)
    rows, want = [], set()
    for i in range(120):
        words = [f"w{source.randrange(10**6)}" for _ in range(source.randrange(0, 300))]
        if i % 3:
            name = source.choice(list(licenses.NOTICES))
            at = source.randrange(0, len(words) + 1)
            words[at:at] = [licenses.NOTICES[name].upper() if i % 2 else licenses.NOTICES[name]]
            want.add((i, name))
        rows.append((i, " ".join(words)))
    got = {(r.doc_id, r.license_id) for r in licenses.scan(docs_of(rows)).collect() if r.containment == 1.0}
    assert want <= got
    assert {i for i, _ in got} == {i for i, _ in want}


def test_a_template_with_words_changed_still_matches(docs_of):
    words = licenses.NOTICES["MIT-text"].split()
    words[10] = "changed"
    rows = licenses.scan(docs_of([(1, "intro " * 40 + " ".join(words)), (2, " ".join(words[:20]))])).collect()
    assert [(r.doc_id, r.license_id) for r in rows] == [(1, "MIT-text")]
    assert 0.8 <= rows[0].containment < 1


def test_odd_and_empty_input(odd_docs, no_docs):
    assert licenses.scan(odd_docs).collect() == []
    assert licenses.scan(no_docs).collect() == []
    with pytest.raises(ValueError, match="shorter"):
        licenses.scan(odd_docs, {"tiny": "too short"})
