import hashlib

import pytest

from assay.llm import fixity


def records(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, status string, offset long")


def rows_of(n):
    return [(i * 3, f"u{i}", "h" * (i % 50), "clash", 1) for i in range(n)]


def found(spark, ours, theirs):
    held = fixity.audit(records(spark, ours), records(spark, theirs), "page_id", ["url", "html"]).collect()
    return {r.page_id: r for r in held}


def test_damage_is_located_and_offsets_add_up(spark):
    ours = rows_of(2_000)
    theirs = [r if r[0] != 300 else (300, "u100", "x", None, 0) for r in ours if r[0] != 4_500] + [(10, "new", "", None, 0)]
    got = found(spark, ours, theirs)
    assert {k: r.status for k, r in got.items() if r.status != "ok"} == {300: "corrupt", 4_500: "missing", 10: "extra"}
    assert len(got) == 2_001 and got[10].offset is None
    at = 0
    for i, url, html, _, _ in ours:
        body = f"{url}\n{html}".encode()
        assert (got[i].offset, got[i].n_bytes, got[i].digest) == (at, len(body), hashlib.sha256(body).hexdigest())
        at += len(body)


def test_only_differing_branches_are_descended(spark):
    ours, theirs = rows_of(3_000), rows_of(3_000)
    theirs[7] = (21, "u7", "bad", None, 0)
    a, b = (fixity.leaves(records(spark, r), "page_id", ["url", "html"]) for r in (ours, theirs))
    levels = fixity.depth(a, b)
    steps = fixity.differing(fixity.tree(a, levels), fixity.tree(b, levels))
    assert [s.count() for s in steps] == [1] * (levels + 1)
    same = fixity.differing(fixity.tree(a, levels), fixity.tree(a, levels))
    assert [s.count() for s in same] == [0] * (levels + 1)


@pytest.mark.parametrize("swap", [False, True])
def test_repeats_nulls_negative_ids_and_empty_tables(spark, swap):
    ours = [(5, "a", "x", None, 0), (5, "a", "x", None, 0), (None, None, None, None, 0), (-9, "n", "é", None, 0), (1 << 40, "far", "", None, 0)]
    if swap:
        got = found(spark, [], ours)
        assert {r.status for r in got.values()} == {"extra"}
        return
    assert {r.status for r in found(spark, ours, list(reversed(ours))).values()} == {"ok"}
    assert found(spark, ours, ours[1:])[5].status == "corrupt"
    got = found(spark, ours, [])
    assert {r.status for r in got.values()} == {"missing"} and set(got) == {5, None, -9, 1 << 40}
    assert got[5].n_records == 2
    assert found(spark, [], []) == {}


def test_records_without_an_id_are_a_leaf_of_their_own(spark):
    ours = [(None, "a", "x", None, 0), (None, "b", None, None, 0), (-1, "c", "yy", None, 0), (4, "d", "", None, 0)]
    for theirs, want in (
        (ours, {None: "ok", -1: "ok", 4: "ok"}),
        (ours[1:], {None: "corrupt", -1: "ok", 4: "ok"}),
        (ours[2:], {None: "missing", -1: "ok", 4: "ok"}),
        ([ours[0], ours[1], (-1, "c", "zz", None, 0), ours[3]], {None: "ok", -1: "corrupt", 4: "ok"}),
    ):
        got = found(spark, ours, theirs)
        assert {k: r.status for k, r in got.items()} == want
        assert {k: r.offset for k, r in got.items()} == {None: 0, -1: 5, 4: 9}
    got = found(spark, ours[2:], ours)
    assert got[None].status == "extra" and got[None].offset is None and got[-1].offset == 0
