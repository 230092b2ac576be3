import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests_shared import components_of

from assay.functions import similarity, tiles
from assay.operators import blocking, matching
from assay.operators.matching import MEMBER, match_records
from assay.specs import MatchAttribute, MatchSpec, load_entity

SCHEMA = "record_key string, full_name string, tax_id string, country_code string, postal_code string"
SPEC = MatchSpec(
    (("country_code", "postal_code_prefix"),),
    (MatchAttribute("full_name", "jaro_winkler", 0.6), MatchAttribute("tax_id", "exact", 0.4)),
    0.7,
)


def sim(a, b):
    return float(similarity.jaro_winkler_batch([a], [b])[0])


def groups_of(spark, rows, spec=SPEC, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    got = match_records(df, spec, **options).groups().collect()
    return {r[MEMBER]: (r.golden_id, r.match_confidence) for r in got}


def brute_groups(rows, spec):
    """The definition, pair by pair."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    records = [dict(zip(names, r)) for r in rows]
    parent = {r["record_key"]: r["record_key"] for r in records}
    conf = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def block(r, columns):
        parts = [r["postal_code"][:3] if c == "postal_code_prefix" and r["postal_code"] else
                 None if c == "postal_code_prefix" else r[c] for c in columns]
        if spec.null_block == "exclude":
            return None if any(p is None for p in parts) else "|".join(parts)
        return "|".join(p for p in parts if p is not None)

    for a, b in combinations(sorted(records, key=lambda r: r["record_key"]), 2):
        if not any(block(a, p) is not None and block(a, p) == block(b, p) for p in spec.blocking):
            continue
        total, void = 0.0, False
        for attr in spec.attributes:
            x, y = a[attr.column], b[attr.column]
            if attr.method == "exact":
                if x is None or y is None:
                    void = void or spec.null_policy == "reject"
                    continue
                total += attr.weight * (x == y)
            else:
                total += attr.weight * sim(x or "", y or "")
        score = total / spec.total_weight
        if void or score < spec.threshold:
            continue
        for r in (a, b):
            conf.setdefault(r["record_key"], []).append(score)
        ra, rb = find(a["record_key"]), find(b["record_key"])
        parent[max(ra, rb)] = min(ra, rb)
    return {k: (find(k), float(np.mean(conf[k])) if k in conf else 1.0) for k in parent}


def same(got, want):
    assert {k: g for k, (g, _) in got.items()} == {k: g for k, (g, _) in want.items()}
    for k in want:
        assert got[k][1] == pytest.approx(want[k][1], abs=1e-9)


def random_rows(seed, n=220, blocks=3, junk=0.2):
    rng = random.Random(seed)
    first = ["jane", "john", "maria", "mario", "anna", "ana", "bob", "rob", None, ""]
    last = ["doe", "dole", "smith", "smyth", "brown", "braun"]
    rows = []
    for i in range(n):
        f = rng.choice(first)
        name = None if f is None else (f + " " + rng.choice(last)).strip() if f else ""
        tax = None if rng.random() < 0.15 else "???" if rng.random() < junk else f"T{rng.randrange(12)}"
        rows.append(
            (f"s:{i:04d}", name, tax, rng.choice(["US", "DE", None]), None if rng.random() < 0.1 else f"{rng.randrange(100, 100 + blocks)}99")
        )
    return rows


# ---- similarity


def test_known_values():
    assert sim("martha", "marhta") == pytest.approx(0.9611111, abs=1e-6)
    assert sim("dwayne", "duane") == pytest.approx(0.84, abs=1e-6)
    assert sim("dixon", "dicksonx") == pytest.approx(0.8133333, abs=1e-6)
    assert sim("", "") == 0.0 and sim("a", "") == 0.0 and sim("a", "a") == 1.0
    assert sim("abc", "xyz") == 0.0
    assert sim("é", "è") == 0.0


def test_batch_does_not_depend_on_neighbours():
    pairs = [("jane doe", "jane d."), ("x", "a much longer text than the others"), ("ab", "ba")]
    together = similarity.jaro_winkler_batch([a for a, _ in pairs], [b for _, b in pairs])
    assert list(together) == [sim(a, b) for a, b in pairs]


def test_bound_is_never_below_the_similarity(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("aabbcdeé1 Z😀") for _ in range(rng.randrange(12))) for _ in range(600)]
    df = spark.createDataFrame(list(zip(texts[:300], texts[300:])), "l string, r string")
    left = df.select(F.monotonically_increasing_id().alias("k"), F.col("l").alias("t")).withColumns(similarity.char_columns("t"))
    right = df.select(F.monotonically_increasing_id().alias("k"), F.col("r").alias("t")).withColumns(similarity.char_columns("t"))
    got = left.alias("a").join(right.alias("b"), on="k").select(
        F.expr(similarity.jaro_winkler_at_most("t")).alias("most"), similarity.jaro_winkler("a.t", "b.t").alias("s")
    )
    assert all(r.most >= r.s - 1e-12 for r in got.collect())


@pytest.mark.parametrize("kinds", ["ab", "abcdefgh", "abcé😀漢\0"])
@pytest.mark.parametrize("lengths", [(0, 4), (0, 12), (5, 40), (30, 70), (60, 150)])
@pytest.mark.parametrize("head", ["", "ab", "Customer#00"])
def test_grid_has_the_similarity_of_every_pair(monkeypatch, kinds, lengths, head):
    rng = random.Random(len(kinds) + lengths[1])
    left, right = ([head + "".join(rng.choice(kinds) for _ in range(rng.randrange(*lengths))) for _ in range(n)] for n in (40, 50))
    li, ri = (x.ravel() for x in np.indices((40, 50)))
    want = similarity.jaro_winkler_pairs(left, right, li, ri).reshape(40, 50)
    assert np.array_equal(similarity.similarity_grid(left, right), want)
    monkeypatch.setattr(similarity, "POSITION_WORDS", 64)  # columns in parts
    monkeypatch.setattr(similarity, "GRID_PAIRS", 100)
    assert np.array_equal(similarity.similarity_grid(left, right), want)


@pytest.mark.parametrize("left, right", [([], ["a"]), ([""], ["", "a"]), (["a", ""], [""]), (["\0"], ["\0", "\0a"]), (["ab"], ["ab"])])
def test_grid_of_few_and_empty_texts(left, right):
    want = np.array([[sim(a, b) for b in right] for a in left]).reshape(len(left), len(right))
    assert np.array_equal(similarity.similarity_grid(left, right), want)


def test_null_counts_as_empty(spark):
    df = spark.createDataFrame([(None, "a"), ("a", "a")], "l string, r string")
    assert [r[0] for r in df.select(similarity.jaro_winkler("l", "r")).collect()] == [0.0, 1.0]


# ---- candidate keys


def test_evidence_follows_from_the_weights():
    def plain(spec):
        return [(e.columns, e.signed) for e in blocking.evidence(spec)]

    assert plain(load_entity("customer").match) == [(("email",), None), (("tax_id",), None)]
    assert plain(load_entity("account").match) == [
        (("owner_customer_id",), None), (("account_name", "account_type"), None),
    ]
    assert plain(SPEC.with_options(threshold=0.5)) == [((), None)]
    assert plain(SPEC.with_options(threshold=0.57)) == [(("tax_id",), None), ((), "full_name")]


NEAR = SPEC.with_options(threshold=0.57)  # equal tax ids, or names at 0.95


def edited(rng, name):
    """A name with a character or two changed, dropped, doubled or moved."""
    for _ in range(rng.randrange(3)):
        i = rng.randrange(len(name)) if name else 0
        name = rng.choice([name[:i] + name[i + 1 :], name[:i] + rng.choice("abx é😀") + name[i:], name[: i - 1] + name[i : i + 1] + name[i - 1 : i] + name[i + 1 :]])
    return name


def names(rng, families, each):
    letters = "abcdefghijklmnopqrstuvwxyz #0123é😀"
    out = []
    for _ in range(families):
        base = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 30)))
        out += [edited(rng, base) for _ in range(each)]
    return out


@pytest.mark.parametrize("sign_above, tile_rows", [(0, 1024), (0, 3), (40, 1024), (10**6, 1024)])
def test_signed_routes_find_every_pair(spark, sign_above, tile_rows):
    rng = random.Random(sign_above + tile_rows)
    found = names(rng, 30, 7) + ["", None, "a", "a", "ab", "abcd", "abcde", "abcd" * 30, "abcd" * 29]
    rows = [
        (f"s:{i:04d}", n, rng.choice([None, "T1", f"T{i}"]), rng.choice(["US", "US", "DE"]), "10099") for i, n in enumerate(found)
    ]
    same(groups_of(spark, rows, NEAR, sign_above=sign_above, tile_rows=tile_rows), brute_groups(rows, NEAR))


def test_pairs_of_a_signed_route_grow_like_its_matches(spark):
    compared, matched = [], []
    for families in (100, 200, 400):
        rows = [(f"s:{i:05d}", n, None, "US", "10099") for i, n in enumerate(names(random.Random(5), families, 10))]
        held = match_records(spark.createDataFrame(rows, SCHEMA), NEAR)
        compared.append(int(blocking.key_pairs(held.profiles, NEAR).first().pairs))
        matched.append(held.edges.count())
        every = int(blocking.key_pairs(held.profiles, NEAR, 10**9).first().pairs)
    assert compared[2] < 0.1 * every
    assert compared[2] / compared[0] < 1.6 * matched[2] / matched[0]


def test_block_sizes_count_without_pairs(spark):
    df = spark.createDataFrame([("a", "x", "t", "US", "10001")] * 4 + [("b", "x", "t", None, "10001")], SCHEMA)
    (row,) = blocking.block_sizes(df, SPEC).collect()
    assert (row.block_key, row.records, int(row.pairs)) == ("US|100", 4, 6)


# ---- groups


def test_records_of_one_name_and_number_meet_only_inside_a_block(spark):
    rows = [(f"{source}:{n}", "Ines Okafor", "NL-20-774", "NL", code) for n, (source, code) in enumerate(
        [("shop", "3011AB"), ("ledger", "3012ZZ"), ("forms", "3019QQ"), ("shop", "9711XY")]
    )]
    got = groups_of(spark, [*rows, ("shop:9", "Tomas Varga", "HU-1", "NL", "3011AB")])
    assert {got[r[0]] for r in rows[:3]} == {("forms:2", 1.0)}
    assert got["shop:3"] == ("shop:3", 1.0) and got["shop:9"] == ("shop:9", 1.0)


def test_records_without_a_block_are_counted(spark):
    rows = [("a", "x", "t", "NL", "3011AB"), ("b", "x", "t", None, "3011AB"), ("c", "x", None, None, "3011AB")]
    df = spark.createDataFrame(rows, SCHEMA)
    spec = SPEC.with_options(blocking=(("country_code", "postal_code_prefix"), ("tax_id",)))
    got = {r.blocking_pass: (r.blocked, r.unblocked) for r in blocking.unblocked_records(df, spec).collect()}
    assert got == {0: (1, 2), 1: (2, 1), None: (2, 1)}


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"threshold": 0.55},
        {"null_policy": "reject", "threshold": 0.6},
        {"null_block": "skip_null"},
        {"blocking": (("country_code", "postal_code_prefix"), ("tax_id",)), "threshold": 0.62},
    ],
)
def test_same_as_comparing_every_pair(spark, options):
    spec = SPEC.with_options(**options)
    rows = random_rows(len(str(options)))
    same(groups_of(spark, rows, spec), brute_groups(rows, spec))


@pytest.mark.parametrize("tile_rows", [2, 7, 1000])
def test_hot_key_split_into_tiles_changes_nothing(spark, tile_rows):
    rows = [(k, f, "???", "US", "10001") for k, f, *_ in random_rows(9, n=150)]
    same(groups_of(spark, rows, tile_rows=tile_rows), brute_groups(rows, SPEC))


def test_many_copies_of_one_record(spark):
    rows = [(f"s:{i:04d}", "Jane Doe", "T1", "US", "10001") for i in range(400)]
    rows += [("s:9000", "Jane Dole", "T1", "US", "10001"), ("s:9001", "Zed", "T9", "US", "10001")]
    df = spark.createDataFrame(rows, SCHEMA)
    matched = match_records(df, SPEC)
    assert matched.edges.count() == 1
    assert {(r.id_a, r.id_b): r.record_pairs for r in matched.pairs().collect()} == {
        ("s:0000", "s:9000"): 400,
        ("s:0000", "s:0000"): 400 * 399 // 2,
    }
    got = {r[MEMBER]: (r.golden_id, r.match_confidence) for r in matched.groups().collect()}
    c = 0.6 * sim("Jane Doe", "Jane Dole") + 0.4
    assert got["s:0123"][0] == "s:0000" and got["s:0123"][1] == pytest.approx((399 + c) / 400)
    assert got["s:9000"] == ("s:0000", pytest.approx(c))
    assert got["s:9001"] == ("s:9001", 1.0)


def test_copies_too_empty_to_match_stay_apart(spark):
    got = groups_of(spark, [(f"s:{i}", "Jane", None, "US", "10001") for i in range(3)])
    assert {g for g, _ in got.values()} == {"s:0", "s:1", "s:2"}


def test_hot_profile_takes_the_broadcast_branch(spark, monkeypatch):
    monkeypatch.setattr(matching, "hot_limit", lambda total: 5)
    rows = [(f"s:{i:04d}", "Jane Doe", "T1", "US", "10001") for i in range(40)] + random_rows(4, n=60)[40:]
    same(groups_of(spark, rows), brute_groups(rows, SPEC))


def test_colliding_raw_ids_are_different_records(spark):
    got = groups_of(spark, [("erp:1", "Jane", "T1", "US", "10001"), ("crm:1", "Bob", "T2", "US", "10001")])
    assert {g for g, _ in got.values()} == {"erp:1", "crm:1"}


def test_second_pass_with_email_domain_and_soundex(spark):
    entity = load_entity("customer")
    spec = entity.match.with_options(blocking=entity.match.blocking + entity.extra_blocking)
    columns = "record_key string, full_name string, email string, tax_id string, address_line1 string, country_code string, postal_code string"
    df = spark.createDataFrame(
        [
            ("erp:1", "Jane Smith", "j@a.com", "TAX-1", "1 Main St", "US", "10001"),
            ("crm:1", "Jane Smyth", "j@a.com", "TAX-1", "1 Main St", "DE", "99999"),
            ("crm:2", "Jane Smyth", "not-an-email", "TAX-1", "1 Main St", "DE", "88888"),
        ],
        columns,
    )
    golden = {r[MEMBER]: r.golden_id for r in match_records(df, spec).groups().collect()}
    assert golden == {"erp:1": "crm:1", "crm:1": "crm:1", "crm:2": "crm:2"}


def test_raising_the_threshold_reuses_scores(spark):
    rows = random_rows(21)
    matched = match_records(spark.createDataFrame(rows, SCHEMA), SPEC.with_options(threshold=0.6))
    for t in (0.6, 0.75, 0.9):
        got = {r[MEMBER]: (r.golden_id, r.match_confidence) for r in matched.at(t).groups().collect()}
        same(got, brute_groups(rows, SPEC.with_options(threshold=t)))
    with pytest.raises(ValueError):
        matched.at(0.5)


def test_contract(spark):
    df = spark.createDataFrame(random_rows(1, n=5), SCHEMA)
    assert matching.WeightedMatcher(SPEC).match(df).columns == ["golden_id", MEMBER, "match_confidence"]
    with pytest.raises(ValueError):
        matching.check_contract(df)


def test_no_records(spark):
    assert groups_of(spark, []) == {}


def test_crowded_keys_list_no_pairs(spark):
    """All 4,950 pairs of one key match; groups sum them in their tiles and never list them."""
    rows = [(f"s:{i:03d}", f"Customer {i:03d}", "???", "US", "10099") for i in range(100)]
    held = match_records(spark.createDataFrame(rows, SCHEMA), SPEC, tile_rows=8)
    got = {r[MEMBER]: (r.golden_id, r.match_confidence) for r in held.groups().collect()}
    same(got, brute_groups(rows, SPEC))
    assert "edges" not in vars(held) and held._summed[0].count() == 0
    assert held.edges.count() == 4950


def test_keys_of_a_few_hundred_profiles_list_no_pairs(spark):
    """Default tiles: 17,955 pairs of one key are summed in place; a key of 20 is still listed."""
    rows = [(f"s:{i:03d}", f"Customer {i:03d}", "???", "US", "10099") for i in range(190)]
    rows += [(f"t:{i:03d}", f"Customer {i:03d}", "???", "US", "20099") for i in range(20)]
    held = match_records(spark.createDataFrame(rows, SCHEMA), SPEC)
    got = {r[MEMBER]: (r.golden_id, r.match_confidence) for r in held.groups().collect()}
    same(got, brute_groups(rows, SPEC))
    assert held._summed[0].count() == 190 and held._summed[1].count() == 190


@pytest.mark.parametrize("panel, stripe, held", [(3, 2, 0), (5, 64, 0), (7, 3, 1 << 22), (1024, 64, 1 << 22)])
@pytest.mark.parametrize("i, j", [(0, 0), (0, 1)])
def test_tile_against_its_pairs(monkeypatch, panel, stripe, held, i, j):
    for name, value in (("PANEL", panel), ("STRIPE", stripe), ("HELD", held)):
        monkeypatch.setattr(tiles, name, value)
    rng = random.Random(panel + i + j)
    rows = [
        {
            "id": f"r{k:02d}", "n": rng.randrange(1, 4), "side": rng.randrange(2) if i < j else 0, "tax": "t", "block": "b",
            "other": rng.choice(["x", "y", None]), "name": rng.choice(["", None, "Jane Doe", "Jane Do", "Jon Doe", "Mary", "Marry"]),
        }
        for k in rng.sample(range(40), 40)
    ]
    run = tiles.tile_sums([("name", False, 0.6), ("tax", True, 0.3), ("other", True, 0.1)], [("block", "other"), ("block", "tax")], 0.75, 1.0)
    got = run(tuple(map(pa.scalar, (9, 1, i, j))), pa.Table.from_pylist(rows)).to_pylist()
    others, mass, links = dict.fromkeys([r["id"] for r in rows], 0), dict.fromkeys([r["id"] for r in rows], 0.0), []
    for x, y in combinations(rows, 2):
        if (i < j and x["side"] == y["side"]) or (x["other"] and x["other"] == y["other"]):
            continue
        sure = 0.6 * sim(x["name"] or "", y["name"] or "") + 0.3
        if sure >= 0.75:
            links.append((x["id"], y["id"]))
            for one, other in ((x, y), (y, x)):
                others[one["id"]] += other["n"]
                mass[one["id"]] += other["n"] * sure
    lowest = components_of(links)
    assert links and {r["id"]: (r["others"], r["lo"]) for r in got} == {k: (others[k], lowest[k]) for k in lowest}
    assert all(r["mass"] == pytest.approx(mass[r["id"]]) for r in got)
