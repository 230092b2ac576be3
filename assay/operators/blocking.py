"""Which record pairs can possibly match, without listing every pair of a block.

Three exact reductions come before any pair exists:

* records equal in everything that matching looks at become one *profile* with a count;
* a pair can only reach the threshold if it agrees on one of a few column sets that follow
  from the weights, so the join key is block + such a set, not the block alone;
* where a pair must then be nearly equal in a text, and very many profiles share a key, groups of
  characters that cannot all differ join the key;
* a key shared by very many profiles is cut into tiles, so no task holds a whole hot key.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions import similarity, text, tiles
from assay.session import cut
from assay.specs import MatchSpec

# Slack that keeps rounding from ever dropping a pair that sits on the threshold.
SLACK = 1e-9
# Profiles of one join key that a single task compares with each other: at least TILE_ROWS, more
# for a key so hot that it would be cut into over TILE_CHUNKS chunks, never over TILE_ROWS_MAX.
TILE_ROWS = 1024
TILE_CHUNKS = 256
TILE_ROWS_MAX = 65536
# Profiles of a key without a signature from which its pairs are summed in place, and how many times TILE_ROWS a
# tile of them has: comparing costs little there, and every row is copied once per chunk of its key.
SUM_ABOVE = 128
SUM_TIMES = 8
# Pairs one task should compare. Comparing costs far more than the bytes suggest, so the number of
# tasks follows the pairs to compare and not the size of the data.
PAIRS_PER_TASK = 20_000_000
# Hot keys up to this many are broadcast (a 64-bit key and a small count each); more are joined.
BROADCAST_KEYS = 200_000
# Lowest similarity from which characters are worth a key, and profiles of a key from which they are used:
# each then has some hundred keys, and fewer others to be compared with.
SIGNED_FROM = 0.9
SIGN_ABOVE = 256
# Characters whose frequency is looked up, the most frequent ones; others are spread by a hash.
RANKED = 1_000


@dataclass(frozen=True)
class Route:
    """One way for a pair to qualify: equal on ``columns``, and similar on ``signed`` at ``least`` or more if given."""

    columns: tuple[str, ...]
    signed: str | None = None
    least: float = 0.0


def block_keys(spec: MatchSpec, existing: list[str]) -> list[Column]:
    """One key column per blocking pass; null means the row takes no part in that pass."""
    out = []
    for columns in spec.blocking:
        parts = [text.block_column(c, existing) for c in columns]
        joined = F.concat_ws("|", *parts)
        if spec.null_block == "exclude":
            joined = F.when(reduce(lambda x, y: x & y, [p.isNotNull() for p in parts]), joined)
        out.append(joined)
    return out


def evidence(spec: MatchSpec) -> list[Route]:
    """Routes of which every qualifying pair takes at least one; the first one it agrees on finds it.

    For each set of agreeing exact attributes, similarity must supply the rest of the threshold. Where
    that leaves an attribute no room below 1.0 it has to be equal too; where it leaves little, the route is
    signed. A route without a signature finds all pairs that agree on more columns as well; signed
    ones come last, those with more columns first, so the exact agreement of a pair names its route.
    """
    exact = [a for a in spec.attributes if a.method == "exact"]
    fuzzy = [a for a in spec.attributes if a.method != "exact"]
    fuzzy_weight = sum(a.weight for a in fuzzy)
    needed = spec.threshold * spec.total_weight - SLACK
    plain: list[frozenset] = []
    signed: list[tuple[frozenset, str, float]] = []
    for size in range(len(exact) + 1):
        for agreeing in combinations(exact, size):
            missing = needed - sum(a.weight for a in agreeing)
            if missing > fuzzy_weight:
                continue
            least = {a.column: (missing - (fuzzy_weight - a.weight)) / a.weight for a in fuzzy if a.weight > 0}
            forced = [c for c, t in least.items() if t >= 1 - 1e-8]
            columns = frozenset([a.column for a in agreeing] + forced)
            best = max(least, key=least.get, default=None)
            if best is not None and not forced and least[best] >= SIGNED_FROM:
                signed.append((columns, best, least[best] - SLACK))
            else:
                plain.append(columns)
    names = [a.column for a in spec.attributes]

    def ordered(columns: frozenset) -> tuple[str, ...]:
        return tuple(n for n in names if n in columns)

    minimal = {s for s in plain if not any(other < s for other in plain)}
    routes = [Route(c) for c in sorted(map(ordered, minimal), key=lambda c: (len(c), c))]
    held = [(ordered(c), f, t) for c, f, t in signed if not any(other <= c for other in minimal)]
    return routes + [Route(*x) for x in sorted(held, key=lambda x: (-len(x[0]), x[0]))]


def with_profile_key(df: DataFrame, spec: MatchSpec) -> DataFrame:
    """Add block keys and ``profile``, a digest of everything matching looks at."""
    blocks = {f"_block{i}": k for i, k in enumerate(block_keys(spec, df.columns))}
    columns = [a.column for a in spec.attributes]
    # absent fields stay absent in the JSON text, so null and '' differ
    digest = F.substring(F.sha2(F.to_json(F.struct(*columns, *blocks)), 256), 1, 32)
    return df.withColumns(blocks).withColumn("profile", digest)


def profiles(keyed: DataFrame, spec: MatchSpec) -> DataFrame:
    """One row per distinct profile: ``id`` (smallest record key), ``n`` records, self score."""
    columns = [a.column for a in spec.attributes]
    blocks = [f"_block{i}" for i in range(len(spec.blocking))]
    grouped = keyed.groupBy("profile", *columns, *blocks).agg(F.min("record_key").alias("id"), F.count("*").alias("n"))
    signed = [(n, e) for n, e in enumerate(evidence(spec)) if e.signed]
    ranks = {c: similarity.character_ranks(grouped, c, RANKED) for c in {e.signed for _, e in signed}}
    in_block = reduce(lambda x, y: x | y, [F.col(b).isNotNull() for b in blocks])
    extra: dict[str, Column] = {}
    for a in spec.attributes:
        if a.method == "exact":
            extra[f"_hash_{a.column}"] = F.when(F.col(a.column).isNotNull(), F.xxhash64(a.column))
        else:
            extra.update(similarity.char_columns(a.column))
    for n, e in signed:
        for near, least in enumerate(similarity.least_jaro(e.least)):
            extra[f"_sig{n}_{near}"] = similarity.signatures(e.signed, least, ranks[e.signed])
    return grouped.select(
        "*",
        F.when(in_block, confidence(spec, _self_terms(spec))).alias("self_confidence"),
        *[c.alias(name) for name, c in extra.items()],
    )


def _self_terms(spec: MatchSpec) -> list[Column]:
    terms = []
    for a in spec.attributes:
        value = F.col(a.column)
        if a.method == "exact":
            miss = F.lit(0.0) if spec.null_policy == "zero" else F.lit(None).cast("double")
            terms.append(F.when(value.isNotNull(), F.lit(1.0)).otherwise(miss))
        else:
            terms.append(F.when(F.coalesce(value, F.lit("")) != "", F.lit(1.0)).otherwise(F.lit(0.0)))
    return terms


def confidence(spec: MatchSpec, terms: list[Column]) -> Column:
    weighted = [t * F.lit(a.weight) for t, a in zip(terms, spec.attributes)]
    return reduce(lambda x, y: x + y, weighted) / F.lit(spec.total_weight)


def block_sizes(df: DataFrame, spec: MatchSpec, block: int = 0) -> DataFrame:
    """Records and record pairs per block of one pass, from counts alone."""
    key = block_keys(spec, df.columns)[block].alias("block_key")
    n = F.col("records")
    return (
        df.select(key)
        .filter(F.col("block_key").isNotNull())
        .groupBy("block_key")
        .agg(F.count("*").alias("records"))
        .withColumn("pairs", (n.cast("decimal(38,0)") * (n - 1) / 2).cast("decimal(38,0)"))
    )


def unblocked_records(df: DataFrame, spec: MatchSpec) -> DataFrame:
    """Per blocking pass how many records have a key and how many take no part, and the same for all passes.

    ``blocking_pass`` counts from 0; the row with a null pass counts records that are in no pass at all.
    """
    keys = block_keys(spec, df.columns)
    held = df.select(*[k.isNotNull().alias(f"_k{i}") for i, k in enumerate(keys)])
    anywhere = reduce(lambda x, y: x | y, [F.col(f"_k{i}") for i in range(len(keys))])
    sides = [(F.lit(i), F.col(f"_k{i}")) for i in range(len(keys))] + [(F.lit(None).cast("int"), anywhere)]
    counts = held.agg(
        *[F.count(F.when(k, 1)).alias(f"_in{n}") for n, (_, k) in enumerate(sides)],
        *[F.count(F.when(~k, 1)).alias(f"_out{n}") for n, (_, k) in enumerate(sides)],
    )
    rows = [
        F.struct(p.alias("blocking_pass"), F.col(f"_in{n}").alias("blocked"), F.col(f"_out{n}").alias("unblocked"))
        for n, (p, _) in enumerate(sides)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _tokens(prof: DataFrame, spec: MatchSpec, sign_above: int = SIGN_ABOVE) -> DataFrame:
    """Every join key of every profile: one per blocking pass and route, or several where a signed route is crowded."""
    method = {a.column: a.method for a in spec.attributes}
    keys = []
    for i, (block, _, e) in enumerate(_routes(spec)):
        usable = F.col(block).isNotNull()
        for c in e.columns:
            usable = usable & F.col(c).isNotNull()
            if method[c] != "exact":
                usable = usable & (F.col(c) != "")
        keys.append(
            F.when(usable, F.struct(F.lit(i).alias("route"), F.xxhash64(F.lit(i), F.col(block), *e.columns).alias("key")))
        )
    usable_rows = prof
    if spec.null_policy == "reject":
        for a in spec.attributes:
            if a.method == "exact":
                usable_rows = usable_rows.filter(F.col(a.column).isNotNull())
    carried = [c for c in prof.columns if c not in ("profile", "self_confidence")]
    plain = usable_rows.select(*carried, F.array_compact(F.array(*keys)).alias("_keys")).select(
        *carried, F.inline("_keys")
    )
    return _signed(plain, spec, sign_above) if any(e.signed for _, _, e in _routes(spec)) else plain


_SIGNED = "struct<near: int, stem: bigint, depth: int, top: int, token: bigint, peers: array<bigint>, key: bigint>"


def _signed(plain: DataFrame, spec: MatchSpec, sign_above: int) -> DataFrame:
    """The rows, those of crowded keys of signed routes once per signature; near, stem, depth, top, token, peers say which.

    Texts that begin alike (the same stem) may differ more than others, so they have signatures of their own.
    """
    routes = {i: (number, e) for i, (_, number, e) in enumerate(_routes(spec)) if e.signed}
    sizes = plain.filter(F.col("route").isin(*routes)).groupBy("key").agg(F.count("*").alias("n"))
    crowded = cut(sizes.filter(F.col("n") > sign_above).select("key", F.lit(True).alias("_crowded")))
    few = crowded.count() <= BROADCAST_KEYS
    marked = plain.join(F.broadcast(crowded) if few else crowded, on="key", how="left")
    none = F.array(F.struct(*[F.lit(None)] * 6, F.col("key")).cast(_SIGNED))
    made = none
    for i, (number, e) in routes.items():
        stem = F.xxhash64(F.substring(F.col(e.signed), 1, similarity.PREFIX_MAX))

        def spread(near: int, number: int = number, stem: Column = stem) -> Column:
            def one(s: Column, t: Column) -> Column:
                parts = [F.lit(near), s["depth"], t, *([stem] if near else [])]
                return F.struct(
                    F.lit(near), stem, s["depth"], s["top"], t, s["peers"], F.xxhash64(F.col("key"), *parts)
                ).cast(_SIGNED)

            return F.flatten(F.transform(f"_sig{number}_{near}", lambda s: F.transform(s["peers"], lambda t: one(s, t))))

        made = F.when(F.col("_crowded") & (F.col("route") == i), F.concat(spread(0), spread(1))).otherwise(made)
    kept = [c for c in plain.columns if c != "key" and not c.startswith("_sig")]
    return marked.select(*kept, F.inline(made))


def key_pairs(prof: DataFrame, spec: MatchSpec, sign_above: int = SIGN_ABOVE) -> DataFrame:
    """One row with the pairs of profiles that share a join key, counted once per key: what the join looks at."""
    sizes = _tokens(prof, spec, sign_above).groupBy("key").agg(F.count("*").cast("decimal(38,0)").alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0)).cast("decimal(38,0)").alias("pairs"))


def _routes(spec: MatchSpec) -> list[tuple[str, int, Route]]:
    """(block column, number of the route, route) of every pass and route."""
    return [(f"_block{i}", n, e) for i in range(len(spec.blocking)) for n, e in enumerate(evidence(spec))]


def _tiled(
    tokens: DataFrame, tile_rows: int, apart: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Left and right side of the pair join, with hot keys spread over tiles.

    A key with k chunks makes a triangle of k*(k+1)/2 tiles; chunk i meets chunk j in tile (i, j)
    only, so each pair of profiles meets exactly once and no tile exceeds about two chunks.
    Every row of a hot key is copied about k times, hence larger tiles for the hottest keys.

    With ``apart`` the tiles of crowded keys without a signature are no part of the two sides but come third: the
    rows of both sides (``side`` 0 and 1; a tile (i, i) has one), tile by tile.
    """
    n = F.col("size").cast("double")
    signed = F.count("token") if "token" in tokens.columns else F.lit(0)
    sizes = tokens.groupBy("key").agg(F.count("*").alias("size"), signed.alias("signed")).withColumn("pairs", n * (n - 1) / 2)
    sizes = sizes.withColumn("summed", F.lit(apart) & (F.col("signed") == 0) & (F.col("size") > min(tile_rows, SUM_ABOVE)))
    sizes = sizes.withColumn("hot", F.col("summed") | (F.col("size") > tile_rows))
    load = sizes.agg(
        F.sum(F.when(~F.col("summed"), F.col("pairs"))).alias("listed"),
        F.sum(F.when(F.col("summed"), F.col("pairs"))).alias("summed"),
        F.count(F.when(F.col("hot"), 1)).alias("hot"),
    ).first()
    # fewer than the session's own number would only be shuffled once more
    usual = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def spread(side: DataFrame, pairs: float | None, least: int) -> DataFrame:
        tasks = int((pairs or 0) // PAIRS_PER_TASK)
        return side if tasks < least else side.repartition(max(tasks, usual), "key", "route", "i", "j")

    if not load["hot"]:
        plain = tokens.select("*", F.lit(0).alias("i"), F.lit(0).alias("j"))
        return spread(plain, load["listed"], 2), plain, None
    most = F.when(F.col("summed"), tile_rows * SUM_TIMES).otherwise(tile_rows)
    rows = F.least(F.greatest(most, F.col("size") / F.lit(TILE_CHUNKS)), F.lit(max(tile_rows * SUM_TIMES, TILE_ROWS_MAX)))
    hot = sizes.filter("hot").select("key", "summed", F.ceil(F.col("size") / rows).cast("int").alias("chunks"))
    marked = tokens.join(F.broadcast(hot) if load["hot"] <= BROADCAST_KEYS else hot, on="key", how="left")
    chunks = F.coalesce("chunks", F.lit(1))
    marked = marked.withColumn("chunks", chunks).withColumn(
        "chunk", F.pmod(F.xxhash64("id", F.lit("tile")), chunks).cast("int")
    )
    last = F.col("chunks") - 1
    crowded = None
    if apart:
        crowd = F.coalesce("summed", F.lit(False))
        if load["summed"]:
            at = F.col("chunk")
            firsts = F.transform(
                F.sequence(at, last), lambda j: F.struct(at.alias("i"), j.alias("j"), F.lit(0).alias("side"))
            )
            seconds = F.transform(
                F.sequence(F.lit(0), at), lambda i: F.struct(i.alias("i"), at.alias("j"), F.lit(1).alias("side"))
            )
            both = F.concat(firsts, F.filter(seconds, lambda t: t["i"] < t["j"]))
            tiles_of = marked.filter(crowd).filter("id IS NOT NULL").select("*", F.inline(both))
            # a few rows are much work, so their bytes do not tell how many tasks they need
            crowded = spread(tiles_of.drop("chunks", "chunk", "summed"), load["summed"], 0)
        marked = marked.filter(~crowd)
    marked = marked.drop("summed")
    left = marked.withColumn("i", F.col("chunk")).withColumn("j", F.explode(F.sequence(F.col("chunk"), last)))
    right = marked.withColumn("j", F.col("chunk")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("chunk"))))
    return spread(left.drop("chunks", "chunk"), load["listed"], 2), right.drop("chunks", "chunk"), crowded


def candidate_pairs(
    prof: DataFrame, spec: MatchSpec, tile_rows: int = TILE_ROWS, sign_above: int = SIGN_ABOVE
) -> DataFrame:
    """Profile pairs that may reach the threshold, each once.

    Exact attributes come as their similarity ``sim_<column>`` (null where a side is null), the
    others as the texts of both sides and an upper bound ``most_<column>``.

    A superset of the matches: nothing that could qualify is left out, whatever the block size.
    """
    left, right, _ = _tiled(_tokens(prof, spec, sign_above), tile_rows)
    return _joined(left, right, spec)


def pairs_and_sums(
    prof: DataFrame, spec: MatchSpec, tile_rows: int = TILE_ROWS, sign_above: int = SIGN_ABOVE
) -> tuple[DataFrame, DataFrame | None]:
    """``candidate_pairs`` without the crowded keys, and those as sums of their matches, if there are any.

    All pairs of a crowded key are many times its profiles. A tile of them is scored in one place, by the very
    same rule, and leaves one row per profile: (id, others, mass, lo), see ``tiles.tile_sums``.
    """
    left, right, crowded = _tiled(_tokens(prof, spec, sign_above), tile_rows, apart=True)
    pairs = _joined(left, right, spec)
    if crowded is None:
        return pairs, None
    routes = [(block, *e.columns) for block, _, e in _routes(spec)]
    attributes = [(a.column, a.method == "exact", float(a.weight)) for a in spec.attributes]
    sums = tiles.tile_sums(attributes, routes, float(spec.threshold), float(spec.total_weight))
    needed = dict.fromkeys([c for r in routes for c in r] + [a.column for a in spec.attributes])
    rows = crowded.select("key", "route", "i", "j", "side", "id", "n", *needed)
    return pairs, rows.groupBy("key", "route", "i", "j").applyInArrow(sums, tiles.SUMS)


def _joined(left: DataFrame, right: DataFrame, spec: MatchSpec) -> DataFrame:
    # the first route on which the pair truly agrees owns it: no second copy, no hash collision
    routes = _routes(spec)
    owner = " ".join(
        "WHEN " + " AND ".join(f"a.`{c}` = b.`{c}`" for c in (block, *e.columns)) + f" THEN {n}"
        for n, (block, _, e) in enumerate(routes)
    )
    # a pair shares several signatures: those of its own kind and depth count, and the smallest of them owns it
    once = """AND (a.token IS NULL OR a.near = CASE WHEN a.stem = b.stem THEN 1 ELSE 0 END
        AND a.depth = greatest(a.top, b.top) AND array_min(array_intersect(a.peers, b.peers)) = a.token)"""
    once = once if any(e.signed for _, _, e in routes) else ""
    most = {}
    for attr in spec.attributes:
        if attr.method == "exact":
            # equal hashes can only overstate agreement, and numbers compare faster than texts
            most[attr] = f"CASE WHEN a.`_hash_{attr.column}` = b.`_hash_{attr.column}` THEN 1D ELSE 0D END"
        else:
            most[attr] = similarity.jaro_winkler_at_most(attr.column)
    reach = [f"{sql} * {attr.weight!r}D" for attr, sql in most.items()]
    condition = f"""
        a.key = b.key AND a.route = b.route AND a.i = b.i AND a.j = b.j
        AND {' + '.join(reach)} >= {(spec.threshold - SLACK) * spec.total_weight!r}D
        AND (a.i < a.j OR a.id < b.id)
        AND CASE {owner} END = a.route {once}"""
    fuzzy = [attr.column for attr in spec.attributes if attr.method != "exact"]
    exact = [attr.column for attr in spec.attributes if attr.method == "exact"]
    carried = ["id", "n", *fuzzy]
    joined = left.alias("a").join(right.alias("b"), on=F.expr(condition)).selectExpr(
        *[f"{side}.`{c}` AS `{c}_{side}`" for side in "ab" for c in carried],
        *[f"CAST(a.`{c}` = b.`{c}` AS DOUBLE) AS `sim_{c}`" for c in exact],
        *[f"{sql} AS `most_{attr.column}`" for attr, sql in most.items() if attr.column in fuzzy],
        "a.id > b.id AS swapped",
    )
    # the smaller id comes first, whichever side of a tile it was on
    return joined.selectExpr(
        *[f"CASE WHEN swapped THEN `{c}_b` ELSE `{c}_a` END AS `{c}_a`" for c in carried],
        *[f"CASE WHEN swapped THEN `{c}_a` ELSE `{c}_b` END AS `{c}_b`" for c in carried],
        *[f"sim_{c}" for c in exact],
        *[f"most_{c}" for c in fuzzy],
    )
