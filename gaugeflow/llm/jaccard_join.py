"""Operator 7, n-gram Jaccard join in metric space: pivots, Voronoi regions, exact.

A document is the set of hashes (64 bits) of its word shingles. The Jaccard distance of
sets is a metric, and two sets link if it is at most the radius 1 - at_least.

Sets of documents that have little in common are all about 1 apart, so no triangle
inequality tells them apart. The space is therefore first cut by the simplest pivots there
are, sets of one shingle: a set has a distance below 1 from just those of its own shingles.
Its home is its rarest shingle, and it is replicated to the regions of as many of the
next rarest as the radius asks for: sets within the radius share one of these. In a region, the place of its shingle in the order of a set bounds
what two sets can have in common, and keeps far sets from being compared. Rarity is counted over all documents in buckets of fixed number; it
only balances regions, any order is exact.

Before sets are compared, the parity of their shingles in PARITIES buckets tells how many shingles
they must at least differ in, which is again a metric that never exceeds the true one. Sets of so many
shingles that this tells nothing have WIDE buckets besides.

A set that can link with no other of a small region, for sizes and places alone, leaves it before it gets its parities.

A region of up to LEAF sets is a star first: each set is compared with the first other one of
another component that may be near enough, so near copies take as many comparisons as there are
sets. What is in different components then and may still be near is compared with all of those.
Regions of more sets are joined recursively. Some of their sets become
pivots, a single one at first, and are compared with all sets of other components, so they are
done. With several pivots, each other set goes to the Voronoi region of the nearest of the first
pivots, and to all regions j with d(x, p_j) <= d(x, p_home) + 2 * radius. If that would make more
than SPREAD times as many rows, the region stays whole and goes on with more pivots. A region ends
when all its sets are in one component already. Every comparison is of whole sets; no link
between sets of different components is missed.

Copies share one set and are never paired. With fewer words than a shingle has, a text
is one shingle of all of them. Null texts and texts without words have the empty set and
link with nothing; each is its own component. Rows equal in doc_id and text are
interchangeable. A component is named by its smallest doc_id; null ids are passed over, and
the name is null where there is no other. An empty table gives no rows, other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow import session
from gaugeflow.llm import sketch, words
from gaugeflow.llm.components import components
from gaugeflow.llm.tables import give_back, text_key, with_group

LEAF = 256
#: Others that a set of a small region is compared with in the first rounds; then with all.
PARTNERS = (1,)
#: Pivots of a large region in the first round, how many times more in each further one, and cells at most.
FIRST_PIVOTS, MORE_PIVOTS, CELLS = 1, 64, 4
SPREAD = 1.5
PARITIES = 512
PARITY_COLUMNS = [f"h{i}" for i in range(PARITIES // 64)]
WIDE = 4096
#: Rows of whole regions that a task looks at together.
HELD = 1 << 14
#: Documents after which a task hands over its 16-bit counts.
COUNTED = 60_000


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for block in words.blocks(column, words.SPACED_LOWER):
        hashes = block.hashes()
        grams = {q: block.shingles(hashes, q)[0] for q in range(1, size + 1)}
        for a, b in zip(block.of[:-1].tolist(), block.of[1:].tolist(), strict=True):
            q = min(size, b - a)
            if not q:
                yield np.zeros(0, np.uint64)
                continue
            values = np.sort(grams[q][a : b - q + 1])
            first = np.ones(len(values), bool)
            first[1:] = values[1:] != values[:-1]
            yield values[first]


def set_name(values: np.ndarray) -> int:
    """A 64-bit name of a set, the same in any order of its members."""
    total = words.mixed(values).sum(dtype=np.uint64) + np.uint64(len(values))
    return int(words.mixed(np.array([total], np.uint64)).view(np.int64)[0])


def parities(values: np.ndarray, buckets: int = PARITIES) -> np.ndarray:
    """For each of so many buckets whether it holds an odd number of the shingles, as 64-bit words."""
    odd = np.bincount((values >> np.uint64(7)).astype(np.int64) % buckets, minlength=buckets).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


def _wide_from(num: int, den: int) -> int:
    """From so many shingles on, linked sets may differ in nearly as many as others do in PARITIES buckets."""
    return PARITIES * (num + den) // (5 * max(1, den - num))


def _survey(docs: DataFrame, size: int, wide_from: int) -> DataFrame:
    """Rows (doc_id, k, n, name, h0, h1, ..., wide) of documents and rows (slice, counts) of shingle counts."""
    odd = ", ".join(f"{c} bigint" for c in PARITY_COLUMNS)
    shape = f"doc_id bigint, k bigint, n bigint, name bigint, {odd}, wide binary, slice int, counts binary"
    names = [x.split()[0] for x in shape.split(", ")]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(1 << sketch.BITS, np.uint16), 0

        def handed_over() -> pa.RecordBatch:
            used, raw = sketch.counter_rows(counts)
            none = pa.nulls(len(used), pa.int64())
            return pa.RecordBatch.from_arrays(
                [
                    *[none] * (4 + len(PARITY_COLUMNS)), pa.nulls(len(used), pa.binary()),
                    pa.array(used, pa.int32()), pa.array(raw, pa.binary()),
                ],
                names,
            )

        for batch in batches:
            sets = list(shingle_sets(batch.column("text"), size))
            n = pa.array([len(x) for x in sets], pa.int64())
            name = pa.array([set_name(x) for x in sets], pa.int64())
            rows = len(sets)
            odd = np.array([parities(x) for x in sets], np.int64).reshape(rows, len(PARITY_COLUMNS))
            wide = [parities(x, WIDE).tobytes() if len(x) >= wide_from else None for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("k"), n, name,
                    *(pa.array(np.ascontiguousarray(x)) for x in odd.T), pa.array(wide, pa.binary()),
                    pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()),
                ],
                names,
            )
            if rows:
                held = sketch.buckets(np.concatenate(sets))
                counts += np.bincount(held, minlength=len(counts)).astype(np.uint16)
            seen += rows
            give_back()
            if seen + 10_000 > COUNTED:
                yield handed_over()
                counts, seen = np.zeros_like(counts), 0
        if seen:
            yield handed_over()

    return docs.select("doc_id", text_key().alias("k"), "text").mapInArrow(look, shape)


def _home_shingles(docs: DataFrame, size: int, levels: np.ndarray, num: int, den: int) -> DataFrame:
    """(region, name, n, pos): each set once per task with the shingles whose regions it is in."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, done = shared.value, set()
        for batch in batches:
            region, name, sizes, lengths, pos = [], [], [], [], []
            for values in shingle_sets(batch.column("text"), size):
                own = set_name(values)
                if not len(values) or own in done:
                    continue
                done.add(own)
                # A set within the radius holds at least this many of the shingles.
                common = -(-num * len(values) // den)
                order = np.lexsort((values, rarity[sketch.buckets(values)]))
                kept = values[order[: len(values) - common + 1]]
                region.append(kept)
                name.append(own)
                sizes.append(len(values))
                lengths.append(len(kept))
                pos.append(np.arange(len(kept)))
            if region:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(region).view(np.int64)),
                        pa.array(np.repeat(np.array(name, np.int64), lengths)),
                        pa.array(np.repeat(np.array(sizes, np.int64), lengths)),
                        pa.array(np.concatenate(pos), pa.int32()),
                    ],
                    ["region", "name", "n", "pos"],
                )
            give_back()

    return docs.select("text").mapInArrow(send, "region bigint, name bigint, n bigint, pos int")


def _regions(homes: DataFrame, num: int, den: int) -> DataFrame:
    """(region, name, n, pos) of the regions of two sets or more.

    A set that cannot link with the smallest set of the region, for the place of the shingle, is left out. So is one
    of a region of up to LEAF sets that can link with none of them.
    """

    def meeting(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        n, pos = (rows.column(c).to_numpy() for c in ("n", "pos"))
        kept = np.zeros(len(n), bool)
        for at in _of_one_size(rows.column("region").to_numpy()):
            some = _may_meet(n[at], pos[at], num, den)
            kept[at] = some.any(axis=1) | some.any(axis=2)
        yield from rows.filter(pa.array(kept)).select(["region", "name", "n", "pos"]).to_batches()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def small() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                few = batch.column("m").to_numpy() <= LEAF
                passed.append(batch.filter(pa.array(~few)).select(["region", "name", "n", "pos"]))
                yield batch.filter(pa.array(few))

        passed: list[pa.RecordBatch] = []
        for rows in _whole_regions(small()):
            yield from passed
            passed.clear()
            if rows is not None:
                yield from meeting(rows)
        give_back()

    once = homes.repartition("region").dropDuplicates(["region", "name"])
    inside = Window.partitionBy("region")
    smallest = F.greatest(F.col("least"), F.ceil(num * F.col("n") / den))
    reaches = (num + den) * (F.col("n") - F.col("pos")) >= num * (F.col("n") + smallest)
    met = (
        once.withColumns({"m": F.count("*").over(inside), "least": F.min("n").over(inside)})
        .where((F.col("m") > 1) & reaches)
        .select("region", "name", "n", "pos", "m")
    )
    # Tasks have their regions one after the other from the window.
    return met.mapInArrow(work, "region bigint, name bigint, n bigint, pos int")


def _whole_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table | None]:
    """Rows that are sorted by region, some whole regions at a time; None after a batch that completes none."""
    held: list[pa.RecordBatch] = []

    def handed(whole: bool) -> pa.Table | None:
        rows = pa.Table.from_batches(held).combine_chunks()
        region = rows.column("region").to_numpy()
        # The last region may go on in the next batch.
        end = len(region) if whole else int(np.searchsorted(region, region[-1], "left"))
        held[:] = rows.slice(end).to_batches()
        return rows.slice(0, end) if end else None

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        yield handed(False) if sum(x.num_rows for x in held) >= HELD else None
    if held:
        yield handed(True)


def _of_one_size(region: np.ndarray) -> Iterator[np.ndarray]:
    """Rows, sorted by region, as matrices: a line for each region of two rows or more."""
    starts = np.flatnonzero(np.diff(region, prepend=region[0] - 1))
    sizes = np.diff(np.append(starts, len(region)))
    for size in np.unique(sizes[sizes > 1]).tolist():
        own = starts[sizes == size]
        step = max(1, (1 << 19) // (size * size))
        for k in range(0, len(own), step):
            yield own[k : k + step, None] + np.arange(size)


def _may_meet(n: np.ndarray, pos: np.ndarray, num: int, den: int) -> np.ndarray:
    """For regions of one size, which of their sets may link for sizes and places, the first of a pair before the second."""
    n_a, n_b, left = n[:, :, None], n[:, None, :], n - pos
    some = (den * n_b >= num * n_a) & (den * n_a >= num * n_b)
    some &= (num + den) * np.minimum(left[:, :, None], left[:, None, :]) >= num * (n_a + n_b)
    return some & np.triu(np.ones(some.shape[1:], bool), 1)


def _bodies(docs: DataFrame, size: int, wanted: np.ndarray) -> DataFrame:
    """(name, n, body) of the sets whose names are in the buckets wanted."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, done = shared.value, set()
        for batch in batches:
            rows = []
            for values in shingle_sets(batch.column("text"), size):
                own = set_name(values)
                if own not in done and kept[sketch.buckets(np.array([own], np.int64))[0]]:
                    done.add(own)
                    rows.append((own, len(values), values.tobytes()))
            if rows:
                name, n, body = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name, pa.int64()), pa.array(n, pa.int64()), pa.array(body, pa.binary())],
                    ["name", "n", "body"],
                )
            give_back()

    return docs.select("text").mapInArrow(send, "name bigint, n bigint, body binary").dropDuplicates(["name"])


def _common(a: pa.Array, b: pa.Array) -> np.ndarray:
    out = np.zeros(len(a), np.int64)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
        if len(p) > len(q):
            p, q = q, p
        at = np.minimum(np.searchsorted(q, p), max(0, len(q) - 1))
        out[i] = (q[at] == p).sum() if len(q) else 0
    return out


def _compared(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """(a, b, common, either): sizes of intersection and union of the sets of each pair."""

    @F.arrow_udf("bigint")
    def common(a: pa.Array, b: pa.Array) -> pa.Array:
        made = pa.array(_common(a, b))
        give_back()
        return made

    left = bodies.select(F.col("name").alias("a"), F.col("n").alias("n_a"), F.col("body").alias("body_a"))
    right = bodies.select(F.col("name").alias("b"), F.col("n").alias("n_b"), F.col("body").alias("body_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", "n_a", "n_b", common("body_a", "body_b").alias("common"))
        .select("a", "b", "common", (F.col("n_a") + F.col("n_b") - F.col("common")).alias("either"))
    )


def _grouped(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members with their component c so far and, by region, how many sets and components there are."""
    if labels is None:
        rows = members.withColumn("c", F.col("name"))
    else:
        rows = members.join(labels.select(F.col("v").alias("name"), F.col("c").alias("label")), "name", "left").select(
            *members.columns, F.coalesce("label", "name").alias("c")
        )
    inside = Window.partitionBy("region")
    seen = {"m": F.count("*").over(inside), "lo": F.min("c").over(inside), "hi": F.max("c").over(inside)}
    return rows.withColumns(seen).where("m > 1 AND lo < hi").drop("lo", "hi")


def _stars(rows: DataFrame, partners: int | None, num: int, den: int) -> DataFrame:
    """(a, b) of sets in small regions: each with the first partners that it may link with, or all.

    Rows with a = b name all sets that may link with any other.
    """

    def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        region, name, n, pos, c = (rows.column(x).to_numpy() for x in ("region", "name", "n", "pos", "c"))
        odd = np.stack([rows.column(x).to_numpy() for x in PARITY_COLUMNS], axis=1).view(np.uint64)
        has = rows.column("wide").is_valid().to_numpy()
        own_wide = b"".join(rows.column("wide").drop_null().to_pylist())
        wide, wide_at = np.frombuffer(own_wide, np.uint64).reshape(-1, WIDE // 64), np.cumsum(has) - 1
        for at in _of_one_size(region):
            some = _may_meet(n[at], pos[at], num, den) & (c[at][:, :, None] != c[at][:, None, :])
            both = n[at][:, :, None] + n[at][:, None, :]
            differ = np.bitwise_count(odd[at][:, :, None, :] ^ odd[at][:, None, :, :]).sum(axis=-1, dtype=np.int64)
            some &= (num + den) * differ <= (den - num) * both
            g, x, y = np.nonzero(some & has[at][:, :, None] & has[at][:, None, :])
            for k in range(0, len(g), HELD):
                own = g[k : k + HELD], x[k : k + HELD], y[k : k + HELD]
                p, q = at[own[0], own[1]], at[own[0], own[2]]
                differ = np.bitwise_count(wide[wide_at[p]] ^ wide[wide_at[q]]).sum(axis=1, dtype=np.int64)
                some[own] = (num + den) * differ <= (den - num) * (n[p] + n[q])
            near = some.any(axis=1) | some.any(axis=2)
            if partners is not None:
                some &= np.cumsum(some, axis=1) <= partners
            g, x, y = np.nonzero(some)
            a = np.concatenate([name[at][g, x], name[at][near]])
            b = np.concatenate([name[at][g, y], name[at][near]])
            if len(a):
                yield pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_regions(batches):
            if rows is not None:
                yield from found(rows)
        give_back()

    columns = ["region", "name", "n", "pos", "c", *PARITY_COLUMNS, "wide"]
    dealt = rows.select(*columns).repartition("region").sortWithinPartitions("region", "name")
    return dealt.mapInArrow(work, "a bigint, b bigint").distinct()


def set_components(
    docs: DataFrame, size: int, num: int, den: int, levels: np.ndarray, parity: DataFrame
) -> DataFrame | None:
    """(v, c) for every set that links with another one: c names the component."""
    radius = 1 - num / den
    regions = session.stage(_regions(_home_shingles(docs, size, levels, num, den), num, den), "regions")
    # Parities are met at the regions; what needs none of them is not carried along.
    once = parity.select("name", *PARITY_COLUMNS, "wide").dropDuplicates(["name"])
    members, written = regions.join(once, "name"), regions
    kept = ["name", "n", "pos", *PARITY_COLUMNS, "wide"]
    bodies, labels, pivots, turn = None, None, FIRST_PIVOTS, 0
    while True:
        grouped = session.stage(_grouped(members, labels), "grouped")
        session.unstage(written)
        largest = grouped.agg(F.max("m")).first()[0]
        if largest is None:
            return labels

        def may_link(a: str, b: str) -> Column:
            """Linked sets are of like size, differ in few shingles, and share none before this one."""
            n_a, n_b, pos_a, pos_b = (F.col(f"{t}.{c}") for c in ("n", "pos") for t in (a, b))
            sizes = (den * n_b >= num * n_a) & (den * n_a >= num * n_b)
            differ = sum(F.bit_count(F.col(f"{a}.{h}").bitwiseXOR(F.col(f"{b}.{h}"))) for h in PARITY_COLUMNS)
            sizes &= (num + den) * differ <= (den - num) * (n_a + n_b)
            return sizes & ((num + den) * F.least(n_a - pos_a, n_b - pos_b) >= num * (n_a + n_b))

        partners = PARTNERS[turn] if turn < len(PARTNERS) else None
        few = grouped.where(f"m <= {LEAF}")
        small = _stars(few, partners, num, den)
        either, large = small, None
        if largest > LEAF:
            # Sets in many regions stand in the middle of their likes; sets in large components
            # have the fewest others to be compared with.
            wide_open = grouped.where(f"m > {LEAF}")
            degree = wide_open.groupBy("name").agg(F.count("*").alias("degree"))
            of_own = F.count("*").over(Window.partitionBy("region", "c"))
            ranked = wide_open.withColumn("of_own", of_own).join(degree, "name")
            first = Window.partitionBy("region").orderBy("of_own", F.desc("degree"), "name")
            large = session.stage(
                ranked.select("region", *kept, "c", "m", F.row_number().over(first).alias("row")), "large"
            )
            some, others = large.where(F.col("row") <= pivots), large.where(F.col("row") > pivots)
            by_pivot = (
                some.alias("p")
                .join(large.alias("o"), F.col("p.region") == F.col("o.region"))
                .where((F.col("p.c") != F.col("o.c")) & may_link("p", "o"))
                .select(F.least("p.name", "o.name").alias("a"), F.greatest("p.name", "o.name").alias("b"))
            )
            either = small.unionByName(by_pivot).distinct()
        named = session.stage(either, "pairs")
        pairs = named.where("a <> b")
        ends = named.select(F.explode(F.array("a", "b")).alias("v"))
        if bodies is None:
            # Later rounds compare no sets but these and those of the large regions.
            ever = ends if large is None else ends.unionByName(large.select(F.col("name").alias("v")))
            bodies = session.stage(_bodies(docs, size, sketch.bitmap(ever, "v")), "bodies")
        wanted = sketch.bitmap(pairs.select(F.explode(F.array("a", "b")).alias("v")), "v")
        compared = session.stage(_compared(pairs, _within(bodies, wanted)), "compared")
        if compared.count() != pairs.count():
            raise RuntimeError("sets to be compared are missing")
        links = compared.where(den * F.col("common") >= num * F.col("either")).select("a", "b")
        labels = _merged(labels, links)
        # What may link with no other set of its small regions is done with them.
        going_on = ends.select(F.col("v").alias("name")).distinct()
        rest = few.join(going_on, "name", "left_semi").select("region", *kept)
        if partners is None and large is None:
            return labels
        if large is not None:
            again = others.select("region", *kept)
            if pivots > 1:
                distance = compared.select("a", "b", (1 - F.col("common") / F.col("either")).alias("d"))
                again = _cells(others, large.where(F.col("row") <= min(pivots, CELLS)), distance, kept, radius)
            rest = again if partners is None else rest.unionByName(again)
        members = written = session.stage(rest, "members")
        session.unstage(named, grouped, compared, *([] if large is None else [large]))
        pivots, turn = pivots * MORE_PIVOTS, turn + 1


def _cells(others: DataFrame, pivots: DataFrame, distance: DataFrame, kept: list[str], radius: float) -> DataFrame:
    """Members of large regions with the Voronoi cells that they go on in, or the region where cells do not part it."""
    both = distance.unionByName(distance.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))
    # A distance that is not known is inside a component or of sets that cannot link; such
    # a set goes to that cell as well.
    near = F.col("d").isNull() | (F.col("d") <= F.col("home") + 2 * radius + 1e-9)
    cells = (
        others.select("region", *kept, "m")
        .join(pivots.select("region", F.col("name").alias("p")), "region")
        .join(both.select(F.col("a").alias("name"), F.col("b").alias("p"), "d"), ["name", "p"], "left")
        .select("*", F.min("d").over(Window.partitionBy("region", "name")).alias("home"))
        .where(near)
    )
    cells = session.stage(cells, "cells")
    wide = cells.groupBy("region", "m").agg((F.count("*") > SPREAD * F.col("m")).alias("wide"))
    split = cells.join(wide.where("NOT wide").select("region"), "region").select(
        F.xxhash64("region", "p").alias("region"), *kept
    )
    whole = others.join(wide.where("wide").select("region"), "region").select("region", *kept)
    return split.unionByName(whole)


def _within(bodies: DataFrame, wanted: np.ndarray) -> DataFrame:
    """The bodies whose names are in the buckets wanted, so that no others are shuffled."""
    shared = bodies.sparkSession.sparkContext.broadcast(wanted)

    @F.arrow_udf("boolean")
    def kept(name: pa.Array) -> pa.Array:
        return pa.array(shared.value[sketch.buckets(name.to_numpy(zero_copy_only=False))])

    return bodies.where(kept("name"))


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Components after more links; what is linked already is contracted to one vertex."""
    if labels is None:
        return components(links) if not links.isEmpty() else None
    of = labels.select("v", "c")
    ends = links.join(of.select(F.col("v").alias("a"), F.col("c").alias("ca")), "a", "left").join(
        of.select(F.col("v").alias("b"), F.col("c").alias("cb")), "b", "left"
    )
    between = ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b").distinct()
    between = session.stage(between, "between")
    if between.isEmpty():
        return labels
    more = components(between).select(F.col("v").alias("c"), F.col("c").alias("to"))
    known = of.join(more, "c", "left").select("v", F.coalesce("to", "c").alias("c"))
    fresh = more.select(F.col("c").alias("v"), F.col("to").alias("c")).join(of.select("v"), "v", "left_anti")
    return session.stage(known.unionByName(fresh), "merged")


def repeats(joined: DataFrame) -> DataFrame:
    """(doc_id, k, keep) for all rows that repeat others: of each group one document stays.

    It is the one with the smallest doc_id, then text key; rows equal in both appear
    once, with keep true where one of them is to stay.
    """
    grouped = joined.where("group IS NOT NULL").groupBy("group", "doc_id", "k").agg(F.count("*").alias("n"))
    grouped = session.stage(grouped, "grouped-rows")
    best = grouped.groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("k"))).alias("best"),
        F.sum("n").alias("rows"),
    )
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("k") == F.col("best.k"))
    return (
        with_group(grouped, session.stage(best.where("rows > 1"), "best"), "group", "rows")
        .where(~stays | (F.col("n") > 1))
        .select("doc_id", "k", stays.alias("keep"))
    )


def jaccard_join(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, k, n_shingles, group and component_id, a row per document.

    group names the component whatever ids its documents have; it is null for empty sets.

    Sets link if den * intersection >= num * union.
    """
    survey = session.stage(_survey(docs, size, _wide_from(num, den)), "survey")
    rows = survey.where("slice IS NULL").select("doc_id", "k", "n", "name")
    levels = sketch.merged_levels(survey.where("slice IS NOT NULL").select("slice", "counts"))
    labels = set_components(docs, size, num, den, levels, survey.where("slice IS NULL AND n > 0"))
    full = rows.where("n > 0")
    if labels is None:
        placed = full.withColumn("c", F.col("name"))
    else:
        placed = full.join(labels.select(F.col("v").alias("name"), F.col("c").alias("label")), "name", "left").select(
            "doc_id", "k", "n", "name", F.coalesce("label", "name").alias("c")
        )
    smallest = placed.groupBy("c").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows"))
    joined = with_group(placed, session.stage(smallest, "smallest"), "c", "rows").select(
        "doc_id", "k", F.col("n").alias("n_shingles"), F.col("c").alias("group"), "component_id"
    )
    empty = rows.where("n = 0").select(
        "doc_id",
        "k",
        F.col("n").alias("n_shingles"),
        F.lit(None).cast("bigint").alias("group"),
        F.col("doc_id").alias("component_id"),
    )
    return joined.unionByName(empty)
