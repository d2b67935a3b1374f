"""Operator 12, Merkle dataset manifest: a tree of digests over every row of a table.

Rows are leaves, ordered within their group. Sixteen consecutive nodes make one node above
them until one is left, the group's subroot; subroots, in the order of the groups, make the
root in the same way. A level is one aggregation: conditional aggregates spread the children of
a node into one column per slot, and the columns in their order are what is hashed. The
same row gives every child its siblings: all columns but its own. Proofs go down the tree, from
the root's slots to those of the leaves, so each level is joined once, row by row with its own
nodes, and no node is looked up by all the rows below it.

Places within a group come from one sort by ranges and the number of rows that each range
has of a group, so a group of any size is spread over many tasks. Levels are written tables.

Null groups come first, null ids come first within a group. Rows with the same id are in the
order of their leaves; equal rows are interchangeable, and each is a leaf of its own. Null
texts and empty texts have different leaves. Bytes that are no UTF-8 are hashed as they are.
An empty table has no root and gives no rows. Columns beyond those named are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow import session

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_POSITION = (1 << 33) - 1
_STEP = "struct<before:string,after:string>"


def field_text(value: Column) -> Column:
    """A value with its length in bytes, or a dash: no two rows have the same text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field_text, values)).cast("binary"), 256)


def digest_of(parts: Sequence[Column]) -> Column:
    """Digest of hex digests one after the other; nulls are left out."""
    return F.sha2(F.concat_ws("", *parts).cast("binary"), 256)


@dataclass(frozen=True)
class Manifest:
    """Written tables: leaves; nodes of each level with a column per slot; groups; their tree."""

    leaves: DataFrame
    levels: list[DataFrame]
    groups: DataFrame
    top_levels: list[DataFrame]

    def root(self) -> str | None:
        """The root's digest; None if there are no rows."""
        last = self.top_levels[-1].select("digest") if self.top_levels else self.groups.select("digest")
        row = last.first()
        return row and row[0]


def _ordered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Rows with the number of their group as `tree`, their place `idx`, and the group's size `n`."""
    # Equal rows differ in `_own`, so a row that is repeated often is cut into ranges as well.
    keys = [group, *order, "_own"]
    own = session.stage(rows.withColumn("_own", F.monotonically_increasing_id()), "rows")
    ranged = own.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_own")
    at = ranged.withColumn("_range", F.spark_partition_id()).withColumn(
        "_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION))
    )
    placed = session.stage(at, "ordered")
    # One row for each group in each range: no more than ranges and groups together.
    runs = session.stage(
        placed.groupBy("_range", group).agg(F.min("_place").alias("_first"), F.count("*").alias("_n")), "runs"
    )
    of_group = Window.partitionBy(group)
    runs = runs.withColumn("_before", F.sum("_n").over(of_group.orderBy("_range")) - F.col("_n")).withColumn(
        "n", F.sum("_n").over(of_group)
    )
    begun = runs.where("_before = 0").withColumn(
        "_at", F.row_number().over(Window.partitionBy("_range").orderBy("_first")) - 1
    )
    per_range = begun.groupBy("_range").agg(F.count("*").alias("_begun"))
    # At most one row for each range.
    earlier = (F.sum("_begun").over(Window.orderBy("_range")) - F.col("_begun")).alias("_earlier")
    groups = begun.join(per_range.select("_range", earlier), "_range").select(
        F.col(group).alias("_group"), (F.col("_earlier") + F.col("_at")).alias("tree")
    )
    numbered = runs.join(groups, F.col(group).eqNullSafe(F.col("_group"))).select(
        F.col("_range").alias("_r"), F.col(group).alias("_g"), (F.col("_before") - F.col("_first")).alias("_shift"),
        "tree", "n",
    )
    same = (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_g"))
    return placed.join(numbered, same).select(
        *rows.columns, "tree", (F.col("_place") + F.col("_shift")).alias("idx"), "n"
    )


def _slot(name: str, k: int) -> Column:
    return F.col(f"{name}{k}")


def _level(nodes: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """The nodes above: one column per slot for the digests, and for each carried column."""
    slot = F.pmod("idx", F.lit(FANOUT))
    spread = [
        F.max(F.when(slot == k, F.col(name))).alias(f"{name}{k}")
        for name in ("digest", *carried)
        for k in range(FANOUT)
    ]
    folded = nodes.where("n > 1").groupBy("tree", F.floor(F.col("idx") / FANOUT).alias("idx"))
    made = folded.agg(F.ceil(F.max("n") / FANOUT).alias("n"), *spread)
    return made.withColumn("digest", digest_of([_slot("digest", k) for k in range(FANOUT)]))


def _fold(nodes: DataFrame, carried: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame | None]:
    """All levels above the nodes, and the last node of each tree with its level as `height`."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    tops = None
    while most:
        single = nodes.where("n = 1").select("tree", "digest", F.lit(len(levels)).alias("height"))
        tops = single if tops is None else tops.unionByName(single)
        if most == 1:
            break
        levels.append(session.stage(_level(nodes, carried if not levels else ()), "level"))
        nodes = levels[-1].select("tree", "idx", "n", "digest")
        most = -(-most // FANOUT)
    return levels, tops


def build(docs: DataFrame, group: str = "source", order: str = "doc_id", fields: Sequence[str] = FIELDS,
          changed: Column | None = None) -> Manifest:
    """The manifest of a table.

    `changed` is a digest that a row shows in place of its leaf when it is verified, null
    where it shows the leaf itself. It takes no part in the tree.
    """
    shown = F.lit(None).cast("string") if changed is None else changed
    leaves = docs.select(
        F.col(order).alias("id"), F.col(group).cast("string").alias("group"),
        leaf_digest([F.col(f) for f in fields]).alias("digest"), shown.alias("shown"),
    )
    placed = session.stage(_ordered(leaves, "group", ["id", "digest"]), "leaves")
    nodes = placed.select("tree", "idx", "n", "digest", F.struct("id", "shown").alias("row"))
    levels, tops = _fold(nodes, carried=["row"])
    if tops is None:
        return Manifest(placed, [], placed.selectExpr("tree", "digest", "0 AS height"), [])
    groups = session.stage(tops, "groups")
    of_groups = groups.select(F.lit(0).alias("tree"), F.col("tree").alias("idx"), "digest")
    top_levels, _ = _fold(of_groups.withColumn("n", F.lit(groups.count())))
    return Manifest(placed, levels, groups, top_levels)


def _children(level: DataFrame, above: DataFrame, carried: str | None = None) -> DataFrame:
    """Nodes below a level, each with the siblings that it meets on its way up as `path`."""
    slots = []
    for k in range(FANOUT):
        before = F.concat_ws("", *[_slot("digest", j) for j in range(k)]) if k else F.lit("")
        after = F.concat_ws("", *[_slot("digest", j) for j in range(k + 1, FANOUT)]) if k + 1 < FANOUT else F.lit("")
        own = [F.lit(k).alias("slot"), _slot("digest", k).alias("digest")]
        own.append(F.struct(before.alias("before"), after.alias("after")).alias("step"))
        slots.append(F.struct(*own, *([_slot(carried, k).alias(carried)] if carried else [])))
    there = F.filter(F.array(*slots), lambda x: x["digest"].isNotNull())
    kept = [c for c in above.columns if c not in ("tree", "idx", "path")]
    joined = level.drop("digest", "n").join(above, ["tree", "idx"])
    return joined.select("tree", "idx", "path", *kept, F.explode(there).alias("c")).select(
        "tree", (F.col("idx") * FANOUT + F.col("c.slot")).alias("idx"), "c.digest", *([f"c.{carried}"] if carried else []),
        F.concat(F.array("c.step"), F.col("path")).alias("path"), *kept,
    )


def proofs(made: Manifest) -> DataFrame:
    """Every leaf with `subroot`, `root`, and its path: the siblings of each level, from below."""
    empty = F.array().cast(f"array<{_STEP}>")
    if made.top_levels:
        above = made.top_levels[-1].select("tree", "idx", empty.alias("path"), F.col("digest").alias("root"))
        for level in reversed(made.top_levels):
            below = _children(level, above)
            above = below.drop("digest")
        tops = below.select(F.col("idx").alias("tree"), "root", "path")
    else:
        tops = made.groups.select("tree", F.col("digest").alias("root"), empty.alias("path"))
    tops = session.stage(
        made.groups.withColumnRenamed("digest", "subroot").join(tops, "tree").withColumn("idx", F.lit(0).cast("long")),
        "tops",
    )
    above = None
    for height in range(len(made.levels), 0, -1):
        begun = tops.where(F.col("height") == height).select("tree", "idx", "path", "subroot", "root")
        above = begun if above is None else above.select(*begun.columns).unionByName(begun)
        above = _children(made.levels[height - 1], above, "row" if height == 1 else None)
    columns = ["id", "leaf", "shown", "subroot", "root", "path"]
    single = made.leaves.where("n = 1").withColumnRenamed("digest", "leaf").drop("idx").join(tops, "tree").select(*columns)
    if above is None:
        return single
    return above.select("row.id", F.col("digest").alias("leaf"), "row.shown", "subroot", "root", "path").unionByName(single)


def proof_digest(path: str = "path") -> Column:
    return digest_of([F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")])


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its path lead to."""
    up = lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]).cast("binary"), 256)
    return F.aggregate(path, leaf, up)


def lowered(text: str) -> Column:
    """A text with A-Z lowered, and nothing else changed."""
    return F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)


def verified_rows(docs: DataFrame) -> DataFrame:
    """Proof of every document, and whether the row it shows, tampered with for some, leads to the root."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = [lowered("text") if f == "text" else F.col(f) for f in FIELDS]
    found = proofs(build(docs, changed=F.when(hit, leaf_digest(other))))
    root = folded(F.coalesce("shown", "leaf"))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest().alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _oracle(height: int = 8) -> str:
    """The same in SQL, with as many levels as any group may need; levels not needed change nothing."""
    parts = " || ".join(
        f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in FIELDS
    )
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    tampered = parts.replace("text::", f"{lower}::")
    mixed = "xor(xor(crc, bit) >> 1, (xor(crc, bit) & 1) * 3988292384)"
    bits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda crc, bit: {mixed}), 4294967295)"
    steps = [f"""leaves AS (
    SELECT doc_id, source, sha256({parts}) AS leaf, sha256({tampered}) AS other, {crc} % 5 = 0 AS hit FROM documents
), g0 AS (
    SELECT doc_id, coalesce('=' || source, '') AS tree, leaf, other, hit, leaf AS digest,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
        count(*) OVER (PARTITION BY source) AS n FROM leaves
)"""]  # fmt: skip

    def levels(name: str) -> None:
        for k in range(height):
            steps.append(f"""{name}{k}s AS (
    SELECT tree, idx, n, digest,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS pre,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS post
    FROM {name}{k} WINDOW run AS (PARTITION BY tree, idx // 16 ORDER BY idx)
), {name}{k + 1} AS (
    SELECT tree, idx // 16 AS idx, (max(n) + 15) // 16 AS n,
        CASE WHEN max(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY idx)) ELSE any_value(digest) END AS digest
    FROM {name}{k} GROUP BY tree, idx // 16
)""")

    levels("g")
    steps.append(f"""h0 AS (
    SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS n, digest,
        tree AS source FROM g{height}
)""")
    levels("h")
    steps.append("""w0 AS (
    SELECT doc_id, g0.tree, leaf, CASE WHEN hit THEN other ELSE leaf END AS up, '' AS sib, g0.idx AS idx,
        h0.idx AS top, h0.digest AS subroot FROM g0 JOIN h0 ON g0.tree = h0.source
)""")
    at = 0
    for name, tree, place in (("g", "w.tree", "idx"), ("h", "''", "top")):
        for k in range(height):
            steps.append(f"""w{at + 1} AS (
    SELECT w.* REPLACE (
        CASE WHEN s.n > 1 THEN sha256(s.pre || w.up || s.post) ELSE w.up END AS up,
        w.sib || s.pre || s.post AS sib, w.{place} // 16 AS {place})
    FROM w{at} w JOIN {name}{k}s s ON s.tree = {tree} AND s.idx = w.{place}
)""")
            at += 1
    return f"""WITH {", ".join(steps)}
SELECT doc_id, leaf, subroot, r.digest AS root, sha256(sib) AS proof_sha256, up AS folded_root, up = r.digest AS verified
FROM w{at} JOIN h{height} r ON true"""


SQL = _oracle()
