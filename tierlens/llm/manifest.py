"""Operator 13, a Merkle manifest of a dataset as a persistent, path-copying tree.

Every row is a leaf. Inside a group (a source) the leaves stand in key order; ``ARITY`` consecutive nodes have one
parent, until one node is left. Positions come from a range sort of narrow rows and small per-part counts, so a
group with a third of all rows is spread over all tasks. The tree is built bottom up in aligned blocks of
``ARITY ** LEVELS`` consecutive nodes: a task sees one block at a time, and only the block's root goes up, where
the roots are the leaves of the next, distributed, layer. The groups' roots, in group order, form the top tree.

A changed leaf makes a new version of the tree that shares every untouched node: only the leaf's ancestors are
copied. Inside the block they are copied in the block's task; the path of its root through the upper layers is
put together from the top down (each node knows its siblings, at most one row for each block) and the copies go
on along it. No version ever copies a block, and no node table is rewritten.

Defined results: a null value counts as ``-``; a null group stands first, then groups by their UTF-8 bytes; null
keys stand first in their group, and rows that share a key stand by their leaf, so repeated rows get neighbouring
places; a table of one row has its leaf as root, without siblings (their hash is that of the empty text); an empty
table has no rows; extra columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

ARITY = 3
#: Levels of a block: 3 ** 5 = 243 nodes at most in one call.
LEVELS = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value as its UTF-8 length, a colon and itself; null as a dash."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def row_leaf(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def group_key(group: Column) -> Column:
    """A key without nulls whose byte order puts null first."""
    return F.coalesce(F.concat(F.lit("s"), group.cast("string")), F.lit(""))


def placed(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """The rows with ``n`` (rows of their group) and ``p`` (place in it from 0).

    One range sort; a row's place is its place in its part plus the group's rows in earlier parts. A group that
    spans parts has at most one row for each part in the small table of counts."""
    parted = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    stored = cut(parted.withColumn("__id", F.monotonically_increasing_id()), name)
    counts = stored.groupBy(group, F.shiftright("__id", 33).alias("__part")).agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).withColumn("n", F.sum("__n").over(Window.partitionBy(group)))
    counts = counts.select(F.col(group).alias("__g"), F.col("__part").alias("__p"), "__off", "n")
    at = stored.join(counts, (F.col(group) == F.col("__g")) & (F.shiftright("__id", 33) == F.col("__p")))
    return at.select(*rows.columns, "n", (F.col("__id") + F.col("__off")).alias("p"))


def height(n: int, most: int) -> int:
    """Levels above n nodes until one is left, at most ``most``."""
    h = 0
    while n > 1 and h < most:
        n, h = -(-n // ARITY), h + 1
    return h


def digest(parts: Iterable[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def block_levels(nodes: list[str], n: int) -> list[list[str]]:
    """All levels of a block, its nodes first. n: nodes of the whole layer of the group."""
    levels = [nodes]
    for _ in range(height(n, LEVELS)):
        low = levels[-1]
        levels.append([digest(low[i : i + ARITY]) for i in range(0, len(low), ARITY)])
    return levels


def siblings(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """(left, right) siblings of node i on each level of its block, joined."""
    out = []
    for low in levels[:-1]:
        a = i - i % ARITY
        out.append(("".join(low[a:i]), "".join(low[i + 1 : a + ARITY])))
        i //= ARITY
    return out


def copied(node: str, path: Sequence[tuple[str, str]]) -> list[str]:
    """The new ancestors of a changed node: the only nodes that its version does not share."""
    out = []
    for left, right in path:
        node = digest((left, node, right))
        out.append(node)
    return out


def _sorted_nodes(table):
    """(places, hashes, n) of a block, by place."""
    p = table.column("p").to_numpy()
    at = p.argsort()
    h = table.column("h").to_pylist()
    return p[at], [h[i] for i in at], table.column("n")[0].as_py()


def block_roots(nodes: DataFrame) -> DataFrame:
    """(g, p, h, n) of the next layer: a node for each aligned block of ``nodes`` (g, p, h, n)."""
    size = ARITY**LEVELS

    def run(table):
        import pyarrow as pa

        p, h, n = _sorted_nodes(table)
        return pa.table({"g": [table.column("g")[0].as_py()], "p": pa.array([int(p[0]) // size], pa.int64()), "h": [block_levels(h, n)[-1][0]], "n": pa.array([-(-n // size)], pa.int64())})

    blocks = nodes.select("g", F.floor(F.col("p") / size).cast("long").alias("b"), "p", "h", "n")
    return blocks.groupBy("g", "b").applyInArrow(run, "g string, p long, h string, n long")


PATH = "array<struct<l:string,r:string>>"


def node_paths(nodes: DataFrame) -> DataFrame:
    """(g, p, path): the siblings of each node inside its block, level by level."""
    size = ARITY**LEVELS

    def run(table):
        import pyarrow as pa

        p, h, n = _sorted_nodes(table)
        levels = block_levels(h, n)
        paths = [[{"l": a, "r": b} for a, b in siblings(levels, i)] for i in range(len(h))]
        kind = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))
        return pa.table({"g": pa.array([table.column("g")[0].as_py()] * len(h), pa.string()), "p": pa.array(p, pa.int64()), "path": pa.array(paths, kind)})

    blocks = nodes.select("g", F.floor(F.col("p") / size).cast("long").alias("b"), "p", "h", "n")
    return blocks.groupBy("g", "b").applyInArrow(run, f"g string, p long, path {PATH}")


@dataclass
class Manifest:
    """leaves: (g, p, n, h, v, c0, c1, ...): group key, place, group size, leaf, changed leaf, carried columns.
    layers: node tables (g, p, h, n) from the leaves up, which no version changes. groups: (g, subroot).
    above: (g, p, path, subroot, root) of the nodes of the first layer over the leaves. root: one row."""

    leaves: DataFrame
    layers: list[DataFrame]
    groups: DataFrame
    above: DataFrame
    root: DataFrame
    carried: list[str]


def _layers(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Node tables from ``nodes`` up to the one in which every group has a single node."""
    out = [nodes]
    while True:
        up = cut(block_roots(out[-1]), name)
        out.append(up)
        if (up.agg(F.max("n")).first()[0] or 1) <= 1:
            return out


def _descend(above: DataFrame, layers: list[DataFrame]) -> DataFrame:
    """Paths to the root of the lowest layer's nodes, from the paths ``above`` of the highest layer's. A node of a
    layer has at most ARITY ** LEVELS children in the layer below, so no key of these joins is hot."""
    size = ARITY**LEVELS
    for nodes in reversed(layers[:-1]):
        own = node_paths(nodes).withColumn("up", F.floor(F.col("p") / size).cast("long")).alias("a")
        joined = own.join(above.alias("b"), F.expr("a.g = b.g and a.up = b.p"))
        above = joined.select("a.g", "a.p", F.concat("a.path", "b.path").alias("path"), *[f"b.{c}" for c in above.columns if c not in ("g", "p", "path")])
    return above


def build(rows: DataFrame, group: Column, order: Sequence[Column], leaf: Column, changed: Column | None = None, carry: Sequence[str] = ()) -> Manifest:
    """The tree over ``rows``. changed: the leaf of the row's version (the leaf itself if null or not given)."""
    keys = [f"k{i}" for i in range(len(order))]
    narrow = rows.select(group_key(group).alias("g"), *[c.alias(k) for k, c in zip(keys, order, strict=True)], leaf.alias("h"), (F.lit(None).cast("string") if changed is None else changed).alias("v"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    rows_h = cut(narrow, "hashed")  # the range sort reads its input twice: texts are hashed once
    leaves = placed(rows_h, "g", [*keys, "h"], "leaves").drop(*keys)
    layers = _layers(leaves.select("g", "p", "h", "n"), "nodes")
    groups = layers[-1].select("g", F.col("h").alias("subroot"))
    top = cut(placed(groups.select(F.lit("").alias("t"), F.col("g").alias("name"), "subroot"), "t", ["name"], "groups"), "top")
    tops = _layers(top.select(F.col("t").alias("g"), "p", F.col("subroot").alias("h"), "n"), "tops")
    over = _descend(tops[-1].select("g", "p", F.array().cast(PATH).alias("path"), F.col("h").alias("root")), tops)
    entry = top.alias("t").join(over.alias("o"), F.expr("t.p = o.p")).select(F.col("t.name").alias("g"), F.lit(0).cast("long").alias("p"), "o.path", "t.subroot", "o.root")
    return Manifest(leaves, layers, groups, _descend(entry, layers[1:]), tops[-1].select(F.col("h").alias("root")), list(carry))


def versions(tree: Manifest) -> DataFrame:
    """One row per leaf: the carried columns, leaf, subroot, root, proof (the siblings up to the root, joined),
    version_leaf and copies: the new ancestors, the last of them the root of the leaf's version. Everything else of
    the version is shared with the tree."""
    size, names = ARITY**LEVELS, [f"c{i}" for i in range(len(tree.carried))]
    kinds = {f.name: f.dataType.simpleString() for f in tree.leaves.schema.fields}
    left = tree.leaves.select("g", F.floor(F.col("p") / size).cast("long").alias("b"), "p", "n", "h", F.coalesce("v", "h").alias("v"), *names)
    right = tree.above.withColumnRenamed("p", "b")

    def run(nodes, over):
        import pyarrow as pa

        p, h, n = _sorted_nodes(nodes)
        nodes = nodes.take(pa.array(nodes.column("p").to_numpy().argsort()))
        upper = [(x["l"], x["r"]) for x in over.column("path")[0].as_py()]
        rest = "".join(a + b for a, b in upper)
        levels = block_levels(h, n)
        proofs, copies = [], []
        for i, v in enumerate(nodes.column("v").to_pylist()):
            path = siblings(levels, i)
            proofs.append("".join(a + b for a, b in path) + rest)
            copies.append(copied(v, [*path, *upper]))
        same = {k: pa.array([over.column(k)[0].as_py()] * len(h), pa.string()) for k in ("subroot", "root")}
        return pa.table({**{c: nodes.column(c) for c in names}, "leaf": nodes.column("h"), **same, "proof": pa.array(proofs, pa.string()), "version_leaf": nodes.column("v"), "copies": pa.array(copies, pa.list_(pa.string()))})

    schema = ", ".join([*(f"{c} {kinds[c]}" for c in names), "leaf string, subroot string, root string, proof string, version_leaf string, copies array<string>"])
    made = left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInArrow(run, schema)
    return made.withColumnsRenamed(dict(zip(names, tree.carried, strict=True)))


def verify(docs: DataFrame) -> DataFrame:
    """The query: the manifest of all rows, the proof of each, and the root of the version in which every second row
    (by the crc32 of its id) has lost its line breaks."""
    text = F.col("text").cast("string")
    fields = [F.col(c) for c in FIELDS[:-1]]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False)) & text.contains("\n")
    changed = F.when(hit, row_leaf([*fields, F.replace(text, F.lit("\n"), F.lit(""))]))
    tree = build(docs, F.col("source"), [F.col("doc_id")], row_leaf([*fields, text]), changed, ["doc_id"])
    folded = F.coalesce(F.try_element_at("copies", F.lit(-1)), F.col("version_leaf"))
    return versions(tree).select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


SQL = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, source, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head, text,
         xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda c, b: xor(c >> 8, list_reduce(list_concat([xor(c, b) & 255], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))), 1) & 1 AS odd
  FROM documents),
d AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
             CASE WHEN odd = 0 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS v FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY source) AS n FROM d),
lv(l, source, p, h, n) AS (
  SELECT 0, source, p, leaf, n FROM r
  UNION ALL SELECT any_value(l) + 1, source, p // 3, sha256(string_agg(h, '' ORDER BY p)), (any_value(n) + 2) // 3 FROM lv WHERE n > 1 GROUP BY source, p // 3),
sub AS (SELECT source, h AS subroot, l AS top, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS p, count(*) OVER () AS n FROM lv WHERE n = 1),
tv(l, p, h, n) AS (
  SELECT 0, p, subroot, n FROM sub
  UNION ALL SELECT any_value(l) + 1, p // 3, sha256(string_agg(h, '' ORDER BY p)), (any_value(n) + 2) // 3 FROM tv WHERE n > 1 GROUP BY p // 3),
nodes AS (SELECT lv.l, lv.source, lv.p, h FROM lv JOIN sub ON lv.source IS NOT DISTINCT FROM sub.source WHERE l < top
  UNION ALL SELECT sub.top + tv.l, sub.source, tv.p, tv.h FROM tv, sub WHERE tv.n > 1),
runs AS (SELECT l, source, p // 3 AS q, list(struct_pack(p := p, h := h) ORDER BY p) AS run FROM nodes GROUP BY l, source, p // 3),
walk(doc_id, leaf, source, l, p, top, start, proof, v) AS (
  SELECT r.doc_id, r.leaf, r.source, 0, r.p, sub.top, sub.p, '', r.v FROM r JOIN sub ON r.source IS NOT DISTINCT FROM sub.source
  UNION ALL
  SELECT doc_id, leaf, source, l + 1, q, top, start, proof || array_to_string(list_transform(list_filter(run, lambda x: x.p <> i), lambda x: x.h), ''),
         sha256(array_to_string(list_transform(run, lambda x: CASE WHEN x.p = i THEN v ELSE x.h END), ''))
  FROM (SELECT walk.*, runs.q, runs.run, CASE WHEN walk.l = top THEN start ELSE walk.p END AS i
        FROM walk JOIN runs ON walk.l = runs.l AND walk.source IS NOT DISTINCT FROM runs.source AND runs.q = (CASE WHEN walk.l = top THEN start ELSE walk.p END) // 3)),
done AS (SELECT * FROM walk QUALIFY l = max(l) OVER (PARTITION BY doc_id, leaf))
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, v AS folded_root, v = root AS verified
FROM done JOIN sub ON done.source IS NOT DISTINCT FROM sub.source CROSS JOIN (SELECT h AS root FROM tv WHERE n = 1)
"""
