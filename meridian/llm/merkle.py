"""A Merkle manifest of a dataset: a tree of digests for each group of rows, a tree over their roots, and the proof of each row.

A node carries the interval of leaf ranks that it covers, so that its ancestors are the nodes whose intervals contain its own, and its
siblings are what is left of its parent's interval without its own. Levels lie in buckets: ``span`` levels of a tree, cut where an interval of
the bucket's top level ends, are one small group of nodes. Going up, each group gives the node above it; going down, groups meet the node whose
interval contains theirs, and take over the siblings on its way to the root. So a bucket of levels costs one shuffle of its nodes, and a
group never has more than ``fan ** span`` of them, whatever the size of a tree.
Ranks come from a range partitioning by group and order: the place in a partition plus the counts of the partitions before it.

Defined results: a null counts as ``-`` in a digest; a null group is a tree of its own, the first one; rows with a null order come last in
theirs; rows of equal order follow by digest, and equal rows are separate leaves; a lone leaf is its own root; an empty table gives an empty
result; texts of any length are one digest; further columns are carried along, and columns named as new ones are replaced.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.llm.common import documents, materialise, shuffle_partitions

#: Levels of one bucket.
SPAN = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NEW = ("leaf", "subroot", "root", "left", "right")
#: Columns of the nodes; those of a caller are in one struct.
NODE = "__tree string, __leaves long, __lo long, __hi long, __digest string"


def digest(*columns: Column) -> Column:
    """sha256 of all values, each as ``-`` if null, else its length in bytes, a colon and itself."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


def _ranked(rows: DataFrame, label: str) -> DataFrame:
    """Leaves (__tree, __order, __tie, __digest and more) with their interval and the leaves of their tree; a large tree lies in many partitions."""
    keys = [F.col("__tree"), F.col("__order").asc_nulls_last(), F.col("__digest"), F.col("__tie")]
    dealt = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    # The upper bits of the id are the number of the partition, the lower ones the place in it.
    placed = materialise(dealt.drop("__order", "__tie").withColumn("__at", F.monotonically_increasing_id()), f"{label}-placed")
    part = F.shiftright("__at", 33)
    counts = placed.groupBy("__tree", part.alias("__part")).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    tree = Window.partitionBy("__tree")
    before = F.coalesce(F.sum("__n").over(tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("__tree", "__part", (before - F.col("__first")).alias("__shift"), F.sum("__n").over(tree).alias("__leaves"))
    counts = materialise(counts, f"{label}-counts")  # a table whose size Spark knows, so that it sees whether to broadcast it
    lo = F.col("__at") + F.col("__shift")
    found = placed.withColumn("__part", part).join(counts, ["__tree", "__part"])
    return found.withColumns({"__lo": lo, "__hi": lo + 1}).drop("__at", "__part", "__shift")


def _levels(lo: list[int], hi: list[int], digests: list[str], whole: bool, fan: int, span: int) -> list[tuple[list[int], list[int], list[str]]]:
    """Intervals and digests of the nodes of a group, level by level, up to its one top node: the root if the group is a whole tree."""
    out = [(lo, hi, digests)]
    while len(out[-1][0]) > 1 if whole else len(out) <= span:
        lo, hi, digests = out[-1]
        runs = [(k, min(k + fan, len(lo))) for k in range(0, len(lo), fan)]
        above = [hashlib.sha256("".join(digests[a:b]).encode()).hexdigest() for a, b in runs]
        out.append(([lo[a] for a, _ in runs], [hi[b - 1] for _, b in runs], above))
    return out


def _siblings(levels: list[tuple[list[int], list[int], list[str]]]) -> list[tuple[list[str], list[str]]]:
    """For each node of the lowest level, the siblings of it and its ancestors up to the top: joined digests left and right of each."""
    paths: list[tuple[list[str], list[str]]] = [([], [])]
    for (lo, _, digests), (above_lo, above_hi, _) in zip(levels[-2::-1], levels[:0:-1], strict=True):
        here = []
        for k, at in enumerate(lo):
            parent = bisect_right(above_lo, at) - 1
            first, last = bisect_right(lo, above_lo[parent] - 1), bisect_right(lo, above_hi[parent] - 1)
            left, right = paths[parent]
            here.append((["".join(digests[first:k]), *left], ["".join(digests[k + 1 : last]), *right]))
        paths = here
    return paths


def _nodes(table: pa.Table) -> tuple[pa.Table, list[int], list[int], list[str]]:
    table = table.sort_by("__lo")
    return table, *(table.column(c).to_pylist() for c in ("__lo", "__hi", "__digest"))


def _top(size: int, fan: int, span: int) -> Callable[[pa.Table], pa.Table]:
    """The top node of a group of nodes that cover ``size`` leaves each."""

    def top(table: pa.Table) -> pa.Table:
        _, lo, hi, digests = _nodes(table)
        tree, leaves = table.column("__tree")[0], table.column("__leaves")[0]
        lo, hi, digests = _levels(lo, hi, digests, leaves.as_py() <= size * fan**span, fan, span)[-1]
        return pa.table({"__tree": pa.array([tree.as_py()], pa.string()), "__leaves": [leaves.as_py()], "__lo": lo, "__hi": hi, "__digest": digests})

    return top


def _climb(leaves: DataFrame, fan: int, span: int, label: str) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """Nodes of each bucket's lowest level with the number of leaves they cover, and the root of each tree."""
    most = leaves.agg(F.max("__leaves")).first()[0] or 0
    size, nodes, tops = 1, leaves, []
    buckets = []
    while True:
        buckets.append((size, nodes))
        grouped = nodes.select("__tree", "__leaves", "__lo", "__hi", "__digest").groupBy("__tree", F.expr(f"__lo div {size * fan**span}"))
        top = materialise(grouped.applyInArrow(_top(size, fan, span), NODE), f"{label}-top")
        size *= fan**span
        tops.append(top.where(F.col("__leaves") <= size))
        if most <= size:
            roots = tops[0]
            for more in tops[1:]:
                roots = roots.unionByName(more)
            return buckets, roots.select("__tree", "__leaves", "__digest")
        nodes = top.where(F.col("__leaves") > size)


def _under(size: int, fan: int, span: int, rest: list[str], from_above: list[str]) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """The nodes of a group with the siblings up to the root, where the other table has those of the node that contains the group."""

    def under(key: tuple, nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes, lo, hi, digests = _nodes(nodes)
        (over,) = above.to_pylist() if above.num_rows == 1 else [None]
        if over is None or not (over["__lo"] <= lo[0] and hi[-1] <= over["__hi"]):
            raise ValueError(f"no single node contains the group {key}")
        whole = nodes.column("__leaves")[0].as_py() <= size * fan**span
        paths = _siblings(_levels(lo, hi, digests, whole, fan, span))
        new = {
            "left": pa.array([left + over["left"] for left, _ in paths], pa.list_(pa.string())),
            "right": pa.array([right + over["right"] for _, right in paths], pa.list_(pa.string())),
        }
        same = {c: pa.array([over[c]] * len(lo), pa.string()) for c in from_above}
        return pa.table({c: nodes.column(c) for c in rest} | same | new)

    return under


def _descend(buckets: list[tuple[int, DataFrame]], above: DataFrame, fan: int, span: int) -> DataFrame:
    """The leaves with ``left`` and ``right``. ``above``: those of the roots, by __tree, and further strings, which each leaf gets."""
    from_above = [c for c in above.columns if c not in ("__tree", "__leaves", "left", "right")]
    roots = above.withColumns({"__lo": F.lit(0).cast("long"), "__hi": F.col("__leaves")})
    over = None
    for size, nodes in reversed(buckets):
        width = size * fan**span
        # Trees whose root is in this bucket, and the nodes of the bucket above, which contain a group each.
        tops = roots.where((F.col("__leaves") <= width) & (F.col("__leaves") > (size if size > 1 else 0)))
        over = tops if over is None else tops.unionByName(over)
        rest = [c for c in nodes.columns if c != "__digest" or size == 1]
        kinds = "".join(f"`{c}` {kind}, " for c, kind in nodes.dtypes if c in rest)
        schema = f"{kinds}{''.join(f'`{c}` string, ' for c in from_above)}left array<string>, right array<string>"
        group = ["__tree", F.expr(f"__lo div {width}")]
        over = nodes.groupBy(*group).cogroup(over.groupBy(*group)).applyInArrow(_under(size, fan, span, rest, from_above), schema)
    return over


def manifest(df: DataFrame, leaf: Column, group: str = "source", order: str = "doc_id", keep: Iterable[str] = ("doc_id",), fan: int = 3, span: int = SPAN) -> DataFrame:
    """The columns ``keep`` with ``leaf``, the ``subroot`` of its group, the ``root`` of all, and its proof: ``left`` and ``right``, the joined
    digests of the siblings on both sides, an element a level from the leaf to the root. ``group`` orders the subroots by its bytes as text."""
    keep = [c for c in keep if c not in NEW]
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))  # null before all others
    rows = df.select(tree.alias("__tree"), F.col(f"`{order}`").alias("__order"), leaf.alias("__digest"), F.struct(F.lit(0).alias("__"), *[F.col(f"`{c}`") for c in keep]).alias("__keep"))
    rows = materialise(rows.withColumn("__tie", F.monotonically_increasing_id()), "leaves")
    buckets, subroots = _climb(_ranked(rows, "leaves"), fan, span, "leaves")
    tops = subroots.select(F.lit("").alias("__tree"), F.col("__tree").alias("__order"), F.lit(0).cast("long").alias("__tie"), "__digest", F.struct("__tree", "__leaves", F.col("__digest").alias("subroot")).alias("__keep"))
    upper, root = _climb(_ranked(tops, "subroots"), fan, span, "subroots")
    none = F.array().cast("array<string>")
    above = _descend(upper, root.select("__tree", "__leaves", F.col("__digest").alias("root"), none.alias("left"), none.alias("right")), fan, span)
    found = _descend(buckets, above.select("__keep.*", "root", "left", "right"), fan, span)
    return found.select(*[F.col(f"__keep.`{c}`").alias(c) for c in keep], F.col("__digest").alias("leaf"), "subroot", "root", "left", "right")


def folded(leaf: Column, left: str = "left", right: str = "right") -> Column:
    """The root that a leaf gives with the siblings of a proof."""
    pairs = F.zip_with(left, right, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.aggregate(pairs, leaf, lambda made, p: F.sha2(F.concat(p["a"], made, p["b"]).cast("binary"), 256))


def proof_digest(left: str = "left", right: str = "right") -> Column:
    """sha256 of all siblings of a proof, level by level."""
    return F.sha2(F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), "").cast("binary"), 256)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, proofs and their test, where some texts have lost their line ends on the way (none under a null doc_id)."""
    docs = documents(spark, sf_dir)
    fields = {c: F.col(c) for c in FIELDS}
    spoilt = digest(*(fields | {"text": F.replace("text", F.lit("\n"), F.lit(""))}).values())
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    rows = docs.select(*FIELDS, F.when(odd, spoilt).alias("spoilt"))
    found = manifest(rows, digest(*fields.values()), keep=("doc_id", "spoilt"))
    found = found.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), folded(F.coalesce("spoilt", "leaf")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


_ORACLE = """
WITH RECURSIVE
-- crc32 of the decimal doc_id, byte by byte with a table of 256 values
step AS (SELECT i, 0 AS k, i AS c FROM (SELECT unnest(range(256))::BIGINT AS i) UNION ALL
         SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
docs AS (SELECT row_number() OVER () AS row, doc_id, source, text, (SELECT t FROM crc) AS t,
    concat(COALESCE(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), COALESCE(strlen(source) || ':' || source, '-'),
           COALESCE(strlen(lang) || ':' || lang, '-'), COALESCE(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head FROM documents),
leaves AS (SELECT row, doc_id, source, sha256(head || COALESCE(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || COALESCE(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) AS spoilt,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')]),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 2 = 0 AS odd FROM docs),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS LAST, leaf, row) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves),
low AS (SELECT source, 0 AS level, pos AS i, leaf AS h, n FROM placed UNION ALL
        SELECT source, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM low WHERE n > 1 GROUP BY source, level, i // 3, n),
subroots AS (SELECT source, level, h, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (SELECT 0 AS level, pos AS i, h, n FROM subroots UNION ALL
         SELECT level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM high WHERE n > 1 GROUP BY level, i // 3, n),
walk AS (SELECT row, source, 0 AS level, pos AS i, CASE WHEN odd THEN spoilt ELSE leaf END AS made, '' AS proof, n FROM placed UNION ALL
    SELECT w.row, w.source, w.level + 1, w.i // 3, sha256(string_agg(CASE WHEN l.i = w.i THEN w.made ELSE l.h END, '' ORDER BY l.i)),
        w.proof || COALESCE(string_agg(l.h, '' ORDER BY l.i) FILTER (l.i <> w.i), ''), (w.n + 2) // 3
    FROM walk w JOIN low l ON l.source IS NOT DISTINCT FROM w.source AND l.level = w.level AND l.i // 3 = w.i // 3 WHERE w.n > 1
    GROUP BY w.row, w.source, w.level, w.i, w.made, w.proof, w.n),
top AS (SELECT w.row, 0 AS level, s.pos AS i, w.made, w.proof, s.n, s.h AS subroot FROM walk w JOIN subroots s ON s.source IS NOT DISTINCT FROM w.source WHERE w.n = 1 UNION ALL
    SELECT w.row, w.level + 1, w.i // 3, sha256(string_agg(CASE WHEN l.i = w.i THEN w.made ELSE l.h END, '' ORDER BY l.i)),
        w.proof || COALESCE(string_agg(l.h, '' ORDER BY l.i) FILTER (l.i <> w.i), ''), (w.n + 2) // 3, w.subroot
    FROM top w JOIN high l ON l.level = w.level AND l.i // 3 = w.i // 3 WHERE w.n > 1 GROUP BY w.row, w.level, w.i, w.made, w.proof, w.n, w.subroot)
SELECT p.doc_id, p.leaf, t.subroot, r.h AS root, sha256(t.proof) AS proof_sha256, t.made AS folded_root, t.made = r.h AS verified
FROM placed p JOIN top t ON t.row = p.row AND t.n = 1 CROSS JOIN (SELECT h FROM high WHERE n = 1) r
"""

QUERIES = {"op11_merkle": op11_merkle}
ORACLE = {"op11_merkle": _ORACLE}
