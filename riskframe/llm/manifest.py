"""Merkle manifest of a table: one tree per group, one over the groups, a proof for every row.

A leaf is the SHA-256 of a row's fields, each written as ``-`` (null) or UTF-8 byte count, ``:``,
value. Within a group, leaves ascend by their order column (null first, ties by leaf); every
``WIDTH`` consecutive nodes become one, the last run may be shorter, until one node is left: the
subroot. Subroots in the order of their groups (null first, UTF-8 bytewise) likewise give the
root. A digest is the SHA-256 of its children's lowercase hex digests, concatenated.

Proofs come by pointer jumping. A node starts with the segment of one step: the run that it
lies in and its place there, and points at its parent. Each round joins nodes to the node they
point at, which appends that node's segment and doubles the distance, so a tree of height h
takes log2(h) joins, whatever the number of rows. Only inner nodes (a seventh of the leaves) are
ever looked up.

As Spark work: rows are hashed where they are read, only digests travel; the order comes from a
range partitioning whose per-partition counts give the offsets (no group is sorted in one task);
a level is one aggregation of at most ``WIDTH`` digests a key; joins are between written tables,
so adaptive execution can split a popular ancestor. Everything is built-in functions.

Repeated rows have equal leaves and proofs that differ by place. A null group is a group of its
own, before the others. A lone row is its own subroot and root; its proof is the digest of the
empty string. An empty table has no rows and no root. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.shared import need, written
from riskframe.plans.broadcast import bounded_broadcast

WIDTH, BITS = 8, 3  # children of a node; a level takes BITS bits of a leaf's rank
TOP = -1  # number of the tree over the subroots
_BYTES = 32
_SEGMENTS = "array<struct<place:int,run:binary,top:boolean>>"


def _hash(hex_text: Column) -> Column:
    return F.unhex(F.sha2(hex_text, 256))


def _parent(run: Column) -> Column:
    """Digest of a run of concatenated binary digests."""
    return _hash(F.lower(F.hex(run)))


def text_digest(digest: Column) -> Column:
    """The lowercase hex text of a binary digest."""
    return F.lower(F.hex(digest))


def field(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    """Binary SHA-256 of the fields, in the given order."""
    return _hash(F.concat(*(field(c) for c in columns)))


def _without(s: Column, own: Column) -> Column:
    """The run of segment ``s`` with ``own`` at its place."""
    at = s["place"] * _BYTES
    return F.concat(F.substr(s["run"], F.lit(1), at), own, F.substr(s["run"], at + F.lit(_BYTES + 1)))


def fold(leaf: Column, segments: Column) -> Column:
    """The root that a binary leaf and the siblings in its proof give."""
    return F.aggregate(segments, leaf, lambda a, s: _parent(_without(s, a)))


def siblings_digest(segments: Column) -> Column:
    """Binary SHA-256 of all siblings of a proof, level by level, left to right."""
    own = F.lit(b"")
    return _parent(F.aggregate(segments, F.lit(b""), lambda a, s: F.concat(a, _without(s, own))))


def _ranked(df: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``rank`` (from 0, within ``keys``, by ``order``), and ``keys, rows`` of each group.

    Partitions hold ranges of (keys, order), so what precedes a row in its group are whole
    partitions, which are counted, and rows of its own partition, which are numbered."""
    spark = df.sparkSession
    width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    by = [*keys, *order]
    at = written(df.repartitionByRange(width, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", 33)
    runs = written(at.groupBy(part.alias("part"), *keys).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows")), "runs")
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift")
    shifts = runs.select(F.col("part").alias("r_part"), *(F.col(k).alias(f"r_{k}") for k in keys), start)
    cond = part == F.col("r_part")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"r_{k}"))
    out = at.join(bounded_broadcast(shifts, runs.count()), cond).withColumn("rank", F.col("at") + F.col("shift"))
    return out.drop("at", "shift", "r_part", *(f"r_{k}" for k in keys)), runs.groupBy(*keys).agg(F.sum("rows").alias("rows"))


def _height(rows: Column) -> Column:
    """Levels over ``rows`` nodes: the least h with WIDTH ** h >= rows."""
    return F.when(rows <= 1, F.lit(0)).otherwise(F.ceil(F.length(F.bin(rows - 1)) / BITS)).cast("int")


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """From leaf nodes (tree, idx, digest, height, payload): a table per level of the steps to the
    parents, and the topmost node of every tree."""
    steps, tops, level = [], [], 0
    high = nodes.agg(F.max("height")).first()[0] or 0
    while True:
        tops.append(nodes.where(F.col("height") == level))
        if level >= high:
            break
        child = F.struct("idx", "digest", "payload")
        up = nodes.where(F.col("height") > level).groupBy("tree", "height", F.shiftright("idx", BITS).alias("up")).agg(
            F.sort_array(F.collect_list(child)).alias("children"))  # at most WIDTH
        run = F.aggregate("children", F.lit(b""), lambda a, c: F.concat(a, c["digest"]))
        up = written(up.withColumn("run", run), f"level-{level + 1}")
        steps.append(up.select(
            "tree", F.lit(level).alias("level"), "up", "height", "run", F.posexplode("children").alias("place", "child")).select(
            "tree", "level", F.col("child.idx").alias("idx"), F.col("child.payload").alias("payload"), "height", "up", "place", "run"))
        nodes = up.select("tree", F.col("up").alias("idx"), _parent(F.col("run")).alias("digest"), "height",
                          F.lit(None).cast(nodes.schema["payload"].dataType).alias("payload"))
        level += 1
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return steps, out


def _named(tree: Column, level: Column, idx: Column, height: Column) -> Column:
    """A node's name; the topmost node of a group's tree is a leaf of the tree over the groups."""
    top = (level == height) & (tree != TOP)
    return F.struct(F.when(top, F.lit(TOP)).otherwise(tree).cast("long").alias("tree"),
                    F.when(top, F.lit(0)).otherwise(level).cast("int").alias("level"),
                    F.when(top, tree).otherwise(idx).cast("long").alias("idx"))


def _jump(rows: DataFrame, inner: DataFrame, root: Column) -> DataFrame:
    """Every row that doesn't point at the root yet takes over the segment of what it points at."""
    by = inner.select(*(F.col(f"node.{c}").alias(f"n_{c}") for c in ("tree", "level", "idx")),
                      F.col("points").alias("n_points"), F.col("segments").alias("n_segments"))
    far = rows.where(F.col("points") != root).select(
        "*", *(F.col(f"points.{c}").alias(f"p_{c}") for c in ("tree", "level", "idx")))
    cond = (F.col("p_tree") == F.col("n_tree")) & (F.col("p_level") == F.col("n_level")) & (F.col("p_idx") == F.col("n_idx"))
    went = far.join(by, cond).select(
        "node", "payload", F.col("n_points").alias("points"), F.concat("segments", "n_segments").alias("segments"))
    return rows.where(F.col("points") == root).select("node", "payload", "points", "segments").union(went)


def merkle_proofs(rows: DataFrame, leaf: str, group: str, order: str) -> DataFrame:
    """All columns of ``rows`` (among them a binary ``leaf``), with subroot, root (binary) and
    ``segments``: per step up to the root the run of digests, the place in it, and whether it lies
    in the tree over the groups."""
    need(rows, leaf, group, order)
    slim = rows.select(F.struct(*rows.columns).alias("payload"), F.col(group).cast("string").alias("part_of"),
                       F.col(order).alias("place_by"), F.col(leaf).alias("digest"))
    slim = written(slim, "leaves")
    ranked, sizes = _ranked(slim, ["part_of"], ["place_by", "digest"])
    groups, _ = _ranked(sizes, [], ["part_of"])
    groups = written(groups.select(F.col("part_of").alias("of"), F.col("rank").alias("tree"), _height(F.col("rows")).alias("height")), "groups")
    n_groups = groups.count()
    # one row per group; beyond the bound a shuffle join, whose hot groups adaptive execution splits
    nodes = written(ranked.join(bounded_broadcast(groups, n_groups), F.col("part_of").eqNullSafe(F.col("of"))).select(
        "tree", F.col("rank").alias("idx"), "digest", "height", "payload"), "nodes")
    steps, subroots = _climb(nodes)
    top_height = max(0, -(-(n_groups - 1).bit_length() // BITS)) if n_groups else 0
    top = written(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest",
                                  F.lit(top_height).alias("height"), "payload"), "subroots")
    top_steps, root_node = _climb(top)
    root_row = root_node.select("digest").first()
    root_digest = F.lit(bytes(root_row[0]) if root_row else b"")
    root = F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(top_height).alias("level"), F.lit(0).cast("long").alias("idx"))

    def pointers(step: DataFrame) -> DataFrame:
        t, level = F.col("tree"), F.col("level")
        segment = F.struct(F.col("place").cast("int").alias("place"), "run", (t == TOP).alias("top"))
        return step.select(_named(t, level, F.col("idx"), F.col("height")).alias("node"), "payload",
                           _named(t, level + 1, F.col("up"), F.col("height")).alias("points"),
                           F.array(segment).cast(_SEGMENTS).alias("segments"))

    lone = top.where((F.col("height") == 0)).select(  # a leaf that is the root has no step
        root.alias("node"), "payload", root.alias("points"), F.array().cast(_SEGMENTS).alias("segments"))
    every = lone
    for s in [*steps, *top_steps]:
        every = every.union(pointers(s))
    paths = written(every.where("payload IS NOT NULL"), "paths")
    inner = written(every.where("payload IS NULL"), "inner")
    reach, longest = 1, len(steps) + top_height
    while reach < longest:
        more = _jump(paths, inner, root)
        reach *= 2
        if reach < longest:
            paths, inner = written(more, "paths"), written(_jump(inner, inner, root), "inner")
        else:
            paths = more
    upper = F.filter("segments", lambda s: s["top"])
    first = F.get(upper, F.lit(0))
    subroot = F.coalesce(F.substr(first["run"], first["place"] * _BYTES + F.lit(1), F.lit(_BYTES)), root_digest)
    return paths.select("payload.*", subroot.alias("subroot"), root_digest.alias("root"), "segments")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def document_manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256 (hex text), and, after the
    texts of a third of the ids (crc32 divisible by 3) were lower-cased, the root that the changed
    leaf and the untouched siblings give (folded_root) and whether it is the true one (verified)."""
    need(docs, "doc_id", "source", "lang", "n_chars", "text")
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    low = F.translate("text", _UPPER, _UPPER.lower())
    leaves = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("lang"),
                         leaf_digest(*head, F.col("text")).alias("leaf"),
                         F.when(changed, leaf_digest(*head, low)).alias("tampered"))
    p = merkle_proofs(leaves, "leaf", "lang", "doc_id")
    folded = fold(F.coalesce("tampered", "leaf"), F.col("segments"))
    return p.select(
        "doc_id", *(text_digest(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")),
        text_digest(siblings_digest(F.col("segments"))).alias("proof_sha256"), text_digest(folded).alias("folded_root"),
        (folded == F.col("root")).alias("verified"))


def _crc32(text: str) -> str:
    """DuckDB expression of the CRC-32 of an ASCII text."""
    step = "list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: xor(c >> 1, (c & 1) * 3988292384))"
    codes = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {step}), 4294967295)"


def oracle(levels: int = 7, top_levels: int = 3) -> str:
    """DuckDB SQL for ``document_manifest`` of up to 8 ** levels rows a language."""

    def enc(c: str, own: str = "") -> str:
        return f"coalesce(octet_length(encode({own or c}::VARCHAR))::VARCHAR || ':' || {own or c}::VARCHAR, '-')"

    heads = " || ".join(enc(c) for c in ("doc_id", "source", "lang", "n_chars"))
    low = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
    parts = [f"""leaves AS (SELECT doc_id, lang, sha256({heads} || {enc('text')}) AS leaf,
  CASE WHEN {_crc32('doc_id::VARCHAR')} % 3 = 0 THEN sha256({heads} || {enc('text', low)}) END AS tampered FROM documents)""",
             """n0 AS (SELECT dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS idx, leaf AS digest, doc_id, tampered,
  count(*) OVER (PARTITION BY lang) AS n FROM leaves)"""]

    def climb(prefix: str, count: int) -> None:
        for k in range(count):
            parts.append(f"""{prefix}u{k} AS (SELECT tree, idx // 8 AS up, string_agg(digest, '' ORDER BY idx) AS run, (max(n) + 7) // 8 AS n
  FROM {prefix}{k} WHERE n > 1 GROUP BY tree, idx // 8)""")
            parts.append(f"""{prefix}{k + 1} AS (SELECT tree, up AS idx, sha256(run) AS digest, n FROM {prefix}u{k}
  UNION ALL SELECT tree, idx, digest, n FROM {prefix}{k} WHERE n = 1)""")

    climb("n", levels)
    parts.append(f"t0 AS (SELECT 0 AS tree, tree AS idx, digest, count(*) OVER () AS n FROM n{levels})")
    climb("t", top_levels)
    parts.append(f"root AS (SELECT digest AS root FROM t{top_levels})")
    parts.append("p0 AS (SELECT doc_id, tree, idx, digest AS leaf, '' AS proof, coalesce(tampered, digest) AS acc FROM n0)")
    last = "p0"

    def follow(prefix: str, k: int, tree: str, to: str, idx: str) -> None:
        nonlocal last
        cut = "(least(p.{0} % 8, 8) * 64)::BIGINT".format(idx)
        left, right = f"substr(u.run, 1, {cut})", f"substr(u.run, {cut} + 65)"
        parts.append(f"""{to} AS (SELECT p.doc_id, p.tree, coalesce(u.up, p.idx) AS idx, p.leaf,
  CASE WHEN u.run IS NULL THEN p.proof ELSE p.proof || {left} || {right} END AS proof,
  CASE WHEN u.run IS NULL THEN p.acc ELSE sha256({left} || p.acc || {right}) END AS acc
  FROM {last} p LEFT JOIN {prefix}u{k} u ON u.tree = {tree} AND u.up = p.{idx} // 8)""")
        last = to

    for k in range(levels):
        follow("n", k, "p.tree", f"p{k + 1}", "idx")
    parts.append(f"q0 AS (SELECT doc_id, tree, tree AS idx, leaf, proof, acc FROM {last})")
    last = "q0"
    for k in range(top_levels):
        follow("t", k, "0", f"q{k + 1}", "idx")
    return f"""WITH {', '.join(parts)}
SELECT q.doc_id, q.leaf, t0.digest AS subroot, root.root, sha256(q.proof) AS proof_sha256, q.acc AS folded_root, q.acc = root.root AS verified
FROM {last} q JOIN t0 ON t0.idx = q.tree CROSS JOIN root"""
