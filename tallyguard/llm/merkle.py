"""A Merkle manifest of a dataset, and proofs that a recursive query climbs leaf by leaf.

Every row is a leaf: the hash of its fields, each with its length, so that no two rows share
an encoding. Leaves of a language, in the order of ``doc_id``, are hashed in runs of
``ARITY`` into nodes, those again in runs, up to the language's subroot; the subroots, in the
order of the languages, are joined to the root in the same way.

Each built level is written as rows ``node, up, before, after``: a node, its parent, and the
digests of the siblings on either side in its run. A level is an eighth of the one below, so
all of them together are a seventh of the leaves. The proof of a leaf is found by a recursive
query over that table: each step looks up the node that a leaf has reached, appends its
siblings, folds the leaf's digest with them and goes on to the parent. The leaves of a run
have all their ancestors in common, so they climb in one row, with a digest for each. A step is
one equi-join by node, whose rows grow with the leaves; nothing is collected, and no run has
more than ``ARITY`` members, however many rows a language has. Numbering the leaves takes a sort by
range and one count per part.

Digests are lowercase hex where they are hashed or returned and 32 bytes where they are kept.

Defined results: null fields count as ``-``; rows without ``lang`` are the first tree, rows
without ``doc_id`` the first leaves of theirs and never altered; repeated rows are leaves of
their own, equal ones next to each other, rows of one ``doc_id`` ordered by their leaf; an
empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyguard.llm.work import materialize, numbered, tidy

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# A node's number: tree, level and place in the level.
PLACES, LEVELS = 40, 4
ROOT_TREE = 0  # the tree over the subroots; those of the languages count from 1

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**replaced: Column) -> Column:
    """The hash of a row, with some columns replaced, in 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[_encoded(replaced.get(c, F.col(c))) for c in FIELDS]), 256))


def _text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _hashed(*digests: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(_text, digests)), 256))


def _number(tree: Column, level: int, place: Column) -> Column:
    return F.shiftleft(F.shiftleft(tree, LEVELS) + F.lit(level), PLACES) + place


def _runs(level: DataFrame) -> DataFrame:
    """Runs of consecutive nodes ``tree, place, rows, node, digest, ...``, each with its members in order."""
    run = F.floor(F.col("place") / ARITY)
    extra = [c for c in level.columns if c not in ("tree", "place", "rows")]
    members = F.sort_array(F.collect_list(F.struct("place", *extra)))
    return level.groupBy("tree", run.alias("run"), "rows").agg(members.alias("members"))


def _joined(members: Column) -> Column:
    """The digests of the members, one after the other."""
    return F.aggregate(members, F.lit(b""), lambda done, m: F.concat(done, m["digest"]))


def _beside(members: Column, i: Column) -> tuple[Column, Column]:
    """The digests before and after the member at place ``i`` of a run, joined."""
    after = F.greatest(F.size(members) - i - 1, F.lit(0))
    return _joined(F.slice(members, F.lit(1), i)), _joined(F.slice(members, i + 2, after))


def _linked(runs: DataFrame, up: Column) -> DataFrame:
    """The members of the runs as rows ``node, up, before, after``."""

    def row(m: Column, i: Column) -> Column:
        before, after = _beside(F.col("members"), i)
        return F.struct(m["node"].alias("node"), before.alias("before"), after.alias("after"))

    return runs.select(up.alias("up"), F.inline(F.transform("members", row))).select("node", "up", "before", "after")


def _above(runs: DataFrame, up: Column) -> DataFrame:
    """The nodes that the runs are hashed into."""
    digest = F.unhex(F.sha2(_text(_joined(F.col("members"))), 256))
    return runs.select("tree", F.col("run").alias("place"), F.ceil(F.col("rows") / ARITY).alias("rows"), up.alias("node"), digest.alias("digest"))


def _built(level: DataFrame, rows: int, depth: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Hash the trees of ``level`` up to their tops: linked rows of every level, and the tops.

    ``rows`` is the number of nodes of the largest tree; smaller ones end earlier. ``depth``
    numbers the level.
    """
    links, tops = [], []
    while rows > 1:
        tops.append(level.where("rows = 1"))
        runs = materialize(_runs(level.where("rows > 1")), "runs")
        depth, rows = depth + 1, -(-rows // ARITY)
        up = _number(F.col("tree"), depth, F.col("run"))
        links.append(_linked(runs, up))
        level = _above(runs, up)
    return links, [*tops, level.where("rows = 1")]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# The leaves of a run start at its node; a step folds each of them into the next node.
_CLIMB = """
WITH RECURSIVE climb(start, node, folded, siblings) AS (
  SELECT node, node, folded, CAST('' AS BINARY) FROM {leaves}
  UNION ALL
  SELECT c.start, n.up,
         transform(c.folded, f -> unhex(sha2(concat(lower(hex(n.before)), lower(hex(f)), lower(hex(n.after))), 256))),
         concat(c.siblings, n.before, n.after)
  FROM climb c JOIN {nodes} n ON c.node = n.node)
SELECT start, folded, siblings FROM climb WHERE node = {root}
"""


def manifest(docs: DataFrame, tampered: Column | None = None, altered: Column | None = None) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and whether the row as it is now still fits.

    ``tampered`` says which rows are read with ``altered`` as their text when their leaf is
    folded with the stored siblings; where it is null or false, rows are as they were.
    """
    docs = tidy(docs, doc_id="long", source="string", lang="string", n_chars="long", text="string")
    spark = docs.sparkSession
    leaf = leaf_digest()
    changed = F.when(tampered, leaf_digest(text=altered)) if tampered is not None else F.lit(None).cast("binary")
    leaves = materialize(docs.select("doc_id", "lang", leaf.alias("leaf"), changed.alias("changed")), "leaves")
    leaves = numbered(leaves, "lang", "doc_id", "leaf", name="no")
    trees = leaves.groupBy("lang").agg(F.min("no").alias("first"), F.count("*").alias("rows"))
    trees = materialize(numbered(trees, "lang", name="nth").withColumn("tree", F.col("nth") + (ROOT_TREE + 1)), "trees")
    size = trees.agg(F.max("rows"), F.count("*")).first()
    largest, count = size[0] or 0, size[1]
    if largest >= 1 << PLACES or count >= 1 << (63 - PLACES - LEVELS):
        raise ValueError(f"{count} trees of up to {largest} leaves are more than nodes are numbered for")
    placed = leaves.join(trees.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")))
    placed = placed.withColumn("place", F.col("no") - F.col("first"))
    placed = placed.select("doc_id", F.coalesce("changed", "leaf").alias("altered"), "tree", "place", "rows",
                           F.lit(None).cast("long").alias("node"), F.col("leaf").alias("digest"))
    runs = materialize(_runs(placed), "runs")
    alone = F.col("rows") == 1  # such a leaf is the top of its tree

    def fold(m: Column, i: Column) -> Column:
        before, after = _beside(F.col("members"), i)
        return F.when(alone, m["altered"]).otherwise(_hashed(before, m["altered"], after))

    node = F.when(alone, _number(F.col("tree"), 0, F.col("run"))).otherwise(_number(F.col("tree"), 1, F.col("run")))
    start = runs.select(node.alias("node"), F.transform("members", fold).alias("folded"))
    first = _above(runs.where(~alone), node).unionByName(
        runs.where(alone).select("tree", F.col("run").alias("place"), "rows", node.alias("node"), F.col("members")[0]["digest"].alias("digest"))
    )
    links, tops = _built(first, -(-largest // ARITY), 1)
    subroots = materialize(_union(tops).select("tree", "node", "digest"), "subroots")
    joined = subroots.select(
        F.lit(ROOT_TREE).cast("long").alias("tree"), (F.col("tree") - (ROOT_TREE + 1)).alias("place"),
        F.lit(count).cast("long").alias("rows"), "node", "digest",
    )
    higher, top = _built(joined, count, 0)
    root = _union(top).select("node", "digest").first()
    none = subroots.select("node", F.col("node").alias("up"), F.col("digest").alias("before"), F.col("digest").alias("after")).where("false")
    nodes = materialize(_union([none, *links, *higher]), "nodes")
    bound = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")  # one row per run of leaves and level
    try:
        climbed = spark.sql(_CLIMB.replace("{root}", str(root.node if root else -1)), leaves=start, nodes=nodes)
        climbed = materialize(climbed, "climbed")
    finally:
        spark.conf.set(_ROW_LIMIT, bound)

    whole = _text(F.lit(bytes(root.digest)) if root else F.lit(None).cast("binary"))

    def proven(m: Column, i: Column) -> Column:
        before, after = _beside(F.col("members"), i)
        beside = F.when(alone, F.lit("")).otherwise(F.concat(_text(before), _text(after)))
        return F.struct(
            m["doc_id"].alias("doc_id"), _text(m["digest"]).alias("leaf"), F.sha2(F.concat(beside, _text(F.col("siblings"))), 256).alias("proof_sha256"),
            _text(F.get("folded", i)).alias("folded_root"),
        )

    known = runs.select("tree", "rows", "members", node.alias("start")).join(climbed, "start")
    known = known.join(subroots.select("tree", _text(F.col("digest")).alias("subroot")), "tree")
    leaves_ = known.select("subroot", F.inline(F.transform("members", proven)))
    return leaves_.select("doc_id", "leaf", "subroot", whole.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == whole).alias("verified"))


def checked_manifest(docs: DataFrame) -> DataFrame:
    """The manifest, checked against a copy whose texts were put into lower case in a third of the rows."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest(docs, chosen, F.translate("text", _UPPER, _UPPER.lower()))
