"""A Merkle manifest of a table: a hash for each row, one root, and a proof for each row.

Rows are leaves, grouped and ordered by id.  Within a group every two consecutive nodes become
one (a last odd node alone), level by level, until the group's subroot is left; the
subroots, ordered by group, become the root in the same way.  A row's proof is the siblings of its
nodes on the way to the root, so one changed row is found without reading any other.

Levels are taken from windows over the leaves.  A node stands on the row of its first leaf, so at
level j its sibling stands exactly 2**j rows before or behind: a lag or a lead of that fixed
offset, masked by the node's slot and by the length of the run.  First-child rows hash
the parents.  Windows are over blocks of 2**LEVELS consecutive leaves and share one shuffle and one
sort; the blocks' nodes are the leaves of the next round.  So no task ever holds a group: positions
come from a range sort and the counts of its parts, and equal rows are dealt over several parts.

Edge cases: a null field is written as `-`, an empty text as `0:`; null ids come first in their
group and null groups before all others; rows of equal id stand in the order of their hashes, and
equal rows are leaves of their own; an empty table gives an empty manifest; only the fields, id
and group are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebook.llm.sampling import remainder
from closebook.llm.storage import WorkingTables, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: levels that one round of windows climbs; its blocks have two to this power leaves
LEVELS = 10
#: bits of a row number within one part, as `monotonically_increasing_id` has them
PART_BITS = 33


def leaf_hash(values: Sequence[Column]) -> Column:
    """The hash of a row's values, each with its length in bytes."""
    written = []
    for value in values:
        text = value.cast("string")
        written.append(F.coalesce(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*written), 256)


def _positions(nodes: DataFrame, order: Sequence[str], tables: WorkingTables) -> DataFrame:
    """`nodes` with `pos`, the place in the run from 0, and `size`, the number of its nodes."""
    keys = ["run", *order, "tie"]
    at = F.monotonically_increasing_id()
    ranged = tables.stored(
        nodes.withColumn("tie", at).repartitionByRange(*keys).sortWithinPartitions(*keys)
        .drop("tie").withColumn("at", at).withColumn("part", F.shiftright("at", PART_BITS)),
        "ranged")
    run = Window.partitionBy("run")
    before = run.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = ranged.groupBy("run", "part").agg(
        F.min("at").alias("first"), F.count("*").alias("n")
    ).select("run", "part", F.sum("n").over(run).alias("size"),
             (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return ranged.join(spans, ["run", "part"]).withColumn(
        "pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _climb(nodes: DataFrame, levels: int) -> DataFrame:
    """`nodes` (run, pos, size, hash, ...) with `block`, `path` and, on a block's first row, `top`.

    `path` lists the siblings met from the node to the block's top, and whether they are left.
    """
    out = nodes.withColumn("block", F.shiftright("pos", levels)).withColumn("h0", F.col("hash"))
    rows = Window.partitionBy("run", "block").orderBy("pos")
    for level in range(levels):
        step, own = 1 << level, F.col(f"h{level}")
        # the level exists while its run has several nodes; `own` is null but on first leaves
        live = own.isNotNull() & (F.col("size") > step)
        right = F.col("pos").bitwiseAND(step) != 0
        out = out.withColumn(
            f"s{level}",
            F.when(live & right, F.lag(own, step).over(rows))
            .when(live, F.coalesce(F.lead(own, step).over(rows), F.lit(""))))
        parent = F.when(live, F.sha2(F.concat(own, F.col(f"s{level}")), 256)).otherwise(own)
        out = out.withColumn(f"h{level + 1}", F.when(~right, parent))
    # every leaf takes the sibling from the first leaf of its node
    so_far = rows.rowsBetween(Window.unboundedPreceding, 0)
    met = [
        F.struct(F.last(f"s{level}", ignorenulls=True).over(so_far).alias("sibling"),
                 (F.col("pos").bitwiseAND(1 << level) != 0).alias("left"))
        for level in range(levels)
    ]
    return out.select(
        *nodes.columns, "block", F.col(f"h{levels}").alias("top"), F.array(*met).alias("met")
    ).withColumn("path", F.filter("met", lambda m: m["sibling"].isNotNull())).drop("met")


def _tree(nodes: DataFrame, tables: WorkingTables) -> tuple[DataFrame, DataFrame]:
    """`nodes` with the whole `path` to the top of their run, and the tops (`run`, `hash`)."""
    levels = LEVELS
    largest = nodes.agg(F.max("size")).first()[0] or 0
    climbed = _climb(nodes, levels)
    tops = tables.stored(climbed.where("top is not null").select(
        "run", F.col("block").alias("pos"),
        F.expr(f"shiftright(size + {(1 << levels) - 1}, {levels})").alias("size"),
        F.col("top").alias("hash")), "tops")
    climbed = climbed.drop("top")
    if largest <= 1 << levels:
        return climbed.drop("block"), tops.select("run", "hash")
    above, roots = _tree(tops, tables)
    above = above.select("run", F.col("pos").alias("block"), F.col("path").alias("above"))
    whole = climbed.join(above, ["run", "block"]).withColumn("path", F.concat("path", "above"))
    return whole.drop("block", "above"), roots


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf hash and the siblings of a proof give."""
    return F.aggregate(proof, start, lambda own, met: F.sha2(
        F.when(met["left"], F.concat(met["sibling"], own))
        .otherwise(F.concat(own, met["sibling"])), 256))


def proof_hash(proof: Column) -> Column:
    """One hash of all siblings of a proof, from the leaf to the root."""
    return F.sha2(F.array_join(F.transform(proof, lambda met: met["sibling"]), ""), 256)


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
             fields: Sequence[str] = FIELDS,
             carried: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row of `docs`: id, `leaf`, `subroot`, `root`, `proof`.

    `proof` is an array of (`sibling`, `left`): the hash, empty if the node has none, and whether
    it stands left.  `carried` names further expressions over `docs` that the result has.
    """
    carried = dict(carried or {})
    group = F.col(group_col).cast("string")
    leaves = docs.select(
        F.col(id_col).alias("id"), leaf_hash([F.col(c) for c in fields]).alias("hash"),
        F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group)).alias("run"),
        *[value.alias(f"carried_{k}") for k, value in enumerate(carried.values())])
    with WorkingTables(docs.sparkSession) as tables:
        # the texts are read once; what follows sorts narrow rows
        leaves = tables.stored(leaves, "leaves")
        rows, subroots = _tree(_positions(leaves, ["id", "hash"], tables), tables)
        groups = _positions(
            subroots.select(F.lit("").alias("run"), F.col("run").alias("name"), "hash"),
            ["name"], tables)
        groups, roots = _tree(groups, tables)
        root = roots.first()
        groups = groups.select(F.col("name").alias("run"), F.col("hash").alias("subroot"),
                               F.col("path").alias("above"))
        return stored(rows.join(groups, "run").select(
            F.col("id").alias(id_col), F.col("hash").alias("leaf"), "subroot",
            F.lit(root["hash"] if root else None).cast("string").alias("root"),
            F.concat("path", "above").alias("proof"),
            *[F.col(f"carried_{k}").alias(name) for k, name in enumerate(carried)]), "manifest")


def op11(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    changed = leaf_hash([
        F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS])
    rows = manifest(docs, carried={
        "tampered": F.when(remainder("doc_id", 7) == 0, changed)})
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
