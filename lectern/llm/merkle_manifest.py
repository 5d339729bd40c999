"""Merkle manifest of a dataset with octopus multiproofs.

A leaf is the hash of a row's fields. The leaves of a group (a source), in key order, are hashed up in runs of ``ARITY`` to the group's
subroot; the subroots, in group order, likewise to the root. Positions come from range partitions and their counts, and trees are
built ``LEVELS`` levels at a time in aligned blocks, so neither a large group nor a high tree meets in one task.

Proofs are made per leaf partition (an aligned block of leaves of one group): it computes the least union of node coordinates that its
leaves lack, fetches them in one join, derives the interior nodes that its leaves share, and expands each leaf's own proof locally.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import bounded, runs_of, sql_crc32, table, written
from lectern.operators.joins import sized_join

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
#: Levels that one pass builds, and with them the leaves of a block: ARITY ** LEVELS.
LEVELS = 6
BLOCK = ARITY ** LEVELS
#: Node coordinates and nodes are narrow rows (a name, two numbers, 32 bytes).
FETCH_ROWS = 1_000_000
_NODE = "tree string, n long, level long, idx long, hash binary"


def H(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def part(col: Column) -> Column:
    """A field inside a leaf: ``-`` for null, else its UTF-8 byte count, ``:`` and the value."""
    s = col.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_hash(*fields: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[part(c) for c in fields]), 256))


@dataclass
class Manifest:
    leaves: DataFrame   # tree, n, pos, key, leaf, claimed
    nodes: DataFrame    # tree, n, level, idx, hash: interior nodes of the group trees
    trees: DataFrame    # tree, n, subroot, place
    top: DataFrame      # the nodes over the subroots, level 0 included
    groups: int
    root: str | None    # None if there are no rows


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """Add pos, the row's number from 0 within its ``tree`` in the given order, and n, the tree's rows."""
    ranged = written(rows.repartitionByRange("tree", *order).withColumn("_part", F.spark_partition_id()), "ranged-leaves")
    each = ranged.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_c"))
    whole = W.partitionBy("tree")
    each = each.select("tree", "_part", F.sum("_c").over(whole).alias("n"), (F.sum("_c").over(whole.orderBy("_part")) - F.col("_c")).alias("_before"))
    at = F.row_number().over(W.partitionBy("_part", "tree").orderBy(*order)) - 1
    found = ranged.withColumn("_at", at).join(bounded(written(each, "range-counts")), ["tree", "_part"])
    return found.withColumn("pos", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def _climb(frames):
    """The next LEVELS levels over blocks of nodes (tree, n, block, level, idx, hash), sorted by (tree, block, idx)."""
    for f in runs_of(frames, ["tree", "block"]):
        tree, n, block, base = f["tree"].iloc[0], int(f["n"].iloc[0]), int(f["block"].iloc[0]), int(f["level"].iloc[0])
        now, out = [x.hex() for x in f["hash"]], []
        for up in range(1, LEVELS + 1):
            if ARITY ** (base + up - 1) >= n:
                break
            now = [H("".join(now[k:k + ARITY])) for k in range(0, len(now), ARITY)]
            first = block * ARITY ** (LEVELS - up)
            out += [(tree, n, base + up, first + k, bytes.fromhex(x)) for k, x in enumerate(now)]
        yield pd.DataFrame(out, columns=["tree", "n", "level", "idx", "hash"])


def _interior(leaves: DataFrame, largest: int) -> DataFrame:
    """All nodes above ``leaves(tree, n, level 0, idx, hash)``, trees having at most ``largest`` leaves."""
    now, done, base = leaves, leaves.limit(0), 0
    while ARITY ** base < largest:
        blocks = now.where(F.col("n") > ARITY ** base).withColumn("block", F.floor(F.col("idx") / BLOCK).cast("long"))
        blocks = blocks.select("tree", "n", "block", "level", "idx", "hash").repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
        made = written(blocks.mapInPandas(_climb, _NODE), f"nodes-{base}")
        done, base = done.unionByName(made), base + LEVELS
        now = made.where(F.col("level") == base)
    return done


def _peak() -> Column:
    """The one node of a tree that nothing stands above."""
    power = lambda level: F.pow(F.lit(float(ARITY)), level)
    return (F.col("idx") == 0) & (power(F.col("level")) >= F.col("n")) & ((F.col("level") == 0) | (power(F.col("level") - 1) < F.col("n")))


def manifest(docs: DataFrame, fields=FIELDS, group: str = "source", key: str = "doc_id", claimed: Column | None = None) -> Manifest:
    """The trees over all rows of ``docs``. ``claimed`` may give another hash (binary) per row that somebody claims as its leaf.

    Leaves ascend by key (null first), rows of equal key by leaf; equal rows all stay. A null group is a group of its own, before
    the others. Fields may be null, empty or long; further columns are not read. An empty table has no root.
    """
    tree = F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit(""))
    leaf = leaf_hash(*[F.col(c) for c in fields])
    raw = docs.select(tree.alias("tree"), F.col(key).alias("key"), leaf.alias("leaf"),
                      (F.lit(None).cast("binary") if claimed is None else claimed).alias("claimed"), F.monotonically_increasing_id().alias("_row"))
    # The row number, once written, tells equal rows apart, so that even many of them are spread over the ranges.
    leaves = written(placed(written(raw, "leaf-hashes"), "key", "leaf", "_row").drop("_row"), "leaves")
    ground = leaves.select("tree", "n", F.lit(0).cast("long").alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("hash"))
    largest, = leaves.agg(F.max("n")).first()
    if largest is None:
        return Manifest(leaves, ground, ground, ground, 0, None)
    nodes = _interior(ground, largest)
    subroots = written(nodes.unionByName(ground.where("n = 1")).where(_peak()).select(F.col("tree").alias("name"), F.col("n").alias("leaves"), "hash"), "subroots")
    above = written(placed(subroots.withColumn("tree", F.lit("top")), "name"), "placed-subroots")
    first = above.select("tree", "n", F.lit(0).cast("long").alias("level"), F.col("pos").alias("idx"), "hash")
    groups = first.count()
    top = first.unionByName(_interior(first, groups))
    trees = above.select(F.col("name").alias("tree"), F.col("leaves").alias("n"), F.col("hash").alias("subroot"), F.col("pos").alias("place"))
    return Manifest(leaves, nodes, trees, top, groups, top.where(_peak()).select(F.lower(F.hex("hash"))).first()[0])


def missing(positions: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """By level, the nodes that leaves ``positions`` (sorted, distinct) lack for deriving the top of a tree of ``n`` leaves: those that stand
    beside a node they lead to and that they do not lead to themselves."""
    out, known, level = [], positions, 0
    while n > 1:
        parents = np.unique(known // ARITY)
        kids = (parents[:, None] * ARITY + np.arange(ARITY)).ravel()
        out.append((level, np.setdiff1d(kids[kids < n], known)))
        known, n, level = parents, -(-n // ARITY), level + 1
    return out


def _coordinates(groups: int):
    def run(frames):
        for f in frames:
            out = []
            for tree, block, n, place, at in f[["tree", "block", "n", "place", "at"]].itertuples(index=False):
                for where, lack in ((0, missing(np.sort(np.asarray(at, np.int64)), int(n))), (1, missing(np.array([place]), groups))):
                    out += [(tree, block, where, level, int(x)) for level, xs in lack for x in xs]
            yield pd.DataFrame(out, columns=["tree", "block", "kind", "level", "idx"])
    return run


def derive(known: dict[int, dict[int, str]], n: int) -> tuple[str, list[dict[int, tuple[str, str]]]]:
    """From the nodes known by level (``known`` is filled up), the top of a tree of ``n`` leaves, and by level what stands left and right of each
    node within its run."""
    beside, level, width = [], 0, n
    while width > 1:
        here, above, sides = known.get(level, {}), known.setdefault(level + 1, {}), {}
        for p in {x // ARITY for x in here}:
            run = [here[x] for x in range(p * ARITY, min(p * ARITY + ARITY, width))]
            above[p] = H("".join(run))
            for k in range(len(run)):
                sides[p * ARITY + k] = ("".join(run[:k]), "".join(run[k + 1:]))
        beside.append(sides)
        width, level = -(-width // ARITY), level + 1
    return known[level][0], beside


def _expand(groups: int, root: str):
    cols = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def paths(beside, at):
        for sides in beside:
            yield sides[at]
            at //= ARITY

    def run(frames):
        for f in runs_of(frames, ["tree", "block"]):
            kind, levels, idx, hashes = f["kind"].to_numpy(), f["level"].to_numpy(), f["idx"].to_numpy(), f["hash"].tolist()
            info = f[kind == -1].iloc[0]
            n, place = int(info["n"]), int(info["place"])
            own, over = {0: {}}, {0: {}}
            for k, lv, x, h in zip(kind.tolist(), levels.tolist(), idx.tolist(), hashes):
                if k >= 0:
                    (over if k == 1 else own).setdefault(int(lv), {})[int(x)] = h.hex()
            subroot, beside = derive(own, n)
            over[0][place] = subroot
            derived, upper = derive(over, groups)
            rest = list(paths(upper, place))
            tail = "".join(a + b for a, b in rest)
            mine, out = kind == 2, []
            for key, at, leaf, claim in zip(f["key"][mine], idx[mine].tolist(), f["hash"][mine], f["claimed"][mine]):
                steps = list(paths(beside, int(at)))
                folded = derived
                if claim is not None:
                    folded = claim.hex()
                    for a, b in steps + rest:
                        folded = H(a + folded + b)
                out.append((key, leaf.hex(), subroot, root, H("".join(a + b for a, b in steps) + tail), folded, folded == root))
            yield pd.DataFrame(out, columns=cols)
    return run


def proofs(made: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) for all leaves, or for those in ``wanted(tree, pos)``.

    proof_sha256 hashes the leaf's siblings (the others of its run) from its own level up to the root, left to right; folded_root is
    the claimed leaf, if there is one, else the leaf itself, folded with them.
    """
    key = made.leaves.schema["key"].dataType.simpleString()
    if made.root is None:
        return made.leaves.selectExpr("key", *[f"string(null) {c}" for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], "boolean(null) verified")
    leaves = made.leaves if wanted is None else made.leaves.join(wanted.select("tree", "pos").distinct(), ["tree", "pos"], "left_semi")
    leaves = leaves.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))
    parts = leaves.groupBy("tree", "block").agg(F.collect_list("pos").alias("at"))
    parts = written(parts.join(bounded(made.trees), "tree"), "leaf-partitions")
    lack = written(parts.select("tree", "block", "n", "place", "at").mapInPandas(_coordinates(made.groups), "tree string, block long, kind int, level long, idx long"), "coordinates")
    least = lack.where("kind = 0").agg(F.coalesce(F.min("level"), F.lit(LEVELS * 99))).first()[0]
    store = made.nodes.where(F.col("level") >= least).select("tree", "level", "idx", "hash")
    if least == 0:
        store = store.unionByName(made.leaves.select("tree", F.lit(0).cast("long").alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("hash")))
    own = sized_join(lack.where("kind = 0"), store, ["tree", "level", "idx"], max_rows=FETCH_ROWS)
    over = sized_join(lack.where("kind = 1"), made.top.select("level", "idx", "hash"), ["level", "idx"], max_rows=FETCH_ROWS)
    info = parts.select("tree", "block", F.lit(-1).alias("kind"), "n", "place")
    rows = leaves.select("tree", "block", F.lit(2).alias("kind"), F.lit(0).cast("long").alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("hash"),
                         "claimed", F.col("key").cast("string").alias("key"))
    for df in (own, over, info):
        rows = rows.unionByName(df, allowMissingColumns=True)
    rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "kind")
    found = rows.mapInPandas(_expand(made.groups, made.root), "key string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return found.withColumn("key", F.col("key").cast(key))


def stripped_leaf(fields=FIELDS, key: str = "doc_id", text: str = "text") -> Column:
    """The leaf of a row whose text lost its line feeds, where the crc32 of the decimal key is even; null for other rows and where nothing changes."""
    changed = leaf_hash(*[F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == text else F.col(c) for c in fields])
    hit = (F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 0) & F.contains(F.col(text), F.lit("\n"))
    return F.when(hit, changed)


def q_op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, each proved with its text as it is or, for half of them, without line feeds."""
    made = manifest(table(spark, sf_dir, "documents"), claimed=stripped_leaf())
    return proofs(made).withColumnRenamed("key", "doc_id")


def _sql_part(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE concat(strlen({x}::VARCHAR), ':', {x}) END"


def _sql_leaf(text: str) -> str:
    return "sha256(concat(" + ", ".join(_sql_part(text if c == "text" else c) for c in FIELDS) + "))"


ORACLE_OP11 = f"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce('s' || source, '') AS t, {_sql_leaf('text')} AS leaf,
  CASE WHEN {sql_crc32('doc_id::VARCHAR')} % 2 = 0 THEN {_sql_leaf("replace(text, chr(10), '')")} ELSE {_sql_leaf('text')} END AS shown FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY t) AS n FROM docs),
own AS (SELECT t, n, 0 AS lv, pos AS i, leaf AS h FROM leaves UNION ALL
  SELECT t, n, lv + 1, i // {ARITY}, sha256(string_agg(h, '' ORDER BY i)) FROM own WHERE n > {ARITY} ** lv GROUP BY t, n, lv, i // {ARITY}),
subs AS (SELECT t, h AS subroot, row_number() OVER (ORDER BY t) - 1 AS place, count(*) OVER () AS k FROM own
  WHERE i = 0 AND {ARITY} ** lv >= n AND (lv = 0 OR {ARITY} ** (lv - 1) < n)),
top AS (SELECT k AS n, 0 AS lv, place AS i, subroot AS h FROM subs UNION ALL
  SELECT n, lv + 1, i // {ARITY}, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > {ARITY} ** lv GROUP BY n, lv, i // {ARITY}),
root AS (SELECT h AS root FROM top WHERE i = 0 AND {ARITY} ** lv >= n AND (lv = 0 OR {ARITY} ** (lv - 1) < n)),
fold AS (SELECT t, pos, n, 0 AS lv, shown AS h, '' AS sib FROM leaves UNION ALL
  SELECT f.t, f.pos, f.n, f.lv + 1, sha256(string_agg(CASE WHEN o.i = f.pos // ({ARITY} ** f.lv)::BIGINT THEN f.h ELSE o.h END, '' ORDER BY o.i)),
    f.sib || coalesce(string_agg(CASE WHEN o.i <> f.pos // ({ARITY} ** f.lv)::BIGINT THEN o.h END, '' ORDER BY o.i), '')
  FROM fold f JOIN own o ON o.t = f.t AND o.lv = f.lv AND o.i // {ARITY} = f.pos // ({ARITY} ** (f.lv + 1))::BIGINT
  WHERE f.n > {ARITY} ** f.lv GROUP BY f.t, f.pos, f.n, f.lv, f.h, f.sib),
mid AS (SELECT f.*, s.place, s.k FROM fold f JOIN subs s USING (t) WHERE {ARITY} ** f.lv >= f.n),
rise AS (SELECT t, pos, place, k, 0 AS lv, h, sib FROM mid UNION ALL
  SELECT f.t, f.pos, f.place, f.k, f.lv + 1, sha256(string_agg(CASE WHEN o.i = f.place // ({ARITY} ** f.lv)::BIGINT THEN f.h ELSE o.h END, '' ORDER BY o.i)),
    f.sib || coalesce(string_agg(CASE WHEN o.i <> f.place // ({ARITY} ** f.lv)::BIGINT THEN o.h END, '' ORDER BY o.i), '')
  FROM rise f JOIN top o ON o.lv = f.lv AND o.i // {ARITY} = f.place // ({ARITY} ** (f.lv + 1))::BIGINT
  WHERE f.k > {ARITY} ** f.lv GROUP BY f.t, f.pos, f.place, f.k, f.lv, f.h, f.sib)
SELECT l.doc_id, l.leaf, s.subroot, root.root, sha256(r.sib) AS proof_sha256, r.h AS folded_root, r.h = root.root AS verified
FROM leaves l JOIN subs s USING (t) JOIN rise r ON r.t = l.t AND r.pos = l.pos AND {ARITY} ** r.lv >= r.k, root"""
