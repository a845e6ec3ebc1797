"""A dataset manifest as a content-addressed Merkle DAG, and inclusion proofs by descent from its root.

Every node is named by its digest. A record says which children a digest has; records of the few levels
between two joins lie together in a segment, named by the digest at its top. Leaves are numbered by rank in
their group, so the binary digits of a rank are the way from the group's subroot down to it.

A request starts at the root with nothing but a digest and digits. In each segment it looks up its digest's
children, takes the one that the next digit names, and keeps the others. What all leaves below a node share
is gone through once: only the different beginnings of the wanted ranks descend, and the last segments alone
deal with single leaves. The path is found from the root down, so it is reversed in the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ctxloom.llm.common import stored
from ctxloom.runtime import ship_package

SEGMENT_LEVELS = 8  # levels between two joins; a segment has at most 2^8 nodes at its foot
_SHARD = 10  # records are kept once for this many neighbouring segments, in bits: equal content never makes a hot key
TOP = "top"


def field_text(value: Column) -> Column:
    """A value as it enters a leaf's digest: its UTF-8 byte count, ``:`` and itself, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field_text(v) for v in values]), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _node(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def segment_records(nodes: list[bytes], whole: bool, levels: int = SEGMENT_LEVELS) -> tuple[bytes, int, list[tuple[bytes, list[bytes]]]]:
    """The digest above these neighbouring nodes, its height and the records below it.

    ``whole``: the nodes are all that their level has, so that one of them alone is the end. Elsewhere a
    segment always has all its levels.
    """
    records = []
    for height in range(levels):
        if whole and len(nodes) == 1:
            return nodes[0], height, records
        above = []
        for at in range(0, len(nodes), 2):
            children = nodes[at : at + 2]
            above.append(_node(children))
            records.append((above[-1], children))
        nodes = above
    return nodes[0], levels, records


# ---------------------------------------------------------------- ranks


def rank_leaves(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` (grp, digest, ...) with ``rank`` in and ``n`` of their group, ascending by ``order``, then digest.

    Rows are dealt out by range, so that neither a group nor many equal rows are ever in one task. One row
    per range and group says where its ranks begin. ``grp`` is never null.
    """
    spark = leaves.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["grp", *order, "digest", "_own"]
    kept = stored(leaves, "leaves").withColumn("_own", F.monotonically_increasing_id())
    dealt = kept.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_own")
    dealt = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), "ordered").withColumn("_part", F.shiftright("_at", 33))
    runs = dealt.groupBy("_part", "grp").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    upto = "sum(_n) over (partition by grp order by _part rows between unbounded preceding and current row)"
    runs = runs.select("_part", "grp", "_first", (F.expr(upto) - F.col("_n")).alias("_before"), F.expr("sum(_n) over (partition by grp)").alias("n"))
    ranked = dealt.join(runs, ["_part", "grp"])
    return ranked.withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_before")


# ---------------------------------------------------------------- the store

_RECORDS = "steps int, records array<struct<node: binary, children: array<binary>>>"


@dataclass
class Forest:
    """One tree per group."""

    records: list[DataFrame]  # by height in segments, from the leaves up: (digest, shard, steps, records)
    roots: DataFrame  # (grp, digest, height): each group's root and its height in segments
    levels: int


def _segments(rows: DataFrame, levels: int) -> DataFrame:
    """(grp, at, n, digest, steps, records) from (grp, at, n, nodes); the new ``n`` counts the level above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("node", pa.binary()), ("children", pa.list_(pa.binary()))]))
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ns = part.column("n").to_pylist()
                made = [segment_records(own, n <= 1 << levels, levels) for own, n in zip(part.column("nodes").to_pylist(), ns, strict=True)]
                records = [[{"node": d, "children": c} for d, c in own] for _, _, own in made]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("grp"), part.column("at"), pa.array([-(-n // (1 << levels)) for n in ns], pa.int64()),
                        pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.int32()), pa.array(records, kind),
                    ],
                    ["grp", "at", "n", "digest", "steps", "records"],
                )

    return rows.mapInArrow(run, f"grp string, at bigint, n bigint, digest binary, {_RECORDS}")


def build_forest(leaves: DataFrame, levels: int = SEGMENT_LEVELS) -> Forest:
    """Trees over ``leaves`` (grp, rank, n, digest): runs of two nodes, the last of one if need be, until one node remains."""
    ship_package(leaves.sparkSession)
    nodes = leaves.select("grp", F.col("rank").alias("at"), "n", "digest")
    records, roots = [], None
    while True:
        done = nodes.filter("n = 1").select("grp", "digest", F.lit(len(records)).alias("height"))
        roots = done if roots is None else roots.unionByName(done)
        if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
            return Forest(records, stored(roots, "roots"), levels)
        members = F.array_sort(F.collect_list(F.struct("at", "digest")))
        pages = nodes.filter("n > 1").groupBy("grp", F.shiftright("at", levels).alias("page"))
        grouped = pages.agg(F.max("n").alias("n"), F.transform(members, lambda m: m["digest"]).alias("nodes"))
        made = stored(_segments(grouped.select("grp", F.col("page").alias("at"), "n", "nodes"), levels), "segments")
        shard = F.shiftright("at", _SHARD).alias("shard")
        records.append(stored(made.select("digest", shard, "steps", "records").dropDuplicates(["digest", "shard"]), "records"))
        nodes = made.select("grp", "at", "n", "digest")


# ---------------------------------------------------------------- descent


def _descended(rows: DataFrame, carried: list[str]) -> DataFrame:
    """One segment further down: a row per wanted node with its digest and the path so far."""
    wanted = rows.schema["wanted"].dataType.elementType
    own = [f for f in wanted.fields if f.name != "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("digest", "siblings", "lefts", "steps", "records")}
                children = {r["node"]: r["children"] for r in row["records"]}
                requests = batch.column("wanted").slice(k, 1).flatten()
                digests, siblings, lefts = [], [], []
                for place in requests.field("at").to_pylist():
                    node, others, sides = row["digest"], list(row["siblings"]), list(row["lefts"])
                    for bit in range(row["steps"] - 1, -1, -1):
                        pair, digit = children[node], place >> bit & 1
                        node = pair[digit]
                        others.append(pair[1 - digit] if len(pair) == 2 else None)
                        sides.append(digit == 1)
                    digests.append(node)
                    siblings.append(others)
                    lefts.append(sides)
                same = pa.array([k] * len(digests), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(same) for c in carried), requests.field("at"), pa.array(digests, pa.binary()),
                        pa.array(siblings, pa.list_(pa.binary())), pa.array(lefts, pa.list_(pa.bool_())),
                        *(requests.field(f.name) for f in own),
                    ],
                    [*carried, "at", "digest", "siblings", "lefts", *(f.name for f in own)],
                )

    plain = StructType.fromDDL("at bigint, digest binary, siblings array<binary>, lefts array<boolean>")
    return rows.mapInArrow(run, StructType([*(rows.schema[c] for c in carried), *plain.fields, *own]))


def descend(forest: Forest, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """(grp, start, at, digest, siblings, lefts, ...) for each request (grp, rank, ...): the leaf and the way to it.

    ``starts`` are (grp, digest, siblings, lefts): where each group's descent begins and what was passed
    before. Each rank is requested at most once; other columns of a request go along. ``siblings`` holds,
    from the root down, the node not taken, null where there is none, and ``lefts`` whether it stands on the left.
    """
    carried, way = ["grp", "start"], ["siblings", "lefts"]
    own = [c for c in requests.columns if c not in ("grp", "rank")]
    known = starts.join(forest.roots.select("grp", "height"), "grp")
    known = stored(known.select("grp", F.col("digest").alias("start"), F.lit(0).cast("bigint").alias("at"), "digest", *way, "height"), "starts")
    now = None
    for height in range(len(forest.records) - 1, -1, -1):
        begun = known.filter(F.col("height") == height + 1).drop("height")
        now = begun if now is None else now.unionByName(begun)
        if height:
            places = requests.select("grp", F.shiftright("rank", height * forest.levels).alias("at")).distinct()
        else:
            places = requests.select("grp", F.col("rank").alias("at"), *own)
        wanted = places.groupBy("grp", F.shiftright("at", forest.levels).alias("page")).agg(
            F.collect_list(F.struct("at", *(own if not height else []))).alias("wanted")
        )
        met = now.withColumnRenamed("at", "page").join(wanted, ["grp", "page"]).withColumn("shard", F.shiftright("page", _SHARD))
        met = met.join(forest.records[height], ["digest", "shard"])
        now = stored(_descended(met.select(*carried, "digest", *way, "steps", "records", "wanted"), carried), "descended")
    alone = known.filter("height = 0").drop("height", "at").join(requests.withColumnRenamed("rank", "at"), "grp")
    alone = alone.select(*carried, "at", "digest", *way, *own)
    return alone if now is None else now.unionByName(alone)


# ---------------------------------------------------------------- the manifest of a table


@dataclass
class Manifest:
    trees: Forest  # one per group
    top: Forest  # over the groups' roots
    leaves: DataFrame  # (grp, rank, n, digest, ...) with the columns that were given
    groups: DataFrame  # (grp, rank, n, digest): the groups' roots in order
    root: bytes | None  # none for a table without rows


def group_text(value: Column) -> Column:
    """A group's name that sorts by the value's UTF-8 bytes, null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def build_manifest(leaves: DataFrame, order: list[str], levels: int = SEGMENT_LEVELS) -> Manifest:
    """The manifest of ``leaves`` (grp, digest, ...): a tree for each group, by ``order`` and digest, and one over their roots by group.

    Other columns are kept. Equal rows are leaves of their own and share their records. Without rows there
    are no trees and no root.
    """
    ranked = stored(rank_leaves(leaves, order), "ranked")
    trees = build_forest(ranked, levels)
    groups = trees.roots.select(F.lit(TOP).alias("grp"), F.col("grp").alias("name"), "digest")
    groups = stored(rank_leaves(groups, ["name"]), "groups")
    top = build_forest(groups, levels)
    found = top.roots.first()
    return Manifest(trees, top, ranked, groups, bytes(found["digest"]) if found else None)


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """(grp, rank, digest, subroot, path, ...) for requests (grp, rank, ...) of a manifest's leaves.

    ``path`` leads from the leaf up to the root: the sibling at each level, null where there is none, and
    whether it stands on the left.
    """
    none = [F.array().cast("array<binary>").alias("siblings"), F.array().cast("array<boolean>").alias("lefts")]
    start = manifest.top.roots.select("grp", "digest", *none)
    subroots = descend(manifest.top, start, manifest.groups.select("grp", "rank", "name"))
    found = descend(manifest.trees, subroots.select(F.col("name").alias("grp"), "digest", "siblings", "lefts"), requests)
    steps = F.arrays_zip(F.col("siblings").alias("sibling"), F.col("lefts").alias("left"))
    path = F.reverse(steps)
    rest = [c for c in requests.columns if c not in ("grp", "rank")]
    return found.select("grp", F.col("at").alias("rank"), "digest", F.col("start").alias("subroot"), path.alias("path"), *rest)


def proof_digest(path: Column) -> Column:
    """Digest of a path's siblings, from the leaf up."""
    there = F.filter(path, lambda s: s["sibling"].isNotNull())
    return F.sha2(F.array_join(F.transform(there, lambda s: hex_text(s["sibling"])), ""), 256)


def fold_path(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""

    def step(node, s):
        own, other = hex_text(node), F.coalesce(hex_text(s["sibling"]), F.lit(""))
        return F.unhex(F.sha2(F.when(s["left"], F.concat(other, own)).otherwise(F.concat(own, other)), 256))

    return F.aggregate(path, leaf, step)


def document_leaves(docs: DataFrame) -> DataFrame:
    """(grp, doc_id, digest, altered) of documents: grouped by lang; ``altered`` has one character more in n_chars.

    One row per row; null values enter as such, and where n_chars is null nothing can be altered. Only the
    documents whose id's checksum is divisible by seven have an altered digest. Other columns are not looked at.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    return docs.select(
        group_text(F.col("lang")).alias("grp"), "doc_id", leaf_digest(*fields).alias("digest"),
        F.when(chosen, leaf_digest(*more)).alias("altered"),
    )
