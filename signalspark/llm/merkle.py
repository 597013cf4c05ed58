"""Operator 12: a Merkle manifest of documents, and proofs of all its leaves by octopus multiproofs.

*Leaves.*  A document's leaf is the SHA-256 of its fields, each written with its length.  The leaves of a language, by id, are the bottom of
a binary tree; the languages' subroots, by name, are that of the tree whose top is the root.  Node i of a level is the hash of nodes 2i
and 2i + 1 of the level below, or of 2i alone where it is the last.
*Partitions.*  Leaves get their places by sorted ranges (no window over a language), and ``1 << FOLD`` consecutive ones of a language are a
leaf partition.  Each partition derives its own top node, a partition of these the next, and so on: a language of any
size is many tasks.
*Multiproof.*  A partition computes the coordinates of the nodes that any of its leaves' proofs needs and that can't be derived from its
own leaves: level by level, the siblings of known nodes that aren't known.  This minimal union is fetched by one join with the node
table.  Interior nodes that the leaves share are derived once, and each leaf's proof is read off and folded in place.

Nodes are kept as 32 bytes and hashed as lowercase hex, as the manifest defines them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm.common import join_ids, read_table, stored
from signalspark.llm.ranges import placed

#: log2 of the leaves of a partition.
FOLD = 10
#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree of the languages' subroots.
TOP = "top"

NODE = "grp string, block long, level int, idx long, hash binary"


def field(value: Column) -> Column:
    """A field as a leaf holds it: ``-`` for null, else its length in bytes, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(**changed: Column) -> Column:
    """Leaf of a row with the columns ``FIELDS``, some of them replaced."""
    return F.unhex(F.sha2(F.concat(*(field(changed.get(c, F.col(c))) for c in FIELDS)), 256))


def join_hash(nodes: Sequence[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def heights(rows: int) -> int:
    """Levels above the leaves of a tree of ``rows`` leaves."""
    return max(rows - 1, 0).bit_length()


def missing(known: Sequence[int], rows: int) -> list[tuple[int, int]]:
    """Octopus: (level, index) of the nodes that the leaves ``known`` (ascending) need for their proofs and can't derive."""
    out, level = [], 0
    while rows > 1:
        have = set(known)
        out += [(level, i ^ 1) for i in known if i ^ 1 < rows and i ^ 1 not in have]
        known = list(dict.fromkeys(i >> 1 for i in known))
        rows, level = rows + 1 >> 1, level + 1
    return out


def derive(nodes: dict[tuple[int, int], str], known: Sequence[int], rows: int, level: int = 0, upto: int | None = None) -> dict[tuple[int, int], str]:
    """``nodes`` (by level and index) with all nodes above ``known`` of ``level``, which holds ``rows`` nodes, up to a level or the top."""
    while rows > 1 and (upto is None or level < upto):
        known = list(dict.fromkeys(i >> 1 for i in known))
        for i in known:
            if (level + 1, i) not in nodes:
                nodes[level + 1, i] = join_hash([nodes[level, 2 * i], nodes[level, 2 * i + 1]] if 2 * i + 1 < rows else [nodes[level, 2 * i]])
        rows, level = rows + 1 >> 1, level + 1
    return nodes


def path(nodes: dict[tuple[int, int], str], place: int, rows: int) -> list[tuple[bool, str | None]]:
    """From the leaf up: whether the sibling stands left, and its hash (None where a node is alone)."""
    out, level = [], 0
    while rows > 1:
        i = place ^ 1
        out.append((i < place, nodes[level, i] if i < rows else None))
        place, rows, level = place >> 1, rows + 1 >> 1, level + 1
    return out


def fold(leaf: str, steps: Sequence[tuple[bool, str | None]]) -> str:
    for left, other in steps:
        leaf = join_hash([leaf] if other is None else [other, leaf] if left else [leaf, other])
    return leaf


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


_NODES = pa.schema([("grp", pa.string()), ("block", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("hash", pa.binary())])


def _climb(t: pa.Table, level: int, fold_: int) -> pa.Table:
    """One block of nodes of ``level``: what stands above them, up to ``fold_`` levels; of leaves the top only, and their missing coordinates (no hash)."""
    t = t.sort_by("place")
    grp, block, rows = (t.column(c)[0].as_py() for c in ("grp", "block", "group_rows"))
    known = t.column("place").to_pylist()
    nodes = {(level, i): h.hex() for i, h in zip(known, t.column("hash").to_pylist(), strict=True)}
    here = -(-rows >> level)  # nodes of this level, the last of which may stand for fewer leaves
    made = derive(nodes, known, here, level, level + fold_)
    top = max(k for k, _ in made)
    out = [(grp, block, k, i, bytes.fromhex(h)) for (k, i), h in made.items() if (k > level if level else k == top)]
    return _table(_NODES, out + ([(grp, block, k, i, None) for k, i in missing(known, rows)] if level == 0 else []))


def _climbing(level: int, fold_: int) -> Callable[[pa.Table], pa.Table]:
    def climb(t: pa.Table) -> pa.Table:
        return _climb(t, level, fold_)

    return climb


def forest(leaves: DataFrame, name: str, fold_: int) -> tuple[DataFrame, DataFrame]:
    """Node table and wanted coordinates of ``leaves (grp, place, group_rows, hash)``.

    The nodes are those from the tops of the leaf partitions upwards; ``level, idx`` are counted in the tree of a group.
    """
    blocks = lambda rows: rows.select("grp", "place", "group_rows", "hash", F.shiftright("place", fold_).alias("block")).groupBy("grp", "block")
    first = stored(blocks(leaves).applyInArrow(_climbing(0, fold_), NODE), f"{name}-base")
    nodes = first.where("hash is not null").drop("block")
    sizes = stored(leaves.groupBy("grp").agg(F.max("group_rows").alias("group_rows")), f"{name}-sizes")
    largest = sizes.agg(F.max("group_rows")).first()[0] or 0
    tier, level = nodes, fold_
    while heights(largest) > level:
        above = join_ids(tier.where(F.col("level") == level), sizes.where(F.col("group_rows") > 1 << level), "grp", "inner")
        tier = stored(blocks(above.withColumnRenamed("idx", "place")).applyInArrow(_climbing(level, fold_), NODE), f"{name}-tier").drop("block")
        nodes, level = nodes.union(tier), level + fold_
    return nodes, first.where("hash is null").drop("hash")


def fetched(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``grp, block, got``: the nodes that each leaf partition wants, two of a level at most."""
    return wanted.join(nodes.hint("merge"), ["grp", "level", "idx"]).groupBy("grp", "block").agg(F.collect_list(F.struct("level", "idx", "hash")).alias("got"))


@dataclass
class Manifest:
    """``leaves (doc_id, grp, place, group_rows, hash, changed)``; ``nodes (grp, level, idx, hash)`` above the leaf partitions and, as group ``TOP``, of the
    languages; ``wanted``, the partitions' missing coordinates; ``languages (grp, subroot, root, steps)`` with the subroot's own proof; ``fold``, log2 of a leaf partition's leaves."""

    leaves: DataFrame
    nodes: DataFrame
    wanted: DataFrame
    languages: DataFrame
    fold: int


_STEP = pa.struct([("left", pa.bool_()), ("hash", pa.binary())])


def _subroot_paths(own: pa.Table, got: pa.Table) -> pa.Table:
    """Root and proof of each subroot of one block."""
    schema = pa.schema([("grp", pa.string()), ("subroot", pa.binary()), ("root", pa.binary()), ("steps", pa.list_(_STEP))])
    if not own.num_rows:
        return _table(schema, [])
    places, names, hashes = (own.column(c).to_pylist() for c in ("place", "lang_grp", "hash"))
    rows = own.column("group_rows")[0].as_py()
    nodes = _known(places, hashes, got, rows)
    out = []
    for place, name, h in zip(places, names, hashes, strict=True):
        steps = path(nodes, place, rows)
        out.append((name, h, bytes.fromhex(fold(h.hex(), steps)), [{"left": left, "hash": None if o is None else bytes.fromhex(o)} for left, o in steps]))
    return _table(schema, out)


def _known(places: list[int], hashes: list[bytes], got: pa.Table, rows: int) -> dict[tuple[int, int], str]:
    """All nodes that a block can know: its leaves, what it fetched, and what follows from these."""
    nodes = {(0, i): h.hex() for i, h in zip(places, hashes, strict=True)}
    if got.num_rows:
        nodes |= {(x["level"], x["idx"]): x["hash"].hex() for x in got.column("got")[0].as_py() or []}
    return derive(nodes, sorted(places), rows)


def build_manifest(docs: DataFrame, fold_: int = FOLD) -> Manifest:
    """The manifest of ``docs`` with the columns ``FIELDS``; see ``op12_merkle_manifest`` for odd rows."""
    more = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars").cast("decimal(20,0)") + 1)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("grp"),  # sorts as the language does, null first
        leaf_hash().alias("hash"),
        F.when(more.isNotNull(), leaf_hash(n_chars=more)).alias("changed"),
    )
    order = [F.col("grp").asc(), F.col("doc_id").asc_nulls_first(), F.col("hash").asc(), F.col("changed").asc()]
    leaves = placed(stored(rows, "leaves"), order, "leaf-places", "grp")
    nodes, wanted = forest(leaves, "forest", fold_)
    sizes = stored(leaves.groupBy("grp").agg(F.max("group_rows").alias("group_rows")), "language-sizes")
    height = F.when(F.col("group_rows") > 1, F.length(F.bin(F.col("group_rows") - 1))).otherwise(0)
    tops = join_ids(nodes.where("idx = 0"), sizes.withColumn("top", height.cast("int")), "grp", "inner").where("level = top")
    subroots = placed(stored(tops.select(F.lit(TOP).alias("grp"), F.col("grp").alias("lang_grp"), "hash"), "subroots"), [F.col("grp").asc(), F.col("lang_grp").asc()], "subroot-places", "grp")
    top_nodes, top_wanted = forest(subroots, "top-forest", fold_)
    block = F.shiftright("place", fold_).alias("block")
    own = subroots.select("grp", block, "place", "group_rows", "hash", "lang_grp").groupBy("grp", "block")
    languages = own.cogroup(fetched(top_nodes, top_wanted).groupBy("grp", "block")).applyInArrow(_subroot_paths, "grp string, subroot binary, root binary, steps array<struct<left:boolean,hash:binary>>")
    return Manifest(leaves, nodes.union(top_nodes), wanted, stored(languages, "languages"), fold_)


PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_PROOFS = pa.schema([("doc_id", pa.int64()), *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_())])


def _prove(own: pa.Table, got: pa.Table) -> pa.Table:
    """The proofs of one leaf partition, each folded from the leaf as it is now."""
    if not own.num_rows:
        return _table(_PROOFS, [])
    cols = {c: own.column(c).to_pylist() for c in ("doc_id", "place", "hash", "changed")}
    rows = own.column("group_rows")[0].as_py()
    nodes = _known(cols["place"], cols["hash"], got, rows)
    top = got.to_pylist()[0]
    subroot, root = top["subroot"].hex(), top["root"].hex()
    above = [(s["left"], None if s["hash"] is None else s["hash"].hex()) for s in top["steps"]]
    out = []
    for doc, place, leaf, changed in zip(*cols.values(), strict=True):
        steps = path(nodes, place, rows) + above
        folded = fold((changed or leaf).hex(), steps)
        out.append((doc, leaf.hex(), subroot, root, join_hash([h for _, h in steps if h is not None]), folded, folded == root))
    return _table(_PROOFS, out)


def proofs(m: Manifest) -> DataFrame:
    """A row for each leaf: its hash, its tree's tops, the hash of its proof, and what the leaf as it is now folds to."""
    blocks = m.leaves.select("grp", F.shiftright("place", m.fold).alias("block")).distinct()
    need = stored(join_ids(blocks.join(fetched(m.nodes.where(F.col("grp") != TOP), m.wanted).hint("merge"), ["grp", "block"], "left"), m.languages, "grp", "inner"), "need")
    own = m.leaves.withColumn("block", F.shiftright("place", m.fold)).groupBy("grp", "block")
    return own.cogroup(need.groupBy("grp", "block")).applyInArrow(_prove, PROOF)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof against the root of all, after tampering with the count of characters of some.

    Rows that repeat an id are leaves of their own, next to each other by hash; rows without an id stand first in their language and are
    never tampered with; no language is one of its own, before all others.  An empty table gives no rows.  Further columns are ignored.
    """
    return proofs(build_manifest(read_table(spark, sf_dir, "documents")))


#: The same in SQL.  CRC-32 is worked out from a table of its bytes, trees and folds by recursion.
ORACLE = """
WITH RECURSIVE
bits AS (SELECT list(list_reduce(list_prepend(v::BIGINT, list_transform(range(8), lambda k: 0::BIGINT)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY v) AS tab FROM range(256) AS t(v)),
crcs AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), bits),
fields AS (SELECT d.doc_id, coalesce('=' || lang, '') AS grp, n_chars,
    coalesce(octet_length(encode(d.doc_id::VARCHAR)) || ':' || d.doc_id::VARCHAR, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail, coalesce(crc % 7 = 0, false) AS hit
  FROM documents d LEFT JOIN crcs c ON d.doc_id = c.doc_id),
leaves AS (SELECT doc_id, grp, sha256(head || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars::VARCHAR, '-') || tail) AS leaf,
    sha256(head || coalesce(octet_length(encode((n_chars::HUGEINT + CASE WHEN hit THEN 1 ELSE 0 END)::VARCHAR)) || ':' || (n_chars::HUGEINT + CASE WHEN hit THEN 1 ELSE 0 END)::VARCHAR, '-') || tail) AS now
  FROM fields),
placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, now) - 1 AS place, count(*) OVER (PARTITION BY grp) AS n FROM leaves),
tree(grp, level, idx, hash, n) AS (
  SELECT grp, 0, place, leaf, n FROM placed
  UNION ALL SELECT grp, level + 1, idx // 2, sha256(string_agg(hash, '' ORDER BY idx)), (any_value(n) + 1) // 2 FROM tree WHERE n > 1 GROUP BY grp, level, idx // 2),
subs AS (SELECT grp, hash AS subroot, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1),
top(level, idx, hash, n) AS (
  SELECT 0, place, subroot, n FROM subs
  UNION ALL SELECT level + 1, idx // 2, sha256(string_agg(hash, '' ORDER BY idx)), (any_value(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY level, idx // 2),
allnodes AS (SELECT 0 AS tier, grp, level, idx, hash, n FROM tree UNION ALL SELECT 1, '', level, idx, hash, n FROM top),
walk(doc_id, leaf, lang, tier, grp, level, place, own, now, proof) AS (
  SELECT doc_id, leaf, grp, 0, grp, 0, place, leaf, now, '' FROM placed
  UNION ALL
  SELECT w.doc_id, w.leaf, w.lang, CASE WHEN a.n = 1 THEN 1 ELSE w.tier END, CASE WHEN a.n = 1 THEN '' ELSE w.grp END, CASE WHEN a.n = 1 THEN 0 ELSE w.level + 1 END,
    CASE WHEN a.n = 1 THEN q.place ELSE w.place // 2 END,
    CASE WHEN a.n = 1 THEN w.own WHEN w.place % 2 = 1 THEN sha256(s.hash || w.own) ELSE sha256(w.own || coalesce(s.hash, '')) END,
    CASE WHEN a.n = 1 THEN w.now WHEN w.place % 2 = 1 THEN sha256(s.hash || w.now) ELSE sha256(w.now || coalesce(s.hash, '')) END,
    CASE WHEN a.n = 1 THEN w.proof ELSE w.proof || coalesce(s.hash, '') END
  FROM walk w JOIN allnodes a ON a.tier = w.tier AND a.grp = w.grp AND a.level = w.level AND a.idx = w.place
  LEFT JOIN allnodes s ON s.tier = w.tier AND s.grp = w.grp AND s.level = w.level AND s.idx = xor(w.place, 1)
  JOIN subs q ON q.grp = w.lang
  WHERE NOT (w.tier = 1 AND a.n = 1))
SELECT w.doc_id, w.leaf, q.subroot, t.hash AS root, sha256(w.proof) AS proof_sha256, w.now AS folded_root, w.now = t.hash AS verified
FROM walk w JOIN subs q ON q.grp = w.lang, (SELECT hash FROM top WHERE n = 1) t, (SELECT max(level) AS height FROM top) h
WHERE w.tier = 1 AND w.level = h.height
"""
