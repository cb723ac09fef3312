"""Operator 11, Merkle dataset manifest: sibling-shift self-joins.

Every row becomes a leaf hash. The leaves of a group, in the order of their ids, are
the lowest level of its tree. At each level a node computes the indices of its
siblings (XOR with one for binary trees, slot offsets in its run otherwise) and an
equijoin of the level with itself brings their digests; the node in slot zero of a run
then emits the parent. The last nodes of all groups, in the order of the groups, are
the leaves of one more tree, whose last node is the root of the dataset. A run of one
still becomes a node of its own; a tree of one leaf is that leaf.

Proofs are read off on the way down: each level joins its families to the paths of
their parents, so a path is put together once per family, not once per row. A row's
leaf, folded along its path, must give the root.

No text passes a shuffle, digests travel as 32 bytes, and the places of the leaves come
from a range sort (``placing``), so that one group may hold nearly all rows. The driver
sees one number per tree (its largest group) and the root.

Defined cases: null columns are written ``-``, null ids sort before all others, and a
null group is a group before all others; rows of one id follow each other in the order
of their leaf hashes, equal rows are leaves of their own; an empty table gives no rows.
Extra columns are not read. ``tampered_col`` (a column with the text of a changed row,
null where a row is not to be changed) is only there to try proofs out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, query, read_columns
from .placing import placed

ARITY = 8


def field(c: str | Column) -> Column:
    """A value as ``byte count:value``, or ``-`` for null."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: str | Column) -> Column:
    """Hash of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*(field(v) for v in values)), 256))


def as_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def sibling_indices(idx: Column, n: Column, arity: int) -> Column:
    """The places of the other nodes in the run of a node, where they exist."""
    if arity == 2:
        near = F.array(idx.bitwiseXOR(F.lit(1)))
    else:
        slot = idx % arity
        near = F.array(*(idx - slot + (slot + off) % arity for off in range(1, arity)))
    return F.filter(near, lambda i: i < n)


def _families(nodes: DataFrame, arity: int) -> DataFrame:
    """``tree, idx, n, digest`` with ``left`` and ``right``: the siblings' digests on either side, joined."""
    # Each node asks for its own place too, so that no second join is needed for its digest.
    asked = F.concat(F.array("idx"), sibling_indices(F.col("idx"), F.col("n"), arity))
    wants = nodes.select("tree", "idx", "n", F.explode(asked).alias("asked"))
    has = nodes.select(F.col("tree").alias("t"), F.col("idx").alias("i"), F.col("digest").alias("d"))
    met = wants.join(has, (F.col("tree") == F.col("t")) & (F.col("asked") == F.col("i")))
    runs = met.groupBy("tree", "idx", "n").agg(F.array_sort(F.collect_list(F.struct("i", "d"))).alias("run"))

    def joined(keep) -> Column:
        return F.unhex(F.array_join(F.transform(F.filter("run", keep), lambda x: F.hex(x["d"])), ""))

    idx = F.col("idx")
    return runs.select(
        "tree", "idx", "n", joined(lambda x: x["i"] == idx).alias("digest"),
        joined(lambda x: x["i"] < idx).alias("left"), joined(lambda x: x["i"] > idx).alias("right"))


def _grow(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Families of each level from the lowest, and the lone nodes ``tree, idx, digest`` found at each level."""
    levels, lone = [], []
    width = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        lone.append(nodes.where("n = 1").select("tree", "idx", "digest"))
        if width <= 1:
            return levels, lone
        families = kept(_families(nodes.where("n > 1"), arity), "families")
        levels.append(families)
        nodes = families.where(F.col("idx") % arity == 0).select(
            "tree", F.floor(F.col("idx") / arity).alias("idx"), F.ceil(F.col("n") / arity).alias("n"),
            F.unhex(F.sha2(F.concat(as_text(F.col("digest")), as_text(F.col("right"))), 256)).alias("digest"))
        width = -(-width // arity)


def _paths(levels: list[DataFrame], lone: list[DataFrame], upper: DataFrame, arity: int) -> DataFrame:
    """``tree, idx, path, top`` of the lowest nodes; ``upper`` has ``tree, path, top`` above each tree."""
    def ended(k: int) -> DataFrame:
        return lone[k].select("tree", "idx").join(upper, "tree").select("tree", "idx", "path", "top")

    paths = ended(len(levels))
    for k in range(len(levels) - 1, -1, -1):
        above = paths.select(F.col("tree").alias("t"), F.col("idx").alias("i"), F.col("path").alias("rest"), "top")
        here = levels[k].join(above, (F.col("tree") == F.col("t")) & (F.floor(F.col("idx") / arity) == F.col("i")))
        paths = here.select(
            "tree", "idx", F.concat(F.array(F.struct("left", "right")), "rest").alias("path"), "top").union(ended(k))
    return paths


def manifest(rows: DataFrame, group_col: str, id_col: str, leaf_col: str, arity: int = ARITY) -> DataFrame:
    """``rows`` with ``subroot``, ``root`` (32 bytes) and ``path`` (siblings left and right, from the leaf up).

    ``rows`` should carry hashes and ids, not texts: they are sorted and shuffled.
    """
    # Null sorts before all names, also where names are compared bytewise.
    named = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-")).alias("tree"),
        F.col(id_col).alias("id"), F.col(leaf_col).alias("digest"), F.struct(*rows.columns).alias("row"))
    leaves = kept(placed(named, ["tree"], ["id", "digest"], "leaves"), "placed-leaves")
    levels, lone = _grow(leaves.select("tree", "idx", "n", "digest"), arity)
    subroots = lone[0].withColumn("level", F.lit(0))
    for k, more in enumerate(lone[1:], 1):
        subroots = subroots.union(more.withColumn("level", F.lit(k)))
    subroots = kept(
        placed(subroots.select(F.lit("").alias("all"), F.col("tree").alias("name"), "digest"), ["all"], ["name"], "subroots"), "placed-subroots")
    top_levels, top_lone = _grow(subroots.select(F.col("all").alias("tree"), "idx", "n", "digest"), arity)
    root = top_lone[0]
    for more in top_lone[1:]:
        root = root.union(more)
    found = root.select("digest").first()
    root_digest = F.lit(bytes(found[0]) if found else None).cast("binary")
    no_steps = F.array().cast("array<struct<left:binary,right:binary>>")
    whole = _paths(
        top_levels, top_lone, root.select("tree", no_steps.alias("path"), F.lit(None).cast("binary").alias("top")), arity)
    upper = kept(
        subroots.join(whole.select("idx", "path"), "idx").select(
            F.col("name").alias("tree"), "path", F.col("digest").alias("top")), "upper-paths")
    paths = _paths(levels, lone, upper, arity).select(
        F.col("tree").alias("t"), F.col("idx").alias("i"), "path", F.col("top").alias("subroot"))
    return leaves.join(paths, (F.col("tree") == F.col("t")) & (F.col("idx") == F.col("i"))).select(
        "row.*", "subroot", root_digest.alias("root"), "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path give, as hexadecimal text."""
    return F.aggregate(path, as_text(leaf), lambda acc, s: F.sha2(F.concat(as_text(s["left"]), acc, as_text(s["right"])), 256))


def proof_hash(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(as_text(s["left"]), as_text(s["right"]))), ""), 256)


def verified_manifest(
    docs: DataFrame, columns: list[str], group_col: str, id_col: str, text_col: str, tampered_col: Column, arity: int = ARITY,
) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` per row, all as hexadecimal text."""
    changed = F.when(
        tampered_col.isNotNull(), leaf_hash(*(tampered_col if c == text_col else c for c in columns)))
    hashed = docs.select(
        F.col(group_col).alias("group"), F.col(id_col).alias("id"), leaf_hash(*columns).alias("leaf"), changed.alias("other"))
    proven = manifest(hashed, "group", "id", "leaf", arity)
    fold = folded(F.coalesce("other", "leaf"), F.col("path"))
    return proven.select(
        "id", as_text(F.col("leaf")).alias("leaf"), as_text(F.col("subroot")).alias("subroot"),
        as_text(F.col("root")).alias("root"), proof_hash(F.col("path")).alias("proof_sha256"), fold.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP11_SQL = f"""
with recursive bits as (
  select i, i as c, 0 as k from range(256) t(i)
  union all
  select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8),
crc as (select list(c order by i) as t from bits where k = 8),
d as (
  select doc_id, coalesce('=' || lang, '-') as tree, text,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head,
    doc_id is not null and xor(list_reduce([4294967295] || list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0 as tampered
  from documents, crc),
h as (
  select doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    case when tampered then sha256(head || coalesce(strlen(text) || ':' || translate(text, '{UPPER}', '{LOWER}'), '-')) end as other
  from d),
leaf as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by tree) as n from h),
low as (
  select 0 as lvl, tree, idx, n, leaf as digest from leaf
  union all
  select any_value(lvl) + 1, tree, idx // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' order by idx))
  from low where n > 1 group by tree, idx // 8),
sub as (
  select tree, digest as subroot, row_number() over (order by tree) - 1 as idx, count(*) over () as n from low where n = 1),
top as (
  select 0 as lvl, idx, n, subroot as digest from sub
  union all
  select any_value(lvl) + 1, idx // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' order by idx))
  from top where n > 1 group by idx // 8),
low_path as (
  select a.tree, a.lvl, a.idx, coalesce(string_agg(b.digest, '' order by b.idx) filter (b.idx < a.idx), '') as l,
    coalesce(string_agg(b.digest, '' order by b.idx) filter (b.idx > a.idx), '') as r
  from low a join low b on a.tree = b.tree and a.lvl = b.lvl and a.idx // 8 = b.idx // 8 where a.n > 1 group by all),
top_path as (
  select a.lvl, a.idx, coalesce(string_agg(b.digest, '' order by b.idx) filter (b.idx < a.idx), '') as l,
    coalesce(string_agg(b.digest, '' order by b.idx) filter (b.idx > a.idx), '') as r
  from top a join top b on a.lvl = b.lvl and a.idx // 8 = b.idx // 8 where a.n > 1 group by all),
deep as (select tree, max(lvl) as deep from low group by tree),
doc as (
  select leaf.*, subroot, deep, sub.idx as pos, row_number() over () as id from leaf join sub using (tree) join deep using (tree)),
fold as (
  select id, 0 as step, tree, idx, pos, deep, coalesce(other, leaf) as cur, '' as proof from doc
  union all
  select id, step + 1, f.tree, f.idx, pos, deep, sha256(coalesce(p.l, q.l) || cur || coalesce(p.r, q.r)), proof || coalesce(p.l || p.r, q.l || q.r)
  from fold f
  left join low_path p on step < deep and p.tree = f.tree and p.lvl = step and p.idx = f.idx // (8 ** step)::bigint
  left join top_path q on step >= deep and q.lvl = step - deep and q.idx = pos // (8 ** greatest(step - deep, 0))::bigint
  where coalesce(p.l, q.l) is not null),
done as (select id, arg_max(cur, step) as folded_root, sha256(arg_max(proof, step)) as proof_sha256 from fold group by id)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified
from doc join done using (id), (select digest as root from top where n = 1)
"""


@query("op11_merkle", OP11_SQL)
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_columns(spark, sf_dir, "documents", doc_id="long", source="string", lang="string", n_chars="long", text="string")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", UPPER, LOWER))
    proven = verified_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", "text", tampered)
    return proven.withColumnRenamed("id", "doc_id")
