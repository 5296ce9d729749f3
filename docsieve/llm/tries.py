"""Prefix trie of conversations by smallest-member ownership.

Every conversation is a path of turns; a node is a distinct sequence of first turns, and its
members are the conversations that start with it.  A node belongs to its smallest member.
Members only become fewer on the way down, so what a conversation owns is the end of its
path: all nodes from some depth on.  A sum over a subtree is therefore a sum over members:
each brings the tokens of its path below the node, less those it owns, as an owner's
tokens are the ones kept.  One grouping by node gives members, children, leaves and savings.

Steps, all on rows of a few numbers (texts are digested in the scan and never shuffled):

1. Turns are sorted by range of (conversation, turn, digest), so that a conversation of any
   length spreads over tasks; counts per conversation and range give every turn its place.
2. Paths: the first turns of the head conversation (at most ``CYCLE`` - 1), then own ones.
3. A node's key is its depth and 128 bits, the exclusive or of its turns' digests, each mixed
   with its place.  Windows over blocks of ``BLOCK`` turns of a path, shifted by the blocks
   before, give keys and token sums; no window holds more than one block.
4. A grouping by node finds its smallest member (as a grouped minimum, not a window, which
   would hold all conversations that share the node in one task), a grouping by owner the
   depth from which it owns.  Copied to the path's blocks this meets the turns again, and
   the prefix grouping sums up.

Member ids for ``ends`` are sorted and written out in parallel; a digest cannot be divided, so
the packs of one node are hashed by one task as they stream by, none kept.

Defined cases: rows without conv_id belong to no conversation; a null role or text is empty;
turns come by number (null first), equal ones by the MD5 digest of role and text, so rows
repeated in full are turns of their own; a conversation that lacks its head has its own
later turns only; no conversations, no nodes; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import discard, input_bytes, keyed, materialise, partitions_for, read_table

#: Conversations of one head, and the number that the turns taken from it stay below.
HEADS, CYCLE = 5, 9
BLOCK = 1024
_EMPTY = hashlib.sha256(b"").hexdigest()


def head_turns(conv: Column) -> Column:
    """How many turns come from the head conversation."""
    return (F.crc32(conv.cast("string").cast("binary")) % CYCLE).cast("long")


def head_of(conv: Column) -> Column:
    return conv - conv % HEADS


def _turns(rows: DataFrame) -> DataFrame:
    """conv, digest, tokens, part and row: sorted turns, numbered inside each sorted part; written."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    small = rows.where("conv is not null").select("conv", "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("tokens"), F.rand(1).alias("salt"))
    n = partitions_for(rows.sparkSession, input_bytes(small))
    keys = ["conv", "turn", "digest", "salt"]  # the salt only spreads rows that are equal
    spread = small.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    return materialise(spread.select("conv", "digest", "tokens", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("row")), "trie-turns")


def paths(conversations: DataFrame) -> DataFrame:
    """conv, pos (from 1), digest and tokens of the turns of every rebuilt conversation, and pos 0 for the root; written.

    ``conversations`` holds conv, turn, role and text."""
    turns = _turns(conversations)
    parts = turns.groupBy("conv", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    whole = Window.partitionBy("conv")  # a row for each range that the conversation touches
    parts = parts.select("*", F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("size"))
    parts = materialise(parts, "trie-parts")
    convs = parts.where("before = 0").select("conv", "size", head_of(F.col("conv")).alias("head"), head_turns(F.col("conv")).alias("h"))
    sizes = convs.select(F.col("conv").alias("head"), F.col("size").alias("head_size"))
    convs = convs.join(sizes, "head", "left").withColumn("taken", F.least("h", F.coalesce("head_size", F.lit(0)))).drop("head_size")
    convs = materialise(convs, "trie-convs")
    placed = turns.join(parts.select("conv", "part", (F.col("before") - F.col("first") + 1).alias("shift")), ["conv", "part"]).select("conv", "part", (F.col("row") + F.col("shift")).alias("own"), "digest", "tokens")
    # The first turns of heads: at most CYCLE - 1 rows of each.
    first = placed.where((F.col("own") < CYCLE) & (head_of(F.col("conv")) == F.col("conv"))).select(F.col("conv").alias("head"), F.col("own").alias("pos"), "digest", "tokens")
    lent = convs.where("taken > 0").select("conv", "head", "taken").join(first, "head").where("pos <= taken").select("conv", "pos", "digest", "tokens")
    shift = parts.join(convs.select("conv", "h", "taken"), "conv").select("conv", "part", "h", "taken")
    kept = placed.join(shift, ["conv", "part"]).where("own > h").select("conv", (F.col("own") - F.col("h") + F.col("taken")).alias("pos"), "digest", "tokens")
    root = convs.select("conv", F.lit(0).cast("long").alias("pos"), F.lit(b"").alias("digest"), F.lit(0).cast("long").alias("tokens"))
    out = materialise(root.unionByName(lent).unionByName(kept), "trie-paths")
    discard(turns, parts, convs)
    return out


def nodes_of(path: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv, block, pos, x, y (the node's key), tokens of its last turn, before (tokens above it) and last (whether the path ends); written."""
    cut = F.expr(f"pos div {block}")
    mixed = path.select("conv", cut.alias("block"), "pos", "tokens", F.xxhash64(F.lit(1), "pos", "digest").alias("mx"), F.xxhash64(F.lit(2), "pos", "digest").alias("my"))
    blocks = mixed.groupBy("conv", "block").agg(F.bit_xor("mx").alias("bx"), F.bit_xor("my").alias("by"), F.sum("tokens").alias("bt"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.lead("block").over(Window.partitionBy("conv").orderBy("block")).isNull()
    blocks = blocks.select("conv", "block", last.alias("end"), *[F.coalesce(f(c).over(earlier), F.lit(0)).alias(c) for f, c in ((F.bit_xor, "bx"), (F.bit_xor, "by"), (F.sum, "bt"))])
    inside = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    run = mixed.select("conv", "block", "pos", "tokens", F.bit_xor("mx").over(inside).alias("ix"), F.bit_xor("my").over(inside).alias("iy"), (F.sum("tokens").over(inside) - F.col("tokens")).alias("it"), F.lead("pos").over(Window.partitionBy("conv", "block").orderBy("pos")).isNull().alias("stop"))
    met = run.join(blocks, ["conv", "block"])
    out = met.select("conv", "block", "pos", F.col("ix").bitwiseXOR(F.col("bx")).alias("x"), F.col("iy").bitwiseXOR(F.col("by")).alias("y"), "tokens", (F.col("it") + F.col("bt")).alias("before"), (F.col("stop") & F.col("end")).alias("last"))
    return materialise(out, "trie-nodes")


KEY = ["pos", "x", "y"]


def ends(found: DataFrame) -> DataFrame:
    """key and ends_sha256 of nodes at which paths end: ids in order, hashed as they come.

    Ids are sorted by range, so those of one node spread over tasks, which write them out in packs of
    ``PACK`` bytes; only the packs of a node meet, to be hashed one after the other."""
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = found.where("last").select(*KEY, "conv").repartitionByRange(n, *KEY, "conv").sortWithinPartitions(*KEY, "conv")
    packs = ids.mapInArrow(_packed(PACK), "pos long, x long, y long, first long, ids binary")
    return packs.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_hashed, "pos long, x long, y long, ends_sha256 string")


def _packed(most: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, size, out = None, None, [], 0, []

        def flush() -> None:
            nonlocal ids, size
            if ids:
                out.append((*key, first, b",".join(ids)))
            ids, size = [], 0

        for batch in it:
            for *now, conv in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if now != key or size >= most:
                    flush()
                    key, first = now, conv
                ids.append(b"%d" % conv)
                size += len(ids[-1]) + 1
            if len(out) >= 1000:
                yield _batch(out, _PACKS)
                out.clear()
        flush()
        if out:
            yield _batch(out, _PACKS)

    return run


def _hashed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest = None, None
    for batch in it:
        out = []
        for *now, _, ids in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if now == key:
                digest.update(b",")
            else:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = now, hashlib.sha256()
            digest.update(ids)
        if out:
            yield _batch(out, _DIGESTS)
    if key is not None:
        yield _batch([(*key, digest.hexdigest())], _DIGESTS)


#: Bytes of member ids written as one row.
PACK = 1 << 16
_KEY_TYPES = [(k, pa.int64()) for k in KEY]
_PACKS = pa.schema([*_KEY_TYPES, ("first", pa.int64()), ("ids", pa.binary())])
_DIGESTS = pa.schema([*_KEY_TYPES, ("ends_sha256", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK) -> DataFrame:
    """A row per node: conv_id (its owner), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    given = keyed(conversations, conv_id, turn, role, text).toDF("conv", "turn", "role", "text").withColumn("conv", F.col("conv").cast("long"))
    path = paths(given)
    found = nodes_of(path, block)
    owners = found.groupBy(*KEY).agg(F.min("conv").alias("owner"), F.max(~F.col("last")).alias("goes_on"), F.min("before").alias("before"))
    owners = materialise(owners, "trie-owners")
    # From which depth on a conversation owns its path, what it has said above, and whether it ends in a leaf.
    own = owners.groupBy(F.col("owner").alias("conv")).agg(F.min(F.struct("pos", "before")).alias("top"), F.max(~F.col("goes_on")).alias("leaf"))
    length = found.where("last").select("conv", (F.col("before") + F.col("tokens")).alias("all"), (F.col("pos") + 1).alias("beyond"))
    own = length.join(own, "conv", "left").select("conv", F.coalesce("top.pos", "beyond").alias("since"), F.coalesce("top.before", "all").alias("above"), F.coalesce("leaf", F.lit(False)).alias("leaf"))
    touched = found.groupBy("conv", "block").agg(F.lit(1)).select("conv", "block")
    met = found.join(touched.join(own, "conv"), ["conv", "block"])
    met = materialise(met.select("conv", *KEY, "since", "leaf", "last", F.greatest(F.col("above") - F.col("before"), F.lit(0)).alias("shared"), "tokens"), "trie-marks")
    child = ~F.col("last") & (F.col("pos") + 1 >= F.col("since"))
    # tokens of occurrences below the node or at it, less those that the members own
    nodes = met.groupBy(*KEY).agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if(child).alias("n_children"), F.count_if("leaf").alias("n_leaves"), F.sum("shared").alias("saved_tokens"))
    branch = met.where("pos = since - 1").select(*KEY, F.col("conv").alias("child"))
    above = branch.join(owners.select(*KEY, "owner"), KEY).select(F.col("child").alias("conv_id"), (F.col("pos") + 1).alias("pos"), "owner")
    nodes = nodes.join(ends(met), KEY, "left").join(above, ["conv_id", "pos"], "left")
    parent = F.when(F.col("pos") == 0, F.lit(None)).otherwise(F.coalesce("owner", "conv_id"))
    return nodes.select("conv_id", F.col("pos").alias("depth"), parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))


def op13(spark, sf_dir: str) -> DataFrame:
    """Query over all of ``conversations``."""
    return trie(read_table(spark, sf_dir, "conversations"))


#: CRC-32 bit by bit: each byte is followed by seven zeros, and every element shifts once.
_CRC = "xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(cast(c as varchar), ''), lambda s: [ascii(s)::bigint, 0, 0, 0, 0, 0, 0, 0]))), lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1))), 4294967295)"

SQL = f"""
with turns as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as own
  from conversations where conv_id is not null),
sized as (select c, count(*) as size from turns group by c),
convs as (select c, size, c - c % 5 as head, {_CRC} % 9 as h from sized),
taken as (select v.c, v.h, v.head, least(v.h, coalesce(b.size, 0)) as taken from convs v left join sized b on b.c = v.head),
path as (
  select v.c, t.own as pos, t.role, t.text from taken v join turns t on t.c = v.head and t.own <= v.h
  union all select v.c, t.own - v.h + v.taken, t.role, t.text from taken v join turns t on t.c = v.c and t.own > v.h),
occ as (
  select c, 0 as pos, '' as key, 0 as bytes from convs
  union all select c, pos, string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') over (partition by c order by pos), strlen(text) from path),
deep as (select c, max(pos) as depth from occ group by c),
node as (
  select o.pos, o.key, min(o.c) as owner, count(*) as n, min(o.bytes) as bytes, max(d.depth) as deepest,
         sha256(coalesce(string_agg(cast(o.c as varchar), ',' order by o.c) filter (where d.depth = o.pos), '')) as ends
  from occ o join deep d using (c) group by o.pos, o.key),
under as (  -- every node once below each node on its owner's path
  select a.pos, a.key, sum((u.n - 1) * u.bytes) as saved, count(*) filter (where u.deepest = u.pos) as leaves, count(*) filter (where u.pos = a.pos + 1) as children, min(u.owner) as owner
  from node u join occ a on a.c = u.owner and a.pos <= u.pos group by a.pos, a.key),
up as (select u.pos, u.key, a.key as parent_key from node u join occ a on a.c = u.owner and a.pos = u.pos - 1)
select n.owner as conv_id, cast(n.pos as bigint) as depth, p.owner as parent_conv_id, n.n as n_convs, w.children as n_children, w.leaves as n_leaves,
       cast(w.saved as bigint) as saved_tokens, n.ends as ends_sha256
from node n join under w using (pos, key) left join up using (pos, key) left join node p on p.pos = n.pos - 1 and p.key = up.parent_key"""
