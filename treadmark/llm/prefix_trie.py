"""Conversation prefix trie: which conversations begin alike, and what sharing those beginnings saves.

Every prefix of a conversation has a digest.  A count-min sketch of all digests screens them: where one of its estimates
is one, the prefix is a conversation's own, and so is all that follows it, whose nodes the conversation emits by itself.
Only prefixes that may be shared are shuffled and grouped exactly.

What a node sums over its subtree needs no walk over levels.  Each node belongs to its smallest member; what a conversation
owns from a depth on is a running sum along it, and a node's subtree holds what its members own from its depth on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from treadmark.llm.common import only, table
from treadmark.operators.position import with_position
from treadmark.session import durable

#: Conversations whose ids agree but for the last two digits begin with up to HEADS - 1 turns of the first of them.
FAMILY, HEADS = 100, 6
#: Turns of one conversation that one task handles together.
BLOCK = 4096
#: Cells in a row of the sketch, by powers of two: eight for each prefix, within these bounds.  The largest sketch that is
#: broadcast takes 32 MB.  With more prefixes fewer are proven to be alone, and more are grouped; the result is the same.
LEAST_CELLS, MOST_CELLS = 1 << 15, 1 << 27
BITS = 32_768  # of one piece of Spark's bitmaps
#: A node with more than this part of all children is looked up by broadcast; there are fewer than so many of them.
HOT = 1000
#: Ids in one piece of a node's list.
IDS = 1024
KEY = ["depth", "p1", "p2"]
#: SHA-256 of nothing.
EMPTY = hashlib.sha256().hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """c, position, digest, size of every turn; positions number all turns of the table by conversation and turn."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    of_text = F.sha2(text.cast("binary"), 256)
    digest = F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, of_text).cast("binary"), 256)
    named = only(conversations, "conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL")
    cut = named.select(
        F.col("conv_id").cast("long").alias("c"), "turn", role.alias("role"), of_text.alias("of_text"), digest.alias("digest"), F.length(text).cast("long").alias("size")
    )
    cut = durable(cut.withColumn("row", F.monotonically_increasing_id()), "turns")
    placed = with_position(cut, [F.col("c"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("of_text"), F.col("row")])
    return placed.select("c", "position", "digest", "size")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns (c, depth, digest, size, last) of the conversations as they are rebuilt, and the conversations (c, last).

    A conversation takes the first h turns of the first of its family, h being its id's CRC-32 modulo HEADS, and goes
    on with its own turns after its first h.
    """
    placed = turns_of(conversations)
    own = durable(placed.groupBy("c").agg(F.min("position").alias("start"), F.count("*").alias("n")), "conversations")
    first = own.select(F.col("c").alias("family"), F.col("n").alias("n_first"))
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % HEADS).cast("long")
    known = own.withColumn("family", F.col("c") - F.col("c") % FAMILY).join(first, "family", "left").withColumn("h", h)
    known = known.withColumn("taken", F.least("h", F.coalesce("n_first", F.lit(0)).cast("long")))
    known = durable(known.withColumn("last", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).drop("n_first"), "rebuilt")
    numbered = placed.join(known, "c").withColumn("i", F.col("position") - F.col("start") + 1)
    numbered = durable(numbered.select("c", "i", "h", "taken", "last", "digest", "size"), "numbered")
    after = numbered.filter("i > h").select("c", (F.col("i") - F.col("h") + F.col("taken")).alias("depth"), "digest", "size", "last")
    heads = numbered.filter(F.col("i") < HEADS).select(F.col("c").alias("family"), "i", "digest", "size")
    before = known.filter("taken > 0").select("family", "c", "taken", "last").join(heads, "family").filter("i <= taken")
    return after.union(before.select("c", F.col("i").alias("depth"), "digest", "size", "last")), known.select("c", "last")


def _running(rows: DataFrame, sums: dict[str, str], over: str, backward: bool = False) -> DataFrame:
    """``rows`` (c, depth, ...) with running aggregates along each conversation; ``sums`` names them and their inputs.

    ``over`` is sum or bit_xor.  A conversation's turns are cut into blocks, so that none, however long, is one task's.
    """
    add = (lambda a, b: a + b) if over == "sum" else (lambda a, b: a.bitwiseXOR(b))
    take = F.sum if over == "sum" else F.bit_xor
    order = F.col("depth").desc() if backward else F.col("depth").asc()
    cut = rows.withColumn("block", F.expr(f"depth div {BLOCK}"))
    inside = W.partitionBy("c", "block").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = cut.select("*", *(take(x).over(inside).alias(name) for name, x in sums.items()))
    whole = cut.groupBy("c", "block").agg(*(take(x).alias(name) for name, x in sums.items()))
    far = W.partitionBy("c").orderBy(F.col("block").desc() if backward else F.col("block").asc()).rowsBetween(W.unboundedPreceding, -1)
    earlier = whole.select("c", "block", *(take(name).over(far).alias(f"{name}_before") for name in sums))
    earlier = earlier.filter(F.coalesce(*(F.col(f"{name}_before") for name in sums)).isNotNull())
    out = out.join(earlier, ["c", "block"], "left")
    zero = F.lit(0).cast("long")
    return out.select(*rows.columns, *(add(F.col(name), F.coalesce(f"{name}_before", zero)).alias(name) for name in sums))


def prefixes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """c, last, depth, size of every prefix of every conversation, its digest (p1, p2), and that of the prefix before it (q1, q2).

    The digest joins, by exclusive or, 120 bits of a SHA-256 of each place with its turn, so the blocks of a long
    conversation are digested side by side.  The textless root is everyone's prefix at depth 0.
    """
    placed = F.sha2(F.concat_ws(":", F.col("depth").cast("string"), F.col("digest")).cast("binary"), 256)
    bits = lambda at: F.conv(F.substring(F.col("placed"), at, 15), 16, 10).cast("long")
    terms = turns.withColumn("placed", placed).select("c", "last", "depth", "size", bits(1).alias("e1"), bits(16).alias("e2"))
    scanned = _running(terms, {"p1": "e1", "p2": "e2"}, "bit_xor")
    inner = scanned.select(
        "c", "last", "depth", "size", "p1", "p2", F.col("p1").bitwiseXOR(F.col("e1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("e2")).alias("q2")
    )
    zero = F.lit(0).cast("long")
    root = conversations.select("c", "last", zero.alias("depth"), zero.alias("size"), zero.alias("p1"), zero.alias("p2"), zero.alias("q1"), zero.alias("q2"))
    return inner.union(root)


def cells_for(prefix_count: int) -> int:
    want = 1 << max(0, 8 * prefix_count - 1).bit_length()
    return min(MOST_CELLS, max(LEAST_CELLS, want))


def alone(found: DataFrame, cells: int) -> DataFrame:
    """``found`` with ``alone``: whether a row of the count-min sketch of all digests estimates this prefix as one.

    The sketch has two rows, whose cells are the digests' halves.  Of its counts only "is it one" matters, so what is
    broadcast is one bit for each cell.
    """
    each = F.array(*(F.struct(F.lit(r).alias("r"), F.pmod(F.col(p), F.lit(cells)).alias("cell")) for r, p in enumerate(("p1", "p2"))))
    counts = found.select(F.explode(each).alias("x")).groupBy("x.r", "x.cell").agg(F.count("*").alias("n"))
    piece, place = F.expr(f"cell div {BITS}"), F.expr(f"cell % {BITS}")
    ones = counts.filter("n = 1").groupBy("r", piece.alias("piece")).agg(F.bitmap_construct_agg(place).alias("bits"))
    ones = durable(ones, "sketch")
    out = found
    for r, p in enumerate(("p1", "p2")):
        bits = ones.filter(F.col("r") == r).select(F.col("piece").alias(f"piece{r}"), F.col("bits").alias(f"bits{r}"))
        out = out.withColumn("cell", F.pmod(F.col(p), F.lit(cells))).join(F.broadcast(bits), piece == F.col(f"piece{r}"), "left")
        byte = F.conv(F.hex(F.substring(f"bits{r}", F.expr(f"CAST(cell % {BITS} div 8 + 1 AS INT)"), F.lit(1))), 16, 10).cast("int")
        one = F.expr("CAST(cell % 8 AS INT)")
        out = out.withColumn(f"one{r}", F.coalesce(F.call_function("shiftright", byte, one).bitwiseAND(F.lit(1)) == 1, F.lit(False)))
    return out.select(*found.columns, (F.col("one0") | F.col("one1")).alias("alone"))


def _hashed(lists: DataFrame) -> DataFrame:
    """KEY and ends of nodes whose id lists (KEY, piece, ids) have several pieces; they stream through the digest one by one."""
    schema = pa.schema([(k, pa.int64()) for k in KEY] + [("ends", pa.string())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in now), pa.array([state.hexdigest()])], schema=schema)

        for batch in batches:
            keys = zip(*(batch.column(batch.schema.get_field_index(k)).to_pylist() for k in KEY), strict=True)
            ids = batch.column(batch.schema.get_field_index("ids"))
            for key, part in zip(keys, ids, strict=True):
                if key != now:
                    if now is not None:
                        yield done()
                    now, state = key, hashlib.sha256(part.as_py().encode())
                else:
                    state.update(b"," + part.as_py().encode())
        if now is not None:
            yield done()

    dealt = lists.repartition(*KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "ids")
    return dealt.mapInArrow(digests, "depth long, p1 long, p2 long, ends string")


def _ends(heads: DataFrame) -> DataFrame:
    """KEY and ends: the SHA-256 of the ids of the conversations that end at a node.

    Ids are gathered by their value in pieces of at most IDS, in parallel.  A digest is made in order, so the pieces of
    one node pass through one task, as a stream of which it holds one batch.
    """
    at = heads.filter("depth = last").withColumn("piece", F.floor(F.col("c") / IDS))
    lists = at.groupBy(*KEY, "piece").agg(F.array_join(F.sort_array(F.collect_list("c")).cast("array<string>"), ",").alias("ids"))
    lists = durable(lists, "id-lists")
    pieces = lists.groupBy(*KEY).agg(F.count("*").alias("pieces"), F.min("ids").alias("ids"))
    several = lists.join(pieces.filter("pieces > 1").select(*KEY), KEY, "left_semi")
    single = pieces.filter("pieces = 1").select(*KEY, F.sha2(F.col("ids").cast("binary"), 256).alias("ends"))
    return single.union(_hashed(several))


def _parents(children: DataFrame, nodes: DataFrame) -> DataFrame:
    """c, depth, parent of ``children`` (c, depth, and q1, q2 of the prefix before): the node of that prefix.

    A node with many children would be one hot join key.  Fewer than HOT nodes can have more than a HOT-th of all
    children; those are broadcast, and no other key holds more than that.
    """
    up = nodes.select(F.col("depth").alias("d"), F.col("p1").alias("a"), F.col("p2").alias("b"), F.col("conv_id").alias("parent"), "n_children")
    total = nodes.agg(F.sum("n_children")).first()[0] or 0
    hot = F.broadcast(up.filter(F.col("n_children") * HOT > total))
    same = (F.col("depth") - 1 == F.col("d")) & (F.col("q1") == F.col("a")) & (F.col("q2") == F.col("b"))
    warm = children.join(hot, same).select("c", "depth", "parent")
    cold = children.join(hot, same, "left_anti").join(up.filter(F.col("n_children") * HOT <= total), same)
    return warm.union(cold.select("c", "depth", "parent"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations.

    conv_id is a node's smallest member, depth its turns, parent_conv_id its parent's conv_id (null for the root),
    n_convs its members, n_children its children, n_leaves the childless nodes of its subtree, saved_tokens the sum over its
    subtree of (members - 1) * code points of the last text, ends_sha256 the digest of the ids that end there.

    Turns are ordered by turn, null first; of equal ones by role and then by a digest of the text.  A null role or text is
    empty.  Rows without conv_id belong to no conversation and are left out.  Repeated rows are turns of their own.  A
    conversation may have no turns once rebuilt; it then ends at the root.  Without conversations there are no nodes.
    """
    turns, convs = rebuilt(conversations)
    found = durable(prefixes(turns, convs), "prefixes")
    screened = alone(found, cells_for(found.count()))
    # From its first proven prefix on, a conversation is by itself.
    tails = durable(screened.filter("alone").groupBy("c", "last").agg(F.min("depth").alias("from")), "tails")
    heads = found.join(tails.select("c", "from"), "c", "left").filter("from IS NULL OR depth < from")
    heads = durable(heads.withColumn("goes_on_alone", F.coalesce(F.col("depth") == F.col("from") - 1, F.lit(False)).cast("long")).drop("from"), "heads")

    groups = durable(
        heads.groupBy(*KEY).agg(
            F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.min("size").alias("size"), F.min("q1").alias("q1"), F.min("q2").alias("q2"),
            F.sum("goes_on_alone").alias("lone_children"),
        ),
        "groups",
    )
    below = groups.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).count()
    n_children = F.coalesce("count", F.lit(0).cast("long")) + F.col("lone_children")
    nodes = durable(groups.join(below, KEY, "left").withColumn("n_children", n_children).drop("count", "lone_children"), "nodes")

    owned = nodes.select(
        F.col("conv_id").alias("c"), "depth", ((F.col("n_convs") - 1) * F.col("size")).alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaf")
    )
    given = heads.join(owned, ["c", "depth"], "left").select(
        "c", *KEY, F.coalesce("saved", F.lit(0).cast("long")).alias("saved"), (F.coalesce("leaf", F.lit(0).cast("long")) + F.col("goes_on_alone")).alias("leaf")
    )
    below = _running(given, {"saved_below": "saved", "leaves_below": "leaf"}, "sum", backward=True)
    subtree = below.groupBy(*KEY).agg(F.sum("saved_below").alias("saved_tokens"), F.sum("leaves_below").alias("n_leaves"))

    firsts = heads.filter("goes_on_alone = 1").select("c", (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
    children = nodes.filter("depth > 0").select(F.col("conv_id").alias("c"), "depth", "q1", "q2").union(firsts)
    parents = durable(_parents(children, nodes), "parents").withColumnRenamed("c", "conv_id")

    shared = nodes.join(subtree, KEY).join(_ends(heads), KEY, "left").join(parents, ["conv_id", "depth"], "left")
    shared = shared.select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256")
    )
    # Blocks first, so that no row holds a long conversation's depths in one list.
    blocks = tails.withColumn("block", F.explode(F.sequence(F.expr(f"from div {BLOCK}"), F.expr(f"last div {BLOCK}"))))
    depths = F.sequence(F.greatest("from", F.col("block") * BLOCK), F.least("last", F.col("block") * BLOCK + BLOCK - 1))
    lone = blocks.withColumn("depth", F.explode(depths)).select(F.col("c").alias("conv_id"), "depth", "from", "last")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    at_first = lone.filter("depth = from").join(parents, ["conv_id", "depth"], "left").select("conv_id", "depth", "last", "parent")
    lone = at_first.union(lone.filter("depth > from").select("conv_id", "depth", "last", F.col("conv_id")))
    lone = lone.select(
        "conv_id", "depth", "parent", one, (F.col("depth") < F.col("last")).cast("long"), one, zero,
        F.when(F.col("depth") == F.col("last"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(EMPTY)),
    )
    return shared.union(lone)


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"))


# The SQL keeps whole prefixes as text and finds each node's subtree by the paths of the nodes' smallest members.
ORACLE = r"""
WITH crc AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
 t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
 n AS (SELECT c, count(*) AS n, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
         lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)])), 4294967295) % 6 AS h
       FROM t, crc GROUP BY c, tab),
 o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM t),
 r AS (SELECT n.c, 0 AS k, o.i, o.role, o.text FROM n JOIN o ON o.c = n.c - n.c % 100 AND o.i <= n.h
       UNION ALL SELECT n.c, 1, o.i, o.role, o.text FROM n JOIN o ON o.c = n.c AND o.i > n.h),
 d AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY k, i) AS d, sha256(length(role) || ':' || role || text) AS turn, length(text) AS size FROM r),
 p AS (SELECT c, d, size, string_agg(turn, '') OVER (PARTITION BY c ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS key FROM d
       UNION ALL SELECT c, 0, 0, '' FROM n),
 l AS (SELECT c, max(d) AS last FROM p GROUP BY c),
 g AS (SELECT key, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         left(key, length(key) - 64) AS up, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = last), '') AS ends
       FROM p JOIN l USING (c) GROUP BY key),
 k AS (SELECT up, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY up),
 m AS (SELECT g.*, coalesce(k.n_children, 0) AS n_children FROM g LEFT JOIN k ON k.up = g.key),
 s AS (SELECT p.key, sum((m.n_convs - 1) * m.size) AS saved, sum((m.n_children = 0)::BIGINT) AS leaves
       FROM m JOIN p ON p.c = m.conv_id AND p.d <= m.depth GROUP BY p.key)
SELECT m.conv_id, m.depth::BIGINT AS depth, above.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.leaves::BIGINT AS n_leaves,
  s.saved::BIGINT AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN s ON s.key = m.key LEFT JOIN m above ON m.depth > 0 AND above.key = m.up
"""
