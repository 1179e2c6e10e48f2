"""N-gram Jaccard join: documents whose sets of five-word shingles overlap by three quarters, and what they link to.

The documents by shingles matrix is kept sparse and cut into blocks.  First its columns are cut into buckets of
shingle hashes: a bucket finds the shingles that more than one document has.  A document with fewer of those than
any link needs is done.  What is left is multiplied with itself only where it can matter: a pair is looked at if
it shares one of each document's rarest shingles, so many that a pair without one stays below the bound, and if the sizes
allow it; its overlap is then counted over all shingles.

Shingles are compared by 48 bits of their hashes and the bucket that the top 16 bits choose: 54 bits with the least number of buckets, 64.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from treadmark.llm.common import LOWER_BYTES, free, give_back, only, rows_of, ship, shuffle_partitions, table
from treadmark.session import durable

WIDTH, PERCENT = 5, 75
#: A chunk of documents ends after so many shingles or documents.
CHUNK_SHINGLES, CHUNK_DOCS = 750_000, 60_000
MEMORY = 100_000
#: So many documents of a posting meet a leader in one task.
PIECE = 4096

_TIMES = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 48) - 1)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, width: int = WIDTH):
        self.width, self.known = width, {}

    def _word(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= MEMORY:
                self.known.clear()
            found = self.known[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().translate(LOWER_BYTES).split()
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self._word, words), np.uint64, len(words))
        width = min(self.width, len(h))
        n = len(h) - width + 1
        total = np.full(n, width, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(width):
                total = total * _TIMES + h[k : k + n]
                total ^= total >> np.uint64(29)
            total *= _TIMES
        total ^= total >> np.uint64(32)
        return np.unique(total)


def need(n: Column, percent: int = PERCENT) -> Column:
    """The least overlap of a document of n shingles with any partner: ceil(percent * n / 100)."""
    return F.ceil(n * percent / 100)


def _six(ids: np.ndarray) -> bytes:
    return np.ascontiguousarray(ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(data: bytes, bucket: int) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8")[:, 0] | np.uint64(bucket << 48)


_SENT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("ids", pa.binary()), ("docs", pa.binary()), ("meta", pa.binary())])
_BACK = pa.schema([("chunk", pa.int64()), ("ids", pa.binary()), ("docs", pa.binary()), ("meta", pa.binary())])
_DOCS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int64()))])


def _send(chunk: int, doc_ids: list, sets: list[np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
    """A chunk's shingles by bucket, in hash order; and its documents' ids and sizes, to one of the buckets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    ids = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    docs = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
    order = np.argsort(ids, kind="stable")
    ids, docs = ids[order], docs[order]
    # of the bucket that the top 16 bits give, the low 48 bits tell the rest
    edges = np.searchsorted((ids >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16), np.arange(buckets + 1, dtype=np.uint64))
    meta = pickle.dumps((doc_ids, sizes.tolist()))
    rows = [(b, chunk, _six(ids[x:y] & _LOW), docs[x:y].tobytes(), None) for b, (x, y) in enumerate(zip(edges, edges[1:], strict=False)) if y > x]
    rows.append((chunk % buckets, chunk, b"", b"", meta))
    for at in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows[at : at + 64], strict=True), _SENT, strict=True)], schema=_SENT)


def shared_shingles(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """row, doc_id, n and ids of every document; ids: the shingles that others have too, if enough for a link, else null."""
    spark = docs.sparkSession
    ship(spark)
    buckets = min(65_536, max(64, 4 * shuffle_partitions(spark)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shingler, doc_ids, sets, held, part = Shingler(width), [], [], 0, 0
        base = TaskContext.get().partitionId() << 20
        for doc_id, value in rows_of(batches, "doc_id", "text"):
            own = shingler(value)
            doc_ids.append(doc_id)
            sets.append(own)
            held += len(own)
            if held >= CHUNK_SHINGLES or len(sets) >= CHUNK_DOCS:
                yield from _send(base + part, doc_ids, sets, buckets)
                doc_ids, sets, held, part = [], [], 0, part + 1
        if sets:
            yield from _send(base + part, doc_ids, sets, buckets)
        shingler.known.clear()
        doc_ids, sets = [], []
        give_back()

    def meet(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        chunks, metas = group.column("chunk").to_pylist(), group.column("meta").to_pylist()
        out = [(c, None, None, m) for c, m in zip(chunks, metas, strict=True) if m is not None]
        parts = [(_from_six(i, bucket), np.frombuffer(d, np.uint16)) for i, d in zip(group.column("ids").to_pylist(), group.column("docs").to_pylist(), strict=True)]
        ids = np.concatenate([p[0] for p in parts])
        if len(ids):
            docs_ = np.concatenate([p[1] for p in parts])
            of = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
            order = np.argsort(ids, kind="stable")
            ids, docs_, of = ids[order], docs_[order], of[order]
            same = ids[1:] == ids[:-1]
            shared = np.zeros(len(ids), bool)
            shared[1:] |= same
            shared[:-1] |= same
            ids, docs_, of = ids[shared], docs_[shared], of[shared]
            back = np.argsort(of, kind="stable")
            ids, docs_, of = ids[back], docs_[back], of[back]
            edges = np.searchsorted(of, np.arange(len(parts) + 1))
            for k, (x, y) in enumerate(zip(edges, edges[1:], strict=False)):
                if y > x:
                    out.append((chunks[k], ids[x:y].tobytes(), docs_[x:y].tobytes(), None))
        if not out:
            return _BACK.empty_table()
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), _BACK, strict=True)], schema=_BACK)

    def gather(group: pa.Table) -> pa.Table:
        chunk = group.column("chunk")[0].as_py()
        doc_ids, sizes = pickle.loads(next(m for m in group.column("meta").to_pylist() if m is not None))
        sizes = np.array(sizes, np.int64)
        ids = np.frombuffer(b"".join(x for x in group.column("ids").to_pylist() if x), np.int64)
        docs_ = np.frombuffer(b"".join(x for x in group.column("docs").to_pylist() if x), np.uint16)
        found = np.bincount(docs_, minlength=len(sizes))
        enough = (found * 100 >= sizes * percent) & (sizes > 0)
        take = enough[docs_]
        ids, docs_ = ids[take], docs_[take]
        order = np.lexsort((ids, docs_))
        offsets = np.concatenate(([0], np.cumsum(np.where(enough, found, 0)))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[order]), mask=pa.array(~enough))
        columns = [pa.array((chunk << 16) + np.arange(len(sizes))), pa.array(doc_ids, pa.int64()), pa.array(sizes), lists]
        return pa.Table.from_arrays(columns, schema=_DOCS)

    rows = only(docs, "doc_id", text).selectExpr("CAST(doc_id AS BIGINT) AS doc_id", f"CAST(`{text}` AS STRING) AS text")
    sent = rows.mapInArrow(send, "bucket int, chunk long, ids binary, docs binary, meta binary")
    met = sent.groupBy("bucket").applyInArrow(meet, "chunk long, ids binary, docs binary, meta binary")
    return durable(met.groupBy("chunk").applyInArrow(gather, "row long, doc_id long, n long, ids array<bigint>"), "shingles")


def components(edges: DataFrame) -> DataFrame:
    """v and c: the smallest vertex that each vertex of the edges (a, b) reaches.

    Labels spread along edges, and each vertex then takes the label of its label, so that the rounds grow with the
    logarithm of a chain's length.  Each round is written down; only the number of changes comes to the driver.
    """
    both = durable(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "both-ways")
    labels = durable(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("c")).select("v", F.least("v", "c").alias("c")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(F.min("c").alias("m"))
        low = labels.join(near, F.col("v") == F.col("a")).select("v", "c", F.least("c", "m").alias("l"))
        up = labels.select(F.col("v").alias("x"), F.col("c").alias("y"))
        new = durable(low.join(up, F.col("l") == F.col("x")).select("v", F.least("l", "y").alias("n"), F.col("c").alias("o")), "labels")
        done = new.filter("n <> o").isEmpty()
        labels = new.select("v", F.col("n").alias("c"))
        if done:
            return labels


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those that overlap enough, by a count over all shared shingles."""
    left = sets.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("ids").alias("ids_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("ids").alias("ids_b"))
    both = pairs.join(left, "a").join(right, "b")
    overlap = F.size(F.array_intersect("ids_a", "ids_b"))
    return both.filter(overlap * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _posted(sets: DataFrame) -> DataFrame:
    """The postings of the prefixes' shingles: id, rep, n, left, and slice and pieces.

    A posting's slices are the turns in which its vertices lead: 0 is the vertex with the fewest shingles of its own, which is
    nearest to most others, and each further slice holds four times as many as the one before, dealt by a hash.  Its
    vertices lie in so many pieces, so that no task compares all of a large posting.
    """
    posted = sets.select("rep", "n", (F.col("n") - F.size("ids")).alias("own"), F.explode("first").alias("f")).select("f.id", "rep", "n", "f.left", "own")
    met = posted.groupBy("id").agg(F.min(F.struct("own", "rep")).alias("nearest"), F.count("*").alias("m")).filter("m > 1")
    share = F.shiftrightunsigned(F.xxhash64("rep"), 11) / F.lit(float(1 << 53))
    further = (F.floor(F.log2(1 + share * F.col("m")) / 2) + 1).cast("int")
    slices = F.when(F.col("rep") == F.col("nearest.rep"), 0).otherwise(further)
    pieces = F.ceil(F.col("m") / PIECE).cast("int")
    return posted.join(met, "id").select("id", "rep", "n", "left", slices.alias("slice"), pieces.alias("pieces"))


def _joined(sets: DataFrame, percent: int) -> DataFrame | None:
    """v and c: the smallest vertex that each linked vertex reaches, or None without links.

    In each turn one slice of every posting leads: its vertices meet those of their posting that have not led yet, if the links
    found so far do not join them.  Every pair of a posting is met once, unless it is joined before; postings whose
    vertices are all joined are done.  So what is looked at is what ends up apart, and the little that a vertex needs to
    find its group.
    """
    spark, labels, turn, posted = sets.sparkSession, None, 0, _posted(sets)
    while True:
        if labels is None:
            named = posted.withColumn("c", F.col("rep"))
        else:
            named = posted.join(labels.select(F.col("v").alias("rep"), "c"), "rep", "left").withColumn("c", F.coalesce("c", "rep"))
        kinds = named.groupBy("id", "c").agg(F.count("*").alias("k"), F.max("slice").alias("last"))
        mixed = kinds.groupBy("id").agg(F.max(F.struct("k", "c")).alias("most"), F.max("last").alias("last"), F.count("*").alias("kinds"))
        mixed = mixed.filter((F.col("kinds") > 1) & (F.col("last") >= turn)).select("id", F.col("most.c").alias("most"))
        named = named.join(mixed, "id").withColumn("main", F.col("c") == F.col("most")).drop("most")
        named = durable(named.withColumn("piece", F.pmod(F.xxhash64("rep"), "pieces").cast("int")), "posted")
        if named.isEmpty():
            return labels
        # Most of a posting is often one group by now: its leaders meet only the others.
        a = named.filter(F.col("slice") == turn).withColumn("main", F.explode(F.when(F.col("main"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))))
        a = a.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        a = a.select("id", "main", "piece", F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("left").alias("left_a"), F.col("c").alias("c_a"))
        b = named.filter(F.col("slice") >= turn)
        later = (F.col("slice") > turn) | (F.col("a") < F.col("rep"))
        sized = F.least("left_a", "left", "n_a", "n") * (100 + percent) >= (F.col("n_a") + F.col("n")) * percent
        pairs = a.join(b, ["id", "main", "piece"]).filter(later & (F.col("c_a") != F.col("c")) & sized)
        pairs = durable(pairs.select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b")).distinct(), "pairs")
        links = durable(_linked(pairs, sets, percent), "links")
        if not links.isEmpty():
            if labels is not None:
                links = links.union(labels.filter("v <> c").select("v", "c"))
            labels = components(links)
            free(spark)
        posted = named.drop("c", "main", "piece")
        turn += 1


def jaccard_join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    Letters A-Z are lower-cased and words are runs of anything but ASCII white space.  A document's set holds its
    distinct shingles of ``width`` words; with fewer words it is the whole sequence.  Two documents link when
    100 * overlap >= percent * union; component_id is the smallest doc_id that a document reaches, its own included.

    A null or empty text has no shingles and links with nothing.  Every row is a document of its own: repeated rows link
    by their equal sets, and a row without doc_id gets the smallest doc_id it reaches, if any.  An empty table gives no
    rows.
    """
    spark = docs.sparkSession
    every = shared_shingles(docs, width, percent, text)
    free(spark)
    some = every.filter("ids IS NOT NULL")
    # Equal sets are one vertex.  A document with a shingle of its own equals no other and need not move.
    full = F.size("ids") == F.col("n")
    keyed = some.filter(full).withColumn("key", F.sha2(F.array_join("ids", ",").cast("binary"), 256))
    ones = keyed.groupBy("key").agg(F.min("row").alias("rep"), F.first("n").alias("n"), F.first("ids").alias("ids"), F.count("*").alias("copies"))
    alone = some.filter(~full).select(F.lit(None).cast("string").alias("key"), F.col("row").alias("rep"), "n", "ids", F.lit(1).cast("long").alias("copies"))
    reps = durable(ones.union(alone), "reps")
    free(spark)
    members = keyed.select("row", "key").join(reps.filter("copies > 1").select("key", "rep"), "key").select("row", "rep")
    cells = reps.select("rep", "n", F.explode("ids").alias("id"))
    rare = cells.groupBy("id").agg(F.count("*").alias("df")).filter("df > 1")
    found = cells.join(rare, "id").groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("df", "id"))).alias("found"))
    found = found.filter(F.size("found") >= need(F.col("n"), percent))
    # Shingles of one document alone come before all others.  ``left`` is how many of a document's shingles stand from one
    # on: a pair's first common shingle must leave enough on both sides.
    ranked = F.transform("found.id", lambda x, i: F.struct(x.alias("id"), (F.size("found") - i).cast("long").alias("left")))
    first = F.slice(ranked, 1, (F.size("found") - need(F.col("n"), percent) + 1).cast("int"))
    # Documents of one size that share the same shingles with others are alike to all others, and to each other: one vertex.
    alike = F.sha2(F.concat_ws(",", F.col("n").cast("string"), F.array_join("found.id", ",")).cast("binary"), 256)
    kinds = durable(found.select("rep", "n", F.col("found.id").alias("ids"), first.alias("first"), alike.alias("alike")), "kinds")
    free(spark)
    leads = kinds.groupBy("alike").agg(F.min("rep").alias("lead"), F.count("*").alias("members"))
    of_kind = durable(kinds.select("rep", "n", F.size("ids").alias("shared"), "alike").join(leads, "alike").drop("alike"), "members")
    sets = durable(kinds.join(of_kind.filter("rep = lead").select("rep"), "rep", "left_semi").drop("alike"), "sets")
    free(spark)
    labels = _joined(sets, percent)
    if labels is None:
        labels = spark.createDataFrame([], "v long, c long")
    # A vertex's documents are joined if they link with each other or with any other vertex; else each is by itself.
    own = F.col("shared") * (100 + percent) >= 2 * F.col("n") * percent
    found = of_kind.join(labels, F.col("lead") == F.col("v"), "left").filter(F.col("c").isNotNull() | ((F.col("members") > 1) & own))
    labels = found.select(F.col("rep").alias("v"), F.coalesce("c", "lead").alias("c"))
    joined = some.select("row", "doc_id").join(members, "row", "left").withColumn("rep", F.coalesce("rep", "row"))
    joined = joined.join(labels, F.col("rep") == F.col("v"), "left").select("row", "doc_id", F.coalesce("c", "rep").alias("c"))
    least = joined.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    of = joined.join(least, "c").select("row", "component_id")
    return every.join(of, "row", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component; of rows that repeat a doc_id, the one with the
    smallest text.

    Rows without doc_id stay: nothing tells which of them is meant.
    """
    found = jaccard_join(docs, width, percent, text)
    first = found.filter("doc_id = component_id").select(F.col("doc_id").alias("id")).distinct()
    # The row travels as one value, so no column of it meets a name of ours.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.col(text).alias("text"))
    order = W.partitionBy("id").orderBy(F.col("text").asc_nulls_last())
    named = rows.filter("id IS NOT NULL").join(first, "id", "left_semi").withColumn("place", F.row_number().over(order)).filter("place = 1")
    return named.union(rows.filter("id IS NULL").withColumn("place", F.lit(1)).select(named.columns)).select("row.*")


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(table(spark, folder, "documents"))
