"""LM scoring: a hierarchical Pitman-Yor model whose restaurants are seated by Gibbs sampling.

A token is drawn in the restaurant of the word before it, hashed to one of CONTEXTS.  Restaurants of words with the same
ending share a parent, the restaurant of that ending (one of CLASSES), and these share the restaurant of words without
context, whose base is uniform over the training words and one unknown.  A customer who opens a table is a customer of
the parent.

A dish is a word; the dishes are cut into buckets by their hashes.  A word's customers in all restaurants are in one
bucket, so a bucket can seat them given what the whole model shares: customers and tables of each restaurant, a bounded
number of figures, summed by Spark after each sweep.  A frequent word (see HOT) is one dish for each ending, so no bucket
gets all of it; its seats in the topmost restaurant are shared figures, too.  Texts become numbers once, in chunks; a chunk
sends its pairs of word and context to the buckets and gets their probabilities back, so no table of all words or pairs is
ever in one place.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from treadmark.llm.common import LOWER_BYTES, fold, free, give_back, only, pack, rows_of, ship, shuffle_partitions, table, unpack
from treadmark.session import durable, staged_path

#: Endings, and restaurants of words with one ending.
CLASSES, IN_CLASS = 256, 256
CONTEXTS = CLASSES * IN_CLASS
#: Sweeps before samples are kept, and sweeps whose predictive probabilities are averaged.
BURN_IN, SAMPLES = 1, 2
STRENGTH = 1.0
#: Words of more than one and a half of HOT-ths of all tokens are cut by endings; there are at most twice HOT of those.
HOT = 4096
#: A chunk of documents ends after so many tokens, or with so many words in its vocabulary.
CHUNK_TOKENS, CHUNK_WORDS = 1_500_000, 300_000
#: Tokens for each bucket, and the least number of buckets.
BUCKET_TOKENS, LEAST_BUCKETS = 4_000_000, 64
#: Texts of a chunk travel in packs of about so many tokens, sums in slices of so many figures.
PACK_TOKENS, SLICE = 1 << 17, 4096
FOLDS, HELD_OUT = 5, 1
#: The token after a text's last word; no word holds a space.
END = b" "


def context_of(word: bytes) -> int:
    """The restaurant of what follows the word; 0 is that of a text's first token.  Its class is that of the last two letters."""
    return (1 + xxhash.xxh32_intdigest(word.decode()[-2:]) % (CLASSES - 1)) * IN_CLASS + xxhash.xxh32_intdigest(word, 1) % IN_CLASS


def tokens_of(text: str | None) -> list[bytes]:
    words = (text or "").encode().translate(LOWER_BYTES).split()
    words.append(END)
    return words


class Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def seat(customers: np.ndarray, opening: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers have sat down one after the other.

    With i customers at t tables, the next one opens a table with chance opening / (opening + i - discount * t).  Up to
    64 customers are seated one by one; beyond, those who come while i grows by a thirty-second share one chance.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    live = np.flatnonzero(customers > 1)
    seated = np.ones(len(live), np.int64)
    while len(live):
        come = np.minimum(np.maximum(1, seated // 32), customers[live] - seated)
        chance = opening[live] / (opening[live] + seated - discount * tables[live])
        single = come == 1
        opened = np.where(single, rng.random(len(live)) < chance, 0).astype(np.int64)
        if not single.all():
            opened[~single] = rng.binomial(come[~single], chance[~single])
        tables[live] += opened
        seated += come
        more = seated < customers[live]
        live, seated = live[more], seated[more]
    return tables


@dataclass
class Shared:
    """What all buckets share after a sweep: tables by context, customers and tables by class, those of the topmost
    restaurant, and the frequent words' probabilities there."""

    by_context: np.ndarray
    customers: np.ndarray
    tables: np.ndarray
    top_customers: float
    top_tables: float
    hot: np.ndarray = field(default_factory=lambda: np.empty(0))


@dataclass
class Model:
    words: int
    tokens: int
    totals: np.ndarray  # customers by context
    discounts: tuple[float, float, float]  # of a context, a class and the topmost restaurant
    hot_count: np.ndarray  # frequent words' training tokens
    sweeps: list[Shared]

    def spare(self, sweep: int) -> np.ndarray:
        """What a context's restaurant leaves to its parent, before it is divided by its customers."""
        return STRENGTH + self.discounts[0] * self.sweeps[sweep].by_context

    def class_spare(self, sweep: int) -> np.ndarray:
        return STRENGTH + self.discounts[1] * self.sweeps[sweep].tables

    def base(self, sweep: int) -> float:
        """What the topmost restaurant leaves to each word."""
        return (STRENGTH + self.discounts[2] * self.sweeps[sweep].top_tables) / (self.words + 1)

    def top(self, sweep: int, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Probabilities of words in the topmost restaurant."""
        return (customers - self.discounts[2] * tables + self.base(sweep)) / (STRENGTH + self.sweeps[sweep].top_customers)

    def middle(self, sweep: int, own: Bucket, seats: Seats) -> np.ndarray:
        """Probabilities of the bucket's dishes in the restaurants of their classes."""
        top = self.top(sweep, seats.top, seats.top_tables)
        if len(self.sweeps[sweep].hot):
            top = np.where(own.hot < 0, top, self.sweeps[sweep].hot[own.hot])
        kept = seats.middle - self.discounts[1] * seats.middle_tables
        return (kept + self.class_spare(sweep)[own.mid_class] * top[own.mid_dish]) / (STRENGTH + self.sweeps[sweep].customers)[own.mid_class]

    def chance(self, sweep: int, own: Bucket, seats: Seats) -> np.ndarray:
        """Probabilities of the bucket's dishes in the restaurants of their contexts."""
        kept = own.n - self.discounts[0] * seats.tables
        return (kept + self.spare(sweep)[own.context] * self.middle(sweep, own, seats)[own.mid]) / (STRENGTH + self.totals[own.context])


@dataclass
class Bucket:
    """A bucket's dishes and their training customers by context; pairs of held-out texts alone have none."""

    number: int
    hot: np.ndarray  # place of a dish among the frequent words, else -1
    dish: np.ndarray
    context: np.ndarray
    n: np.ndarray

    def __post_init__(self) -> None:
        of = self.dish.astype(np.int64) * CLASSES + self.context // IN_CLASS  # sorted, as the pairs are
        groups, self.mid = np.unique(of, return_inverse=True)
        self.mid_dish, self.mid_class = groups // CLASSES, groups % CLASSES


@dataclass
class Seats:
    """Tables of each pair; customers and tables of each dish in each class, and in the topmost restaurant."""

    tables: np.ndarray
    middle: np.ndarray
    middle_tables: np.ndarray
    top: np.ndarray
    top_tables: np.ndarray


def _sums(of: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(of, weights=value, minlength=size).astype(np.int64)


def fewest(own: Bucket) -> Seats:
    """One table for each dish of a restaurant."""
    tables = np.minimum(own.n, 1).astype(np.int64)
    middle = _sums(own.mid, tables, len(own.mid_dish))
    top = _sums(own.mid_dish, np.minimum(middle, 1), len(own.hot))
    return Seats(tables, middle, np.minimum(middle, 1), top, np.minimum(top, 1))


def seated(own: Bucket, model: Model, sweeps: int) -> list[Seats]:
    """The bucket's seats after 0 to ``sweeps`` sweeps.

    A sweep seats every dish anew given all other seats; its random numbers depend on the bucket and the sweep alone.
    """
    states = [fewest(own)]
    for sweep in range(1, sweeps + 1):
        rng, last, old = np.random.default_rng([own.number, sweep]), sweep - 1, states[-1]
        middle = model.middle(last, own, old)
        tables = seat(own.n, model.spare(last)[own.context] * middle[own.mid], model.discounts[0], rng)
        customers = _sums(own.mid, tables, len(own.mid_dish))
        top = model.top(last, old.top, old.top_tables)
        if len(model.sweeps[last].hot):
            top = np.where(own.hot < 0, top, model.sweeps[last].hot[own.hot])
        middle_tables = seat(customers, model.class_spare(last)[own.mid_class] * top[own.mid_dish], model.discounts[1], rng)
        guests = _sums(own.mid_dish, middle_tables, len(own.hot))
        states.append(Seats(tables, customers, middle_tables, guests, seat(guests, np.full(len(guests), model.base(last)), model.discounts[2], rng)))
    return states


def told(own: Bucket, seats: Seats, hot: int) -> np.ndarray:
    """What a bucket adds to the shared figures: tables by context, customers and tables by class, customers and tables of the
    topmost restaurant but for frequent words, and these words' customers there."""
    cold = own.hot < 0
    return np.concatenate((
        _sums(own.context, seats.tables, CONTEXTS), _sums(own.mid_class, seats.middle, CLASSES), _sums(own.mid_class, seats.middle_tables, CLASSES),
        [seats.top[cold].sum(), seats.top_tables[cold].sum()], _sums(own.hot[~cold], seats.top[~cold], hot),
    )).astype(np.int64)


def shared(sums: np.ndarray, model: Model, sweep: int) -> Shared:
    """The shared figures of a sweep; frequent words, a bounded number, take their seats in the topmost restaurant here."""
    by_context, customers, tables, (guests, set_up), hot = np.split(sums, np.cumsum((CONTEXTS, CLASSES, CLASSES, 2)))
    hot = hot.astype(np.int64)
    opened = np.minimum(hot, 1) if sweep == 0 else seat(hot, np.full(len(hot), model.base(sweep - 1)), model.discounts[2], np.random.default_rng(sweep))
    out = Shared(by_context, customers, tables, guests + hot.sum(), set_up + opened.sum())
    model.sweeps.append(out)
    out.hot = model.top(sweep, hot, opened)
    return out


_CUT = pa.schema([
    ("chunk", pa.int64()), ("bucket", pa.int32()), ("sent", pa.binary()), ("texts", pa.binary()),
])


def _cut(chunk: int, vocabulary: Vocabulary, docs: list[tuple], hot: dict[bytes, int], buckets: int) -> Iterator[pa.RecordBatch]:
    """A chunk's documents as numbers of its pairs, and for each bucket its dishes with their customers by context."""
    words, frequent = list(vocabulary), list(hot)
    contexts = np.fromiter(map(context_of, words), np.int64, len(words))
    rank = np.fromiter((hot.get(w, -1) for w in words), np.int64, len(words))
    sizes = np.array([len(i) for _, _, i in docs])
    flat = np.concatenate([i for _, _, i in docs]).astype(np.int64)
    context = np.concatenate(([0], contexts[flat[:-1]]))
    context[np.cumsum(sizes)[:-1]] = 0
    dish = np.where(rank[flat] < 0, flat, len(words) + rank[flat] * CLASSES + context // IN_CLASS)
    del flat
    used, dish = np.unique(dish, return_inverse=True)
    names = [words[d] if d < len(words) else b"%b %d" % (frequent[(d - len(words)) // CLASSES], (d - len(words)) % CLASSES) for d in used.tolist()]
    of = [xxhash.xxh3_64_intdigest(name) % buckets for name in names]
    order = sorted(range(len(names)), key=lambda i: (of[i], names[i]))  # as the buckets sort them
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    keys = place[dish] * CONTEXTS + context
    del dish, context
    pairs, inverse = np.unique(keys, return_inverse=True)
    del keys
    n = np.bincount(inverse, weights=~np.repeat([bool(h) for _, h, _ in docs], sizes), minlength=len(pairs)).astype(np.uint32)
    edges = np.searchsorted(np.array(of)[order], np.arange(buckets + 1))
    cuts = np.searchsorted(pairs, edges * CONTEXTS)
    rows = []
    for b in np.flatnonzero(np.diff(edges)).tolist():
        x, y, p, q = edges[b], edges[b + 1], cuts[b], cuts[b + 1]
        each = np.bincount(pairs[p:q] // CONTEXTS - x, minlength=y - x).astype(np.uint32)
        rows.append((chunk, b, pack((b"\n".join(names[i] for i in order[x:y]), each, (pairs[p:q] % CONTEXTS).astype(np.uint16), n[p:q])), None))
    ends, inverse = np.cumsum(sizes), inverse.astype(np.uint32)
    cut = np.flatnonzero(np.diff(ends // PACK_TOKENS, prepend=0))
    for own in np.split(np.arange(len(docs)), cut):
        if len(own):
            rows.append((chunk, None, None, pack(([docs[k][0] for k in own], [bool(docs[k][1]) for k in own], sizes[own], inverse[ends[own[0]] - sizes[own[0]] : ends[own[-1]]]))))
    for at in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows[at : at + 64], strict=True), _CUT, strict=True)], schema=_CUT)


def _steps(places: np.ndarray) -> np.ndarray:
    """Rising numbers as small ones: ``np.cumsum`` gives them back."""
    return np.diff(places, prepend=0).astype(np.uint32)


def _merge(group: pa.Table, hot: dict[bytes, int]) -> pa.Table:
    """One bucket: its dishes, the training customers of each pair, and where each chunk's dishes and pairs are in it."""
    number = group.column("bucket")[0].as_py()
    sent = sorted(zip(group.column("chunk").to_pylist(), group.column("sent").to_pylist(), strict=True))
    sent = [(chunk, unpack(data)) for chunk, data in sent]
    lists = [s[0].split(b"\n") for _, s in sent]
    place = {w: i for i, w in enumerate(sorted(set().union(*lists)))}
    maps = [np.fromiter((place[w] for w in own), np.int64, len(own)) for own in lists]
    keys = [np.repeat(m, s[1]) * CONTEXTS + s[2] for m, (_, s) in zip(maps, sent, strict=True)]
    pairs, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(inverse, weights=np.concatenate([s[3] for _, s in sent]), minlength=len(pairs)).astype(np.int64)
    parts = [w.rpartition(b" ") for w in place]  # a frequent word's dish names its class after a space; the end alone is a space
    ranks = np.array([hot[word] if space and number_ else -1 for word, space, number_ in parts], np.int64)
    own = Bucket(number, ranks, pairs // CONTEXTS, pairs % CONTEXTS, n)
    at = np.split(inverse, np.cumsum([len(k) for k in keys])[:-1])
    asks = [(chunk, _steps(m), s[1], _steps(a)) for (chunk, s), m, a in zip(sent, maps, at, strict=True)]
    count, seats, cold = _sums(own.dish, n, len(place)), fewest(own), ranks < 0
    levels = (n, seats.middle, seats.top[cold])
    seen = [(count[cold] > 0).sum(), *(x for level in levels for x in ((level == 1).sum(), (level == 2).sum()))]
    stats = np.concatenate((_sums(own.context, n, CONTEXTS), seen, _sums(ranks[~cold], count[~cold], len(hot)), told(own, seats, len(hot))))
    state = (number, ranks.astype(np.int16), np.bincount(own.dish).astype(np.uint32), own.context.astype(np.uint16), n.astype(np.uint32))
    return pa.table({
        "bucket": pa.array([number], pa.int32()), "state": pa.array([pack(state)], pa.binary()),
        "asks": pa.array([pack(asks)], pa.binary()), "stats": pa.array([pack(stats.astype(np.int64))], pa.binary()),
    })


def _bucket(data: bytes) -> Bucket:
    number, ranks, each, context, n = unpack(data)
    return Bucket(number, ranks.astype(np.int64), np.repeat(np.arange(len(each)), each), context.astype(np.int64), n.astype(np.int64))


def _totals(df: DataFrame, size: int) -> np.ndarray:
    """Sums of packed figures by place: added up in each task, then slice by slice; as many numbers as one of them holds."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for (data,) in rows_of(batches, "stats"):
            total = unpack(data) if total is None else total + unpack(data)
        if total is not None:
            parts = [pack(total[at : at + SLICE]) for at in range(0, size, SLICE)]
            yield pa.record_batch([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names=["slice", "stats"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for part, data in rows_of(batches, "slice", "stats"):
            total[part] = total.get(part, 0) + unpack(data)
        yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([pack(t) for t in total.values()], pa.binary())], names=["slice", "stats"])

    kinds = "slice int, stats binary"
    slices = df.select("stats").mapInArrow(added, kinds).repartition(min(-(-size // SLICE), shuffle_partitions(df.sparkSession)), "slice")
    out = np.zeros(size)
    for part, data in slices.mapInArrow(joined, kinds).collect():
        out[part * SLICE : (part + 1) * SLICE] = unpack(bytes(data))
    return out


def _discount(once: float, twice: float) -> float:
    """The discount that singletons and pairs of counts suggest."""
    return float(np.clip(once / (once + 2 * twice), 0.05, 0.95)) if once else 0.5


def learned(buckets: DataFrame, hot: int) -> Model:
    """The model's shared figures after all sweeps."""
    rest = CONTEXTS + 2 * CLASSES + 2 + hot
    totals, (cold, *levels), hot_count, first = np.split(_totals(buckets, CONTEXTS + 7 + hot + rest), np.cumsum((CONTEXTS, 7, hot)))
    discounts = tuple(_discount(*levels[k : k + 2]) for k in (0, 2, 4))
    model = Model(int(cold + (hot_count > 0).sum()), int(totals.sum()), totals, discounts, hot_count, [])
    shared(first, model, 0)
    for sweep in range(1, BURN_IN + SAMPLES + 1):

        def swept(batches: Iterator[pa.RecordBatch], sweep: int = sweep) -> Iterator[pa.RecordBatch]:
            for (data,) in rows_of(batches, "state"):
                own = _bucket(data)
                yield pa.record_batch([pa.array([pack(told(own, seated(own, model, sweep)[-1], hot))], pa.binary())], names=["stats"])

        shared(_totals(buckets.select("state").mapInArrow(swept, "stats binary"), rest), model, sweep)
    return model


def frequent(rows: DataFrame) -> tuple[dict[bytes, int], int]:
    """Frequent words by number, and the number of all tokens.

    A task tells the words that have a HOT-th of some stretch of its tokens, so at most HOT of each stretch; their sums find
    every word of more than one and a half HOT-ths of all tokens.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def often() -> pa.RecordBatch:
            some = [(w, n) for w, n in seen.items() if n * HOT >= tokens] + [(None, tokens)]
            return pa.record_batch([pa.array([w for w, _ in some], pa.binary()), pa.array([n for _, n in some], pa.int64())], names=["word", "n"])

        seen, tokens = Counter(), 0
        for (value,) in rows_of(batches, "text"):
            words = tokens_of(value)
            seen.update(words)
            tokens += len(words)
            if tokens >= CHUNK_TOKENS or len(seen) >= CHUNK_WORDS:
                yield often()
                seen, tokens = Counter(), 0
        if tokens:
            yield often()
        seen.clear()
        give_back()

    sums = durable(rows.select("text").mapInArrow(counted, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "frequent-words")
    total = sums.filter("word IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    some = sums.filter(F.col("word").isNotNull() & (F.col("n") * (2 * HOT) >= total)).select("word").collect()  # at most 2 * HOT
    return {w: i for i, w in enumerate(sorted(bytes(r["word"]) for r in some))}, total


def scored(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every whole text.

    Letters A-Z are lower-cased; tokens are the words and one end.  The model learns from the documents whose
    crc32(doc_id as text) modulo 5 is not 1.  ``base_score`` is the smoothed unigram score, ``score`` the model's: the log10
    probability of the tokens, each the mean over the kept sweeps.  A null or empty text is the end alone.  Rows count
    each, also repeated ones; a row without doc_id is in the fold of the empty id.  Without training documents all words are
    unknown; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = only(docs, "doc_id", text).select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), F.col(text).cast("string").alias("text")
    )
    hot, tokens = frequent(rows)
    buckets = max(LEAST_BUCKETS, 4 * shuffle_partitions(spark), tokens // BUCKET_TOKENS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocabulary, held, tokens, part = Vocabulary(), [], 0, 0
        base = TaskContext.get().partitionId() << 20
        for doc_id, out, value in rows_of(batches, "doc_id", "held_out", "text"):
            words = tokens_of(value)
            held.append((doc_id, out, np.fromiter(map(vocabulary.__getitem__, words), np.uint32, len(words))))
            tokens += len(words)
            if tokens >= CHUNK_TOKENS or len(vocabulary) >= CHUNK_WORDS:
                yield from _cut(base + part, vocabulary, held, hot, buckets)
                vocabulary, held, tokens, part = Vocabulary(), [], 0, part + 1
        if held:
            yield from _cut(base + part, vocabulary, held, hot, buckets)
        vocabulary, held = Vocabulary(), []
        give_back()

    path = staged_path(spark, "numbered")
    kinds = "chunk long, bucket int, sent binary, texts binary"
    rows.mapInArrow(cut, kinds).write.parquet(path)
    numbered = spark.read.schema(kinds).parquet(path)
    sent = numbered.filter("bucket IS NOT NULL").select("bucket", "chunk", "sent")

    def merge(group: pa.Table) -> pa.Table:
        out = _merge(group, hot)
        give_back()
        return out

    merged = durable(sent.groupBy("bucket").applyInArrow(merge, "bucket int, state binary, asks binary, stats binary"), "buckets")
    free(spark)
    model = learned(merged, len(hot))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, asks in rows_of(batches, "state", "asks"):
            own = _bucket(data)
            states = seated(own, model, BURN_IN + SAMPLES)
            chance = np.mean([model.chance(s, own, states[s]) for s in range(BURN_IN + 1, BURN_IN + SAMPLES + 1)], axis=0)
            value = np.log10(chance).astype(np.float32)
            count = _sums(own.dish, own.n, len(own.hot))
            if len(hot):
                count = np.where(own.hot < 0, count, model.hot_count[own.hot].astype(np.int64))
            for chunk, m, each, at in unpack(asks):
                back = pack((own.number, count[np.cumsum(m)], each, value[np.cumsum(at)]))
                yield pa.record_batch([pa.array([chunk], pa.int64()), pa.array([back], pa.binary())], names=["chunk", "back"])

    lost = np.log10(model.tokens + 0.5 * (model.words + 1))

    def score(own: pa.Table, back: pa.Table) -> pa.Table:
        answers = sorted((unpack(b) for b in back.column("back").to_pylist()), key=lambda b: b[0])
        pair_log = np.concatenate([b[3] for b in answers]).astype(np.float64)
        count = np.concatenate([np.repeat(b[1], b[2]) for b in answers])
        word_log = np.log10(count + 0.5) - lost
        packs = [unpack(t) for t in own.column("texts").to_pylist()]
        doc_ids, held = [i for p in packs for i in p[0]], [h for p in packs for h in p[1]]
        sizes, pairs = np.concatenate([p[2] for p in packs]), np.concatenate([p[3] for p in packs])
        starts = np.cumsum(sizes) - sizes
        return pa.table({
            "doc_id": pa.array(doc_ids, pa.int64()), "held_out": pa.array(held, pa.bool_()), "n_tokens": pa.array(sizes, pa.int64()),
            "n_known": pa.array(np.add.reduceat((count[pairs] > 0).astype(np.int64), starts)),
            "train_tokens": pa.array(np.full(len(sizes), model.tokens, np.int64)),
            "base_score": pa.array(np.add.reduceat(word_log[pairs], starts)), "score": pa.array(np.add.reduceat(pair_log[pairs], starts)),
        })

    answers = merged.select("state", "asks").mapInArrow(answer, "chunk long, back binary")
    texts = numbered.filter("texts IS NOT NULL").select("chunk", "texts")
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def perplexity(scores: DataFrame, column: str = "score") -> DataFrame:
    """held_out and perplexity: ten to the mean negative log10 probability of a token."""
    mean = F.sum(column) / F.sum("n_tokens")
    return scores.groupBy("held_out").agg(F.pow(F.lit(10.0), -mean).alias("perplexity"))


def op7_seating_lm(spark: SparkSession, folder: str) -> DataFrame:
    return scored(table(spark, folder, "documents"))
