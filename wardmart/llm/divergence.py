"""How far the sources of a language differ from each other and from the whole language.

The terms that enough documents of a language hold are sorted and built into minimal acyclic
transducers (``vocabulary``), one for each stretch of ``SHARD_TERMS``. The texts then stream
through them once more and every occurrence is counted under its term's ordinal. While all
transducers together are at most ``CARRIED_BYTES``, each task carries them to the text; beyond
that, the terms of the text, counted in each task, are dealt to the transducer of their stretch.
Shares and divergences are whole numbers of billionths, computed exactly.

Sums over terms for pairs of sources come from blocks of ordinals by tiles of sources: a term
that no source of the tile holds gives each pair the same value and is added by count. The
result has a row for each ordered pair of sources of a language, so it grows with their square.

Null texts, languages and sources count as empty; an empty text has no terms, and a document
without terms still makes its group known. Repeated rows are documents of their own. A term is
as long as its run of letters; texts are cut into terms piece by piece. A language without kept
terms has divergence 0 between all its sources and no term rows. An empty table gives none.
Other columns of the table, whatever their names, are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmart.llm.common import freeing, partitions, written
from wardmart.llm.vocabulary import Tally, Transducer, pieces

SCALE = 1_000_000_000
#: Terms of one transducer, and bytes of them after which it ends too.
SHARD_TERMS, SHARD_BYTES = 1 << 16, 8 << 20
#: Bytes of all transducers that a task may carry.
CARRIED_BYTES = 64 << 20
#: Different terms, and bytes of text, that a task counts before it hands the counts on.
TALLY_TERMS, TALLY_BYTES = 500_000, 64 << 20
#: Parts that the terms of one stretch are dealt into when they go to their transducer.
SALTS = 8
#: Ordinals of a block and sources of a tile.
BLOCK, TILE = 2048, 256


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Key columns and the bytes of the text, row by row."""
    for batch in batches:
        *keys, text = (batch.column(i) for i in range(batch.num_columns))
        yield from zip(zip(*(k.to_pylist() for k in keys)), text.cast(pa.large_binary()).to_pylist())


def _document_terms(most: int, most_bytes: int):
    """lang, term and in how many documents, in parts that add up."""
    def out(tally: Tally) -> Iterator[pa.RecordBatch]:
        for (lang,), numbers, n in tally.counted():
            words = pa.array(tally.words(lang), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(n)), words.take(pa.array(numbers)), pa.array(n)], names=["lang", "term", "n"])
        tally.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(most, most_bytes)
        for (lang,), text in _texts(batches):
            found = [np.unique(tally.numbered(lang, piece)) for piece in pieces(text)]
            if found:
                tally.add((lang,), found[0] if len(found) == 1 else np.unique(np.concatenate(found)))
            if tally.full:
                yield from out(tally)
        yield from out(tally)
    return run


_SHARD = ("lang string, first binary, size long, root int, keys array<long>, targets array<int>, "
          "skips array<int>, final array<boolean>")


def _shard(lang: str, words: list[bytes]) -> pa.RecordBatch:
    t = Transducer.of(words)
    lists = [pa.array([x], pa.list_(kind)) for x, kind in (
        (t.keys, pa.int64()), (t.targets, pa.int32()), (t.skips, pa.int32()), (t.final, pa.bool_()))]
    return pa.RecordBatch.from_arrays(
        [pa.array([lang]), pa.array([words[0]], pa.binary()), pa.array([len(words)]), pa.array([t.root], pa.int32()),
         *lists], names=["lang", "first", "size", "root", "keys", "targets", "skips", "final"])


def _transducers(most: int, most_bytes: int):
    """Transducers of the sorted terms (lang, term) of a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, words, held = None, [], 0
        for batch in batches:
            for its, word in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist()):
                if words and (its != lang or len(words) >= most or held >= most_bytes):
                    yield _shard(lang, words)
                    words, held = [], 0
                lang = its
                words.append(word)
                held += len(word)
        if words:
            yield _shard(lang, words)
    return run


def vocabulary(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """The terms that at least ``min_docs`` documents of a language hold, as transducers.

    One row each: lang, shard (0, 1, ... in the order of the terms), base (terms of the
    language before it), first (its first term), size, and the transducer's arrays.
    """
    found = docs.select("lang", "text").mapInArrow(
        freeing(_document_terms(TALLY_TERMS, TALLY_BYTES)), "lang string, term binary, n long")
    kept = written(
        found.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)
        .select("lang", "term"), "terms")
    stretches = max(1, -(-kept.count() // SHARD_TERMS))
    shards = written(
        kept.repartitionByRange(stretches, "lang", "term").sortWithinPartitions("lang", "term")
        .mapInArrow(_transducers(SHARD_TERMS, SHARD_BYTES), _SHARD), "transducers")
    order = Window.partitionBy("lang").orderBy("first")
    light = shards.select(
        "lang", "first", (F.row_number().over(order) - 1).alias("shard"),
        (F.sum("size").over(order) - F.col("size")).alias("base"))
    return written(shards.join(light, ["lang", "first"]), "vocabulary")


def _transducer(row) -> Transducer:
    kinds = {"keys": np.int64, "targets": np.int32, "skips": np.int32, "final": bool}
    return Transducer(**{name: np.asarray(row[name], kind) for name, kind in kinds.items()}, root=row["root"])


class Stretches:
    """The first terms of a language's transducers; deals sorted terms to them."""

    def __init__(self):
        self.firsts: dict[str, list[tuple[bytes, int]]] = {}

    def add(self, lang: str, first: bytes, shard: int) -> None:
        self.firsts.setdefault(lang, []).append((first, shard))

    def deal(self, lang: str, words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """Shards of a language and the places of the words that fall into each."""
        its = sorted(self.firsts.get(lang, ()))
        if len(its) == 1:
            yield its[0][1], np.arange(len(words))
        elif its:
            at = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
            ranked = [words[i] for i in at]
            cuts = [0, *(bisect_left(ranked, first) for first, _ in its[1:]), len(words)]
            for (_, shard), low, high in zip(its, cuts, cuts[1:]):
                if high > low:
                    yield shard, at[low:high]


def _stream(rows, batches: Iterator[pa.RecordBatch], stretches: Stretches, tally: Tally):
    """Runs over the text and yields what ``rows`` makes of it, full tally by full tally."""
    for key, text in _texts(batches):
        if key[0] not in stretches.firsts:
            continue
        for piece in pieces(text):
            tally.add(key, tally.numbered(key[0], piece))
            if tally.full:
                yield from rows(tally)
                tally.clear()
    yield from rows(tally)


_COUNT = "lang string, source string, shard int, ordinal long, n long"


def _carried(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """Counts by ordinal; every task has all transducers and meets the text with them."""
    held, stretches = {}, Stretches()
    for row in shards.collect():  # at most CARRIED_BYTES
        stretches.add(row["lang"], bytes(row["first"]), row["shard"])
        held[row["lang"], row["shard"]] = (row["base"], _transducer(row))
    sent = docs.sparkSession.sparkContext.broadcast((held, stretches))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducers, dealt = sent.value

        def rows(tally: Tally) -> Iterator[pa.RecordBatch]:
            places = {}
            for lang in tally.numbers:  # each term walks once, however many occurrences it has
                words = tally.words(lang)
                shards, ordinals = np.zeros(len(words), np.int32), np.full(len(words), -1)
                for shard, at in dealt.deal(lang, words):
                    base, t = transducers[lang, shard]
                    found = t.ordinals([words[i] for i in at.tolist()])
                    shards[at], ordinals[at] = shard, np.where(found < 0, -1, found + base)
                places[lang] = shards, ordinals
            for (lang, source), numbers, n in tally.counted():
                shards, ordinals = (x[numbers] for x in places[lang])
                held = ordinals >= 0
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, int(held.sum())), pa.repeat(source, int(held.sum())), pa.array(shards[held]),
                     pa.array(ordinals[held]), pa.array(n[held])], names=["lang", "source", "shard", "ordinal", "n"])

        yield from _stream(rows, batches, dealt, Tally(TALLY_TERMS, TALLY_BYTES))

    return docs.mapInArrow(freeing(count), _COUNT)


def _beside(rows: DataFrame, shards: DataFrame, task, schema: str, salts: int = 1) -> DataFrame:
    """``task(transducer, base, batch)`` on batches of ``rows`` (lang, shard, salt, ...), each
    with the transducer of its shard. A task holds one transducer and one batch at a time."""
    heavy = [c for c in shards.columns if c not in ("lang", "shard")]
    left = shards.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(
        "lang", "shard", "salt", F.lit(0).alias("__turn"), F.struct(*heavy).alias("__held"))
    both = left.unionByName(rows.withColumn("__turn", F.lit(1)), allowMissingColumns=True)
    ahead = ("lang", "shard", "salt")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = transducer = None
        for batch in batches:
            turn = batch.column("__turn").to_numpy()
            heads = np.flatnonzero(turn == 0)
            for low, high in zip([0, *(heads + 1)], [*heads, len(turn)]):
                if low and turn[low - 1] == 0:
                    row = batch.column("__held")[low - 1].as_py()
                    base, transducer = row["base"], _transducer(row)
                if high > low:
                    yield from task(transducer, base, batch.slice(low, high - low))

    # Few transducers a partition, as those that no row follows arrive in one batch.
    parts = max(partitions(rows.sparkSession), shards.count() * salts // 4)
    return both.repartition(parts, *ahead).sortWithinPartitions(*ahead, "__turn").mapInArrow(run, schema)


def _dealt(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """Counts by ordinal; the terms of each task, counted there, go to their transducer."""
    stretches = Stretches()
    for row in shards.select("lang", "first", "shard").collect():  # one row for each SHARD_TERMS terms
        stretches.add(row["lang"], bytes(row["first"]), row["shard"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(tally: Tally) -> Iterator[pa.RecordBatch]:
            terms, shards = {}, {}
            for lang in tally.numbers:
                words = tally.words(lang)
                terms[lang], shards[lang] = pa.array(words, pa.binary()), np.zeros(len(words), np.int32)
                for shard, at in stretches.deal(lang, words):
                    shards[lang][at] = shard
            for (lang, source), numbers, n in tally.counted():
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(n)), pa.repeat(source, len(n)), pa.array(shards[lang][numbers]),
                     terms[lang].take(pa.array(numbers)), pa.array(n)], names=["lang", "source", "shard", "term", "n"])

        yield from _stream(rows, batches, stretches, Tally(TALLY_TERMS, TALLY_BYTES))

    def walk(t: Transducer, base: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = t.ordinals(batch.column("term").to_pylist())
        held = found >= 0
        part = batch.filter(pa.array(held))
        yield pa.RecordBatch.from_arrays(
            [part.column("lang"), part.column("source"), part.column("shard"), pa.array(found[held] + base),
             part.column("n")], names=["lang", "source", "shard", "ordinal", "n"])

    words = docs.mapInArrow(freeing(count), "lang string, source string, shard int, term binary, n long")
    salted = words.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
    return _beside(salted, shards, walk, _COUNT, SALTS)


def recounted(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """lang, source, shard, ordinal and n: the occurrences of every kept term in every group."""
    size = shards.agg(F.sum(F.size("keys") * 16 + F.size("final") + F.octet_length("first"))).first()[0] or 0
    found = (_carried if size <= CARRIED_BYTES else _dealt)(docs.select("lang", "source", "text"), shards)
    return found.groupBy("lang", "source", "shard", "ordinal").agg(F.sum("n").alias("n"))


def _share(n: str, total: str, size: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * size)), in decimals of 38 digits."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * cast({n} + 2 as decimal(20, 0))) "
                  f"div nullif(cast({total} + 2 * {size} as decimal(20, 0)), 0)")


def _divergence(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


_SUMS = "lang string, a long, b long, value long, terms long"


def _tile(table: pa.Table) -> pa.Table:
    """Sums over the terms of one block for pairs of sources of two tiles."""
    tile, source, ordinal, p = (table.column(c) for c in ("tile", "place", "ordinal", "p"))
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    known, source, p = ~ordinal.is_null().to_numpy(), source.to_numpy(), p.to_numpy()
    listed, row = np.unique(ordinal.filter(pa.array(known)).to_numpy(), return_inverse=True)
    sources, first = np.unique(source, return_index=True)
    column = np.searchsorted(sources, source)
    shares = np.empty((len(listed), len(sources)), np.int64)
    shares[:, column[~known]] = p[~known]  # what a source that lacks the term has
    shares[row, column[known]] = p[known]
    side = tile.to_numpy()[first]
    others = np.flatnonzero(side == j)
    left, right, value = [], [], []
    for a in np.flatnonzero(side == i):
        b = others[others > a] if i == j else others
        difference = shares[:, b] - shares[:, a, None]
        found = (difference * difference // (shares[:, b] + shares[:, a, None])).sum(axis=0)
        left.append(np.full(len(b), sources[a]))
        right.append(sources[b])
        value.append(found)
    a, b, value = (np.concatenate(x).astype(np.int64) for x in (left, right, value))
    return pa.table({
        "lang": pa.repeat(table.column("lang")[0].as_py(), len(a)), "a": a, "b": b, "value": value,
        "terms": np.full(len(a), len(listed), np.int64)})


def _pair_sums(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b (places of sources, a before b), the sum over the terms that some tile of
    theirs lists, and how many these are."""
    tile = F.floor(F.col("place") / TILE).alias("tile")
    tiles = F.ceil(F.col("sources") / TILE).alias("tiles")
    given = counts.join(groups, ["lang", "source"]).select(
        "lang", F.floor(F.col("ordinal") / BLOCK).alias("block"), tile, tiles, "place", "ordinal",
        _share("n", "total", "size").alias("p"))
    lacking = groups.where("size > 0").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / BLOCK))).alias("block"),
        tile, tiles, "place", F.lit(None).cast("long").alias("ordinal"), _share("0", "total", "size").alias("p"))
    met = given.unionByName(lacking).withColumn(
        "with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    return (met.select("lang", "block", F.least("tile", "with").alias("i"), F.greatest("tile", "with").alias("j"),
                       "tile", "place", "ordinal", "p")
            .groupBy("lang", "block", "i", "j").applyInArrow(_tile, _SUMS)
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms")))


def _pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language and its divergence over all kept terms."""
    one = groups.select("lang", "source", "size", "place", _share("0", "total", "size").alias("p"))
    two = one.select("lang", F.col("source").alias("item"), F.col("place").alias("other"), F.col("p").alias("q"))
    ends = (F.least("place", "other").alias("a"), F.greatest("place", "other").alias("b"))
    found = one.join(two, "lang").where("place <> other").select("*", *ends).join(
        _pair_sums(counts, groups), ["lang", "a", "b"], "left")
    rest = (F.col("size") - F.coalesce("terms", F.lit(0))) * _divergence("p", "q")
    value = F.coalesce("value", F.lit(0)) + F.coalesce(rest, F.lit(0))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return found.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")).withColumn(
        "rank", place)


def _words(top: DataFrame, shards: DataFrame) -> DataFrame:
    """``top`` (lang, source, shard, ordinal, value, rank) with each ordinal's term as item."""
    def look(t: Transducer, base: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        items = [t.word(o - base).decode() for o in batch.column("ordinal").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("source"), pa.array(items, pa.string()), batch.column("value"),
             batch.column("rank")], names=["lang", "source", "item", "value", "rank"])

    return _beside(top.withColumn("salt", F.lit(0)), shards, look,
                   "lang string, source string, item string, value long, rank int")


def _terms(counts: DataFrame, groups: DataFrame, shards: DataFrame, most: int) -> DataFrame:
    """The terms of each group that go furthest beyond their share of the language; the
    ordinal decides ties."""
    whole = F.sum("n").over(Window.partitionBy("lang", "ordinal")).alias("in_lang")
    shares = counts.select("*", whole).join(groups, ["lang", "source"]).select(
        "lang", "source", "shard", "ordinal", _share("n", "total", "size").alias("p"),
        _share("in_lang", "lang_total", "size").alias("q"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal"))
    top = (shares.where("p > q").select("lang", "source", "shard", "ordinal", _divergence("p", "q").alias("value"))
           .withColumn("rank", place).where(F.col("rank") <= most))
    return _words(top, shards).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, min_docs: int = 10, most: int = 10) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank of ``docs`` (text, lang, source)."""
    docs = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    shards = vocabulary(docs, min_docs)
    counts = written(recounted(docs, shards), "counts")
    of_lang = Window.partitionBy("lang")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = shards.groupBy("lang").agg(F.sum("size").alias("size"))
    known = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = written(
        known.select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("size", zero).alias("size"))
        .select("*", F.sum("total").over(of_lang).alias("lang_total"), F.count("*").over(of_lang).alias("sources"),
                (F.row_number().over(of_lang.orderBy("source")) - 1).cast("long").alias("place")), "groups")
    return _pairs(counts, groups).unionByName(_terms(counts, groups, shards, most))
