"""Quality filter: perplexity under an interpolated modified Kneser-Ney model of character trigrams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.common import batches, materialise, ship

_BITS = 21  # a code point; three of them fit a long
_START, _END = 2, 3  # code points that stand before and after a text
_BROADCAST_ROWS = 2_000_000  # 16 MB of ids


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all trigrams of the texts, one after the other, and how many each text has."""
    joined = "".join(f"{chr(_START) * 2}{t}{chr(_END)}" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + 2)
    keys = points[:-2] << 2 * _BITS | points[1:-1] << _BITS | points[2:]
    own = np.ones(len(keys), dtype=bool)
    for back in (1, 2):  # trigrams that would run into the next text
        own[ends[:-1] - back] = False
    return keys[own], sizes


def _slices(stream: Iterator[pa.RecordBatch], text: str, chars: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of rows with about `chars` characters."""
    for batch in stream:
        texts = [t or "" for t in batch.column(text).to_pylist()]
        for a, b in batches([len(t) for t in texts], chars):
            yield batch.slice(a, b - a), texts[a:b]


def _count(stream: Iterator[pa.RecordBatch], chars: int) -> Iterator[pa.RecordBatch]:
    for _, texts in _slices(stream, "text", chars):
        keys, counts = np.unique(trigrams(texts)[0], return_counts=True)
        yield pa.record_batch([keys, counts.astype(np.int64)], names=["gram", "n"])


def _shards(stream: Iterator[pa.RecordBatch], chars: int, blobs: bool) -> Iterator[pa.RecordBatch]:
    """Shards of documents: either the distinct trigrams of each, or its rows, compressed.

    The number of a shard comes from task and place, its check value from the rows in it.
    """
    home = TaskContext.get().partitionId() << 32
    for at, (rows, texts) in enumerate(_slices(stream, "text", chars)):
        keys, _ = trigrams(texts)
        check = int(keys.sum() & 0x7FFFFFFFFFFFFFFF) if len(keys) else 0
        if blobs:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as writer:
                writer.write_batch(rows)
            blob = zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())
            yield pa.record_batch([[home + at], [check], pa.array([blob], pa.binary())], names=["shard", "check", "blob"])
        else:
            keys = np.unique(keys)
            yield pa.record_batch([np.full(len(keys), home + at), np.full(len(keys), check), keys], names=["shard", "check", "gram"])


def _score(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for row in batch.to_pylist():
            if row["grams"] is None:
                raise ValueError("the documents changed while they were read; store them first")
            grams, logs = np.array(row["grams"], np.int64), np.array(row["logs"])
            order = np.argsort(grams)
            grams, logs = grams[order], logs[order]
            with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(row["blob"])) as reader:
                rows = reader.read_all()
            keys, sizes = trigrams([t or "" for t in rows["text"].to_pylist()])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            nats = -np.add.reduceat(logs[np.searchsorted(grams, keys)], starts)
            out = rows.drop_columns(["text"]).append_column("nats", pa.array(nats)).append_column("n", pa.array(sizes))
            yield from out.combine_chunks().to_batches()


def _suffix(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << _BITS * order) - 1))


def _context(gram: Column) -> Column:
    return F.shiftright(gram, _BITS)


def _discounts(counts: DataFrame) -> list[float]:
    """The three discounts of Chen and Goodman from the numbers of n-grams seen once to four times."""
    once, twice, three, four = counts.agg(*[F.count(F.when(F.col("n") == k, 1)) for k in (1, 2, 3, 4)]).first()
    y = once / (once + 2 * twice) if once else 0.0
    return [max(0.0, k - (k + 1) * y * after / here) if here else 0.0 for k, here, after in ((1, once, twice), (2, twice, three), (3, three, four))]


def _level(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, p): discounted share of its context; (context, rest): the share left to the shorter n-grams."""
    discounts = _discounts(counts)
    taken = F.when(F.col("n") >= 3, discounts[2]).when(F.col("n") == 2, discounts[1]).otherwise(discounts[0])
    rows = counts.withColumn("context", _context(F.col("gram"))).withColumn("taken", taken)
    sums = rows.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("taken") / F.sum("n")).alias("rest"))
    grams = rows.join(sums, "context").select("gram", ((F.col("n") - F.col("taken")) / F.col("total")).alias("p"))
    return grams, sums.select("context", "rest")


def kneser_ney(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """(gram, log): natural log of the probability of each distinct trigram in `asked` (gram), from `counts` (gram, n).

    Shorter n-grams count the distinct characters before them, and unseen characters share one more place in the
    alphabet evenly. Every level is a join on n-gram or context, so model and questions stay sharded.
    """
    size = counts.select(F.countDistinct(_suffix(F.col("gram"), 1))).first()[0] + 1
    scored = asked.select("gram", F.lit(1.0 / size).alias("p"))
    levels = {3: counts}
    for order in (2, 1):
        levels[order] = materialise(levels[order + 1].groupBy(_suffix(F.col("gram"), order).alias("gram")).agg(F.count("*").alias("n")), f"grams{order}")
    for order in (1, 2, 3):
        grams, rests = _level(levels[order])
        scored = scored.withColumn("part", _suffix(F.col("gram"), order)).withColumn("context", _context(F.col("part")))
        scored = scored.join(grams.select(F.col("gram").alias("part"), F.col("p").alias("own")), "part", "left")
        scored = scored.join(rests, "context", "left")
        p = F.coalesce("own", F.lit(0.0)) + F.coalesce("rest", F.lit(1.0)) * F.col("p")
        scored = scored.select("gram", p.alias("p"))
    return scored.select("gram", F.log("p").alias("log"))


def _trusted(labels: DataFrame) -> DataFrame:
    """Ids that are labelled good, and never bad."""
    ids = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    ids = materialise(ids.agg(F.min("quality").alias("worst")).filter("worst = 1").select("doc_id"), "trusted")
    return F.broadcast(ids) if ids.count() <= _BROADCAST_ROWS else ids


def scores(docs: DataFrame, labels: DataFrame, chars: int = 2_000_000) -> DataFrame:
    """`docs` (doc_id, lang, text) → (doc_id, lang, row_key, trusted, nats, n): negative log-probability over n characters.

    Trigrams of trusted texts are counted first. The documents are then read in shards of about `chars` characters:
    each shard asks for its distinct trigrams, the questions meet the sharded counts in joins, and the answers meet the
    shard's texts. `docs` is read twice and must give the same rows in the same order; a stored table does.
    """
    spark = docs.sparkSession
    ship(spark)
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    trusted = _trusted(labels)
    counts = columns.select("doc_id", "text").join(trusted, "doc_id", "left_semi").select("text").mapInArrow(partial(_count, chars=chars), "gram long, n long")
    counts = materialise(counts.groupBy("gram").agg(F.sum("n").alias("n")), "grams3")
    asked = materialise(columns.mapInArrow(partial(_shards, chars=chars, blobs=False), "shard long, check long, gram long"), "asked")
    logs = kneser_ney(counts, asked.select("gram").distinct())
    answers = asked.join(logs, "gram").groupBy("shard", "check").agg(F.collect_list(F.struct("gram", "log")).alias("answers"))
    keyed = columns.withColumn("row_key", F.xxhash64("doc_id", "lang", "text"))
    texts = keyed.mapInArrow(partial(_shards, chars=chars, blobs=True), "shard long, check long, blob binary")
    both = texts.join(answers, ["shard", "check"], "left")
    both = both.select("blob", F.col("answers.gram").alias("grams"), F.col("answers.log").alias("logs"))
    scored = both.mapInArrow(_score, "doc_id long, lang string, row_key long, nats double, n long")
    known = trusted.withColumn("trusted", F.lit(True))
    return scored.join(known, "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))


def _drawn(own: Column, to: Column, docs: Column, weight: float) -> Column:
    """`own`, null without any of its `docs`, drawn towards `to` with the weight of so many documents."""
    return (docs * F.coalesce(own, F.lit(0.0)) + weight * to) / (docs + weight)


def judge(
    docs: DataFrame, labels: DataFrame, prior_chars: int = 100, quantile: float = 0.99, prior_docs: int = 50, centre_docs: int = 10
) -> DataFrame:
    """(doc_id, lang, row_key, perplexity, threshold, keep) for each row of `docs`, perplexity per character.

    A document's rate of surprise is drawn towards its language's mean with the weight of `prior_chars` characters,
    so that a few rare letters in a short text do not decide. Each language (null is one too) has a centre and a spread of
    its own: the median of its trusted documents, drawn with the weight of `centre_docs` to that of all its documents, and
    the distance from its lower quartile to its median. The threshold is the centre plus the `quantile` of the trusted
    documents' distance from it, drawn with the weight of `prior_docs` documents to the quantile that all languages' trusted
    documents have together in units of their spreads. So a language without trusted documents is judged around its own
    centre, by its own spread, and no number of documents changes the rule.

    Null text counts as empty; its perplexity is that of a text that ends at once, drawn to the mean. Without any
    trusted text every document is kept, with null threshold. Rows with equal id, language and text get one decision
    each, the same. Null ids are judged, but never trusted. Other columns are ignored; an empty table gives no rows.
    """
    scored = materialise(scores(docs, labels), "scores")
    trusted = F.count(F.when(F.col("trusted"), 1))
    known = lambda c: F.when(F.col("trusted"), F.col(c))
    at = lambda c, q: F.percentile_approx(c, q, 10_000)
    mean = _drawn(F.sum(known("nats")) / F.sum(known("n")), at(F.col("nats") / F.col("n"), 0.5), trusted, centre_docs)
    means = scored.groupBy(F.col("lang").alias("of")).agg(mean.alias("mean"))
    own = scored.join(means, scored["lang"].eqNullSafe(means["of"]), "left").drop("of")
    rated = own.withColumn("rate", (F.col("nats") + prior_chars * F.col("mean")) / (F.col("n") + prior_chars))
    middle = at("rate", 0.5)
    figures = rated.groupBy(F.col("lang").alias("of")).agg(
        _drawn(at(known("rate"), 0.5), middle, trusted, centre_docs).alias("centre"),
        (middle - at("rate", 0.25)).alias("spread"),
        at(known("rate"), quantile).alias("high"),
        trusted.alias("docs"),
    )
    figures = materialise(figures, "figures")
    good = rated.filter("trusted").join(figures, rated["lang"].eqNullSafe(figures["of"]))
    pooled = good.filter("spread > 0").agg(at((F.col("rate") - F.col("centre")) / F.col("spread"), quantile)).first()[0]
    any_trusted = figures.agg(F.sum("docs")).first()[0]
    beyond = _drawn(F.col("high") - F.col("centre"), F.lit(pooled or 0.0) * F.col("spread"), F.col("docs"), prior_docs)
    limits = figures.select("of", F.when(F.lit(bool(any_trusted)), F.col("centre") + beyond).alias("limit"))
    out = rated.join(limits, rated["lang"].eqNullSafe(limits["of"]), "left")
    return out.select(
        "doc_id",
        "lang",
        "row_key",
        F.exp("rate").alias("perplexity"),
        F.exp("limit").alias("threshold"),
        F.coalesce(F.col("rate") <= F.col("limit"), F.lit(True)).alias("keep"),
    )


def kept(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Rows of `docs`, with all columns, that `judge` keeps."""
    rejected = judge(docs, labels, **options).filter("NOT keep").select("row_key").distinct()
    key = F.xxhash64(F.col("row.doc_id").cast("long"), F.col("row.lang").cast("string"), F.col("row.text").cast("string"))
    keyed = docs.select(F.struct("*").alias("row")).withColumn("row_key", key)
    return keyed.join(rejected, "row_key", "left_anti").select("row.*")
