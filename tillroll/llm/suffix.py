"""Repeated passages through a sparse suffix array: suffixes at minimiser positions.

Hashes stand in for texts: suffixes are sorted by the hash of their first words, and matches extended as hashed windows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillroll.llm.common import batches, materialise, ship
from tillroll.llm.words import mixed, run_hashes, sorted_groups, word_hashes

_DOC = ["doc_id", "mark"]


def minimisers(runs: np.ndarray, window: int) -> np.ndarray:
    """Places whose run of words has the least hash of a window of `window` runs; the first one of equals."""
    if len(runs) < window:
        return np.array([], np.int64)
    views = np.lib.stride_tricks.sliding_window_view(runs, window)
    return np.unique(views.argmin(axis=1) + np.arange(len(views)))


def _texts(stream: Iterator[pa.RecordBatch], *lengths: int) -> Iterator[tuple]:
    """Each row's batch and place, its words' hashes, and those of its runs of each of `lengths` words."""
    for batch in stream:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for a, b in batches([len(t) for t in texts], 1_000_000):
            words, counts = word_hashes(texts[a:b])
            runs = [run_hashes(words, length) for length in lengths]
            at = 0
            for i, n in zip(range(a, b), counts.tolist(), strict=True):
                yield batch, i, words[at : at + n], *(r[at : at + max(n - length + 1, 0)] for r, length in zip(runs, lengths, strict=True))
                at += n


def _rows(parts: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Parts of (doc_id, mark, columns ...) as one batch."""
    sizes = [len(p[2]) for p in parts]
    fixed = [np.repeat(np.array([p[i] for p in parts], kind), sizes) for i, kind in ((0, np.int64), (1, np.int32))]
    return pa.record_batch([*fixed, *(np.concatenate([p[i] for p in parts]) for i in range(2, len(names)))], names=names)


def _gathered(parts: Iterator[tuple], names: list[str], rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[2])
        if n >= rows:
            yield _rows(held, names)
            held, n = [], 0
    if n:
        yield _rows(held, names)


def _suffixes(stream: Iterator[pa.RecordBatch], length: int, gram: int, window: int, reach: int) -> Iterator[pa.RecordBatch]:
    """The retained suffixes: document, hash of the first `reach` words, place. Place -n gives a document's n words."""

    def parts():
        for batch, i, words, runs, heads in _texts(stream, gram, reach):
            if len(words) >= length:
                places = minimisers(runs, window)
                places = places[places < len(heads)]
                heads = np.concatenate([[np.uint64(0)], heads[places]])
                places = np.concatenate([[-len(words)], places])
                yield batch.column("doc_id")[i].as_py(), batch.column("mark")[i].as_py(), heads.view(np.int64), places.astype(np.int32)

    yield from _gathered(parts(), ["doc_id", "mark", "head", "place"])


def _passages(stream: Iterator[pa.RecordBatch], length: int, reach: int) -> Iterator[pa.RecordBatch]:
    """Passages of `length` words that hold a suffix's first `reach` words: each extended to the left and right."""

    def parts():
        for batch, i, words, runs in _texts(stream, length):
            places = np.array(batch.column("places")[i].as_py(), np.int64)
            starts = np.unique(places[:, None] + np.arange(reach - length, 1)[None, :])
            starts = starts[(starts >= 0) & (starts < len(runs))]
            if len(starts):
                again = mixed(runs[starts] + words[starts])
                yield batch.column("doc_id")[i].as_py(), batch.column("mark")[i].as_py(), runs[starts].view(np.int64), again.astype(np.uint32).view(np.int32), starts.astype(np.int32)

    yield from _gathered(parts(), ["doc_id", "mark", "head", "again", "place"])


def _compare(stream: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """From sorted rows, those that agree with a neighbour in `keys`, and the task's first and last."""
    held: pa.RecordBatch | None = None
    before: tuple | None = None  # keys of the row before `held`
    start = True
    at = lambda b, i: tuple(b.column(k)[i].as_py() for k in keys)

    def out(rows: pa.RecordBatch, after: tuple | None) -> pa.RecordBatch:
        nonlocal before, start
        n = rows.num_rows
        same = np.ones(max(n - 1, 0), bool)
        for k in keys:
            values = rows.column(k).to_numpy()
            same &= values[1:] == values[:-1]
        first, last = at(rows, 0), at(rows, n - 1)
        prev = np.concatenate([[before == first], same])
        then = np.concatenate([same, [after == last]])
        edge = np.zeros(n, bool)
        edge[0] |= start
        edge[-1] |= after is None
        before, start = last, False
        result = rows.append_column("prev_same", pa.array(prev)).append_column("next_same", pa.array(then)).append_column("edge", pa.array(edge))
        return result.filter(pa.array(prev | then | edge))

    for batch in stream:
        if not batch.num_rows:
            continue
        if held is not None:
            yield out(held, at(batch, 0))
        held = batch
    if held is not None:
        yield out(held, None)


def neighbours(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that agree in `keys` with the row before or after them in the order of all columns, and with which.

    The order is a sort over all tasks; since it ends in document and place, equal keys spread over tasks too. Each
    task compares its own rows, and of the first and last rows of tasks, two each, one more step compares the ends.
    """
    order = [*keys, "doc_id", "mark", "place"]
    rows = rows.select(*order)
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("task", F.spark_partition_id())
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema)
    compared = materialise(ranged.mapInArrow(partial(_compare, keys=keys), f"{schema}, prev_same boolean, next_same boolean, edge boolean"), "neighbours")
    over = Window.orderBy("task", *order)
    key = F.struct(*keys)
    ends = compared.filter("edge").withColumn("_before", F.lag(key).over(over)).withColumn("_after", F.lead(key).over(over))
    ends = ends.withColumn("prev_same", F.col("prev_same") | F.coalesce(F.col("_before") == key, F.lit(False)))
    ends = ends.withColumn("next_same", F.col("next_same") | F.coalesce(F.col("_after") == key, F.lit(False)))
    both = compared.filter("NOT edge").unionByName(ends.drop("_before", "_after"))
    return both.filter("prev_same OR next_same").drop("edge", "task")


def _spans(stream: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Per document, the runs of words that passages cover: those seen before, and those seen first here.

    Place -n stands for all passages of a text of n words.
    """
    out: list[tuple] = []
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int32()), ("start", pa.int32()), ("words", pa.int32()), ("first", pa.bool_())])
    for group in sorted_groups(stream, 2):
        doc, mark = group["doc_id"][0].as_py(), group["mark"][0].as_py()
        places, copies = group["place"].to_numpy().astype(np.int64), np.asarray(group["copy"])
        seen, new = np.unique(places[copies]), np.unique(places[~copies & (places >= 0)])
        if places.min() < 0:
            new = np.setdiff1d(np.arange(-places.min() - length + 1), seen)
        for first, starts in ((False, seen), (True, new)):
            if len(starts):
                cut = np.flatnonzero(np.diff(starts) > length) + 1
                for part in np.split(starts, cut):
                    out.append((doc, mark, int(part[0]), int(part[-1] - part[0] + length), first))
        if len(out) > 10_000:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out = []
    if out:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _named(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash(text).alias("mark"), text.alias("text"))
    return named.filter("doc_id IS NOT NULL AND text IS NOT NULL")


def repeated_passages(docs: DataFrame, length: int = 50, gram: int = 6, window: int = 20) -> DataFrame:
    """(doc_id, mark, start, words, first): runs of words covered by passages of `length` words that occur again.

    Passages are compared over the whole table, places in one document included. Rows with `first` false cover all
    passages that an earlier place, by (doc_id, mark, place), has; rows with `first` true cover those whose later copies
    are elsewhere. `start` and `words` count words between white space; `mark` is a hash of the text.

    Any `length` words hold a minimiser among their first `window` places, followed by reach = length - window + 1 words.
    Suffixes at minimisers are sorted by their first `reach` words; those equal to a neighbour are extended left and
    right to every passage of `length` words around them, and the passages are sorted and compared in turn. Texts equal as
    a whole are compared once, through their first document.

    Null ids or texts take no part and texts under `length` words have no passage. Rows that repeat id and text count as
    one document. Other columns are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    reach = length - window + 1
    named = _named(docs)
    suffixes = named.mapInArrow(
        partial(_suffixes, length=length, gram=gram, window=window, reach=reach), "doc_id long, mark int, head long, place int"
    )
    suffixes = materialise(suffixes, "suffixes")
    met = neighbours(suffixes.filter("place >= 0"), ["head"])

    whole = named.select("doc_id", "mark", F.unhex(F.md5(F.col("text").cast("binary"))).alias("content"))
    whole = materialise(whole.distinct(), "contents")
    heads = whole.groupBy("content").agg(F.min(F.struct(*_DOC)).alias("head"), F.count("*").alias("copies")).filter("copies > 1")
    copies = whole.join(heads, "content").filter(F.struct(*_DOC) != F.col("head")).select(*_DOC).distinct()
    copies = materialise(copies, "copies")

    places = met.join(copies, _DOC, "left_anti").groupBy(*_DOC).agg(F.collect_list("place").alias("places"))
    candidates = named.join(places, _DOC).dropDuplicates(_DOC)
    passages = candidates.mapInArrow(partial(_passages, length=length, reach=reach), "doc_id long, mark int, head long, again int, place int")
    found = neighbours(materialise(passages, "passages"), ["head", "again"])
    sizes = suffixes.filter("place < 0").select(*_DOC, "place").distinct()
    copied = sizes.join(heads.select("head.doc_id", "head.mark"), _DOC, "left_semi").withColumn("copy", F.lit(False))
    covered = found.select(*_DOC, "place", F.col("prev_same").alias("copy")).unionByName(copied)
    covered = covered.repartition(*_DOC).sortWithinPartitions(*_DOC)
    spans = covered.mapInArrow(partial(_spans, length=length), "doc_id long, mark int, start int, words int, first boolean")

    full = sizes.join(copies, _DOC, "left_semi").withColumn("words", -F.col("place"))
    return spans.unionByName(full.select(*_DOC, F.lit(0).alias("start"), "words", F.lit(False).alias("first")))


def _cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the spans' words: what stands before, between and after them is joined by line ends."""
    for batch in stream:
        texts = batch.column("text").to_pylist()
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            words = list(re.finditer(r"\S+", texts[i]))
            parts, at = [], 0
            for start, n in sorted((s["start"], s["words"]) for s in spans):
                parts.append(texts[i][at : words[start].start()])
                at = words[start + n - 1].end()
            parts.append(texts[i][at:])
            texts[i] = "\n".join(p.strip() for p in parts if p.strip())
        yield batch.set_column(1, "text", pa.array(texts, pa.string())).drop_columns(["spans"])


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """Rows of `docs` with all columns, each repeated passage left only where it comes first; emptied texts go.

    Rows without repeated passages stay exactly as they are. Null ids and texts stay. Rows that repeat id and text
    lose the same passages.
    """
    spans = repeated_passages(docs, **options).filter("NOT first").groupBy(*_DOC).agg(F.collect_list(F.struct("start", "words")).alias("spans"))
    text = F.col("row.text").cast("string")
    keyed = docs.select(F.struct("*").alias("row")).withColumns({"doc_id": F.col("row.doc_id").cast("long"), "mark": F.hash(text)})
    marked = keyed.join(spans, _DOC, "left")
    kept = marked.filter("spans IS NULL").select("row")
    found = marked.filter("spans IS NOT NULL").select("row", text.alias("text"), "spans")
    row = kept.schema["row"].dataType.simpleString()
    cut = found.mapInArrow(_cut, found.drop("spans").schema).filter("text != ''")
    cut = cut.select(F.col("row").withField("text", F.col("text").cast(docs.schema["text"].dataType)).cast(row).alias("row"))
    return kept.union(cut).select("row.*")
