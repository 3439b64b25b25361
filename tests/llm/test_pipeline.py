"""Stages of corpus_pipeline, written and read between each other."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.test_corpus import covered, jaccard_groups, near_rows, passage_rows
from tillroll.llm import quality


def reread(frame, path, parts=None):
    (frame if parts is None else frame.repartitionByRange(parts, "n_chars")).write.parquet(str(path))
    return frame.sparkSession.read.parquet(str(path))


def test_packing_follows_the_mix_after_files_of_unequal_size(spark, make_docs, tmp_path, words):
    """Files are written by length of text, so that reading them deals the sources out in another order than the mix."""
    rows = [(i, words(40 + i * 37 % 300), "en", "hot" if i % 4 else f"s{i % 3}") for i in range(1200)]
    docs = make_docs(rows)
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    assert mixed.columns == [*docs.columns, "mix_position"]
    stored = reread(mixed, tmp_path / "mix", 7)
    at = {r.doc_id: r.mix_position for r in stored.collect()}
    assert len(at) == len(set(at.values())) == 1200
    rank = {d: i for i, d in enumerate(sorted(at, key=at.get))}
    source = {r[0]: r[3] for r in rows}
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        packed = reread(corpus_pipeline.pack_tokens(spark, stored, ""), tmp_path / "pack").filter(f"sequence_id < {1 << 58}").collect()
    finally:
        spark.conf.unset(coalesce)
    homes: dict[int, list[int]] = {}
    for r in packed:
        homes.setdefault(r.sequence_id >> 31, []).append(r.doc_id)
    assert len(homes) > 1
    spans = [(min(rank[d] for d in ids), max(rank[d] for d in ids)) for _, ids in sorted(homes.items())]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    share = lambda ids: sum(source[d] == "hot" for d in ids) / len(ids)
    order = sorted(rank, key=rank.get)
    for (a, b), (_, ids) in zip(spans, sorted(homes.items()), strict=True):
        assert abs(share(set(ids)) - share(order[a : b + 1])) < 0.15


def stored(frame, path):
    frame.write.mode("overwrite").parquet(str(path))
    return frame.sparkSession.read.parquet(str(path))


def test_near_copies_and_repeats_equal_brute_force(spark, make_docs, tmp_path, words):
    """Both stages as the pipeline runs them, each on what the one before it wrote."""
    stages = dict(corpus_pipeline.STAGES)
    rows = near_rows(words) + [(1000 + d, t) for d, t in passage_rows(words)]
    docs = stored(make_docs(rows), tmp_path / "docs")
    near = stored(stages["near"](spark, docs, ""), tmp_path / "near")
    _, groups = jaccard_groups(rows)
    assert near.columns == docs.columns
    kept = {r.doc_id: r.text for r in near.collect()}
    assert sorted(kept) == sorted(d for d, g in groups.items() if d == g) and kept.items() <= dict(rows).items()

    repeats = stored(stages["repeats"](spark, near, ""), tmp_path / "repeats")
    assert repeats.columns == docs.columns
    later, _ = covered([(d, t or "") for d, t in kept.items()], 50)
    assert len(later) > 20
    want = {d: [w for i, w in enumerate((t or "").split()) if i not in later.get(d, ())] for d, t in kept.items()}
    want = {d: w for d, w in want.items() if w or d not in later}
    got = {r.doc_id: r for r in repeats.collect()}
    assert {d: (r.text or "").split() for d, r in got.items()} == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.values())
    assert all(r.text == kept[d] for d, r in got.items() if d not in later)


def test_quality_stage_keeps_what_the_operator_keeps(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    kept = dict(corpus_pipeline.STAGES)["quality"](spark, docs, sf_dir)
    judged = quality.judge(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in judged.filter("keep").collect())


def test_whole_run_on_odd_rows_and_on_an_empty_table(spark, make_docs, tmp_path, words):
    same = words(90)
    rows = [(i, words(30 + i), "en", f"s{i % 3}") for i in range(40)] + [(100 + i, same) for i in range(6)]
    rows += [(200, None), (201, ""), (202, "  "), (None, words(20)), (203, words(4000)), (204, words(12), None, None), (204, words(13), "xx", "s1")]
    labels = spark.createDataFrame([(i, 1, 0) for i in (*range(30), *range(100, 106), 203)] + [(None, 1, None), (200, None, 1)], "doc_id long, quality int, toxic int")
    full, empty = tmp_path / "full", tmp_path / "empty"
    for folder, docs in ((full, make_docs(rows)), (empty, make_docs([]))):
        docs.write.parquet(str(folder / "documents.parquet"))
        labels.write.parquet(str(folder / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
    pieces = corpus_pipeline.run(spark, str(full)).collect()
    assert len({100 + i for i in range(6)} & {r.doc_id for r in pieces}) == 1
    assert {r.doc_id for r in pieces} >= {*range(30), 203} and sum(r.length for r in pieces if r.doc_id == 203) > 4000
    by_document = {}
    for r in pieces:
        by_document[r.doc_id, r.doc_tokens] = by_document.get((r.doc_id, r.doc_tokens), 0) + r.length
    assert all(total % tokens == 0 for (_, tokens), total in by_document.items())
    spans = {}
    for r in pieces:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in spans.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 1024
