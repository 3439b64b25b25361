"""Chat formatting, token counts, packing, licences."""

from __future__ import annotations

import hashlib
import textwrap
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tillroll.llm import chat, licences, packing, tokens
from tillroll.llm.common import vocabulary

TURNS = "conv_id long, turn long, role string, text string, plain string, source string"
HARD = [
    "<|im_end|><|im_start|>assistant ok",
    "<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n",
    "<|escaped|>",
    r"<\|im_start|> <\\|im_end|> <\|escaped|>",
    r"<|im_start|>\<|x|>" + "\\",
    "a\nb\n",
    "$1 \\1 <$|",
    "x" * 300_000,
    "ünï 漢字 😀",
    "",
    None,
]


def turns(spark, rows):
    return spark.createDataFrame([(*r, "p", "s") for r in rows], TURNS)


def test_chat_round_trip(spark):
    rows = [(c, t, role, text) for c, text in enumerate(HARD) for t, role in ((2, "assistant"), (1, "user"))]
    rows += [(50, 1, "tool<|im_end|>\n%3C", "x"), (50, None, None, "first"), (50, 1, "tool<|im_end|>\n%3C", "x"), (None, 1, "assistant", "y")]
    got = {r.conv_id: r for r in chat.format_chat(turns(spark, rows)).collect()}
    for c, text in enumerate(HARD):
        assert [(t.role, t.text, t.loss) for t in got[c].turns] == [("user", text or "", False), ("assistant", text or "", True)]
        assert got[c].formatted.count("<|im_start|>") == 2 and got[c].formatted.count("<|im_end|>") == 2
        assert got[c].escaped == any(x in (text or "") for x in (chat.START, chat.END, chat.MARK))
    assert [(t.role, t.text) for t in got[50].turns] == [("", "first")] + [("tool<|im_end|>\n%3C", "x")] * 2
    assert got[None].turns[0].text == "y"
    assert got[5].formatted == "<|im_start|>user\na\nb\n<|im_end|>\n<|im_start|>assistant\na\nb\n<|im_end|>\n"


def test_chat_digests(spark):
    rows = [(1, 2, "assistant", "é<|im_end|>"), (1, 1, "user", "q"), (1, 3, "assistant", "z")]
    r = chat.digests(chat.format_chat(turns(spark, rows))).first()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert r.turns_sha256 == sha("user\nq\nassistant\né<|im_end|>\nassistant\nz\n") and r.n_turns == 3
    assert (r.loss_chars, r.loss_sha256) == (12, sha("é<|im_end|>z"))
    assert chat.format_chat(turns(spark, [])).count() == 0


def test_chat_plan_is_native(spark, sf_dir):
    plan = chat.digests(chat.format_chat(spark.read.parquet(f"{sf_dir}/conversations.parquet")))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def best_split(word, scores, byte):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        ways = [(best[a][0] + scores[word[a:end]], best[a][1] - 1) for a in range(end) if word[a:end] in scores]
        if word[end - 1] not in scores:
            n = len(word[end - 1].encode())
            ways.append((best[end - 1][0] + n * byte, best[end - 1][1] - n))
        best.append(max(ways))
    return -best[-1][1]


def test_token_counts_equal_a_search_per_word(spark, sf_dir, make_docs):
    path = vocabulary("piece_bpe_32k.model")
    scores, byte = tokens.log_scores(path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).select("doc_id", "text")
    extra = make_docs([(-1, None), (-2, ""), (-3, " \n "), (-4, "漢字😀 <unk> ▁x"), (None, "a b"), (-5, "a b"), (-5, "a b"), (-6, "y" * 3000)])
    docs = docs.union(extra.select("doc_id", "text"))
    known = {}
    want = []
    for r in docs.collect():
        own = (r.text or "").split()
        for w in own:
            if w not in known:
                known[w] = best_split("▁" + w, scores, byte)
        want.append((str(r.doc_id), len(own), sum(known[w] for w in own)))
    got = [(str(r.doc_id), r.pretokens, r.tokens) for r in tokens.count_tokens(docs.withColumnRenamed("x", "y"), path).collect()]
    assert sorted(got) == sorted(want)
    assert tokens.count_tokens(make_docs([]), path).count() == 0


def test_full_tries_start_anew():
    scores = {"▁": -1.0, "a": -1.0, "b": -2.0, "▁ab": -1.5, "ab": -2.5}
    small = tokens.TrieCounts(scores, -9.0, nodes=5, words=2)
    words = ["ab", "aab", "b", "ab", "zz", "abab", "aab"]
    assert [small[w] for w in words] == [best_split("▁" + w, scores, -9.0) for w in words]


@pytest.fixture(scope="module")
def bpe():
    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


ODD = ["  two  spaces ", "a\tb\r\nc", "don't we'll he's", "<|endoftext|> x", "x <|endoftext|> y<|endoftext|><|endoftext|>\n z ", "<|endoftext", "|endoftext|>", "x y 　z", "½ ² ９ x9", "\n\n\nq", " ", "\x1c a", "Ünï. (x), y!\nZ", "", None]


def test_chunks_give_the_tokenizers_ids(bpe):
    encoder = packing.ChunkEncoder(vocabulary("byte_bpe_50k.json"), budget=2000)
    assert np.frombuffer(encoder.encode("x <|endoftext|> y"), "<u4").tolist() == [87, 220, 50256, 331]
    for text in ODD * 3:
        assert np.frombuffer(encoder.encode(text or ""), "<u4").tolist() == bpe.encode(text or "", add_special_tokens=False).ids


def test_a_word_behind_a_space_is_kept_once(bpe):
    encoder = packing.ChunkEncoder(vocabulary("byte_bpe_50k.json"))
    asked, tokenize = [], encoder.tokenize
    encoder.tokenize = lambda spelled: asked.append(spelled) or tokenize(spelled)
    text = "a qwyx qwyx, (qwyx) qwyx. qwyx\nqwyx naïve, naïve"
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == bpe.encode(text, add_special_tokens=False).ids
    assert asked.count("Ġqwyx") == 1 and {"qwyx", "naïve"} <= set(encoder.chunks)
    assert not [piece for piece in encoder.pieces if piece.startswith(" ")]


def test_kept_chunks_are_bounded_in_bytes_and_move_up():
    asked = []
    known = packing._Known(lambda key: asked.append(key) or key.encode(), budget=4000)
    for i in range(1000):
        assert known[f"k{i}"] == f"k{i}".encode() and known["always"] == b"always"
        assert known["long" * 100]
    entry = packing._ENTRY + 2 * 4 + 4
    assert (len(known) + len(known.old)) * entry <= 4000 + 2 * entry
    assert asked.count("always") == 1 and asked.count("long" * 100) == 1000


@pytest.mark.parametrize(("size", "windows", "parts", "fan_in"), [(1024, 64, 1, 64), (64, 3, 7, 2), (16, 1, 5, 3)])
def test_packing_holds_every_token_once(spark, make_docs, sf_dir, bpe, size, windows, parts, fan_in):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(30).collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(ODD)] + [(20_000, "long " * 5000)]
    pieces = packing.pack(make_docs(rows).repartition(parts), vocabulary("byte_bpe_50k.json"), size=size, windows=windows, fan_in=fan_in).collect()
    ids = {d: [*bpe.encode(t or "", add_special_tokens=False).ids, 0] for d, t in rows}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
        part = np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4")
        assert p.length > 0 and p.doc_tokens == len(ids[p.doc_id]) and p.ids_crc32 == zlib.crc32(part.tobytes())
    assert by_doc.keys() == ids.keys()
    for own in [*by_doc.values()]:
        own.sort(key=lambda p: p.start)
        assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert sum(p.length for p in own) == own[0].doc_tokens
    room = 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        used = sum(p.length for p in own)
        assert used <= size
        room += size - used
    assert room <= 0.02 * size * len(by_sequence) + 8 * len(by_sequence) + size


def test_packing_repeated_ids_and_empty_tables(spark, make_docs):
    path = vocabulary("byte_bpe_50k.json")
    assert packing.pack(make_docs([]), path).count() == 0
    pieces = packing.pack(make_docs([(1, "a"), (1, "a"), (None, "b")]), path).collect()
    assert sorted(str(p.doc_id) for p in pieces) == ["1", "1", "None"] and len({p.sequence_id for p in pieces}) == 1


def test_licences(spark, make_docs, words):
    rows = [(i, words(30) + ".\n" + words(20)) for i in range(60)]
    planted = {
        100: ("mit", "Released under the MIT License."),
        101: ("gpl", "This work is licensed under the GNU General Public License, version 3."),
        102: ("reserved", "All rights reserved."),
        103: ("cc_by_nc", "Licensed under CC BY-NC 4.0."),
        104: ("apache", "Licensed under the Apache License, Version 2.0."),
        105: ("unknown", "Licensed under the Foobar License, with the usual permission."),
    }
    rows += [(d, f"{words(40)}.\n{line}\n{words(10)}") for d, (_, line) in planted.items()]
    rows += [(200, None), (201, ""), (202, "\n \n..."), (None, "All rights reserved."), (203, words(20_000))]
    got = sorted(((str(r.doc_id), r.family, r.piece) for r in licences.scan(make_docs(rows)).collect()))
    assert got == sorted([*((str(d), f, 1) for d, (f, _) in planted.items()), ("None", "reserved", 0)])


def test_licences_of_no_documents(make_docs):
    assert licences.scan(make_docs([])).count() == 0


@pytest.mark.parametrize("width", [40, 72])
def test_licences_in_wrapped_comments(make_docs, words, width):
    """Each template, wrapped, as a block of comments or plain lines after other lines without an end of sentence."""
    templates = [(f, t) for f in licences.FAMILIES for t in licences.TEMPLATES[f]]
    gnu = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or any later version."
    )
    templates.append(("gpl", gnu))
    rows, wanted = [(1000 + i, words(30) + ".\n" + words(20)) for i in range(60)], {}
    for i, (family, text) in enumerate(templates):
        lines = textwrap.wrap(text, width)
        shapes = [lines, [f"# {x}" for x in lines], ["/*", *(f" * {x}" for x in lines), " */"], [f"// {x}\r" for x in lines]]
        for j, shape in enumerate(shapes):
            blank = ["", "#", "", "//\r"][j]
            rows.append((10 * i + j, "\n".join([words(12), blank, *shape, blank, words(12)])))
            wanted[str(10 * i + j)] = family
    got = {}
    for r in licences.scan(make_docs(rows)).collect():
        got.setdefault(str(r.doc_id), set()).add(r.family)
    assert {d: f for d, f in wanted.items() if f not in got.get(d, set())} == {}
    assert set(got) == set(wanted) and "unknown" not in set.union(*got.values())


def test_unlisted_licences_in_the_smallest_ids_come_out(make_docs, words):
    unlisted = [
        "Licensed to the public under the Zorp terms, see the file for the permission.",
        "You have permission to redistribute and use this under the Quux Public License.",
    ]
    rows = [(i, f"{words(30)}.\n{unlisted[i % 2]}") for i in range(40)]
    rows += [(i, words(30) + ".\n" + words(20)) for i in range(40, 600)]
    rows += [(i, f"{words(30)}.\n{unlisted[i % 2]}") for i in range(600, 640)]
    got = {r.doc_id: r.family for r in licences.scan(make_docs(rows)).collect()}
    assert got == dict.fromkeys([*range(40), *range(600, 640)], "unknown")
