from __future__ import annotations

import heapq
import math
import random
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import AWKWARD, doc, prose
from tidemark.llm import licenses, sharding, token_files, topk
from tidemark.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, label int, digest string, rank int"
WORD_BPE = tokenizer_path("word_bpe_49k.json")


def plain_loads(sizes, shards):
    heap = [(0, i) for i in range(shards)]
    for s in sorted(sizes, reverse=True):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + s, i))
    return sorted(load for load, _ in heap)


@pytest.mark.parametrize("seed", range(20))
def test_schedule_is_longest_first(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 3, 7, 50, 400]) for _ in range(rng.randrange(400))]
    classes = sorted(Counter(sizes).items(), reverse=True)
    given = sharding.schedule([(float(s), n) for s, n in classes], 8)
    assert [sum(g) for g in given] == [n for _, n in classes]
    assert sorted(sum(s * g[i] for (s, _), g in zip(classes, given, strict=True)) for i in range(8)) == plain_loads(sizes, 8)


def check_shards(rows, got):
    assert len(got) == len(rows)
    homes, slots, loads = defaultdict(set), defaultdict(list), Counter()
    texts = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == texts
    for r in got:
        homes[(r["text_crc32"], r["size"])].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return homes, loads


def test_shards(spark):
    rng = random.Random(6)
    rows = [doc(i, prose(i if i % 3 else 0, rng.randrange(20, 200) if i % 3 else 30)) for i in range(300)]  # a third are copies
    homes, loads = check_shards(rows, sharding.assign(spark.createDataFrame(rows, SCHEMA), 8).collect())
    assert all(len(h) == 1 for h in homes.values())
    groups = Counter()
    for r in rows:
        groups[r[1]] += len(r[1].encode()) + 1
    expected = plain_loads(groups.values(), 8)
    assert max(loads.values()) - min(loads.values()) <= max(expected[-1] - expected[0], 8) + 64


def test_large_groups_are_evened_out_by_small_ones(spark):
    """Sizes above 4095 bytes are scheduled by class; the loads they really make are what small groups fill up."""
    rng = random.Random(16)
    rows = [doc(i, prose(i, rng.randrange(700, 3000))) for i in range(60)] + [doc(100 + i, prose(1000 + i, rng.randrange(1, 30))) for i in range(400)]
    _, loads = check_shards(rows, sharding.assign(spark.createDataFrame(rows, SCHEMA), 8).collect())
    assert max(loads.values()) - min(loads.values()) <= min(len(r[1]) for r in rows) + 2


def test_shards_of_awkward_rows(awkward, nothing):
    check_shards(AWKWARD, sharding.assign(awkward, 8).collect())
    assert sharding.assign(nothing, 8).count() == 0


def test_perfect_hash():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 63, 5000):
        keys = np.unique(np.concatenate([rng.integers(-(1 << 62), 1 << 62, n // 2), np.arange(n - n // 2)]))
        slots = token_files.PerfectHash.build(keys).slots(keys)
        assert sorted(slots.tolist()) == list(range(len(keys)))


def check_files(spark, rows, folder):
    plain = Tokenizer.from_file(WORD_BPE)
    manifest = token_files.write(spark.createDataFrame(rows, SCHEMA).repartition(4), folder, WORD_BPE, 2)
    got = token_files.read(spark, manifest, folder).collect()
    ids = {i: [*plain.encode(r[1] or "", add_special_tokens=False).ids, 2] for i, r in enumerate(rows)}
    expected = Counter((r[0], len(ids[i]), zlib.crc32(np.array(ids[i], "<u4").tobytes())) for i, r in enumerate(rows))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == expected
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ordered = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ordered == sorted(ordered, key=lambda d: (d is not None, d or 0))
    store = token_files.Store(manifest, folder)
    held = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            held[r[0]].append(ids[i])
    for key, expected in held.items():
        assert sorted(f.tolist() for f in store.get(key)) == sorted(expected)
    assert all(store.get(123_456_789_000 + k) == [] for k in range(50))
    if max(map(len, held.values()), default=0) < 9:
        assert all(shard.whole == {} for shard in store.shards)  # words are read at their places, no part as a whole
    return manifest.count()


def test_files(spark, tmp_path):
    check_files(spark, [doc((i * 7919) % 1009 - 300, prose(i, i % 50)) for i in range(400)], str(tmp_path / "store"))


def test_a_key_in_several_shards(spark, tmp_path):
    """More rows of one key than a shard holds, among others, some before and some after."""
    rows = [doc(5, prose(i, 20)) for i in range(300)] + [doc(i, prose(i, 5)) for i in range(10)] + [doc(None, "no key")] * 3
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        assert check_files(spark, rows, str(tmp_path / "store")) > 2
    finally:
        spark.conf.unset(name)


def test_files_of_awkward_rows(spark, nothing, tmp_path):
    check_files(spark, AWKWARD, f"file://{tmp_path}/store")
    manifest = token_files.write(nothing, str(tmp_path / "none"), WORD_BPE, 2)
    assert token_files.read(spark, manifest, str(tmp_path / "none")).count() == 0


def test_repeated_attempts_leave_one_store(spark, tmp_path):
    """Files of an attempt that is not in the manifest are not read."""
    frame = spark.createDataFrame([doc(i, "a b") for i in range(20)], SCHEMA)
    token_files.write(frame, str(tmp_path / "store"), WORD_BPE, 2)
    manifest = token_files.write(frame, str(tmp_path / "store"), WORD_BPE, 2)
    assert token_files.read(spark, manifest, str(tmp_path / "store")).count() == 20


def plain_search(rows, k):
    """Every pair of rows with different ids; the rows of one query id share a list."""
    v = [(i, [math.floor(64 * float(np.float32(x))) for x in e]) for i, e in rows]
    found = Counter()
    for q in {i for i, _ in v if i % 20 == 0}:
        scored = [
            (-sum(a * b for a, b in zip(e, f, strict=True)), c) for i, e in v if i == q for c, f in v if c != q and len(e) == len(f)
        ]
        found.update((q, n + 1, c, min(-s, 2**63 - 1)) for n, (s, c) in enumerate(sorted(scored)[:k]))
    return found


def search(spark, rows, k=5):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return Counter(tuple(r) for r in topk.search(frame, lambda i: i % 20 == 0, k, 64).collect())


def test_search(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(i, [round(rng.gauss(0, 1), 1) for _ in range(6)]) for i in range(200)]
    rows += [(1000 + i, [0.5] * 6) for i in range(60)]  # one very common vector: ties
    rows += [(i % 45, [round(rng.gauss(0, 2), 1) for _ in range(6)]) for i in range(90)]  # repeated ids, also of queries
    rows += [(20, [9.0] * 6)] * 12  # more rows of a query's own id than places in its list
    assert search(spark, rows) == plain_search(rows, 5)
    for name, size in (("TILE_NUMBERS", 24), ("SHARD_NUMBERS", 300), ("BLOCK_ROWS", 3), ("BLOCK_COLUMNS", 16), ("FAN_IN", 3)):
        monkeypatch.setattr(topk, name, size)
    assert search(spark, rows) == plain_search(rows, 5)


def test_search_of_awkward_rows(spark):
    good = [(0, [1.0, 2.0]), (1, [3.0, -1.0]), (20, [1e9, 1e9]), (21, [2e9, 3e9]), (40, [1.0]), (41, [2.0])]
    bad = [(None, [1.0, 1.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [])]
    assert search(spark, good + bad + [(1, [3.0, -1.0])]) == plain_search(good + [(1, [3.0, -1.0])], 5)
    assert search(spark, [(3, [1.0, 0.0]), (3, [5.0, 0.0]), (20, [1.0, 0.0])]) == {(20, 1, 3, 64 * 64 * 5): 1, (20, 2, 3, 64 * 64): 1}
    assert search(spark, []) == Counter()


def canonical(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(licenses.canonical(licenses.F.col("t"))).first()[0]


def test_license_forms(spark):
    forms = {canonical(spark, t) for t in (
        "Licensed under the MIT Licence.", "LICENSED  under\tthe “MIT License”", "Copyright (c) 2019 A. Author\nLicensed under the MIT License\n",
        "# Copyright 2020 by X, all rights reserved\n# Licensed under the MIT license!")}
    assert forms == {"licensed under the mit license"}


def test_licenses(spark):
    rows = [
        doc(1, "Copyright (c) 2001 Someone\n\n" + licenses.MIT), doc(2, "text before\n" + "Released under the MIT License.\nLicensed under CC BY-NC 4.0.\nafter"),
        doc(3, "This text mentions that it is licensed under the MIT License and goes on."), doc(4, "x\n\n" + licenses.ISC.upper() + "\n\ny"),
    ]
    known = licenses.known_digests(spark)
    got = {r["doc_id"]: (r["license"], r["part_licenses"], r["n_rows"]) for r in licenses.scan(spark.createDataFrame(rows, SCHEMA), known).collect()}
    assert got[1][0] == "MIT"
    assert got[2] == (None, ["CC-BY-NC-4.0", "MIT"], 1)
    assert got[3] == (None, [], 1)
    assert got[4] == (None, ["ISC"], 1)


def test_every_known_text_is_found(spark):
    texts = licenses.known_texts()
    frame = spark.createDataFrame([doc(i, text) for i, (_, text) in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r["license"] for r in licenses.scan(frame, licenses.known_digests(spark)).collect()}
    assert [i for i, (name, _) in enumerate(texts) if got[i] != name] == []
    assert len(set(got.values())) > 15


def wrapped(text, width=60):
    return "\n".join(textwrap.wrap(text, width))


GNU_FILE = """# Copyright (C) Jane Doe
#
# This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as
# published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
#
# This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."""


def test_a_whole_text_of_each_license(spark):
    texts = [
        ("MIT", "MIT License\n\nCopyright (c) Jane Doe\n\n" + wrapped(licenses.MIT)), ("ISC", "Copyright © 2020 X\n" + wrapped(licenses.ISC, 72)),
        ("BSD-2-Clause", "BSD 2-Clause Licence\n\nCopyright (c) 2011, Jane\nAll rights reserved.\n\n" + wrapped(licenses.BSD_START + licenses.BSD_END)),
        ("BSD-3-Clause", wrapped(licenses.BSD_START + licenses.BSD_THIRD + licenses.BSD_END, 50).replace("merchantability", "MERCHANTABILITY")),
        ("Unlicense", wrapped(licenses.UNLICENSE).replace("https://", "http://")), ("Apache-2.0", wrapped(licenses.APACHE_HEADER)),
        ("MPL-2.0", wrapped(licenses.MPL_HEADER)), ("LGPL-3.0", GNU_FILE), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
        ("AGPL-3.0", "// spdx-license-identifier: AGPL-3.0-only"),
    ]
    frame = spark.createDataFrame([doc(i, text) for i, (_, text) in enumerate(texts)], SCHEMA)
    words = licenses.anchors(licenses.known_texts())
    got = {r["doc_id"]: r["license"] for r in licenses.scan(frame, licenses.known_digests(spark), words).collect()}
    assert [got[i] for i in range(len(texts))] == [name for name, _ in texts]


def test_words_are_chosen_from_what_is_known(spark):
    """Other known texts than the usual ones, in any spelling; with and without the choice of words."""
    known = [("own", "Redistribution and use in source and binary forms are allowed"), ("short", "Licence"), ("odd", "copy while you can"), ("sign", "© favour 12")]
    rows = [doc(i, f"before\n\n{text.upper()}.\n\nafter") for i, (_, text) in enumerate(known)] + [doc(9, "nothing\n\nhere under licence and permission")]
    frame, digests = spark.createDataFrame(rows, SCHEMA), licenses.known_digests(spark, known)
    for words in (None, licenses.anchors(known)):
        got = {r["doc_id"]: r["part_licenses"] for r in licenses.scan(frame, digests, words).collect()}
        assert got == {0: ["own"], 1: ["short"], 2: ["odd"], 3: ["sign"], 9: []}, words
    assert "licen" in licenses.anchors(licenses.known_texts()) and len(licenses.anchors(licenses.known_texts())) < 10


def test_many_digests_are_joined_without_being_sent_around(spark, monkeypatch):
    monkeypatch.setattr(licenses, "BROADCAST_DIGESTS", 3)
    frame = spark.createDataFrame([doc(1, licenses.ISC), doc(2, "none")], SCHEMA)
    assert {r["doc_id"]: r["license"] for r in licenses.scan(frame, licenses.known_digests(spark)).collect()} == {1: "ISC", 2: None}


def test_licenses_of_awkward_rows(spark, awkward, nothing):
    got = licenses.scan(awkward, licenses.known_digests(spark)).collect()
    assert sum(r["n_rows"] for r in got) == len(AWKWARD) and {r["license"] for r in got} == {None}
    assert licenses.scan(nothing, licenses.known_digests(spark)).count() == 0
