"""License scans, placement and preference formatting: column expressions only."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from leadmill.llm import chat, licenses, placement


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(text):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    places, labels = [], set()
    for phrase, label in licenses.BASE:
        parts = [p.encode() for p in phrase.split()]
        own = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += own
        labels |= {label} if own else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_scan_is_its_definition(spark):
    rng = random.Random(3)
    parts = ["Under the", "MIT", "license", "Licence", "under", "the", "mit-license", "Apache License,", "Version", "2", "2.0", "cc", "by", "NC", "CC BY-NC", "é", "É", "\n", " , ", "x" * 20]
    texts = ["", None, " .\n", "CC BY NC cc by nc", "under the MIT license under the MIT license", "Kunder the MIT license"] + ["  ".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in enumerate(texts)], "doc_id long, text string, words string, n_base int")
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == scanned(text), text
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


@pytest.mark.parametrize(
    "text,labels",
    [
        ("Licensed under the GNU General Public License v3.", "gpl-3"),
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
        ("under the terms of the GNU Lesser General Public License version 2.1", "lgpl-2.1"),
        ("Released under CC BY-NC-SA 4.0, and the Boost Software License", "cc-by-nc,cc-by-nc-sa"),
        ("distributed under the Mozilla Public License 2.0 and the zlib license", "mpl-2,zlib"),
        ("permit submit limit committee", ""),
        ("a driver's license for apache helicopters", ""),
        ("MIT is a university", ""),
    ],
)
def test_rules(spark, text, labels):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert licenses.scan(docs).first()["labels"] == labels


FSF = "you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation; either version {1} of the License, or (at your option) any later version. This program comes WITHOUT ANY WARRANTY. See the GNU {0} for more details."


@pytest.mark.parametrize(
    "text,labels",
    [
        (FSF.format("General Public License", "2"), "gpl-2"),
        (FSF.format("General Public License", "3"), "gpl-3"),
        (FSF.format("Lesser General Public License", "2.1"), "lgpl-2.1"),
        (FSF.format("Library General Public License", "2"), "lgpl-2"),
        (FSF.format("Affero General Public License", "3"), "agpl-3"),
        ("Released under a GPL license.", "gpl"),
        ("under the GNU General Public License version 1", "gpl-1"),
        ("Licensed under the LGPL.", "lgpl"),
        ("released under the Mozilla Public License", "mpl"),
        ("under the Apache license", "apache"),
        ("released under the Apache License, Version 2.0", "apache-2"),
        ("SPDX-License-Identifier: GPL-3.0-only", "gpl-3"),
        ("SPDX-License-Identifier: Artistic-2.0", "artistic-2"),
        ("GPLv2 and AGPLv3, MPL 2.0", "agpl-3,gpl-2,mpl-2"),
        ("expat version 2.4 and zlib version 1.2.11", ""),
        ("X11 version 7 server, Apache 2.4.41, BSD 4.4", ""),
        ("an artistic 2 day event", ""),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2"),
        ("The Software shall be used for Good, not Evil.", "json"),
    ],
)
def test_labels_state_what_the_text_states(spark, text, labels):
    assert licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["labels"] == labels


def test_passages_lie_within_the_intervals(spark):
    both = FSF.format("General Public License", "2") + " Parts are licensed under the LGPL version 3."
    assert licenses.scan(spark.createDataFrame([(1, both)], "doc_id long, text string")).first()["labels"] == "gpl-2,lgpl-3"


@pytest.mark.parametrize(
    "text,labels",
    [
        ("this project is MIT licensed", "mit"),
        ("zlib-licensed", "zlib"),
        ("Artistic version 2", "artistic-2"),
        ("MIT 2019, ISC 4 and zlib 1.2", ""),
    ],
)
def test_names_that_are_plain_words(spark, text, labels):
    assert licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["labels"] == labels


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction. {}THE SOFTWARE IS PROVIDED "AS IS"."""
NOTICE = "The above copyright notice and this permission notice shall be included in all copies. "
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that:
1. Redistributions of source code must retain the above copyright notice. 2. Redistributions in binary form must
reproduce the above copyright notice. {}THIS SOFTWARE IS PROVIDED BY THE AUTHOR."""
NEITHER = "3. Neither the name of the holder nor the names of its contributors may be used to endorse or promote products. "
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"


@pytest.mark.parametrize(
    "text,label",
    [
        (MIT.format(NOTICE), "mit"),
        (MIT.format(""), "mit-0"),
        (BSD.format(""), "bsd-2-clause"),
        (BSD.format(NEITHER), "bsd-3-clause"),
        (BSD.format("3. All advertising materials mentioning features must say so. " + NEITHER), "bsd-4-clause"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted.", "bsd"),
        (ISC + ", provided that the above copyright notice appears.", "isc"),
        (ISC + ".", "0bsd"),
        ("This notice may not be removed or altered from any source distribution.", "zlib"),
        ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ],
)
def test_texts_of_licenses(spark, text, label):
    docs = spark.createDataFrame([(1, f"x {text} x"), (2, text.replace("is", "was").replace("may", "might"))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert got[1]["labels"] == label and got[1]["score"] == 1.0 and got[1]["n_base"] == 0


def test_rows_without_an_id_are_dealt_to_several_parts(spark):
    docs = spark.range(400).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    out = placement.place(docs).collect()
    assert len({r["shard"] for r in out}) == 1 and sorted(r["slot"] for r in out) == list(range(400))
    by_slot = [r["text_crc32"] for r in sorted(out, key=lambda r: r["slot"])]
    assert by_slot != sorted(by_slot) and len(set(by_slot)) == 400


def test_a_longer_detection_suppresses_what_it_holds(spark):
    docs = spark.createDataFrame([(1, "licensed under the gnu lesser general public license version 3")], "doc_id long, text string")
    assert licenses.scan(docs).first()["labels"] == "lgpl-3"
    assert len(licenses.rules()) > 200


def test_placement_is_balanced_gapless_and_moves_little(spark):
    rows = [(i, "x" * (i % 7)) for i in range(4000)] + [(None, None), (None, "é"), (5, "again"), (5, "again")]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, shard int, key string").repartition(5)
    out = placement.place(docs).collect()
    assert len(out) == len(rows)
    shards = Counter(r["shard"] for r in out)
    assert set(shards) == set(range(16)) and max(shards.values()) < 2 * min(shards.values())
    for shard, n in shards.items():
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(n))
    assert all(r["grown_shard"] in (r["shard"], 16) for r in out)
    assert 100 < sum(r["grown_shard"] == 16 for r in out) < 400
    assert {(r["size"], r["text_crc32"]) for r in out if r["doc_id"] is None} == {(1, 0), (3, zlib.crc32("é".encode()))}
    assert len({r["shard"] for r in out if r["doc_id"] is None}) == 1


def test_weights_move_rows_only_into_the_heavier_subtree(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    tree = {"a": {"r1": {"0": 1.0, "1": 2.0}, "r2": {"2": 1.0}}, "b": {"r1": {"3": 4.0}, "r2": {"4": 1.0, "5": 0.5}}}
    heavier = {"a": tree["a"], "b": {"r1": {"3": 8.0}, "r2": tree["b"]["r2"]}}
    rows = keys.select(placement.shard_of(F.col("key"), tree).alias("x"), placement.shard_of(F.col("key"), heavier).alias("y")).collect()
    moved = [(r["x"], r["y"]) for r in rows if r["x"] != r["y"]]
    assert moved and all(y in (3, 4, 5) for _, y in moved)
    assert {y for x, y in moved if x in (4, 5)} == {3}
    share = Counter(r["x"] for r in rows)
    assert abs(share[3] / 5000 - 4 / 9.5) < 0.05 and abs(share[1] / 5000 - 2 / 9.5) < 0.05


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    turns = spark.createDataFrame([], "pair_id long, turn long, role string, text string")
    assert placement.place(docs).collect() == []
    assert licenses.scan(docs).collect() == []
    assert chat.preference_turns(turns, turns).collect() == []


def test_preference_pairs(spark):
    schema = "pair_id long, turn long, role string, text string, loss string"
    chosen = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "bye"), (1, 4, "assistant", "good bye"), (2, 0, None, None), (3, 0, "user", "only chosen"), (None, 0, "user", "no pair"), (4, 0, "user", "same"), (4, 0, "user", "same")]
    rejected = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "go away"), (1, 4, "assistant", "good bye"), (2, 0, "user", ""), (2, None, "assistant", "late"), (4, 0, "user", "same")]
    parts = chat.preference_turns(*(spark.createDataFrame([(*r, "x") for r in side], schema) for side in (chosen, rejected)))
    rows = {r["pair_id"]: r for r in chat.examples(parts).collect()}
    show = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert rows.keys() == {1, 2, 3, 4}
    assert rows[1]["prompt"] == show("system", "be kind") + show("user", "hi")
    assert rows[1]["chosen"] == show("assistant", "hello") + show("user", "bye") + show("assistant", "good bye")
    assert rows[1]["rejected"] == show("assistant", "go away") + show("assistant", "good bye")
    learnt = [rows[1]["chosen"][a:b] for a, b in rows[1]["chosen_spans"]]
    assert learnt == [show("assistant", "hello"), show("assistant", "good bye")]
    assert rows[2]["prompt"] == show("user", "") and rows[2]["chosen"] == "" and rows[2]["rejected"] == show("assistant", "late")
    assert rows[3]["prompt"] == "" and rows[3]["chosen"] == show("user", "only chosen") and rows[3]["rejected"] == ""
    assert rows[4]["prompt"] == show("user", "same") and rows[4]["chosen"] == rows[4]["rejected"] == ""


def test_plans_have_no_python(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    turns = spark.createDataFrame([(1, 0, "user", "x")], "pair_id long, turn long, role string, text string")
    for df in (licenses.scan(docs), placement.place(docs), chat.preference_turns(turns, turns)):
        assert not re.search("Python|Pandas|Arrow", plan_of(df))
