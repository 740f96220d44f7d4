"""Decontamination, license scans, archives and sharding against brute force."""

from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from premiumlake.llm import _text, decontaminate, license_scan, sharding, warc
from premiumlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# --- decontamination -------------------------------------------------------------------------


def brute_scores(index, passages):
    """Every item's score for every passage, in full."""
    out = {}
    for p, words in enumerate(passages):
        present = {t for t in index.terms(np.array(words, np.uint64)).tolist() if t >= 0} if words else set()
        for k, weights in enumerate(index.weights):
            out[p, k] = sum(w for t, w in weights.items() if t in present)
    return out


@pytest.mark.parametrize("frequent", [0.01, 0.05, 1.0])
def test_opened_blocks_hold_all_items_above_the_threshold(frequent):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(150)]
    draw = lambda n: " ".join(vocabulary[int(150 * rng.random() ** 2)] for _ in range(n))
    questions = [draw(rng.randint(3, 25)) for _ in range(60)]
    search = decontaminate.Search(block=4, frequent=frequent, threshold=0.5)
    index = decontaminate.Index(list(range(60)), questions, [""] * 60, search)
    texts = [draw(rng.randint(1, 60)) + (" " + rng.choice(questions) if rng.random() < 0.3 else "") for _ in range(80)]
    import pyarrow as pa

    from premiumlake.llm import _text

    words, row, at = _text.lower_words(pa.array(texts))
    passages = [words[at[k] : at[k + 1]].tolist() for k in range(80)]
    term = index.terms(words)
    key = np.unique(row[term >= 0] * 1000 + term[term >= 0])
    opened = set(zip(*[x.tolist() for x in index.open_blocks(key // 1000, key % 1000)]))
    for (p, k), score in brute_scores(index, passages).items():
        if score >= search.threshold:
            assert (p, k // search.block) in opened


def test_planted_items_are_found_and_clean_documents_are_not(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {(r.doc_id, r.item_id) for r in QUERIES["op3_decontamination"](spark, SF).collect()}
    texts = docs.collect()
    whole = {(d.doc_id, i.item_id) for d in texts for i in items.collect() if i.text in (d.text or "")}
    assert whole <= got
    squeeze = lambda s: " ".join(s.split())
    assert got <= {(d.doc_id, i.item_id) for d in texts for i in items.collect() if squeeze(i.text) in squeeze(d.text or "")}


def test_leaks_at_any_place_in_any_case(spark):
    item = "What is the tallest mountain on the plain of Ardoon? The old peak Ferrumil."
    filler = lambda n, s: " ".join(f"{s}{k}" for k in range(n))
    rows = [(k, f"{filler(k * 7, 'a')} {item.upper() if k % 2 else item} {filler(50, 'b')}", "x", 1.0) for k in range(40)]
    rows += [(100, None, "x", 1.0), (101, "", "x", 1.0), (102, "What is the tallest mountain on the plain of Ardoon?", "x", 1.0), (103, item, "x", 1.0), (103, item, "x", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item string, score double")
    items = spark.createDataFrame([(7, item), (8, None), (9, "..."), (10, "Another thing is asked? Yes.")], "item_id long, text string")
    asked = decontaminate.question_and_answer(items)
    got = Counter((r.doc_id, r.item) for r in decontaminate.find_leaks(docs, asked).collect())
    assert got == Counter({**{(k, 7): 1 for k in range(40)}, (103, 7): 2})
    assert decontaminate.find_leaks(docs, asked.limit(0)).count() == 0
    assert decontaminate.find_leaks(docs.limit(0), asked).count() == 0
    several = decontaminate.find_leaks(docs, asked, decontaminate.Search(items=2))
    assert Counter((r.doc_id, r.item) for r in several.collect()) == got


def leaks_of(texts, questions, answers, search=decontaminate.Search()):
    """(text number, item number) pairs of an index of all items."""
    index = decontaminate.Index(list(range(len(questions))), questions, answers, search)
    return {(r, k) for r, k, *_ in index.find(*_text.lower_words(pa.array(texts, pa.string())))}


def test_near_copies_with_one_changed_word_are_found(spark):
    made = [
        ("What is the tallest mountain on the plain of Ardoon?", "The old peak Ferrumil."), ("Who wrote the long book of Ulm in the year of rain?", "Ada."),
        ("Name two rivers.", "Osk and Tarn."), ("Ulm?", "It was a town by the lake that the river left long ago."), ("Which sea is deep?", "Marn sea."),
    ]
    asked = decontaminate.question_and_answer(spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    made += [(r.question, r.answer) for r in asked]
    before, after = (" ".join(f"{x}{k}" for k in range(30)) for x in "ab")
    texts, of = [], []
    for k, (question, answer) in enumerate(made):
        words = f"{question} {answer}".split()
        for j in range(len(words)):
            for put in (["other"], [], [words[j], "other"]):
                texts.append(" ".join([before, *words[:j], *put, *words[j + 1 :], after]))
                of.append(k)
    found = leaks_of(texts, *zip(*made))
    assert [(texts[r], k) for r, k in enumerate(of) if (r, k) not in found] == []


def test_a_question_without_its_answer_is_no_leak():
    question, answer = "What is the tallest mountain on the plain of Ardoon in the land of the seven small lakes?", "The old peak Ferrumil."
    filler = " ".join(f"a{k}" for k in range(30))
    texts = [f"{filler} {question} {x} {filler}" for x in ("", "The new hill", "Ferrumil peak old the.", f"{filler} the {filler} old {filler} peak {filler}")]
    texts += [f"{question} {answer}", f"{filler} {answer} {filler}", " ".join(reversed(f"{question} {answer}".split()))]
    others = ["Another thing is asked?", "Is the world flat?"]
    assert leaks_of(texts, [question, *others], [answer, "Yes.", "No."]) == {(4, 0)}
    assert leaks_of(["Is the world flat? One may ask"], others, ["Yes.", "No."]) == set()


def test_the_number_of_indexes_changes_nothing(spark):
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(120)]
    draw = lambda n: " ".join(vocabulary[int(120 * rng.random() ** 2)] for _ in range(n))
    texts = [f"{draw(rng.randint(4, 30))}? {draw(rng.randint(1, 12))}." for _ in range(40)]
    texts += [f"{draw(400)}? {draw(5)}."] + texts[:1] * 15
    items = spark.createDataFrame([*enumerate(texts), (None, texts[1]), (3, texts[3])], "item_id long, text string")
    spoilt = lambda t: " ".join(w for w in t.split() if rng.random() < 0.9)
    docs = spark.createDataFrame([(k, f"{draw(20)} {spoilt(rng.choice(texts))} {draw(20)}") for k in range(150)], "doc_id long, text string")
    asked = decontaminate.question_and_answer(items)
    one, many = (decontaminate.find_leaks(docs, asked, decontaminate.Search(items=n)).collect() for n in (1000, 20))
    tell = lambda rows: Counter((r.doc_id, r.item, round(r.score, 9), r.question_overlap, r.answer_overlap) for r in rows)
    assert len(one) > 50 and tell(one) == tell(many)
    # a long item does not widen the passages of the others
    far = spark.createDataFrame([(1, " ".join(["one two three", *[f"a{k}" for k in range(60)], "four five six"]))], "doc_id long, text string")
    for extra in ([], [(" ".join(f"b{k}" for k in range(300)) + ".", "")]):
        asked = spark.createDataFrame([(1, "one two three.", "four five six"), *[(2, q, a) for q, a in extra]], "item long, question string, answer string")
        assert decontaminate.find_leaks(far, asked).count() == 0


# --- license scans ----------------------------------------------------------------------------


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b):
            last, row[k + 1] = row[k + 1], last + 1 if x == y else max(row[k + 1], row[k])
    return row[-1]


def test_increasing_subsequence_is_longest():
    rng = random.Random(1)
    for _ in range(200):
        values = [rng.randint(0, 30) for _ in range(rng.randint(0, 25))]
        got = [values[k] for k in license_scan.longest_increasing(values)]
        assert all(a < b for a, b in zip(got, got[1:]))
        best = [1] * len(values)
        for i in range(len(values)):
            best[i] = 1 + max([best[j] for j in range(i) if values[j] < values[i]], default=0)
        assert len(got) == max(best, default=0)


def test_alignment_is_a_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        template = [rng.randint(0, 40) for _ in range(20)]
        text = [rng.randint(0, 40) for _ in range(10)] + [w for w in template if rng.random() < 0.9] + [rng.randint(0, 40) for _ in range(10)]
        pairs = license_scan.align(text, template)
        assert all(text[a] == template[b] for a, b in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) <= longest_common(text, template)
    distinct = random.Random(4).sample(range(100), 30)
    assert len(license_scan.align([200, *distinct[:10], 201, *distinct[10:]], distinct)) == 30


def test_licenses_of_documents(spark):
    got = {(r.doc_id, r.license) for r in QUERIES["op5_license_scan"](spark, SF).collect()}
    want = set()
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        want |= {(d.doc_id, name) for name, line in license_scan.TEMPLATES.items() if line in (d.text or "")}
    assert want and got == want


def test_licenses_of_odd_texts(spark):
    mit = "released UNDER the\nMIT license"
    rows = [
        (1, None, "a"), (2, "", "a"), (3, mit, "a"), (3, mit, "a"), (4, f"{mit}. {'the ' * 3000}{mit} {mit}", "a"),
        (5, "released under some mit thing the", "a"), (None, "All rights, reserved", "a"), (6, "license MIT the under released", "a"),
        (7, "Redistribution and use in source and binary form, with or without any modification, are permitted", "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = Counter((r.doc_id, r.license, r.n_notices) for r in license_scan.scan_licenses(docs).collect())
    assert got == Counter({(3, "mit", 1): 2, (4, "mit", 3): 1, (None, "all-rights-reserved", 1): 1, (7, "bsd", 1): 1})
    assert license_scan.scan_licenses(docs, {}).count() == 0
    assert license_scan.scan_licenses(docs, {"none": "..."}).count() == 0
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0


def names_of(text):
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.COVERAGE)
    words, row, _ = _text.lower_words(pa.array([text]))
    return {scanner.names[k] for _, k in scanner.possible(words, row, 1) if scanner.scan(words.tolist(), scanner.words[k], scanner.telling[k])}


def test_other_licenses_are_not_named_as_a_known_one():
    notices = [
        ("Released under the BSD License.", "mit"), ("Released under the ISC License.", "mit"), ("It is released under the same license.", "mit"),
        ("Released under the modified MIT License.", "mit"), ("Released under the MIT No Attribution License.", "mit"),
        ("Licensed under CC BY 4.0.", "cc-by-nc-4.0"), ("Licensed under CC BY-SA 4.0.", "cc-by-nc-4.0"), ("Licensed under CC BY-NC-ND 4.0.", "cc-by-nc-4.0"), ("Licensed under CC BY-NC 3.0.", "cc-by-nc-4.0"),
        ("Licensed under the Apache License, Version 1.0.", "apache-2.0"), ("Licensed under the Educational Community License, Version 2.0.", "apache-2.0"),
        ("This work is licensed under the GNU General Public License, version 2.", "gpl-3.0"), ("This work is licensed under the GNU General Public License, version 2. Section 3", "gpl-3.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "gpl-3.0"), ("This work is licensed under the GNU Affero General Public License, version 3.", "gpl-3.0"),
        ("All moral rights reserved.", "all-rights-reserved"),
        ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "mit-permission"),
        ('Licensed under the Educational Community License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at', "apache-2.0-header"),
    ]
    assert [(x, name) for x, name in notices if name in names_of(f"Some words before. {x} The words after.")] == []


def test_known_licenses_are_found_in_other_words():
    notices = [
        ("Distributed under the MIT License.", "mit"), ("Released under MIT License", "mit"), ("Released under the MIT or Apache License", "mit"), ("Released under the terms of the MIT License", "mit"),
        ("Licensed under the Apache License 2.0", "apache-2.0"), ("Offered under the Apache License, Version 2.0", "apache-2.0"), ("Shared under CC-BY-NC 4.0", "cc-by-nc-4.0"),
        ("This program is licensed under the GNU General Public License, version 3", "gpl-3.0"), ("This work is licensed under the GNU General Public License (GPL), version 3", "gpl-3.0"),
        ("The MIT License. MIT License: released under the MIT License, the MIT License", "mit"),
    ]
    notices += [(line, name) for name, line in license_scan.TEMPLATES.items()]
    assert [(x, name) for x, name in notices if name not in names_of(f"Some words before. {x} The words after.")] == []


def test_every_notice_gets_its_own_name():
    # a header that holds another template's words holds that one too
    within = {"apache-2.0-header": {"apache-2.0"}, "bsd-conditions": {"bsd"}, "mit-text": {"mit-permission"}}
    for name, line in license_scan.TEMPLATES.items():
        assert names_of(f"Some words before. {line} And words after.") == {name} | within.get(name, set()), name


def test_long_texts_with_changes_are_found():
    rng = random.Random(5)
    for name, line in license_scan.TEMPLATES.items():
        words, told = line.split(), set(_text.lower_words(pa.array([" ".join(license_scan.TELLING[name])]))[0].tolist())
        if len(words) < 20:
            continue
        for _ in range(5):
            put = [w if rng.random() < 0.92 or set(_text.lower_words(pa.array([w]))[0].tolist()) & told else rng.choice(["", "other", f"{w} more"]) for w in words]
            assert name in names_of(" ".join(["before", *put, "after"])), (name, put)


# --- archives ----------------------------------------------------------------------------------


def test_loser_tree_merges(spark):
    rng = random.Random(7)
    for k in [0, 1, 2, 3, 5, 8, 13]:
        runs = [sorted(rng.randint(0, 20) for _ in range(rng.randint(0, 9))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


ODD_PAGES = [
    (1, "http://a.example/x", "same"), (2, "http://b.example/x", "same"), (3, None, None), (4, "", ""), (5, "http://A.example/x#f", "line\r\n\r\nWARC/1.0\r\n\r\nend\r\n\r\n"),
    (6, "http://a.example/x\r\nEvil: 1", "ü漢🙂" * 5000), (7, "not a url", "same"), (7, "not a url", "same"), (None, "http://n.example/", "same"), (8, "https://www.a.example:80/x?q", "\r\n\r\n"),
]


@pytest.mark.parametrize("least", [0, 5])
def test_archives_give_back_every_record(spark, least):
    pages = spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in ODD_PAGES], "page_id long, url string, html string, record string, part int").repartition(3)
    rows = warc.archive_pages(pages, least_bytes=least).collect()
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)
    newest = defaultdict(lambda: -1)
    for i, _, h in ODD_PAGES:
        newest[h or ""] = max(newest[h or ""], -1 if i is None else i)
    want = Counter()
    for i, _, h in ODD_PAGES:
        data = (h or "").encode()
        top = newest[h or ""]
        revisit = len(data) >= least and top >= 0 and i != top
        want[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", top if revisit else None] += 1
    assert got == want
    by_key = defaultdict(list)
    ordered = sorted(rows, key=lambda r: (r.part, r.place))
    for r in ordered:
        by_key[r.url_key].append(r)
    assert [r.url_key for r in ordered] == sorted(r.url_key for r in ordered)
    for history in by_key.values():
        assert [r.capture for r in history] == list(range(len(history)))
        assert [r.date for r in history] == sorted(r.date for r in history)


def test_archives_of_nothing(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(pages).count() == 0


def test_one_url_spans_ranges(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("http://hot.example/").alias("url"), F.col("id").cast("string").alias("html"))
    path = warc.folder(spark, "hot")
    captures = pages.select(F.col("page_id").alias("id"), F.col("url").alias("uri"), F.timestamp_seconds("page_id").alias("date"), F.col("html").alias("payload"))
    warc.write_archives(captures, path, archive_bytes=200_000)
    index = warc.capture_histories(warc.merge_runs(warc.read_runs(spark, path), rows_per_range=400))
    rows = sorted(index.collect(), key=lambda r: (r.part, r.place))
    assert len({r.part for r in rows}) > 4 and len({r.run for r in rows}) > 4
    assert [int(r.record) for r in rows] == list(range(3000)) == [r.capture for r in rows]


def test_page_digests(spark):
    rows = {r.page_id: r for r in QUERIES["op4_warc_index"](spark, SF).collect()}
    for p in spark.read.parquet(f"{SF}/pages.parquet").collect():
        data = (p.html or "").encode()
        assert rows[p.page_id].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert rows[p.page_id].payload_bytes == len(data)


# --- sharding ----------------------------------------------------------------------------------


def check_even(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(slots[s]) == list(range(len(slots[s]))) for s in slots)


def test_copies_stay_together_where_they_fit(spark):
    rows = QUERIES["op2_label_propagation"](spark, "/root/testdata/sf0.01").collect()
    docs = {d.doc_id: (d.text or "").encode() for d in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    check_even(rows, 8)
    assert {r.doc_id: r["size"] for r in rows} == {i: len(t) + 1 for i, t in docs.items()}
    import zlib

    assert all(r.text_crc32 == zlib.crc32(docs[r.doc_id]) for r in rows)
    groups = defaultdict(set)
    members = Counter()
    for r in rows:
        groups[docs[r.doc_id]].add(r.shard)
        members[docs[r.doc_id]] += 1
    several = [g for g, n in members.items() if n > 1]
    assert sum(len(groups[g]) > 1 for g in several) <= 0.1 * len(several)


def test_communities_cut_fewer_links_than_chance(spark):
    links, n = [], 0
    for k in range(400):
        for a in range(k * 5, k * 5 + 5):
            links += [(a, f"e{n}"), (k * 5 + (a + 1) % 5, f"e{n}"), (None, f"e{n}"), (a, None), (a, f"e{n}"), (99999, f"e{n}")]
            n += 1
    ids = [(i,) for i in range(2000)] + [(5,), (None,)]
    docs = spark.createDataFrame(ids, "id long")
    got = sharding.assign_shards(docs, spark.createDataFrame(links, "id long, link string"), shards=8).collect()
    assert len(got) == 2000
    check_even(got, 8)
    shard = {r.id: r.shard for r in got}
    ends = defaultdict(set)
    for i, link in links:
        if i is not None and link and i < 2000:
            ends[link].add(shard[i])
    cut = sum(len(x) > 1 for x in ends.values())
    assert cut < 0.6 * len(ends), cut  # 7 in 8 by chance


def test_hot_group_and_odd_cases(spark):
    hot = [(i, "hot") for i in range(700)] + [(i, f"g{i // 2}") for i in range(700, 2000)]
    docs = spark.createDataFrame([(i,) for i in range(2003)], "id long")
    got = sharding.assign_shards(docs, spark.createDataFrame(hot, "id long, link string"), shards=8).collect()
    check_even(got, 8)
    none = spark.createDataFrame([], "id long, link string")
    check_even(sharding.assign_shards(docs, none, shards=8).collect(), 8)
    check_even(sharding.assign_shards(docs.limit(3), none, shards=8).collect(), 8)
    assert sharding.assign_shards(docs.limit(0), none, shards=8).count() == 0


def test_sharding_places_every_row(spark):
    """Rows without an id, rows that share one and rows that repeat."""
    own = [(k, f"text {k % 9}") for k in range(40)] + [(None, "text 1"), (None, None), (5, "other"), (5, "other"), (5, "more"), (7, None), (7, "")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in own], "doc_id long, text string, shard int, row int").repartition(3)
    got = sharding.shard_documents(docs, 8).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(t or "") + 1) for i, t in own)
    slots = {s: sorted(r.slot for r in got if r.shard == s) for s in range(8)}
    assert all(x == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.shard_documents(docs.limit(0), 8).collect() == []
