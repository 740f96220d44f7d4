"""Suffix-array dedup and the near-duplicate join against brute force."""

from __future__ import annotations

import hashlib
import random
import re

from premiumlake.llm import jaccard_join, suffix_dedup


def texts():
    rng = random.Random(9)
    draw = lambda n: " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7))) for _ in range(n))
    passage, base = draw(30), draw(80)
    rows = [draw(rng.randint(0, 60)) + " " + passage + " " + draw(5) for _ in range(12)]
    for _ in range(6):
        words = base.split()
        words[rng.randrange(80)] = "changed"
        rows.append(" ".join(words))
    rows += [base, base, None, "", "", "one two", "one two", "ab " * 400, "ab " * 300]
    return [(k, t) for k, t in enumerate(rows)]


def check_removed(spark, rows, rule):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, key string")
    kept = suffix_dedup.with_counts(suffix_dedup.kept_texts(docs, rule))
    got = {r.doc_id: r for r in suffix_dedup.per_document(docs, kept, "kept", suffix_dedup.F.lit(b""), rule).collect()}
    seen: dict = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            seen.setdefault(b[k : k + 50], i)
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if seen[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        left = bytes(x for x, y in zip(b, gone) if not y)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, hashlib.md5(bytes(r.kept)).digest()) == (len(b), sum(gone), spans, hashlib.md5(left).digest())


def test_removed_bytes_equal_brute_force(spark):
    for rule in (suffix_dedup.Repeats(), suffix_dedup.Repeats(block=3)):
        check_removed(spark, texts(), rule)


def test_passage_of_more_texts_than_a_block(spark):
    rng = random.Random(3)
    draw = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))
    passage, ends = draw(14), [draw(4) for _ in range(40)]
    rows = [f"{rng.choice(ends)} {draw(1)} {passage} {draw(1)} {rng.choice(ends)}" for _ in range(5000)] + ["na " * 9000]
    rule = suffix_dedup.Repeats()
    assert len(rows) > rule.block
    check_removed(spark, list(enumerate(rows)), rule)
    blocks = {(r.seed, r.block) for r in _blocks(spark, rows, rule).collect()}
    assert len(blocks) > len({seed for seed, _ in blocks})  # the passage's seeds have several


def _blocks(spark, rows, rule):
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = suffix_dedup._distinct_texts(suffix_dedup._keyed(docs, "doc_id", "text"), rule)
    return suffix_dedup._candidates(found, suffix_dedup._shared_seeds(found, rule), rule).select("seed", "block").distinct()


def test_strings_shorter_than_a_window_gather_no_stretches(spark, monkeypatch):
    rng = random.Random(5)
    draw = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    rows = [" ".join(x for _ in range(20) for x in (draw(12), "of the same twenty two")) for _ in range(50)]
    assert _blocks(spark, rows, suffix_dedup.Repeats()).count() == 0
    written, store = [], suffix_dedup.stored
    monkeypatch.setattr(suffix_dedup, "stored", lambda df, name: written.append(name) or store(df, name))
    check_removed(spark, list(enumerate(rows + texts_of_one_period())), suffix_dedup.Repeats())
    assert written == ["shared", "blocks"]  # the stretches themselves go straight to their shards


def texts_of_one_period():
    return ["na " * 900, "xy" * 1500, "=" * 2000, "=" * 2500, "twenty bytes a line\n" * 70, "twenty bytes a line\n" * 90]


def test_seeds_follow_the_window_alone():
    import numpy as np

    rule = suffix_dedup.Repeats()
    rng = random.Random(6)
    text = "".join(rng.choice("ab ") for _ in range(3000)) + "".join(texts_of_one_period())
    whole = np.frombuffer(text.encode(), np.uint8)
    seed, start = suffix_dedup.window_seeds(whole, np.array([0, len(whole)]), rule)
    assert np.array_equal(start, np.arange(len(whole) - 49))
    rows = np.lib.stride_tricks.sliding_window_view(whole, 50)
    alone, _ = suffix_dedup.window_seeds(np.ascontiguousarray(rows).ravel(), np.arange(len(rows) + 1) * 50, rule)
    assert np.array_equal(seed, alone)
    last = slice(3000, None)  # periodic text: long stretches
    assert len(suffix_dedup._stretches(seed[last], start[last], rule)[0]) < len(start[last]) / 9


def test_links_equal_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, class_id int")

    def sets(t):
        w = (t or "").split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    own = [sets(t) for _, t in rows]
    near = lambda a, b: (rows[a][1] or "") == (rows[b][1] or "") or bool(own[a]) and len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b])
    links = {a: [b for b, _ in rows if b != a and near(a, b)] for a, _ in rows}
    for join in (jaccard_join.Join(), jaccard_join.Join(block=3)):
        got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.near_duplicates(docs, join).collect()}
        for a, b in links.items():
            reach, work = {a}, [a]
            while work:
                for c in links[work.pop()]:
                    if c not in reach:
                        reach.add(c)
                        work.append(c)
            assert got[a] == (min(reach), len(b)), a
    assert jaccard_join.near_duplicates(docs.limit(0)).count() == 0


def test_shingling_for_verification_is_bounded_and_cuts_a_text_once(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from premiumlake.llm import _text, jaccard_join

    texts = [" ".join(f"w{k}x{n % 40}" for k in range(300)) for n in range(80)]  # 40 texts, each in two rows
    table = pa.table({"text_id": [n % 40 for n in range(80)], "text": texts})
    seen, cut = [], jaccard_join.shingles
    monkeypatch.setattr(jaccard_join, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(jaccard_join, "shingles", lambda data, at, size: seen.append(len(data)) or cut(data, at, size))
    wanted = np.array([1, 2, 41, 43, 79])
    sets = jaccard_join.shingle_sets(table, wanted, 5)
    assert max(seen) <= 4000 and sum(seen) == sum(len(texts[n]) for n in (1, 2, 3, 39))
    for n in range(80):
        hashes, _ = cut(*_text.buffers(pa.array([texts[n]])), 5)
        assert sets[n].tolist() == (np.unique(hashes).tolist() if n in wanted else [])
