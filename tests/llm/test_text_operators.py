"""Byte-level BPE, quality rules, quality classifier and URL filter against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from premiumlake.llm import byte_bpe, pu_quality, quality_rules, url_filter
from premiumlake.llm.queries import QUERIES, URL_RULES, rank_file

SF = "/root/testdata/sf0.001"
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one two three four five one two three four five"),
    (5, "a\x1cb\x85c d  e f 'll don't 123 ### \r\n\r\n end  "),
    (6, "same line\nsame line\n\nsame line \nother"),
    (6, "same line\nsame line\n\nsame line \nother"),
    (None, "日本語 text 🙂🙂 " + "x" * 3000),
    (7, "word " * 5000),
    (8, "".join(random.Random(5).choice("aé \n\t#|<>!漢🙂Z9.\x00\x1f") for _ in range(20000))),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, with columns whose names the operators use themselves."""
    rows = [(i, t, True, 1.0, "x") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, kept boolean, llr double, ids string")


def test_bpe_equals_the_rank_library(spark, odd):
    import base64

    import tiktoken

    path, pattern = rank_file()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    expected = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for frame in (odd, docs):
        texts = Counter((r.doc_id, r.text or "") for r in frame.collect())
        got = byte_bpe.decode(byte_bpe.encode(frame, path, pattern), path).collect()
        want = Counter()
        for (i, t), n in texts.items():
            want[i, tuple(expected.encode_ordinary(t)), t.encode()] += n
        assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got) == want


def test_bpe_every_entry_is_its_own_encoding():
    path, _ = rank_file()
    ranks = byte_bpe.read_ranks(path)
    encoder = byte_bpe.Encoder(byte_bpe.serialise_model(ranks), {})
    wrong = [t for t, r in ranks.items() if (s := t.decode("utf-8", "ignore")).encode() == t and encoder.pretoken(s) != (r,)]
    assert not wrong  # the merges alone reach every entry


def test_bpe_query_digests(spark):
    rows = {r.doc_id: r for r in QUERIES["op1_byte_bpe"](spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        assert rows[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_bpe_empty_table_and_null_ids(spark):
    path, pattern = rank_file()
    none = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.decode(byte_bpe.encode(none, path, pattern), path).count() == 0
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(byte_bpe.decode(nulls, path).first().decoded) == b""


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed)


def brute_llr(texts, trusted, ratio):
    import numpy as np

    from premiumlake.llm import _text

    def grams(text):
        data = (text or "").encode()
        out = []
        for i in range(len(data) - ratio.n + 1):
            code = 0
            for b in data[i : i + ratio.n]:
                code = (code * 257 + b) % (1 << 64)
            out.append(int(_text.mix(np.array([code], np.uint64))[0] % np.uint64(ratio.buckets)))
        return out

    found = [grams(t) for _, t in texts]
    raw, target = Counter(g for f in found for g in f), Counter(g for (i, _), f in zip(texts, found) if i in trusted for g in f)
    n, m = sum(raw.values()) + ratio.buckets * ratio.smoothing, sum(target.values()) + ratio.buckets * ratio.smoothing
    value = lambda g: np.log((target[g] + ratio.smoothing) / m / ((raw[g] + ratio.smoothing) / n))
    return [sum(map(value, f)) / max(len(f), 1) for f in found]


def test_quality_rules_equal_brute_force(spark, odd):
    ratio = quality_rules.Ratio(buckets=512, threshold=-0.05)
    labels = spark.createDataFrame([(1,), (4,), (5,), (5,), (None,)], "doc_id long")
    got = quality_rules.score_documents(odd, labels, ratio).collect()
    want = brute_llr(ODD, {1, 4, 5}, ratio)
    assert len(got) == len(ODD)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    by_row = sorted(zip(ODD, want), key=lambda x: key(x[0]))
    for row, ((i, text), llr) in zip(sorted(got, key=lambda r: key((r.doc_id, r.text))), by_row):
        figures = tuple(row[c] for c in (*quality_rules.FIGURES, "base_failed"))
        assert figures == brute_base(text), i
        assert row.llr == pytest.approx(llr, abs=1e-9)
        assert row.kept == (not row.base_failed and row.llr >= ratio.threshold)
        assert row.ids == "x"


def test_quality_rules_on_documents(spark):
    rows = {r.doc_id: r for r in QUERIES["op6_quality_rules"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    for d in docs:
        r = rows[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_base(d.text)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    passed = [i for i in quality if not rows[i].base_failed]
    assert all(rows[i].kept for i in passed if quality[i] == 1)
    assert sum(not rows[i].kept for i in passed if quality[i] == 0) >= 0.8 * sum(quality[i] == 0 for i in passed)


def test_quality_rules_without_labels_or_rows(spark, odd):
    assert {r.llr for r in quality_rules.score_documents(odd, None).collect()} == {0.0}
    none = spark.createDataFrame([], odd.schema)
    assert quality_rules.score_documents(none, None).count() == 0


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op9_pu_quality"](spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    judged = [(rows[i].score, y) for i, y in labels.items() if rows[i].held_out]
    good, bad = [s for s, y in judged if y], [s for s, y in judged if not y]
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.98
    assert sum((s >= 0.7) == y for s, y in judged) / len(judged) > 0.95


def test_classifier_never_reads_held_out_labels_and_takes_odd_rows(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id as string)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    both = docs.unionByName(odd.select("doc_id", "text"))
    score = lambda y: sorted((r.doc_id is None, r.doc_id or 0, r.score) for r in pu_quality.score_quality(both, y).collect())
    first = score(labels)
    assert len(first) == both.count()
    assert [(a, b) for a, b, _ in first] == [(a, b) for a, b, _ in score(flipped)]
    assert [s for *_, s in first] == pytest.approx([s for *_, s in score(flipped)], abs=1e-6)
    none = pu_quality.score_quality(odd, labels.limit(0)).collect()
    assert {round(r.score, 9) for r in none} == {0.7}
    assert pu_quality.score_quality(odd.limit(0), labels).count() == 0


def test_prior_estimate_is_near_the_truth():
    import numpy as np

    rng = np.random.default_rng(0)
    p, bad = rng.normal(0.5, 0.3, 20000), rng.normal(-0.8, 0.3, 8000)
    u = np.concatenate([rng.normal(0.5, 0.3, 32000), bad])
    bins = lambda x: np.histogram(x, np.linspace(-2, 2, pu_quality.BINS + 1))[0]
    assert pu_quality.estimate_prior(bins(u), bins(p), 2.0) == pytest.approx(0.8, abs=0.04)


URLS = [
    None, "", "nothing", "://", "http://EXAMPLE.net/en/", "http://a.example.net/en", "http://x.net", "http://x.net/", "http://x.net?/a",
    "https://example.com/de/x?y#z", "https://notexample.com/de/", "http://a.org/fr/#", "http://org/fr/", "http://.net/", "http://É.NET/EN/",
    "ftp://u:p@example.net:80/en/", "http://a.example.net/en/x/://b", "http://x.net#/en/", "http://a.b.example.com//de/",
]


def brute_rule(url, rules):
    host, path = "", ""
    if url and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url[url.index("://") + 3 :], re.S)
        host, path = "".join(c.lower() if c < "\x80" else c for c in m[1]), m[2]
    fit = [(h.count(".") + (h != ""), len(h + p), v == "allow", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h) or h == "") and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[3] if best else None, best[4] if best else "allow"


def test_urls_equal_brute_force(spark):
    more = [("block", "", "/x"), ("allow", "net", "/e"), ("block", "net", "/en/x"), ("block", "b.example.com", ""), ("allow", "b.example.com", ""), ("block", "net", "/e")]
    pages = spark.createDataFrame([(k, u, "z") for k, u in enumerate(URLS + URLS[-2:])], "page_id long, url string, rule string")
    for rules in (URL_RULES, URL_RULES + more, []):
        for block in (1, 3, 1000):
            got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules, block=block).collect()}
            assert got == {k: brute_rule(u, rules) for k, u in enumerate(URLS + URLS[-2:])}
    assert url_filter.filter_urls(pages.limit(0), URL_RULES).count() == 0


def test_urls_of_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in QUERIES["op10_url_filter"](spark, SF).collect()}
    assert got == {p.page_id: brute_rule(p.url, URL_RULES) for p in pages}
