"""Secret scan against the patterns themselves, and what the token test finds and leaves."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import string

import pytest

from premiumlake.llm import secret_scan
from premiumlake.llm.byte_bpe import read_ranks
from premiumlake.llm.queries import QUERIES, rank_file

SF = "/root/testdata/sf0.001"
R = random.Random(11)
KEY = "".join(R.choices(string.ascii_letters + string.digits, k=32))
HEX = "0123456789abcdef" * 4
TEXTS = {
    1: None,
    2: "",
    3: f"é🙂 Password : '{'x' * 8}' then API_KEY=short and apikey=\"{KEY}\" x",
    4: f"AKIA{'Z' * 12} AKIAAKIA{'9' * 9} akia{'Z' * 20} xAKIASHORT1",
    5: f"{HEX}{HEX[:3]}G{HEX[:31]} {HEX[:32].upper()}",
    6: f"token: secret=abcdefgh12 TOKEN ={KEY}==",
    7: f"ſecret=abcdefgh1 toKen=abcdefgh1 日本{KEY}語",
    8: "token = \"" + "zk19" * 300_000 + "\" end",
    9: f"{KEY} {KEY}",
}


def brute(text: str | None) -> list[tuple[int, int, str]]:
    text, found = text or "", []
    assign = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    found += [(m.start(), m.end(), "assign") for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda x: (x[0], secret_scan.KINDS.index(x[2])))


def by_id(frame):
    return {r.doc_id: r.spans for r in frame.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", i) for i, t in TEXTS.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, id long")


def test_base_spans_equal_the_patterns(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for frame in (odd, docs):
        texts = {r.doc_id: r.text for r in frame.collect()}
        for i, spans in by_id(secret_scan.scan_secrets(frame, *rank_file())).items():
            assert [(s.start, s.end, s.kind) for s in spans if s.kind != "random"] == brute(texts[i])
            assert all((texts[i] or "")[s.start : s.end] == s.text for s in spans)
            order = [(s.start, secret_scan.KINDS.index(s.kind)) for s in spans]
            assert order == sorted(set(order))


def test_random_strings_are_found_by_their_tokens(spark, odd):
    found = by_id(secret_scan.scan_secrets(odd, *rank_file()))
    assert [s.text for s in found[9]] == [KEY, KEY] and found[9][0].ratio < 2
    assert [s.text for s in found[7] if s.kind == "random"] == [KEY]
    assert [s.kind for s in found[3]] == ["assign", "assign"]  # the key lies in a span of its own
    assert len(found[8]) == 1 and found[8][0].end - found[8][0].start > 1_200_000
    keys = [base64.b64encode(R.randbytes(30)).decode() for _ in range(300)]
    docs = spark.createDataFrame([(i, f"the value {k} stands here") for i, k in enumerate(keys)], "doc_id long, text string")
    caught = by_id(secret_scan.scan_secrets(docs, *rank_file()))
    assert sum(bool(s) for s in caught.values()) >= 285


def test_digests_and_identifiers_are_left(spark):
    clean = [
        hashlib.sha256(b"a").hexdigest().upper(), "sha1:" + base64.b32encode(hashlib.sha1(b"a").digest()).decode(),
        "sha512-" + base64.b64encode(hashlib.sha512(b"a").digest()).decode(), "123e4567-e89b-12d3-a456-426614174000",
        "4550997810720808", "2024-11-05T10-22-33Z", "GB82WEST12345698765432", "eineeinkeitlichpf", "SCREAMING_SNAKE_CASE_CONSTANT_17",
        "AbstractSingletonProxyFactoryBean2", "some/path/to/a/file_name_2024", "https://example.org/a/long/path/of/words-and-more",
    ]
    docs = spark.createDataFrame(list(enumerate(clean)), "doc_id long, text string")
    assert {i: s for i, s in by_id(secret_scan.scan_secrets(docs, *rank_file())).items() if s} == {}


def test_ratio_counts_whole_candidates():
    encoding = secret_scan._encoding(read_ranks(rank_file()[0]), rank_file()[1])
    run = KEY * 100
    pieces = [run[k : k + secret_scan.PIECE] for k in range(0, len(run), secret_scan.PIECE)]
    assert secret_scan.characters_per_token(run, encoding) == len(run) / sum(len(encoding.encode_ordinary(p)) for p in pieces)


def test_query_repeats_and_empty_table(spark, tmp_path):
    got = QUERIES["op11_token_efficiency"](spark, SF)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = [f"{k}:{a}:{b}" for a, b, k in brute(texts[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("random")] == want
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k) for x in want) for k in ("assign", "access", "hex"))
    twice = spark.createDataFrame([(None, KEY), (None, KEY), (1, KEY), (1, "no")], "doc_id long, text string")
    assert sorted(len(r.spans) for r in secret_scan.scan_secrets(twice, *rank_file()).collect()) == [0, 1, 1, 1]
    assert secret_scan.scan_secrets(twice.limit(0), *rank_file()).collect() == []
