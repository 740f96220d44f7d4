"""Every stage of the corpus pipeline, and its run, against brute force over odd rows."""

from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter, defaultdict

import pytest
from test_text_operators import brute_base, brute_llr

import corpus_pipeline
from premiumlake.llm import quality_rules
from premiumlake.llm.queries import rank_file

ITEM = "Which river runs below the seven old hills of Marn before it meets the sea? The long Osk."
KINDS = "doc_id long, text string, n_chars int, kept boolean, llr double, key string, class_id int, lowest long, digest string, item string, id long, marks string"
LAST = 1 << 63


def rows():
    """(id, text): nulls, empty, short and repetitive texts, repeats, one id with several texts, near
    copies in a chain, shared passages with characters of several bytes, leaks."""
    rng = random.Random(12)
    draw = lambda n: " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(2, 7))) for _ in range(n))
    out = [(k, draw(rng.randint(15, 60))) for k in range(10)]
    passage, base = draw(25), draw(80)
    out += [(k, f"{draw(12)} {passage} {draw(12)}") for k in range(20, 25)]
    chain = base.split()
    for k in range(30, 36):
        out.append((k, " ".join(chain)))
        chain[rng.randrange(80)] = draw(1)
    out += [(36, base), (None, base), (None, draw(40)), (40, out[0][1]), (3, draw(30)), (3, out[3][1]), (None, out[4][1])]
    out += [(50, None), (51, ""), (None, None), (52, " \n"), (53, "one two"), (54, "one two three four five six " * 8), (55, "ЖШЩ " + " ".join(f"ЖШ{k}Щ" for k in range(40)))]
    out += [(60, f"{draw(20)} {ITEM} {draw(20)}"), (61, f"{draw(20)} {ITEM.replace('old', 'new')} {draw(20)}"), (62, f"{draw(20)} {ITEM[: ITEM.index('?')]} {draw(20)}"), (None, f"{draw(15)} {ITEM.upper()}")]
    return out


TRUSTED = [*range(10), *range(20, 25), *range(30, 37), 40, *range(60, 63)]


def quality(own):
    limit = quality_rules.Ratio()
    scores = brute_llr(own, set(TRUSTED), limit)
    return [r for r, s in zip(own, scores) if not brute_base(r[1])[-1] and s >= limit.threshold]


def near_duplicates(own):
    def sets(t):
        w = t.split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    texts = sorted({t or "" for _, t in own})
    grams, root = {t: sets(t) for t in texts}, {t: t for t in texts}
    for a in texts:
        for b in texts:
            if grams[a] and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]):
                old, new = root[a], root[b]
                root = {t: new if r == old else r for t, r in root.items()}
    classes = defaultdict(list)
    for r in set(own):
        classes[root[r[1] or ""]].append(r)
    return [min(c, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())) for c in classes.values()]


def repeated_passages(own):
    rank = lambda i: LAST if i is None else i
    lowest, seen = {}, {}
    for i, t in own:
        lowest[t or ""] = min(lowest.get(t or "", LAST), rank(i))
    for t, low in lowest.items():
        b = t.encode()
        for k in range(len(b) - 49):
            seen[b[k : k + 50]] = min(seen.get(b[k : k + 50], LAST), low)
    out = []
    for i, t in own:
        t = t or ""
        b, gone = t.encode(), set()
        for k in range(len(b) - 49):
            if seen[b[k : k + 50]] < lowest[t]:
                gone |= set(range(k, k + 50))
        left, at = "", 0
        for c in t:
            size = len(c.encode())
            left += "" if set(range(at, at + size)) <= gone else c
            at += size
        if left and not (rank(i) > lowest[t] and len(b) >= 50):
            out.append((i, left))
    return out


def decontamination(own):
    holds = lambda t: ITEM.lower() in t.lower() or ITEM.replace("old", "new").lower() in t.lower()
    return [r for r in own if not holds(r[1] or "")]


def tokens(own):
    import tiktoken

    path, pattern = rank_file()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    ids = [(i, tuple(encoding.encode_ordinary(t or "")), t or "") for i, t in own]
    return Counter((i, len(x), x, hashlib.sha256(t.encode()).hexdigest()) for i, x, t in ids)


BRUTE = [quality, near_duplicates, repeated_passages, decontamination]


def frame(spark, own):
    """Documents with columns whose names the stages use themselves."""
    full = [(i, t, len(t or ""), False, 9.0, f"k{i}", 7, 5, f"d{i}", f"i{i}", -1, f"m{i}") for i, t in own]
    return spark.createDataFrame(full, KINDS).repartition(3)


def told(frame):
    return Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded_sha256) for r in frame.collect())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    frame(spark, rows()).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(k, 1) for k in TRUSTED] + [(0, 1), (None, 1), (55, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_equal_brute_force(spark, folder):
    own = rows()
    for brute, (name, stage) in zip(BRUTE, corpus_pipeline.STAGES):
        for given in (own, own + own[:5]):  # repeats, also of what a stage before would have dropped
            docs = frame(spark, given)
            got, want = stage(spark, docs, folder), brute(given)
            assert got.columns == docs.columns, name
            found = got.collect()
            assert Counter((r.doc_id, r.text) for r in found) == Counter(want), name
            assert all((r.n_chars, r.kept, r.llr, r.key, r.class_id, r.lowest, r.digest, r.item, r.id, r.marks) == (len(r.text or ""), False, 9.0, f"k{r.doc_id}", 7, 5, f"d{r.doc_id}", f"i{r.doc_id}", -1, f"m{r.doc_id}") for r in found), name
    assert told(corpus_pipeline.tokens(spark, frame(spark, own), folder)) == tokens(own)


def test_run_equals_brute_force(spark, folder):
    own = rows()
    for brute in BRUTE:
        before, own = own, brute(own)
        assert own and own != before  # each stage has something to do
    assert told(corpus_pipeline.run(spark, folder)) == tokens(own)


def test_stages_of_an_empty_table(spark, folder):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame(spark, rows()).limit(0), folder).count() == 0, name


def test_columns_of_any_name_survive(spark, folder):
    """Names that a stage may use inside, in any case, and ids that are strings."""
    own = [(i, t) for i, t in rows() if i is not None]
    names = ["doc_id", "text", "__key", "__kept", "__lowest", "__size", "__text", "N_WORDS", "Kept", "row", "left", "rest"]
    for kind, id_of in (("long", lambda i: i), ("string", lambda i: f"d{i}")):
        schema = f"doc_id {kind}, text string, " + ", ".join(f"`{c}` string" for c in names[2:])
        docs = spark.createDataFrame([(id_of(i), t, *[f"{c}-{i}" for c in names[2:]]) for i, t in own], schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, docs, folder) if kind == "long" or name != "quality rules" else docs
            found = got.collect()
            assert got.columns == names and found, name
            for r in found:
                number = str(r.doc_id).removeprefix("d")
                assert [r[c] for c in names[2:]] == [f"{c}-{number}" for c in names[2:]], name


def test_of_repeats_the_same_row_stays(spark, folder):
    text = "one two three four five six seven eight nine ten eleven twelve"
    many = [(1, text, f"v{k}") for k in range(9)]
    kept = set()
    for k in range(3):
        docs = spark.createDataFrame(many[k:] + many[:k], "doc_id long, text string, v string").repartition(1 + k)
        (row,) = corpus_pipeline.near_duplicates(spark, docs, folder).collect()
        kept.add(row.v)
    assert len(kept) == 1
