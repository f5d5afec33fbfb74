"""Ball trees, trie shards and the heavy-light split against plain versions, and their queries over awkward tables."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from skysift.llm import ball_tree, divergence, spelling
from skysift.llm import queries as corpus
from tests.llm.test_operators import prose

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# exact top-k


def plain_top(rows, k=10):
    """(query, rank, id, score) by comparing each query with every row."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    scaled = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in good]
    scaled = [(i, v) for i, v in scaled if sum(x * x for x in v) <= ball_tree.MOST_SQUARED]
    out = []
    for i, q in scaled:
        if i % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in scaled if j != i and len(v) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out)


def vector_rows():
    r = np.random.default_rng(7)
    lumps = [c + r.normal(0, 0.05, (300, 6)) for c in r.normal(0, 1, (5, 6))]
    x = np.concatenate([*lumps, r.normal(0, 1, (300, 6)), np.tile(r.normal(0, 1, 6), (200, 1))]).astype(np.float32)
    rows = [(n, [float(v) for v in row]) for n, row in enumerate(x)]
    odd = [(5000, None), (5100, [None, 1.0]), (5200, [float("nan")] * 6), (5300, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (5400, [3.0e38] * 6), (5500, []), (5501, []), (5600, [1.0, 2.0]), (5601, [3.0, -1.0]), (5700, [0.0] * 6), (5800, [1.0e6] * 6)]
    return rows + odd + [rows[0], rows[100]]


def test_top_k(spark, monkeypatch):
    """Lumps, equal vectors, other lengths, huge and missing components; shards, leaves and blocks so small that all of them are many."""
    for name, value in (("SHARD_ROWS", 150), ("LEAF_ROWS", 8), ("QUERY_BLOCK", 7), ("FEW_SHARDS", 6)):
        monkeypatch.setattr(ball_tree, name, value)
    rows = vector_rows()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<float>, score int, cell int").repartition(5)
    got = sorted(tuple(r) for r in ball_tree.top_k(df, "vec_id % 100 = 0").collect())
    assert got == plain_top(rows)


@pytest.mark.parametrize("scale", [1, 1 << 14, 1 << 26])
def test_tree_search_is_exact_and_leaves_out(scale):
    """All three number types; lumps of one tree are left out once the k-th score is known."""
    r = np.random.default_rng(3)
    x = np.concatenate([r.normal(c, 0.05, (400, 4)) for c in r.normal(0, 2, (8, 4))]) * scale
    x = np.rint(x).astype(np.int32) if scale > 1 else np.rint(x * 50).astype(np.int32)
    ids = r.permutation(len(x)).astype(np.int64)
    tree = ball_tree.BallTree.of(ids, x)
    q = x[:50]
    best, made = ball_tree.search(tree, ids[:50], q, np.full(50, -(1 << 62)), 5)
    assert made < 0.7 * len(q) * len(x)
    for n in range(50):
        s = sorted(((-int(a), int(j)) for a, j in zip((x.astype(object) @ q[n].astype(object)).tolist(), ids.tolist(), strict=True) if j != ids[n]))[:5]
        assert [(-int(a), int(j)) for a, j in zip(best.score[best.who == n], best.ids[best.who == n], strict=True)] == s
    floor = best.floor.copy()
    again, fewer = ball_tree.search(tree, ids[:50], q, floor, 5)
    assert fewer <= made and (again.ids == best.ids).all()


# spelling variants


def plain_words(docs):
    n = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def plain_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(docs):
    n = plain_words(docs)
    words = sorted(n)
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and plain_near(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def spelled_docs():
    r = random.Random(8)
    words = ["".join(r.choice(["an", "the", "er", "on", "ti", "és", "ou"]) for _ in range(r.randrange(3, 6))) for _ in range(60)]
    docs = [(n, " ".join(r.choice(words[:8] if r.random() < 0.7 else words) for _ in range(r.randrange(5, 200)))) for n in range(120)]
    long = "ab" * 4000
    odd = [None, "", " 123 ", "AaaaaaaÉaaaaaaa", "x" * 3000 + " " + "x" * 3001, f"{long} {long} {long}c {long}c", "straßeŸstraße ×÷×÷×÷×÷ ×÷×÷×÷×÷", "x" * 3000 + "," + "x" * 3001]
    docs += [(1000 + n, t) for n, t in enumerate(odd)]
    return [*docs, (None, "thentherenowhere thentherenowhere"), docs[3], docs[3], docs[0]]


def test_spelling_variants(spark, monkeypatch):
    """Several shards and groups of shards, chains of forms, ties, long words, repeated rows, a null id."""
    for name, value in (("SHARD_WORDS", 40), ("GROUP_BYTES", 30_000), ("HELD", 50), ("BLOCK", 64)):
        monkeypatch.setattr(spelling, name, value)
    docs = spelled_docs()
    chain = ["Lengthyword", "lengthywor", "lengthywo"]
    docs += [(2000, " ".join(chain[:1] * 400 + chain[1:2] * 35 + chain[2:] * 3)), (2001, " ".join(chain[:1] * 400))]
    df = spark.createDataFrame([(*d, "a") for d in docs], "doc_id bigint, text string, word string").repartition(4)
    got = spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = plain_variants(docs)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert any(w[1] and w[2] != w[1] for w in want)


@pytest.mark.parametrize("states", [2, 60, 1 << 20])
def test_automata(monkeypatch, states):
    monkeypatch.setattr(spelling, "STATES", states)
    r = random.Random(states)
    for letters, most in ((b"ab", 9), (b"abcd\xe9", 14)):
        words = sorted({bytes(r.choice(letters) for _ in range(r.randrange(1, most))) for _ in range(120)} | {b"a" * 60, b"a" * 61, b"a" * 30 + b"b" + b"a" * 30})
        trie = spelling.Trie.of(words, [2] * len(words))
        w, x = spelling.near_words(trie, *spelling._flat(words))
        assert set(zip(w.tolist(), x.tolist(), strict=True)) == {(a, b) for a, b in itertools.permutations(range(len(words)), 2) if plain_near(words[a], words[b])}
    assert spelling.groups([(0, 1, 5), (0, 0, 6), (1, 0, 50), (2, 0, 1)], 11) == [[(0, 0), (0, 1)], [(1, 0)], [(2, 0)]]


# source divergence


def plain_audit(docs, least=30):
    pattern = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    docs = [(lang or "", source or "", collections.Counter("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in pattern.findall(text or ""))) for text, lang, source in docs]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = collections.Counter(t for d in own for t in d[2])
        kept = [t for t, k in seen.items() if k >= least]
        counts = {s: collections.Counter() for _, s, _ in own}
        whole = collections.Counter()
        for _, s, c in own:
            for t in kept:
                counts[s][t] += c[t]
                whole[t] += c[t]
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        ps, q = {s: p(c) for s, c in counts.items()}, p(whole)
        for s in counts:
            pairs = sorted((-sum(abs(ps[s][t] - ps[o][t]) for t in kept), o.encode(), o) for o in counts if o != s)
            terms = sorted((q[t] - ps[s][t], t.encode(), t) for t in kept if counts[s][t] and ps[s][t] > q[t])[:50]
            out |= {(lang, s, part, o, -v, n + 1) for part, found in (("pair", pairs), ("term", terms)) for n, (v, _, o) in enumerate(found)}
    return out


def sourced_docs():
    r = random.Random(6)
    vocabulary = [prose(r, 1).strip(".") for _ in range(150)] + ["não", "日本", " x", "İİ"]
    out = []
    for n in range(700):
        source = None if n % 50 == 0 else f"s{min(int(r.expovariate(0.12)), 30)}"
        words = r.sample(vocabulary, 60 if source in ("s0", None) else 25)
        out.append(("  ".join(r.choice(words) + r.choice(["", "-", "9", "\n"]) for _ in range(r.randrange(0, 120))), None if n % 61 == 0 else r.choice(["en", "en", "de"]), source))
    return [*out, (None, "en", "silent"), ("", "en", "Silent"), ("lonely words", "xx", "only"), ("few", "yy", "a"), ("few", "yy", "b"), out[5], out[5]]


@pytest.mark.parametrize(("light", "block", "chunk"), [(8, 64, 4096), (2, 5, 7), (0, 3, 30), (100, 4, 10)])
def test_divergence(spark, monkeypatch, light, block, chunk):
    """Only heavy terms, only light ones, and both; several tiles of groups and chunks of terms."""
    for name, value in (("LIGHT", light), ("BLOCK", block), ("CHUNK", chunk), ("HELD", 200)):
        monkeypatch.setattr(divergence, name, value)
    docs = sourced_docs()
    df = spark.createDataFrame([(n, *d, 3) for n, d in enumerate(docs)], "doc_id bigint, text string, lang string, source string, term int").repartition(4)
    got = divergence.audit(df).select("lang", "source", "part", "item", "value", "rank").collect()
    want = plain_audit(docs)
    assert len(got) == len(want) and {tuple(r) for r in got} == want


# queries over awkward tables


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    rows = [(d, t, *((lang, s) if n % 7 else (None, None)), None) for n, ((d, t), (_, lang, s)) in enumerate(zip(spelled_docs(), sourced_docs(), strict=False))]
    spark.createDataFrame(rows, DOCUMENTS).selectExpr("*", "1 as n", "'w' as word", "2 as term", "3 as part").repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(*r, None) for r in vector_rows()], "vec_id bigint, embedding array<float>, label int").write.parquet(f"{at}/embeddings.parquet")
    return str(at), rows


def test_queries(spark, folder):
    at, rows = folder
    kinds = {
        "op11_exact_top_k": "query_id bigint, rank int, vec_id bigint, score bigint",
        "op12_spelling_variants": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
        "op13_source_divergence": "lang string, source string, part string, item string, value bigint, rank int",
    }
    out = {}
    for name, columns in kinds.items():
        df = corpus.queries()[name](spark, at)
        assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == columns
        out[name] = [tuple(r) for r in df.collect()]
    assert sorted(out["op11_exact_top_k"]) == plain_top(vector_rows())
    assert set(out["op12_spelling_variants"]) == plain_variants([r[:2] for r in rows])
    assert set(out["op13_source_divergence"]) == plain_audit([r[1:4] for r in rows])


@pytest.mark.parametrize("name", ["op11_exact_top_k", "op12_spelling_variants", "op13_source_divergence"])
def test_empty(spark, folder, tmp_path, name):
    for table in ("documents", "embeddings"):
        spark.read.parquet(f"{folder[0]}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus.queries()[name](spark, str(tmp_path)).count() == 0
