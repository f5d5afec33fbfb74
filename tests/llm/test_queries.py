"""Every registered corpus query, and the pipeline, over whole tables with awkward rows, against plain versions."""

import collections
import hashlib
import importlib.util
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from skysift.llm import compression_classifier, packing, pii, quality_rules, viterbi
from skysift.llm import queries as corpus
from tests.llm.test_operators import WORDS, plain_base, plain_components, plain_shingles, plain_stats, prose

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def bodies():
    r = random.Random(31)
    base = prose(r, 160)
    junk = ["@@ ## || " * 60, "again and again " * 70, " | ".join(prose(r, 1) for _ in range(90)), "".join(w + "%%% " for w in prose(r, 80).split())]
    good = [prose(r, r.randrange(60, 300)) for _ in range(150)]
    odd = [None, "", " ", "\n\t", "one", "one two three", "naïve 日本 \U0001f600 <|endoftext|>", "x" * 3000, "word " * 2500]
    private = [prose(r, 70) + " mail a.b@c-d.org or call +1 (521) 555-6210, card 4111 1111 1111 1111 at 10.2.3.4" for _ in range(3)]
    return odd + [base, base, base.upper(), base.replace(" ", "  ")] + [base + f" end {k}" for k in range(3)] + private + good + [r.choice(junk) + prose(r, 20) for _ in range(60)]


@pytest.fixture(scope="module")
def texts():
    return bodies()


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    """documents with null ids and columns, repeated rows and extra columns whose names the operators use."""
    at = tmp_path_factory.mktemp("tables")
    rows = [(n, t, "en" if n % 3 else None, "s", None if t is None else len(t)) for n, t in enumerate(texts)]
    rows += [(None, "a row without an id " * 20, None, None, None), rows[9], rows[0]]
    spark.createDataFrame(rows, DOCUMENTS).selectExpr(
        "*", "1 as size", "2 as shard", "3 as score", "4 as n_tokens", "5 as length", "'x' as spans", "7 as component_id", "8 as payload", "9 as kept", "10 as n_words", "'y' as stratum", "11 as node", "12 as piece"
    ).repartition(3).write.parquet(f"{at}/documents.parquet")
    labels = [(n, int(n < len(texts) - 60), 0) for n in range(16, len(texts))]
    spark.createDataFrame([*labels, (None, 1, 0), (3, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    urls = [None, "", "no scheme", "https://a.ORG/x", "http://example.org/es/1", "http://x.com/de/9", "http://x.com/de/9"]
    spark.createDataFrame([(n, u, None) for n, u in enumerate(urls)], "page_id bigint, url string, html string").write.parquet(f"{at}/pages.parquet")
    spark.createDataFrame([(0, [1.0, 0.5], 1), (1, [0.5, 2.0], 0)], "vec_id bigint, embedding array<float>, label int").write.parquet(f"{at}/embeddings.parquet")
    return str(at)


@pytest.fixture(scope="module")
def empty(spark, folder, tmp_path_factory):
    at = tmp_path_factory.mktemp("empty")
    for name in ("documents", "labels", "pages", "embeddings"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{at}/{name}.parquet")
    return str(at)


def crc(raw):
    return zlib.crc32(raw)


def run(spark, folder, name, columns):
    """Rows of a query by id (of repeated ones any), after a look at its columns and counts."""
    out = corpus.queries()[name](spark, folder)
    assert [f"{c} {t}" for c, t in out.dtypes][: len(columns)] == columns
    return out.collect()


def by_id(rows):
    return {r.doc_id: r for r in rows}


def test_op1(spark, folder, texts):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(corpus.tokenizer_file("byte_bpe_50k.json"))
    rows = run(spark, folder, "op1_best_fit_packing", ["doc_id bigint", "piece int", "start bigint", "length bigint", "ids_crc32 bigint", "sequence_id bigint", "offset bigint"])
    pieces = collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = collections.Counter()
    for n, t in [*enumerate(texts), (None, "a row without an id " * 20), (9, texts[9]), (0, None)]:
        ids = np.array(coder.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        first = (len(ids) - 1) % packing.CAPACITY + 1
        at = [0, *range(first, len(ids) + 1, packing.CAPACITY)]
        want.update((n, k, a, b - a, crc(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(at, at[1:])))
    assert pieces == want
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        ends = np.cumsum([x for _, x in sorted(parts)])
        assert ends[-1] <= packing.CAPACITY and [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()]
    assert len(places) <= 1.02 * sum(r.length for r in rows) / packing.CAPACITY + 2


def test_op2(spark, folder, texts):
    rows = run(spark, folder, "op2_jaccard_join", ["doc_id bigint", "n_shingles bigint", "component_id bigint"])
    sets = {n: plain_shingles(t) for n, t in enumerate(texts)}
    want = plain_components(sets)
    assert len(rows) == len(texts) + 3
    assert all((r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id]) for r in rows if r.doc_id is not None)


def test_op3(spark, folder, texts):
    rows = run(spark, folder, "op3_sentencepiece", ["doc_id bigint", "n_tokens bigint", "ids_crc32 bigint", "round_trip boolean"])
    coder = viterbi.encoder(corpus.tokenizer_file("piece_bpe_32k.model"))
    assert len(rows) == len(texts) + 3 and all(r.round_trip for r in rows)
    assert all(r.ids_crc32 == crc(coder.encode([texts[r.doc_id] or ""])[0]) for r in rows if r.doc_id is not None)


def test_op4(spark, folder, texts):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(corpus.tokenizer_file("byte_bpe_50k.json"))
    rows = run(spark, folder, "op4_token_counts", ["doc_id bigint", "n_bytes bigint", "n_tokens bigint", "over_limit boolean"])
    assert len(rows) == len(texts) + 3
    for r in rows:
        if r.doc_id is not None:
            count = len(coder.encode(texts[r.doc_id] or "", add_special_tokens=False).ids)
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), count, count > 1024)


def test_op5(spark, folder, texts):
    rows = run(spark, folder, "op5_pii", ["doc_id bigint", "n_email bigint", "n_ip bigint", "n_card bigint", "n_phone bigint", "base_sha256 string", "spans string"])
    assert len(rows) == len(texts) + 3
    for r in rows:
        if r.doc_id is not None:
            base = plain_base(texts[r.doc_id] or "")
            assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest() and set(base) <= {*r.spans.split(","), ""}
            spans = [x.split(":") for x in r.spans.split(",") if x]
            assert spans == sorted(spans, key=lambda x: (pii.KINDS.index(x[0]), int(x[1]))) and all(int(a) < int(b) <= len(texts[r.doc_id]) for _, a, b in spans)


def test_op6(spark, folder):
    rows = run(spark, folder, "op6_url_filters", ["page_id bigint", "host string", "path string", "rule string", "verdict string"])
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert len(rows) == 7 and {got[n] for n in range(3)} == {("", "", None, "allow")}
    assert got[3] == ("a.org", "/x", "org/", "allow") and got[4] == ("example.org", "/es/1", "example.org/es/", "block") and got[5] == got[6] == ("x.com", "/de/9", "com/de/", "block")


def test_op7(spark, folder, texts):
    rows = run(spark, folder, "op7_media_chunks", ["doc_id bigint", "n_bytes bigint", "payload_bytes bigint", "payload_sha256 string", "tail_crc32 bigint", "media_bytes bigint", "media_sha256 string", "feature string"])
    assert len(rows) == len(texts) + 3
    for r in rows:
        if r.doc_id is not None:
            body = (texts[r.doc_id] or "").encode()
            payload = body + b"\xff" * (max(1, -(-len(body) // 576)) * 576 - len(body))
            assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(body), len(payload), hashlib.sha256(payload).hexdigest(), crc(payload[-32:]))


def test_op8(spark, folder, texts):
    rows = run(spark, folder, "op8_quality_rules", ["doc_id bigint", "n_words bigint", "word_chars bigint", "n_symbols bigint", "n_dup_lines bigint", "n_repeat_words bigint", "base_failed boolean", "kept boolean"])
    assert len(rows) == len(texts) + 3
    for r in rows:
        if r.doc_id is not None:
            want = plain_stats(texts[r.doc_id])
            assert tuple(r)[1:6] == want and r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)


def test_op9(spark, folder, texts):
    columns = ["doc_id bigint", "size bigint", "text_crc32 bigint", "law string", "shard int", "slot bigint", "grown_shard int"]
    rows = run(spark, folder, "op9_sharding", columns)
    assert len(rows) == len(texts) + 3 and {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    inside, loads = collections.defaultdict(list), collections.Counter()
    for r in rows:
        inside[r.shard].append(r.slot)
        loads[r.shard] += r.size
        if r.doc_id is not None:
            body = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(body) + 8, crc(body)) and 0 <= r.shard < 24
    assert all(sorted(v) == list(range(len(v))) for v in inside.values())
    assert max(loads.values()) - min(loads[s] for s in range(24)) <= max(r.size for r in rows)


def test_op10(spark, folder, texts):
    rows = run(spark, folder, "op10_quality_classifier", ["doc_id bigint", "held_out boolean", "score double", "predicted int"])
    assert len(rows) == len(texts) + 3
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = compression_classifier.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    sizes = compression_classifier.Sizes(model.good, model.bad)
    for r in rows:
        if r.doc_id is not None:
            f = sizes.features([texts[r.doc_id] or ""])[0]
            z = model.weights[0] + model.weights[1] * min(max(f[0], -0.2), 0.2) + model.weights[2] * min(f[1], 0.5)
            assert r.score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9) and r.predicted == (r.score >= 0.3) and r.held_out == (crc(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in rows if r.doc_id is not None and r.held_out and r.doc_id >= 16]
    assert sum(r.predicted == (r.doc_id < len(texts) - 60) for r in held) >= 0.9 * len(held)


def test_pipeline(spark, folder, texts):
    """Each stage on its own input: what goes, what stays, and that the last one packs what is left."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {n: t for n, t in enumerate(texts)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), name)
        rows = docs.collect()
        assert docs.columns == columns and {r.doc_id for r in rows} <= {*kept, None}
        now = {r.doc_id: r.text for r in rows if r.doc_id is not None}
        if name == "quality_rules":
            assert all((s := plain_stats(t))[0] >= quality_rules.MIN_WORDS and 100 * s[4] <= 50 * s[0] for t in now.values())
        if name == "near_duplicates":
            assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(set(plain_components({n: plain_shingles(t) for n, t in kept.items()}).values()))
        if name == "pii":
            assert set(now) == set(kept) and not any(plain_base(t) for t in now.values())
            assert all(r.n_chars == len(r.text) for r in rows)
        else:
            assert all(t == kept[n] for n, t in now.items())
        kept = now
    assert len(kept) > 100 and any("[EMAIL]" in t for t in kept.values())
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in out if r.doc_id is not None} == set(kept)
    assert sum(r.length for r in out) >= sum(len(WORDS.findall(t)) for t in kept.values())


@pytest.mark.parametrize("name", [*corpus.queries(), "pipeline"])
def test_empty_tables(spark, empty, name):
    query = corpus_pipeline.run if name == "pipeline" else corpus.queries()[name]
    out = query(spark, empty)
    assert out.columns and out.count() == 0


def test_the_entry_has_them():
    import __spark_entry__

    assert {*corpus.queries(), "pipeline"} <= set(__spark_entry__.queries()) and importlib.util.find_spec("corpus_pipeline")
