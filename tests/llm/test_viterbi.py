import random

import numpy as np
import pytest

from skysift.llm import viterbi

sentencepiece = pytest.importorskip("sentencepiece")
PATH = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def plain(text):
    """One text's best segmentation, position by position, without segments or batches."""
    sp = sentencepiece.SentencePieceProcessor(model_file=str(PATH))
    scores = {sp.id_to_piece(n): (sp.get_score(n), n) for n in range(sp.get_piece_size()) if not (sp.is_control(n) or sp.is_unknown(n) or sp.is_byte(n))}
    unknown = min(s for s, _ in scores.values()) - viterbi.UNKNOWN
    text = "▁" + text.replace(" ", "▁") if text else ""
    best, back = [0.0] + [-np.inf] * len(text), [None] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 16), end):
            known = scores.get(text[start:end], (unknown, -1) if end - start == 1 else None)
            if known and best[start] + known[0] > best[end]:
                best[end], back[end] = best[start] + known[0], (start, known[1])
    out, at = [], len(text)
    while at:
        start, n = back[at]
        out[:0] = [n] if n >= 0 else [sp.piece_to_id(f"<0x{b:02X}>") for b in text[start].encode()]
        at = start
    return out


def ids(text):
    return np.frombuffer(viterbi.encoder(str(PATH)).encode([text])[0], "<i4").tolist()


def unigram():
    """The library over the same pieces and scores, with the model's type set to unigram."""
    raw = bytearray(open(PATH, "rb").read())

    def varint(at):
        value = shift = 0
        while True:
            b = raw[at]
            value |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return value, at

    at = 0
    while at < len(raw):
        key, at = varint(at)
        assert key & 7 == 2
        size, at = varint(at)
        if key >> 3 == 2:  # the trainer's settings
            inner, stop = at, at + size
            while inner < stop:
                k, inner = varint(inner)
                if k & 7 == 0:
                    if k >> 3 == 3:
                        raw[inner] = 1
                    _, inner = varint(inner)
                elif k & 7 == 2:
                    n, inner = varint(inner)
                    inner += n
                else:
                    inner += 4 if k & 7 == 5 else 8
        at += size
    return sentencepiece.SentencePieceProcessor(model_proto=bytes(raw))


@pytest.mark.parametrize("text", ["", " ", "a", "Hello world", "the  cat\n sat\ton", "naïve 日本 \U0001f600x", "x" * 200 + " y", "  lead and trail  ", "ab" * 70])
def test_equals_plain_search_and_round_trips(text):
    assert ids(text) == plain(text)
    coder = viterbi.encoder(str(PATH))
    assert coder.decode(coder.encode([text])[0]) == text


def test_long_segments_equal_the_plain_search(monkeypatch):
    """Segments without spaces of many lengths, together and across blocks and arrays of blocks."""
    r = random.Random(11)
    words = ["".join(r.choice(["tion", "an", "he", "q", "日", "é", "01", "\U0001f600", "ing", "str", "x", "\x00"]) for _ in range(n)) for n in (30, 33, 40, 64, 90, 200, 400, 900)]
    coder = viterbi.Encoder(viterbi.load(str(PATH)))
    want = [np.array(plain(w), "<i4").tobytes() for w in words]
    assert coder.encode(words) == want
    monkeypatch.setattr(viterbi, "BLOCK", 16)
    monkeypatch.setattr(viterbi, "ROWS", 3)
    assert coder.encode(words) == want
    assert [coder.decode(x) for x in want] == words


def test_long_segments_in_bounded_memory():
    import tracemalloc

    r, coder = random.Random(2), viterbi.Encoder(viterbi.load(str(PATH)))
    text = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    coder.encode([text[:1000]])
    tracemalloc.start()
    ids = coder.encode([text])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert coder.decode(ids) == text and peak < 150_000_000


def test_equals_the_library_in_unigram_mode():
    # digits are left out: their scores of -1e9 use up the library's single precision
    lib, r = unigram(), random.Random(3)
    words = "the of and tion anhaou erorth sting people water year's good-bye".split()
    for _ in range(50):
        text = " ".join(r.choice(words) for _ in range(r.randrange(1, 12)))
        total = lambda path: sum(map(lib.get_score, path))
        assert total(ids(text)) == total(lib.nbest_encode_as_ids(text, 2)[0])


def test_tables(spark):
    rows = [(1, "some words here"), (2, None), (3, ""), (None, "x"), (1, "some words here")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as ids", "2 as n_tokens")
    out = viterbi.round_trip(docs, str(PATH), as_unigram=True).collect()
    assert len(out) == 5 and all(r.round_trip for r in out)
    assert sorted(r.n_tokens for r in out)[:2] == [0, 0]
    back = viterbi.decode(viterbi.encode(docs, str(PATH), as_unigram=True), str(PATH)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((a or 0, b or "") for a, b in rows)
    assert viterbi.round_trip(docs.limit(0), str(PATH), True).count() == 0


def test_other_kinds_are_refused_unless_asked_for(spark):
    assert viterbi.model_kind(str(PATH)) == "bpe"
    docs = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    for call in (viterbi.encode, viterbi.round_trip):
        with pytest.raises(ValueError, match="bpe"):
            call(docs, str(PATH))


def test_words_with_unknown_characters_by_both_ways():
    """Short words are spelled by plain values, long ones by arrays."""
    pieces = viterbi.load(str(PATH))
    for word in ("ab\x00日é\U0001f600", "\x00", "tion"):
        codes = viterbi._codes(word)
        for ids in ([-1] * len(word), [5, *[-1] * (len(word) - 1)]):
            ends = list(range(1, len(word) + 1))
            assert viterbi._spelled_word(pieces, word, ids, ends) == viterbi._spelled(pieces, codes, np.array(ids), np.array(ends))
