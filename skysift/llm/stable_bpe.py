"""Byte-level BPE, word by word.

The pre-tokenizer of a byte-level BPE never joins a character that isn't white space with white space
after it, so a cut before white space that follows another character is stable: both sides encode as
they do within the text. Words recur, so their ids are kept in a bounded memo. Words that aren't in it
are strung together (each cut is stable) and encoded at once by tiktoken with the vocabulary of the
tokenizers file, which gives the same ids four times as fast; whatever holds a special string, or
ends in white space, goes to the tokenizers library itself. A file with other settings than these (see
is_plain) has no such cuts that are known; its texts go to the library whole.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import json
import os
import re
from collections.abc import Callable

import numpy as np

#: Words kept by one Python worker (about 100 MB); beyond that the memo starts anew.
MEMO_WORDS = 500_000

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
WIDE_SPACES = SPACES + "\x85\xa0                　"
_PAIRS = [a + b for a in SPACES for b in " \n"]
_WIDE_PAIRS = [a + b for a in WIDE_SPACES for b in " \n"]
_CUT = re.compile(r"(?<=\S)(?=\s)")


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer, loaded once in a Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


#: The pre-tokenizer's pattern (a fixed value of byte-level BPE).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=4)
def is_plain(path: str) -> bool:
    """Whether the file is a byte-level BPE with the pattern above and nothing else that could touch a text."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, before = file.get("model") or {}, file.get("pre_tokenizer") or {}
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or file.get("normalizer"):
        return False
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if model.get("type") != "BPE" or any(model.get(k) for k in odd):
        return False
    return not any(t.get(k) for t in file.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip"))


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary: itself where it prints, else the next free one from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out = {chr(b): b for b in plain}
    return out | {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(plain)))}


@functools.lru_cache(maxsize=4)
def fast_coder(path: str):
    """tiktoken over the file's vocabulary, the special strings, and the bytes of each id."""
    import tiktoken

    whole = tokenizer(path)
    special = {t.content: n for n, t in whole.get_added_tokens_decoder().items()}
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in token): n for token, n in whole.get_vocab(with_added_tokens=False).items() if token not in special}
    widths = np.zeros(max(whole.get_vocab().values()) + 1, np.int64)
    for raw, n in ranks.items():
        widths[n] = len(raw)
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), list(special), widths


class WordEncoder:
    """Ids of texts. keep(ids) is what the memo holds of a word: a count, or bytes."""

    def __init__(self, path: str, keep: Callable):
        self.path, self.keep = path, keep
        self.memo: dict[str, object] = {}

    def segments(self, text: str) -> list[str]:
        """Keys of the memo for text in order: a word without the space before it, or "\\0" and a segment as it stands."""
        if "\0" not in text and not any(p in text for p in (_PAIRS if text.isascii() else _WIDE_PAIRS)):
            first, *rest = text.replace("\n", " \n").split(" ")
            return ["\0" + first, *rest] if first else rest
        return ["\0" + x for x in _CUT.split(text) if x]

    def encode(self, texts: list[str]) -> list[list]:
        """For each text what keep() made of its segments, in order."""
        if not is_plain(self.path):
            return [[self.keep(np.asarray(tokenizer(self.path).encode(t, add_special_tokens=False).ids, "<u4"))] for t in texts]
        cut = [self.segments(t) for t in texts]
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        missing = list(set().union(*cut).difference(self.memo))
        if missing:
            self.learn(missing)
        get = self.memo.__getitem__
        return [list(map(get, c)) for c in cut]

    def forget(self) -> None:
        """Drop the memo and give its memory back to the system: a Python worker lives on after its task, and then other stages count it."""
        self.memo.clear()
        with contextlib.suppress(OSError, AttributeError):  # no such call in other C libraries
            ctypes.CDLL(None).malloc_trim(0)

    def learn(self, missing: list[str]) -> None:
        coder, special, widths = fast_coder(self.path)
        strung, apart = [], []
        for w in missing:
            odd = w[:1] == "\0" or not w or w[-1].isspace() or any(s in w for s in special)
            (apart if odd else strung).append(w)
        if strung:
            plain = [w if w[0] == "\n" else " " + w for w in strung]
            ids = coder.encode_to_numpy("".join(plain))
            ends = np.cumsum(widths[ids])
            stops = np.cumsum([len(x) if x.isascii() else len(x.encode("utf-8", "surrogatepass")) for x in plain])
            at = np.searchsorted(ends, stops)
            if len(at) and at[-1] < len(ends) and (ends[at] == stops).all():
                raw, start = ids.astype("<u4"), 0
                for w, stop in zip(strung, (at + 1).tolist(), strict=True):
                    self.memo[w] = self.keep(raw[start:stop])
                    start = stop
            else:
                apart += strung
        if apart:
            plain = [w[1:] if w[:1] == "\0" else w if w[:1] == "\n" else " " + w for w in apart]
            for w, e in zip(apart, tokenizer(self.path).encode_batch_fast(plain, add_special_tokens=False), strict=True):
                self.memo[w] = self.keep(np.asarray(e.ids, "<u4"))


@functools.lru_cache(maxsize=4)
def word_encoder(path: str, kind: str) -> WordEncoder:
    """One encoder for each Python worker: kind "count" or "ids" (little-endian 32-bit)."""
    return WordEncoder(path, len if kind == "count" else lambda ids: ids.tobytes())
