"""Personal data: fixed base patterns, and more spans picked by boosted trees.

Base spans (email, ip, card, phone) come from fixed patterns and always stay. Generators of high recall
propose further, overlapping spans of these kinds in looser forms and of other kinds (iban, secret,
ssn), of any length. Boosted trees score each by its format and context; a cut for each kind, calibrated
on held-out examples to PRECISION, decides. Of overlapping spans the best stays, and none that meets a
base span.

The trees learn from generated examples (EXAMPLES, a fixed seed) set into words of a bounded sample of
the texts (CONTEXT_DOCS texts by hash order, CONTEXT_WORDS words of each from a hashed place on), so they
need no labelled personal data.

Defined results: a null text counts as empty and has no spans; rows that repeat get equal spans; an
empty table gives an empty result; only id and text are read (redact() keeps all columns). Time is
linear in a text's length but for the candidates' context, which has a fixed length.
"""

from __future__ import annotations

import hashlib
import ipaddress
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skysift.llm.boosting import BoostedTrees, calibrated_cut
from skysift.llm.support import short_batches, text_rows

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "secret", "ssn")
#: Generated examples of each kind, the precision that a cut must reach on held-out ones, and the least cut.
EXAMPLES, PRECISION, LEAST_CUT = 900, 0.98, 0.5
#: Candidates whose features are held at once.
SCORED = 20_000
#: Texts sampled for context and words of each; the driver sees some times SPARE texts before it picks them.
CONTEXT_DOCS, CONTEXT_WORDS, SPARE = 200, 50, 8
SEED = 7

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

#: Loose forms. Each starts where a run starts or at a sign, so that long runs cost linear time.
_AT = re.compile(r"[ ]?[\[({<][ ]?(?:at|AT|At)[ ]?[\])}>][ ]?|[ ](?:at|AT)[ ]")
_SPELLED = re.compile(r"[\w-]+(?:(?:\.|[ ]?[\[({<][ ]?(?:dot|DOT|Dot)[ ]?[\])}>][ ]?|[ ](?:dot|DOT)[ ])[\w-]+)+")
_BEFORE_AT = re.compile(r"[\w.+%-]")
_COLONS = re.compile(r"(?<![\w:.])[0-9A-Fa-f]*:[0-9A-Fa-f:]*:[0-9A-Fa-f:]*(?![\w])")
_TOKEN = re.compile(r"(?<![\w+/=.~-])[\w+/=.~-]{16,}")
_GIVEN = re.compile(r"(?<![A-Za-z0-9])(?:token|key|secret|password|passwd|passphrase|pwd|auth|bearer|credential)[\"']?[ \t]{0,3}(?:[:=]|is\b|[ \t])[ \t]{0,3}[\"']?([^\s\"',;<>]{6,})", re.IGNORECASE)
_LOOSE = {
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:(?:[ ./-]{1,3}[0-9]{4}){2}[ ./-]{1,3}[0-9]{3,7}|[ ./-]{1,3}[0-9]{6}[ ./-]{1,3}[0-9]{5})(?![0-9])"),
    "phone": re.compile(r"(?<![\w.])(?:\(?[0-9]{2,4}\)?[ ./-]{1,2}){1,3}[0-9]{3,4}(?:[ .-]?[0-9]{2,4})?(?![\w])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w)"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}(?:-[0-9]{2}-|[ ][0-9]{2}[ ])[0-9]{4}(?![0-9-])"),
}
#: Words that stand before personal data or before harmless numbers.
_CUES = {
    "email": ("mail", "contact", "write", "reach"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "pay", "credit", "billing"),
    "phone": ("tel", "phone", "call", "fax", "mobile", "cell"),
    "iban": ("iban", "account", "bank", "transfer"),
    "secret": ("token", "key", "secret", "passw", "passphrase", "pwd", "auth", "bearer", "credential"),
    "ssn": ("ssn", "social", "security"),
}
_HARMLESS = ("version", "order", "page", "isbn", "build", "commit", "figure", "table", "year", "chapter", "sku", "price", "http", "www.", "file", "path")


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        v = int(d) * (1 + n % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, leftmost and non-overlapping for each kind."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        # no later start can match where this one fails, so starts before the sign are seen once
        done = found.end() if found else at + 1
        if found:
            out.append((0, start, done))
        at = text.find("@", done)
    if _DIGIT.search(text):
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


def _spelled_mail(text: str) -> list[tuple[int, int]]:
    """Addresses with the signs written out: from each such sign to the left as far as a name goes, and to the right."""
    out, done = [], 0
    for sign in _AT.finditer(text):
        start = sign.start()
        while start > done and _BEFORE_AT.match(text[start - 1]):
            start -= 1
        found = _SPELLED.match(text, sign.end()) if start < sign.start() else None
        if found:
            out.append((start, found.end()))
        done = sign.end()
    return out


def _ipv6(text: str) -> bool:
    try:
        return ipaddress.IPv6Address(text).packed != bytes(16)
    except ValueError:
        return False


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Spans of the loose forms; they may overlap."""
    low = "at" in text or "AT" in text or "At" in text
    out = [(0, a, b) for a, b in _spelled_mail(text)] if low else []
    if "::" in text or text.count(":") > 6:
        for m in _COLONS.finditer(text):
            body = m[0][:-1] if m[0].endswith(":") and not m[0].endswith("::") else m[0]
            if len(body) <= 39 and _ipv6(body):
                out.append((1, m.start(), m.start() + len(body)))
    if _DIGIT.search(text):
        out += [(KINDS.index(kind), m.start(), m.end()) for kind, form in _LOOSE.items() for m in form.finditer(text)]
    found = {(m.start(), m.start() + len(m[0].rstrip("."))) for m in _TOKEN.finditer(text)}
    found |= {(m.start(1), m.start(1) + len(m[1].rstrip(".)]}"))) for m in _GIVEN.finditer(text)}
    return out + [(5, a, b) for a, b in sorted(found) if b > a]


def well_formed(kind: int, body: str, digits: str) -> bool:
    """The kind's own check: sum digits, areas that are given out, addresses of use."""
    if kind == 2:
        return luhn(digits) if digits else False
    if kind == 4:
        tight = body.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in tight[4:] + tight[:4])) % 97 == 1
    if kind == 6:
        return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"
    if kind == 0:
        return body.rstrip("])}> ")[-2:].isalpha()
    return kind == 1


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    """Format and context of one candidate."""
    kind, start, end = span
    body = text[start:end]
    digits = re.sub("[^0-9]", "", body)
    letters = sum(c.isalpha() for c in body)
    before, after = text[max(0, start - 40) : start].lower(), text[end : end + 20].lower()
    groups = [len(g) for g in re.findall("[0-9]+", body)]
    words = [len(g) for g in re.findall("[A-Za-z]+", body)]
    vowels = sum(c in "aeiouAEIOU" for c in body)
    return [
        float(kind), float(len(body)), float(len(digits)), float(letters), float(sum(c.isupper() for c in body)),
        float(len(body) - len(digits) - letters), float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)),
        float(well_formed(kind, body, digits)), len(set(digits)) / max(1, len(digits)), len(set(body)) / len(body),
        float(body.startswith(("(", "0", "+"))), float("-" in body), float("." in body), float(" " in body), float("/" in body),
        float(all(c in "0123456789abcdefABCDEF:" for c in body)), sum(a.isdigit() != b.isdigit() for a, b in zip(body, body[1:])) / len(body),
        float(any(c in before for c in _CUES[KINDS[kind]])), float(any(c in before for c in _HARMLESS)),
        float(before.rstrip()[-1:] in (":", "=", '"')), float(after[:1] in (",", ".", "", "\n", '"')),
        len(words) / len(body), max(words, default=0) / len(body), vowels / max(1, letters), float(len(set(body))),
        sum(a.islower() and b.isupper() for a, b in zip(body, body[1:])) / len(body), float("_" in body), float(before[-3:] == "://" or body.startswith("//")),
    ]


@dataclass(frozen=True)
class PiiModel:
    trees: BoostedTrees
    cuts: tuple[float, ...]

    def extra(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Further spans: those over their kind's cut, best first, apart from base spans and from each other."""
        found = candidates(text)
        good = []
        for at in range(0, len(found), SCORED):
            some = found[at : at + SCORED]
            scores = self.trees.predict(np.array([features(text, s) for s in some]))
            good += [(-score, start, kind, end) for score, (kind, start, end) in zip(scores.tolist(), some, strict=True) if score >= self.cuts[kind]]
        if not good:
            return []
        # a byte for each character says whether a span has it, so a candidate costs its own length
        taken = bytearray(len(text))
        for _, start, end in base:
            taken[start:end] = b"\1" * (end - start)
        out = []
        for _, start, kind, end in sorted(good):
            if taken.find(1, start, end) < 0:
                out.append((kind, start, end))
                taken[start:end] = b"\1" * (end - start)
        return out


def _draw(r: random.Random, letters: str, n: int) -> str:
    return "".join(r.choice(letters) for _ in range(n))


_LOWER, _HEX, _MIXED = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "ABCDEFGHJKMNPQRSTUVWXYZabcdefghjkmnpqrstuvwxyz23456789"


def _digits(r: random.Random, n: int) -> str:
    return _draw(r, "0123456789", n)


def _spoken(r: random.Random, n: int) -> str:
    """A word of n syllables: harmless names read like speech."""
    return "".join(r.choice("bcdfglmnprstv") + r.choice("aeiou") + r.choice(["", "", "n", "r", "s"]) for _ in range(n))


def _card(r: random.Random, valid: bool) -> str:
    body = _digits(r, 15)
    end = next(d for d in "0123456789" if luhn(body + d) == valid)
    sep = r.choice(["  ", " / ", ".", " - "])
    return sep.join((body + end)[k : k + 4] for k in range(0, 16, 4))


def _iban(r: random.Random, valid: bool) -> str:
    land, account = r.choice(["DE", "FR", "ES", "GB", "NL", "IT"]), _digits(r, r.choice([16, 18, 20]))
    check = 98 - int("".join(str(int(c, 36)) for c in account + land + "00")) % 97
    whole = f"{land}{check if valid else (check + r.randrange(1, 90)) % 97:02d}{account}"
    return " ".join(whole[k : k + 4] for k in range(0, len(whole), 4)) if r.random() < 0.5 else whole


def _secret(r: random.Random) -> str:
    n = r.choice([16, 20, 24, 32, 40, 64, 128, 300])
    return r.choice([
        _draw(r, _HEX, n), _draw(r, _HEX, n), _draw(r, _MIXED, n), _draw(r, _MIXED + "+/", n) + r.choice(["", "=", "=="]),
        ".".join(_draw(r, _MIXED + "_-", k) for k in (36, n + 20, 43)), r.choice(["sk_live_", "ghp_", "AKIA", "xoxb-"]) + _draw(r, _MIXED, n),
        _draw(r, _MIXED[:44], n) + _digits(r, 8),
    ])


def _example(r: random.Random, kind: str, private: bool) -> tuple[str, str]:
    """(cue, body) of one made-up example of a loose form."""
    named = r.random() < 0.8
    cue = r.choice(_CUES[kind]) if private and named else "" if private else r.choice(["", *_HARMLESS])
    if kind == "email":
        a, b = r.choice([(" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "), (" [at] ", "."), ("{at}", ".")])
        bad = r.choice([f"{_spoken(r, 1)} at {_spoken(r, 2)} dot {_digits(r, 2)}", f"{_spoken(r, 2)}[at]{_spoken(r, 1)}.{_digits(r, 1)}", f"{_spoken(r, 2)} at {_spoken(r, 2)}.{_digits(r, 2)}"])
        return cue, f"{_spoken(r, 2)}{a}{_spoken(r, 2)}{b}{r.choice(['com', 'org', 'net', 'de', 'io'])}" if private else bad
    if kind == "ip":
        parts = [_draw(r, _HEX, 1 + r.randrange(4)) for _ in range(8)]
        short = ":".join(parts[: r.randrange(1, 4)]) + "::" + ":".join(parts[: r.randrange(1, 4)])
        return cue, r.choice([":".join(parts), "fe80::" + short.replace("::", ":"), short]) if private else r.choice([":".join(_digits(r, 2) for _ in range(8)), _digits(r, 1) + "::" + _digits(r, 1)])
    if kind == "card":
        return cue, _card(r, private)
    if kind == "phone":
        good = [f"({_digits(r, 3)}) {_digits(r, 3)}-{_digits(r, 4)}", f"0{_digits(r, 2)} {_digits(r, 3)} {_digits(r, 4)}", f"{_digits(r, 3)}-{_digits(r, 3)}-{_digits(r, 4)}"]
        bad = [f"{r.randrange(1900, 2100)}-{r.randrange(10, 13)}-{r.randrange(10, 29)}0", f"{_digits(r, 3)}.{_digits(r, 3)}", f"{_digits(r, 2)}/{_digits(r, 2)}/{_digits(r, 4)}", f"{_digits(r, 4)} {_digits(r, 4)}"]
        return cue, r.choice(good if private else bad)
    if kind == "iban":
        return cue, _iban(r, private)
    if kind == "secret":
        if private and r.random() < 0.35:  # a password of letters, told by the word before it
            return r.choice(["password", "passwd", "secret", "pwd", "passphrase"]) + r.choice([":", " =", " ="]), r.choice([_spoken(r, r.randrange(4, 9)), _draw(r, _LOWER, 21), _spoken(r, 3) + _digits(r, 3) + "!"])
        if private:
            return (cue + r.choice([" =", ":"]) if cue else ""), _secret(r)
        names = [_spoken(r, 2 + r.randrange(4)) for _ in range(5)]
        return cue, r.choice([
            _digits(r, 16 + r.randrange(9)), "-".join(names[:4]), "_".join(names[:4]) + _digits(r, 1), _spoken(r, 7 + r.randrange(6)), "/".join(names), "//" + ".".join(names[:3]) + "/" + names[3] + "/" + _digits(r, 4),
            _spoken(r, 8).upper(), "".join(w.capitalize() for w in names), r.choice("-=._~") * r.randrange(16, 80), "../" + "/".join(names[:3]) + ".html", ".".join(names), "_".join(names).upper(), names[0] + "..." + names[1] + "..." + names[2],
        ])
    area = r.choice(["000", "666", f"9{_digits(r, 2)}"]) if not private and r.random() < 0.5 else f"{r.randrange(1, 600):03d}"
    if not private and area[0] != "9" and area not in ("000", "666"):
        cue = r.choice(_HARMLESS)
    return cue, f"{area}-{r.randrange(1, 100):02d}-{r.randrange(1, 10000):04d}"


def examples(words: list[str], count: int = EXAMPLES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of made-up spans among the given words."""
    r, x, y = random.Random(seed), [], []
    words = words or ["the", "of"]
    for kind in KINDS:
        for n in range(count):
            private = n % 2 == 0
            cue, body = _example(r, kind, private)
            text = " ".join([*(r.choice(words) for _ in range(4)), *([cue] if cue else [])]) + r.choice([" ", ": " if not cue.endswith((":", "=")) else " ", ' "' if cue else " "]) + body
            text += r.choice([" ", ". ", ", ", "\n"]) + r.choice(words)
            for span in candidates(text):
                if KINDS[span[0]] == kind and body in text[span[1] : span[2]]:
                    x.append(features(text, span))
                    y.append(float(private))
    return np.array(x), np.array(y)


def train(words: list[str], count: int = EXAMPLES, seed: int = SEED) -> PiiModel:
    """Trees from three quarters of the examples, and the cut of each kind from the rest."""
    x, y = examples(words, count, seed)
    held = np.arange(len(y)) // 2 % 4 == 3  # pairs of a private and a harmless one
    trees = BoostedTrees(depth=4, rounds=60).fit(x[~held], y[~held])
    scores = trees.predict(x[held])
    return PiiModel(trees, tuple(max(LEAST_CUT, calibrated_cut(scores[of], y[held][of], PRECISION)) if (of := x[held, 0] == k).any() else 1.01 for k in range(len(KINDS))))


def fit(docs: DataFrame) -> PiiModel:
    """The model in words of these texts. Of the hashes below a bound that some SPARE times CONTEXT_DOCS texts reach,
    the least go to the driver, so that no number of tasks or copies makes that more; equal rows count once."""
    bound = F.lit(max(1, docs.count() // (SPARE * CONTEXT_DOCS)))
    body = F.coalesce("text", F.lit(""))
    few = docs.select(F.xxhash64("doc_id", "text").alias("o"), body.alias("text")).where(F.pmod("o", bound) == 0)
    words = F.split("text", r"\s+")
    place = F.pmod(F.col("o"), F.greatest(F.size("w") - CONTEXT_WORDS, F.lit(1))).cast("int") + 1
    sample = few.select("o", words.alias("w")).select("o", F.slice("w", place, CONTEXT_WORDS).alias("w")).groupBy("o").agg(F.first("w").alias("w"))
    return train([w for r in sample.orderBy("o").limit(CONTEXT_DOCS).collect() for w in r.w if w.isalpha()])


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame, model: PiiModel) -> DataFrame:
    """doc_id, counts of base spans, digest of their list, and all spans of each row; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch, texts in text_rows(batches):
            rows = []
            for text in texts:
                base = base_spans(text)
                rows.append((*(sum(s[0] == k for s in base) for k in range(4)), hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + model.extra(text, base))))
            types = (*[pa.int64()] * 4, pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))], names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    short_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """text with each run of overlapping spans replaced by the first one's kind in brackets."""
    out, done, until = [], 0, 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= until:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        until = max(until, end)
        done = until
    return "".join(out) + text[done:]


def redact(docs: DataFrame, model: PiiModel) -> DataFrame:
    """docs with personal data masked in text, and n_chars (where there is one) counted anew."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            new = []
            for text in texts:
                base = base_spans(text) if text else []
                spans = base + model.extra(text, base) if text else []
                new.append(masked(text, spans) if spans else text)
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            yield batch

    short_batches(docs.sparkSession)
    out = docs.mapInArrow(run, schema)
    if "n_chars" in schema.names and isinstance(schema["n_chars"].dataType, T.IntegralType):
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(schema["n_chars"].dataType))
    return out
