"""Secret scans: fixed patterns, and a battery of randomness tests for tokens that no pattern knows.

A text becomes one byte for each code point (those beyond Latin-1 become "?", which no pattern contains), so offsets
are code points and searches run on bytes. A token is 20 or more of A-Z a-z 0-9 + / _ - in a row, as in NAME=value
or ?sig=value, with the "=" of padding where they end the run. From its characters follow its encoding (hex, base32,
base62 or base64) and that alphabet's size.

Three tests look at the token's symbols: chi-squared uniformity over the alphabet, runs (how often neighbours change
between capitals, small letters, digits and signs), and serial correlation of neighbours' values. Each gives a normal
deviate that is about 0 for random symbols and grows with the length for words. Their sum is judged by two
distributions, those of random and of ordinary tokens of the same encoding and length. Both are calibrated by
simulation, once on the driver: ordinary tokens are made of words with the letter frequencies of English, joined in
the usual ways, and of numbers (calibration() states how). The p-values against "ordinary" of all three tests
together pass a Benjamini-Hochberg step over the tokens of the document, each weighted by its length (long tokens are
believed sooner); a token that isn't plausible as random either is left alone. Tokens that overlap a span of a
pattern aren't added again.

Defined results: null counts as empty, without spans. Texts of any length are read whole, in time linear in their
length but for sorting; memory is a few bytes a code point of the longest text. Tokens of equal p-values pass or fail
together. Every row is scanned, repeated ones too; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame

from .common import stream

ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
WORDS = (b"passw", b"secret", b"token", b"api")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = b"0123456789abcdef"
KINDS = ("assign", "access", "hex", "random")
TOKEN = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN_CHARS = 20
PART = re.compile(rb"[^=]+(?:=+\Z)?")
#: Alphabets by the order of their values.
BASE32 = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE62 = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
BASE64 = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
URL64 = BASE64[:62] + b"-_"
#: letters' frequencies in English text, in percent, from a to z.
ENGLISH = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
#: Lengths at which the distributions are simulated, and tokens for each.
LENGTHS, SIMULATED = (20, 26, 34, 48, 80, 160, 400), 200
#: Capitals, small letters, digits, signs.
_CLASS = np.array([0 if 65 <= b <= 90 else 1 if 97 <= b <= 122 else 2 if 48 <= b <= 57 else 3 for b in range(256)], np.int8)


def _member(chars: bytes) -> bytes:
    return bytes(97 if b in chars else 32 for b in range(256))


_HEX, _TOKEN = _member(HEX), _member(TOKEN)


def runs(text: bytes, member: bytes, least: int) -> Iterator[tuple[int, int]]:
    """Maximal runs of at least so many member characters: a needle of that many is searched, which skips most of a text."""
    flat, needle, at = text.translate(member), b"a" * least, 0
    while (at := flat.find(needle, at)) >= 0:
        end = flat.find(b" ", at)
        end = len(flat) if end < 0 else end
        yield at, end
        at = end


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def encoding(token: bytes) -> bytes | None:
    """The alphabet that a token seems to be written in; None for one with "=" elsewhere than at its end."""
    body = token.rstrip(b"=")
    chars = set(body)
    if b"=" in body:
        return None
    if chars <= set(HEX) or chars <= set(HEX.upper()):
        return HEX if chars <= set(HEX) else HEX.upper()
    if chars <= set(BASE32):
        return BASE32
    if chars <= set(BASE62):
        return BASE62
    return URL64 if chars & set(b"-_") else BASE64


def deviate(token: bytes, alphabet: bytes) -> float:
    """The sum of the three tests' deviates."""
    codes = np.frombuffer(token.rstrip(b"="), np.uint8)
    order, classes, k = _order(alphabet)
    x = order[codes]
    codes, x = codes[x >= 0], x[x >= 0]
    n = len(x)
    chi = float(((np.bincount(x, minlength=k) - n / k) ** 2).sum() * k / n)
    spread = 2 / (9 * (k - 1))
    uniform = ((chi / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread)
    kinds = _CLASS[codes]
    change = 1 - float((classes**2).sum())
    runs_ = (change * (n - 1) - float((kinds[1:] != kinds[:-1]).sum())) / math.sqrt(change * (1 - change) * (n - 1))
    y = x - x.mean()
    var = float((y * y).sum())
    serial = (float((y[1:] * y[:-1]).sum()) / var + 1 / n) * math.sqrt(n) if var else math.sqrt(n)
    return uniform + runs_ + serial


@lru_cache(maxsize=8)
def _order(alphabet: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Values of the characters (-1 elsewhere), shares of the classes, size."""
    order = np.full(256, -1)
    own = np.frombuffer(alphabet, np.uint8)
    order[own] = np.arange(len(alphabet))
    return order, np.bincount(_CLASS[own], minlength=4) / len(alphabet), len(alphabet)


def ordinary(alphabet: bytes, n: int, rng: random.Random) -> bytes:
    """A token as people write them: words in one of the usual styles, with numbers between them; in hexadecimal, numbers and words of a to f."""
    letters, weights = "abcdefghijklmnopqrstuvwxyz", ENGLISH
    if len(alphabet) == 16:
        letters, weights = letters[:6], weights[:6]
    style = rng.choice(("camel", "lower", "upper", "mixed")) if len(alphabet) >= 62 else "upper" if alphabet[0] == 65 or alphabet[-1] == 70 else "lower"
    joint = rng.choice("-_") if alphabet == URL64 else rng.choice("+//") if alphabet == BASE64 else ""
    digits = "".join(chr(b) for b in alphabet if 48 <= b <= 57)
    out = ""
    while len(out) < n:
        if rng.random() < (0.6 if len(alphabet) == 16 else 0.15):
            part = "".join(rng.choice(digits) for _ in range(rng.randint(1, 10 if len(alphabet) == 16 else 4)))
        else:
            part = "".join(rng.choices(letters, weights, k=rng.randint(2, 10)))
            part = part.upper() if style == "upper" or style == "mixed" and rng.random() < 0.3 else part.capitalize() if style == "camel" else part
        out += (joint if out else "") + part
    return out[:n].encode()


Fit = dict[bytes, tuple[tuple[float, ...], ...]]


@lru_cache(maxsize=2)
def calibration(seed: int = 5) -> Fit:
    """For each alphabet the means and deviations of random and of ordinary tokens' deviates at LENGTHS."""
    out, rng = {}, random.Random(seed)
    for alphabet in (HEX, BASE32, BASE62, BASE64, URL64):
        rows = []
        for n in LENGTHS:
            chance = np.array([deviate(bytes(rng.choices(alphabet, k=n)), alphabet) for _ in range(SIMULATED)])
            usual = np.array([deviate(ordinary(alphabet, n, rng), alphabet) for _ in range(SIMULATED)])
            rows.append((chance.mean(), chance.std(), usual.mean(), usual.std()))
        out[alphabet] = tuple(tuple(map(float, column)) for column in zip(*rows, strict=True))
    return out | {HEX.upper(): out[HEX]}


def battery(token: bytes, fit: Fit) -> tuple[float, float] | None:
    """(p of randomness, p of an ordinary token) by the three tests together, or None if no encoding fits."""
    alphabet = encoding(token)
    if alphabet is None:
        return None
    n = len(token.rstrip(b"="))
    if n < TOKEN_CHARS:
        return None
    found, at = deviate(token, alphabet), math.log(n)
    means, spreads, usual, wide = (float(np.interp(at, _LOGS, column)) for column in fit[alphabet])
    if n > LENGTHS[-1]:  # the mean of ordinary tokens grows as the square root of the length
        usual *= math.sqrt(n / LENGTHS[-1])
    return normal_tail((found - means) / spreads), normal_tail((usual - found) / wide)


_LOGS = [math.log(n) for n in LENGTHS]


def tokens(text: bytes) -> Iterator[tuple[int, int]]:
    """Long enough parts of the runs, which are cut at "="; those that end a run stay, as padding."""
    for start, end in runs(text, _TOKEN, TOKEN_CHARS):
        for m in PART.finditer(text, start, end):
            if m.end() - m.start() >= TOKEN_CHARS:
                yield m.start(), m.end()


def overlapping(taken: list[tuple[int, int, str]]) -> Callable[[int, int], bool]:
    """Whether a stretch overlaps one of the spans: the farthest end of all spans that begin before its end tells."""
    spans = sorted(taken)
    starts, ends = [s for s, *_ in spans], list(accumulate((e for _, e, _ in spans), max))

    def asked(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return before > 0 and ends[before - 1] > start

    return asked


def random_tokens(text: bytes, taken: list[tuple[int, int, str]], q: float, least_random: float, fit: Fit) -> list[tuple[int, int, str]]:
    found = []
    for start, end in tokens(text):
        if (p := battery(text[start:end], fit)) is not None:
            found.append((start, end, *p))
    if not found:
        return []
    weights = np.array([min(2.0, (e - s) / 32) for s, e, *_ in found])
    ps = np.array([p for *_, p in found]) / (weights / weights.mean())
    order = np.sort(ps)
    passing = np.nonzero(order <= q * np.arange(1, len(ps) + 1) / len(ps))[0]
    if not len(passing):
        return []
    limit, within = order[passing[-1]], overlapping(taken)
    return [(s, e, "random") for (s, e, chance, _), p in zip(found, ps.tolist(), strict=True) if p <= limit and chance >= least_random and not within(s, e)]


def scan(text: str | None, q: float = 0.02, least_random: float = 0.005, fit: Fit | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, by start and kind."""
    code = (text or "").encode("latin-1", "replace")
    lower, spans = code.lower(), []
    if any(w in lower for w in WORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(code) if len(m[1]) >= 6]
    if b"AKIA" in code:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(code) if len(m[0]) >= 20]
    spans += [(s, e, "hex") for s, e in runs(code, _HEX, 24)]
    spans += random_tokens(code, spans, q, least_random, fit or calibration())
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans: a row for each row of docs."""

    fit = calibration()

    def rows(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            spans = [scan(t, fit=fit) for t in part[text_col]]
            out: dict = {"doc_id": part[id_col], "spans": [joined(s) for s in spans]}
            out["base_sha256"] = [hashlib.sha256(joined([x for x in s if x[2] != "random"]).encode()).hexdigest() for s in spans]
            yield out | {f"n_{k}": [sum(x[2] == k for x in s) for s in spans] for k in KINDS}

    kind = dict(docs.dtypes)[id_col]
    return stream(docs, [id_col, text_col], f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string", rows)
