"""Language ID: a bidirectional gated recurrent network over bytes, trained here in numpy by backpropagation through time.

Both directions read a word's bytes (a space before them, A-Z lower-cased; digits and ASCII punctuation count as spaces;
words longer than STEPS bytes go on in further pieces) and label every byte position with a distribution over languages.
A document's probability pools the log-probabilities of all its positions. Words repeat, so each worker labels a
distinct piece once and remembers its sums, for a bounded number of pieces; every byte of every text counts.

The network learns from a bounded sample, with three documented parameters of fit(): about train_docs labelled
documents of each of the `languages` most frequent labels outside the held-out fold, chosen by a hash of identifier and
text, and sample_chars characters of each from a hashed place (None: whole texts). Everything that is predicted is read
whole.

Defined results: `und` with score 0 for null texts and texts without a letter, and for all if nothing is labelled.
Null labels are not learned from; a null identifier isn't held out. Very long texts are pooled over all their
positions, piece by piece. Of equally probable languages (ties) the first by name is told. Every row gives a row, repeated ones too; an empty
table gives an empty result; other columns pass through keep_identified() untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, pieces_of, stream

STEPS, HIDDEN = 16, 12
TRAIN_DOCS, SAMPLE_CHARS, LANGUAGES = 300, 3000, 500
#: Pieces that a worker remembers; positions that count as one independent witness; bytes that are split at once.
REMEMBERED, CORRELATED, AT_ONCE = 400_000, 8.0, 1 << 21
_FLAT = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def pieces(text: str) -> list[bytes]:
    """The words of a text, each with a space before it."""
    return text.encode().translate(_FLAT).split()


def segments(data: bytes) -> Iterator[bytes]:
    """The bytes in runs of about AT_ONCE that end at a space."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + AT_ONCE)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def _parts(word: bytes) -> list[bytes]:
    word = b" " + word
    return [word[i : i + STEPS] for i in range(0, len(word), STEPS)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    """Two directions: x (256 x 3 hidden: update, reset, new), u (hidden x 3 hidden); out (2 hidden x languages), bias."""

    languages: list[str]
    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, languages: list[str], rng: np.random.Generator) -> Network:
        h, k = HIDDEN, len(languages)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        return cls(languages, {"xf": draw(256, 3 * h), "uf": draw(h, 3 * h), "xb": draw(256, 3 * h), "ub": draw(h, 3 * h), "out": draw(2 * h, k), "bias": np.zeros(k, np.float32)})

    def _forward(self, codes: np.ndarray, mask: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """States after each step (steps x rows x hidden), and what backpropagation needs. codes: rows x steps."""
        h, x, u = HIDDEN, self.p["x" + d], self.p["u" + d]
        state, states, kept = np.zeros((len(codes), h), np.float32), [], []
        for t in range(codes.shape[1]):
            a, b = x[codes[:, t]], state @ u
            z, r = _sigmoid(a[:, :h] + b[:, :h]), _sigmoid(a[:, h : 2 * h] + b[:, h : 2 * h])
            n = np.tanh(a[:, 2 * h :] + r * b[:, 2 * h :])
            m = mask[:, t, None]
            new = m * ((1 - z) * n + z * state) + (1 - m) * state
            kept.append((state, z, r, n, b[:, 2 * h :], m))
            state = new
            states.append(state)
        return np.array(states), kept

    def _backward(self, codes: np.ndarray, kept: list, grads: np.ndarray, d: str) -> tuple[np.ndarray, np.ndarray]:
        h, u = HIDDEN, self.p["u" + d]
        gx, gu, later = np.zeros_like(self.p["x" + d]), np.zeros_like(u), np.zeros_like(grads[0])
        for t in reversed(range(len(kept))):
            before, z, r, n, bn, m = kept[t]
            g = grads[t] + later
            through = g * (1 - m)
            g = g * m
            gn = g * (1 - z) * (1 - n * n)
            gz = g * (before - n) * z * (1 - z)
            gr = gn * bn * r * (1 - r)
            ga, gb = np.hstack([gz, gr, gn]), np.hstack([gz, gr, gn * r])
            np.add.at(gx, codes[:, t], ga)
            gu += before.T @ gb
            later = through + g * z + gb @ u.T
        return gx, gu

    def step(self, codes: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over positions, and its gradients."""
        rows, steps = codes.shape
        mask = (np.arange(steps) < lengths[:, None]).astype(np.float32)
        back = np.where(mask > 0, np.take_along_axis(codes, np.maximum(lengths[:, None] - 1 - np.arange(steps), 0), 1), 0)
        sf, kf = self._forward(codes, mask, "f")
        sb, kb = self._forward(back, mask, "b")
        turn = np.maximum(lengths[:, None] - 1 - np.arange(steps), 0).T
        both = np.concatenate([sf, np.take_along_axis(sb, turn[:, :, None], 0)], axis=2)
        logits = both @ self.p["out"] + self.p["bias"]
        logits -= logits.max(axis=2, keepdims=True)
        logp = logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))
        w = mask.T / mask.sum()
        loss = -float((np.take_along_axis(logp, labels[None, :, None].repeat(steps, 0), 2)[:, :, 0] * w).sum())
        g = np.exp(logp)
        g[:, np.arange(rows), labels] -= 1
        g *= w[:, :, None]
        to_states = g @ self.p["out"].T
        gb = np.zeros_like(sb)
        np.put_along_axis(gb, turn[:, :, None].repeat(HIDDEN, 2), 0, 0)
        valid = mask.T > 0
        ts, rs = np.nonzero(valid)
        gb[turn[ts, rs], rs] = to_states[ts, rs, HIDDEN:]
        grads = {"out": np.einsum("trh,trk->hk", both, g), "bias": g.sum((0, 1))}
        grads["xf"], grads["uf"] = self._backward(codes, kf, to_states[:, :, :HIDDEN], "f")
        grads["xb"], grads["ub"] = self._backward(back, kb, gb, "b")
        return loss, grads

    def train(self, words: list[list[bytes]], rng: np.random.Generator, steps: int = 400, batch: int = 256, rate: float = 0.02) -> float:
        """words: of each language. Adam, with as many words of each language in a batch. The last mean loss."""
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second, recent = {k: np.zeros_like(v) for k, v in self.p.items()}, 0.0
        each = max(1, batch // len(words))
        for i in range(1, steps + 1):
            chosen = [(w[j], k) for k, w in enumerate(words) for j in rng.integers(0, len(w), each)]
            codes, lengths = encoded([w for w, _ in chosen])
            loss, grads = self.step(codes, lengths, np.array([k for _, k in chosen]))
            recent = 0.95 * recent + 0.05 * loss if i > 1 else loss
            now = rate * min(1.0, 2 * (1 - i / (steps + 1)))
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                self.p[k] -= (now * (first[k] / (1 - 0.9**i)) / (np.sqrt(second[k] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
        return recent

    def label(self, words: list[bytes]) -> np.ndarray:
        """Sums of log-probabilities over the positions of each word of up to STEPS bytes: words x languages."""
        codes, lengths = encoded(words)
        order = np.argsort(-lengths, kind="stable")
        codes, lengths = codes[order], lengths[order]
        longest = int(lengths[0])
        active = [int((lengths > t).sum()) for t in range(longest)]
        turned = np.take_along_axis(codes, np.maximum(lengths[:, None] - 1 - np.arange(codes.shape[1]), 0), 1)
        h, logits = HIDDEN, {}
        for d, c, out in (("f", codes, self.p["out"][:h]), ("b", turned, self.p["out"][h:])):
            state, x, u = np.zeros((len(codes), h), np.float32), self.p["x" + d], self.p["u" + d]
            for t in range(longest):
                n = active[t]
                state = state[:n]
                a, b = x[c[:n, t]], state @ u
                gates = a[:, : 2 * h] + b[:, : 2 * h]
                np.exp(np.negative(gates, out=gates), out=gates)
                gates += 1
                np.reciprocal(gates, out=gates)
                new = np.tanh(a[:, 2 * h :] + gates[:, h:] * b[:, 2 * h :])
                state = new + gates[:, :h] * (state - new)
                logits[d, t] = state @ out
        sums = np.empty((len(words), len(self.languages)), np.float32)
        end = len(words)
        for n in range(1, longest + 1):
            start = active[n] if n < longest else 0
            if start == end:
                continue
            at = np.array([logits["f", t][start:end] + logits["b", n - 1 - t][start:end] for t in range(n)]) + self.p["bias"]
            at -= at.max(axis=2, keepdims=True)
            sums[order[start:end]] = (at - np.log(np.exp(at).sum(axis=2, keepdims=True))).sum(axis=0)
            end = start
        return sums


def encoded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(w) for w in words])
    codes = np.frombuffer(b"".join(w.ljust(STEPS, b"\0") for w in words), np.uint8).reshape(-1, STEPS)
    return codes.astype(np.int64), lengths


class Labeller:
    """Documents' languages, with the sums of remembered words."""

    def __init__(self, network: Network):
        import regex

        self.network, self.known, self.letter = network, {}, regex.compile(r"\p{L}")
        self.sums = np.zeros((0, len(network.languages)), np.float32)

    def _learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED and self.known:
            self.known, self.sums, new = {}, self.sums[:0], list(words)
        if not new:
            return
        parts = [p for w in new for p in _parts(w)]
        sums = np.concatenate([self.network.label(parts[i : i + 4096]) for i in range(0, len(parts), 4096)])
        starts = np.cumsum([0, *((len(w) + STEPS) // STEPS for w in new[:-1])])
        begin = len(self.sums)
        self.sums = np.concatenate([self.sums, np.add.reduceat(sums, starts, axis=0)])
        self.known.update((w, begin + i) for i, w in enumerate(new))

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        totals, some = np.zeros((len(texts), len(self.network.languages))), np.zeros(len(texts), bool)
        group: list[tuple[int, list[bytes]]] = []
        size = 0

        def pool() -> None:
            self._learn(set().union(*(w for _, w in group)))
            for i, words in group:
                at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
                totals[i] += self.sums[at].sum(axis=0, dtype=np.float64)
                some[i] = some[i] or len(words) > 0

        for i, text in enumerate(texts if self.network.languages else []):
            for part in segments((text or "").encode()):
                group.append((i, part.translate(_FLAT).split()))
                size += len(part)
                if size > AT_ONCE:
                    pool()
                    group, size = [], 0
        if group:
            pool()
        for i, text in enumerate(texts):
            if not text or not some[i] or not self.letter.search(text):
                yield "und", 0.0
                continue
            p = np.exp((totals[i] - totals[i].max()) / CORRELATED)
            best = int(p.argmax())
            yield self.network.languages[best], float(p[best] / p.sum())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", seed: int = 7, train_docs: int = TRAIN_DOCS, sample_chars: int | None = SAMPLE_CHARS, languages: int = LANGUAGES) -> Network:
    """A network trained on at most about train_docs x languages texts, of sample_chars characters each (None: whole)."""
    known = docs.filter(named(text_col).isNotNull() & named(lang_col).isNotNull() & ~held_out(named(id_col)))
    counts = known.groupBy(named(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return Network([], {})
    part = F.lit(0.0)
    for r in counts:
        part = F.when(named(lang_col) == r["lang"], min(1.0, train_docs / r["count"])).otherwise(part)
    text = named(text_col)
    place = F.pmod(F.xxhash64(named(id_col), text, F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    if sample_chars is not None:
        start = F.floor(F.pmod(F.xxhash64(named(id_col), text), F.lit(1 << 20)) / float(1 << 20) * F.greatest(F.lit(0), F.length(text) - sample_chars)).cast("int") + 1
        text = F.substring(text, start, F.lit(sample_chars))
    sample = known.filter(place < part).select(named(id_col).alias("doc_id"), named(lang_col).alias("lang"), text.alias("text")).collect()
    by_lang: dict[str, list[bytes]] = {}
    for r in sorted(sample, key=lambda r: (str(r.doc_id), r.text)):
        by_lang.setdefault(r["lang"], []).extend(p for w in pieces(r.text) for p in _parts(w))
    by_lang = {k: v for k, v in sorted(by_lang.items()) if v}
    if not by_lang:
        return Network([], {})
    rng = np.random.default_rng(seed)
    network = Network.new(list(by_lang), rng)
    network.train(list(by_lang.values()), rng)
    return network


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", network: Network | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score: a row for each row of docs."""
    network = network or fit(docs, id_col, text_col, lang_col)

    def rows(parts: Iterator[dict]) -> Iterator[dict]:
        label = Labeller(network)
        for part in parts:
            found = list(label(part["text"]))
            yield {"doc_id": part["doc_id"], "held_out": part["held_out"], "lang_pred": [x for x, _ in found], "score": [s for _, s in found]}

    narrow = docs.select(named(id_col).alias("doc_id"), held_out(named(id_col)).alias("held_out"), named(text_col).alias("text"))
    return stream(narrow, ["doc_id", "held_out", "text"], f"doc_id {dict(narrow.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double", rows)


def keep_identified(docs: DataFrame, least: float = 0.4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs whose language is told with at least that probability, with all columns. Nothing is shuffled."""
    network, at = fit(docs, id_col, text_col, lang_col), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = Labeller(network)
        for batch in batches:
            for part in pieces_of(batch, 256):
                yield part.filter(pa.array([x != "und" and s >= least for x, s in label(part.column(at).to_pylist())], pa.bool_()))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names with dots can't pass
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
