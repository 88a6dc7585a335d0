"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token's bytes are a linked list. Every neighbouring pair that the vocabulary can merge stands in the bucket of
its merge rank, a heap of list positions; a bitmap of three levels of 64-bit words says which buckets hold any, and
find-first-set down the levels gives the lowest rank. A popped position is stale, and skipped, if its pair has another
rank by now. So a merge costs the same in a pre-token of a hundred thousand bytes as in one of ten. The new short
pre-tokens of a few megabytes of text share one list and one queue, so that a bucket merges in many of them at a
time; they are remembered in a table of bounded size. Pre-tokens that are tokens themselves take their rank at once.

Defined results: null counts as empty, which has no tokens. Special tokens' strings are ordinary text. Texts of any
length are encoded whole; long ones are matched piecewise from an iterator. Every row gives a row; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame

from .common import stream

#: Remembered pre-tokens, and the longest of them, in characters; characters of a text that is matched at once.
REMEMBERED, SHORT, AT_ONCE = 400_000, 48, 1 << 22


class RankQueue:
    """Buckets of list positions by rank, and a bitmap of three levels that says which buckets hold any."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        words = -(-ranks // 64)
        self.low, self.middle, self.top = [0] * words, [0] * (-(-words // 64)), 0

    def open(self, rank: int, bucket: list[int]) -> None:
        """A bucket for a rank that has none."""
        self.buckets[rank] = bucket
        word = rank >> 6
        self.low[word] |= 1 << (rank & 63)
        self.middle[word >> 6] |= 1 << (word & 63)
        self.top |= 1 << (word >> 6)

    def lowest(self) -> int:
        """Find-first-set from the top level down; -1 if all is empty."""
        if not self.top:
            return -1
        high = (self.top & -self.top).bit_length() - 1
        bits = self.middle[high]
        word = high << 6 | (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return word << 6 | (bits & -bits).bit_length() - 1

    def close(self, rank: int) -> list[int]:
        """The bucket of the lowest rank, taken out."""
        word = rank >> 6
        self.low[word] &= self.low[word] - 1
        if not self.low[word]:
            high = word >> 6
            self.middle[high] &= self.middle[high] - 1
            if not self.middle[high]:
                self.top &= self.top - 1
        return self.buckets.pop(rank)


def merged(piece: bytes, ranks: dict[bytes, int], size: int) -> list[int]:
    """The tokens of one pre-token, of any length: a bucket is a heap, so equal ranks merge from the left."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a node ends where the next one begins
    queue = RankQueue(size)
    now: list[int | None] = [None] * n  # the rank of the pair that begins at a position

    def look(at: int) -> None:
        right = after[at]
        now[at] = rank = ranks.get(piece[at : after[right]]) if right < n else None
        if rank is not None:
            if bucket := queue.buckets.get(rank):
                heapq.heappush(bucket, at)
            else:
                queue.open(rank, [at])

    for i in range(n - 1):
        look(i)
    while (rank := queue.lowest()) >= 0:
        bucket = queue.buckets[rank]
        at = heapq.heappop(bucket)
        if not bucket:
            queue.close(rank)
        if now[at] != rank:
            continue
        gone = after[at]
        after[at], now[gone] = after[gone], None
        if after[at] < n:
            before[after[at]] = at
        look(at)
        if before[at] >= 0:
            look(before[at])
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : after[at]]])
        at = after[at]
    return out


class Merger:
    """The same for many short pre-tokens at once: one list and one queue for all, and a bucket merges in all of them together, the leftmost position of each."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.size = ranks, max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.array(sorted(pairs), np.int64)
        self.keys, self.made = np.append(keys, np.iinfo(np.int64).max), np.array([*(pairs[k] for k in keys.tolist()), -1], np.int64)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        both = self.single[:, None] << 32 | self.single[None, :]
        self.double = self.rank_of(both.ravel())

    def rank_of(self, pair: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, pair)
        return np.where(self.keys[at] == pair, self.made[at], -1)

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b"".join(pieces), np.uint8)
        lengths = np.array([len(p) for p in pieces])
        n, ends = len(data), np.cumsum(lengths)
        owner = np.repeat(np.arange(len(pieces)), lengths)
        ids = np.append(self.single[data], -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1], before[ends - lengths] = n, n
        now = np.full(n + 1, -1)
        now[: n - 1] = self.double[data[:-1].astype(np.int64) << 8 | data[1:]]
        now[ends - 1] = -1
        queue, order = RankQueue(self.size), np.argsort(now[:n], kind="stable")
        order = order[now[order] >= 0]
        for part in np.split(order, np.nonzero(np.diff(now[order]))[0] + 1) if len(order) else []:
            queue.open(int(now[part[0]]), part.tolist())
        buckets = queue.buckets
        while (rank := queue.lowest()) >= 0:
            at = np.array(queue.close(rank))
            at = np.sort(at[now[at] == rank])
            if not len(at):
                continue
            if len(at) > 1:
                piece = owner[at]
                again = np.append(False, piece[1:] == piece[:-1])
                if again.any():
                    queue.open(rank, at[again].tolist())
                    at = at[~again]
            gone = after[at]
            new, left = after[gone], before[at]
            ids[at], now[gone], after[at], before[new] = rank, -1, new, at
            both = self.rank_of(np.concatenate([ids[at] << 32 | ids[new], ids[left] << 32 | ids[at]]))
            both[: len(at)][new == n] = -1
            both[len(at) :][left == n] = -1
            places = np.concatenate([at, left])
            now[places] = both
            now[n] = -1
            good = both >= 0
            for r, p in zip(both[good].tolist(), places[good].tolist(), strict=True):
                if (bucket := buckets.get(r)) is not None:
                    bucket.append(p)
                else:
                    queue.open(r, [p])
        # The nodes that are left, in order.
        alive = np.zeros(n + 1, bool)
        alive[ends - lengths] = True
        alive[after[self._heads(after, ends - lengths, n)]] = True
        alive[n] = False
        out = ids[:n][alive[:n]].astype("<u4")
        counts = np.bincount(owner[alive[:n]], minlength=len(pieces))
        stops = (np.cumsum(counts) * 4).tolist()
        blob, begin, result = out.tobytes(), 0, []
        for stop in stops:
            result.append(blob[begin:stop])
            begin = stop
        return result

    @staticmethod
    def _heads(after: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        """All nodes reached from the starts."""
        found, at = [], starts
        while len(at):
            found.append(at)
            at = after[at]
            at = at[at < n]
        return np.concatenate(found)


class Tokens(dict):
    """Pre-token to its ids as bytes, of a bounded number of short pre-tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.merger = ranks, Merger(ranks)

    def learn(self, pieces: set[str]) -> None:
        """Has all short ones of the pieces ready."""
        new = {p for p in pieces - self.keys() if len(p) <= SHORT}
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = {p for p in pieces if len(p) <= SHORT}
        todo = []
        for p in new:
            if (whole := self.ranks.get(code := p.encode())) is not None:
                self[p] = whole.to_bytes(4, "little")
            else:
                todo.append((p, code))
        if todo:
            self.update(zip((p for p, _ in todo), self.merger([code for _, code in todo]), strict=True))

    def __missing__(self, piece: str) -> bytes:
        return np.array(merged(piece.encode(), self.ranks, self.merger.size), "<u4").tobytes()


def narrowed(pattern: str) -> re.Pattern | None:
    """The same pattern for texts of Latin-1 alone, its classes spelled out for the faster built-in matcher; None if that can't be told."""
    import regex

    kinds = {c: "".join(re.escape(chr(i)) for i in range(256) if regex.match(c, chr(i))) for c in (r"\p{L}", r"\p{N}", r"\s")}
    flat = pattern.replace(r"[^\s\p{L}\p{N}]", "[^" + "".join(kinds.values()) + "]")
    for c, members in kinds.items():
        flat = flat.replace(c, f"[{members}]")
    flat = flat.replace(r"\S", f"[^{kinds[chr(92) + 's']}]")
    return None if r"\p" in flat else re.compile(flat)


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.pattern, self.tokens = regex.compile(pattern), Tokens(self.ranks)
        self.narrow = narrowed(pattern)

    def _pieces(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.pattern.findall(text)
        return (self.narrow or self.pattern).findall(text)

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. Texts are taken together up to AT_ONCE characters."""
        group, chars = [], 0
        for text in [*texts, None]:
            if group and (text is None or chars + len(text) > AT_ONCE):
                yield from self._together(group)
                group, chars = [], 0
            if text is not None and len(text) > AT_ONCE:
                yield self._long(text)
            elif text is not None:
                group.append(text)
                chars += len(text)

    def _together(self, texts: list[str]) -> Iterator[bytes]:
        found, get = [self._pieces(t) for t in texts], self.tokens.__getitem__
        self.tokens.learn(set().union(*found))
        return (b"".join(map(get, f)) for f in found)

    def _long(self, text: str) -> bytes:
        found, get, out = (m.group() for m in self.pattern.finditer(text)), self.tokens.__getitem__, bytearray()
        while part := list(islice(found, 65536)):
            self.tokens.learn(set(part))
            out += b"".join(map(get, part))
        return bytes(out)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def decode(self, ids: bytes) -> bytes:
        get, codes = self.bytes_of.__getitem__, np.frombuffer(ids, "<u4")
        return b"".join(b"".join(map(get, codes[at : at + 65536].tolist())) for at in range(0, len(codes), 65536))


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    """Path and pattern of an installed public vocabulary, to be found at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def byte_bpe(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids: a row for each row of docs."""

    def rows(parts: Iterator[dict]) -> Iterator[dict]:
        bpe = tokenizer(path, pattern)
        for part in parts:
            out: dict = {n: [] for n in ("n_tokens", "ids_sha256", "decoded_sha256", "ids")}
            for ids in bpe.encode_all([text or "" for text in part[text_col]]):
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                out["ids"].append(np.frombuffer(ids, "<u4").astype(np.int32) if with_ids else None)
            yield out | {"doc_id": part[id_col]}

    kind = dict(docs.dtypes)[id_col]
    return stream(docs, [id_col, text_col], f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids, rows, slice_rows=1024)
