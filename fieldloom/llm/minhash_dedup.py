"""MinHash near-dedup with bottom-k sketches from one hash function.

1. Each text's set of word-shingle hashes is sorted; its K smallest are its sketch. Texts of equal sets are one class
   and go on as their smallest identifier alone.
2. Inverted lists of the retained values generate the overlaps. Two sketches of a pair at the threshold share at
   least so many values (below) that, of each sketch's values from rarest to most frequent, only the first few need to
   be looked up; values that no other sketch has are looked up without cost. So a passage that a third of all texts
   share makes no list, unless it is most of a text.
3. Within a list the union-sketch estimate (agreeing values among the union's values up to the smaller of both
   sketches' ends) filters pairs, five standard deviations below the threshold (exactly at it when the sketches are
   whole sets). Of the pairs that pass, a spanning forest leaves the list, not all of them. Lists above a block's size
   are left as one star, unfiltered. Components of all these edges are clusters: every pair that passes lies in one.
4. Full sets of the clusters' texts (recomputed from the texts) verify exactly, and links of spanning forests come
   out. A cluster is dealt by blocks of bounded size. Nearly all clusters are a block; of the others (large groups of
   near copies, or chains of texts that pass the filter without being linked) texts are first linked within their
   block, then a few representatives of each linked part across blocks.
5. What is left are pairs of such clusters that pass the filter and lie in different linked parts. Only lists with
   members of several parts are looked at again. The largest part's members are dealt by blocks and the others meet
   each of these blocks, so a list costs its members and what the few others need, and not the square of its blocks.
   Members with a passing partner in another part are verified by their full sets.
So every pair that passes the filter is verified or lies in one linked part, and no step holds more than two blocks.
The components of all links are the result.

A pair at the threshold is missed only if its estimate errs by five standard deviations or its sketches share
fewer than LEAST of about 51 expected values: by the binomial tail of 64 values at 0.8, about 4 in a million (4.2e-6
for 35 or fewer, 1.2e-6 for fewer than LEAST). That is a model of infinite sets.

Defined results: null, empty and wordless texts have no shingles, no links, and stay. Texts below `width` words are one
shingle. Texts of any length are hashed whole, piece by piece; of pairs exactly at the threshold (ties) all are
linked. Where rows share an identifier or have none, each row is judged by its own text under a row number in a
written copy: near_dedup() then tells each component's smallest identifier, null if it has none, and every row with
that identifier as kept; keep_representatives() leaves one row of each component, so one of rows repeated whole. An
empty table gives an empty result. Other columns pass through keep_representatives() untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, free, fresh, keyed_rows, leaf_mask, leaf_of, named, stream, with_leaves
from .components import components

K, LEAST = 64, 35
#: Members of a list in a block; shingles of a cluster in a block; bytes of texts hashed at once.
LIST_BLOCK, CLUSTER_BLOCK, AT_ONCE = 4096, 1 << 21, 1 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_END = np.uint64(2**64 - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, 1 << 16), _powers(pow(_BASE, -1, 2**64), 1 << 16)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of lower-cased bytes, and where each begins."""
    global _UP, _DOWN
    codes = np.frombuffer(data, np.uint8)
    if len(codes) >= len(_UP):
        _UP, _DOWN = _powers(_BASE, 2 * len(codes)), _powers(pow(_BASE, -1, 2**64), 2 * len(codes))
    blank = _SPACE[codes]
    inside = np.concatenate([[False], ~blank, [False]])
    edges = np.nonzero(inside[1:] != inside[:-1])[0]
    start, end = edges[::2], edges[1::2]
    sums = np.concatenate([[np.uint64(0)], np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _UP[: len(codes)], dtype=np.uint64)])
    return _mixed((sums[end] - sums[start]) * _DOWN[start] + (end - start).astype(np.uint64)), start


def _set_of(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; the largest value is left free as an end mark."""
    if not len(words):
        return words
    n = min(width, len(words))
    out = words[: len(words) - n + 1]
    for i in range(1, n):
        out = _mixed(out * np.uint64(_BASE) + words[i : len(words) - n + 1 + i])
    out = np.sort(_mixed(out + np.uint64(n)))
    return np.minimum(out[np.append(True, out[1:] != out[:-1])], _END - np.uint64(1))


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """Of each text. Short texts are hashed together, long ones in pieces that end at white space."""
    group: list[bytes] = []
    size = 0

    def together() -> Iterator[np.ndarray]:
        hashes, start = word_hashes(b" ".join(group))
        ends = np.cumsum([len(g) + 1 for g in group])
        at = np.searchsorted(start, ends)
        for a, b in zip([0, *at[:-1].tolist()], at.tolist(), strict=True):
            yield _set_of(hashes[a:b], width)

    for text in texts:
        data = (text or "").encode().translate(_LOWER)
        if len(data) > AT_ONCE or size + len(data) > AT_ONCE:
            if group:
                yield from together()
            group, size = [], 0
        if len(data) <= AT_ONCE:
            group.append(data)
            size += len(data) + 1
            continue
        parts, at = [], 0
        while at < len(data):
            end = min(len(data), at + AT_ONCE)
            while end < len(data) and not _SPACE[data[end]]:
                end += 1
            parts.append(word_hashes(data[at:end])[0])
            at = end
        yield _set_of(np.concatenate(parts), width)
    if group:
        yield from together()


def _signatures(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """doc_id, n, d1, d2 (digest of the set), sketch."""

    def rows(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            out: dict = {"doc_id": part["doc_id"], "n": [], "d1": [], "d2": [], "sketch": []}
            for s in shingle_sets(part["text"], width):
                digest = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
                for k, v in (("n", len(s)), ("d1", int(digest[0])), ("d2", int(digest[1])), ("sketch", s[:K].view(np.int64))):
                    out[k].append(v)
            yield out

    narrow = docs.select(named(id_col).alias("doc_id"), named(text_col).alias("text"))
    return stream(narrow, ["doc_id", "text"], f"doc_id {dict(narrow.dtypes)['doc_id']}, n long, d1 long, d2 long, sketch array<bigint>", rows)


def grouped(df: DataFrame, keys: list[str], columns: list[str], schema: str, judge: Callable[[dict, list[int]], tuple[list, list]]) -> DataFrame:
    """Rows of equal keys, together and in order, to judge (columns' values, starts of the groups); (a, b) pairs come back."""
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(rows: pa.Table) -> pa.RecordBatch:
            code = np.stack([rows.column(k).to_numpy() for k in keys])
            starts = np.concatenate([[0], np.nonzero((code[:, 1:] != code[:, :-1]).any(axis=0))[0] + 1])
            a, b = judge({c: rows.column(c).combine_chunks() for c in columns}, [*starts.tolist(), rows.num_rows])
            return pa.RecordBatch.from_arrays([pa.array(a, arrow.field(0).type), pa.array(b, arrow.field(1).type)], schema=arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                code = np.stack([part.column(keys.index(k)).to_numpy() for k in keys])
                last = code[:, -1:]
                turn = np.nonzero((code != last).any(axis=0))[0]
                same = bool(held) and all(held[-1].column(i)[-1].as_py() == part.column(i)[-1].as_py() for i in range(len(keys)))
                if same and not len(turn):
                    held.append(part)
                    continue
                cut_at = int(turn[-1]) + 1 if len(turn) else 0
                whole = [*held, *([part.slice(0, cut_at)] if cut_at else [])]
                if whole:
                    yield out(pa.Table.from_batches(whole))
                held = [part.slice(cut_at)]
        if held:
            yield out(pa.Table.from_batches(held))

    placed = df.select(*keys, *columns).repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(run, kind)


def _matrix(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Sketches as rows, ended by _END, and their lengths."""
    offsets = lists.offsets.to_numpy()
    lengths = np.diff(offsets)
    out = np.full((len(lengths), K), _END)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], lengths)] = lists.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint64)
    return out, lengths


def _passes(sketches: np.ndarray, size: np.ndarray, pivot: int, others: np.ndarray, share: float) -> np.ndarray:
    """Whether the union-sketch estimate of the pivot with each of the others reaches the share, less five deviations."""
    a, s = sketches[pivot], sketches[others]
    own = a[: min(K, int(size[pivot]))]
    limit = lambda n, last: np.where(n > K, last, _END - np.uint64(1))
    top = np.minimum(limit(size[pivot], a[-1]), limit(size[others], s[:, -1]))
    at = np.searchsorted(own, s)
    shared = ((own[np.minimum(at, len(own) - 1)] == s) & (s <= top[:, None])).sum(axis=1)
    union = np.searchsorted(own, top, "right") + (s <= top[:, None]).sum(axis=1) - shared
    whole = (size[others] <= K) & (size[pivot] <= K)
    slack = np.where(whole, 1e-9, 5 * np.sqrt(share * (1 - share) / np.maximum(union, 1)))
    return shared >= (share - slack) * union


def _forest(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the graph in which linked(pivot, others) tells the pivot's neighbours among others."""
    left = np.arange(n)
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            pivot = queue.pop()
            found = linked(pivot, left)
            for x in left[found].tolist():
                yield pivot, x
                queue.append(x)
            left = left[~found]


def _clusters(classes: DataFrame, share: float) -> tuple[DataFrame, DataFrame]:
    """The inverted lists (rep, value, df), and (a, b): forests of the pairs whose estimate passes, stars of large lists. classes: rep, n, sketch."""
    posts = classes.select("rep", "n", F.explode("sketch").alias("value"))
    lists = posts.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    kept = F.least(F.lit(K), F.col("n"))
    # Up to this size each partner's sketch is its whole set, as the larger set has n / share values at most.
    agree = F.when(F.col("n") <= int(K * share + 1e-9), F.ceil(F.col("n") * F.lit(share) - 1e-9)).otherwise(F.lit(LEAST if share >= 0.8 else max(1, int(K * share - 5 * (K * share * (1 - share)) ** 0.5))))
    of = Window.partitionBy("rep")
    rarest = posts.join(lists, "value").withColumn("place", F.row_number().over(of.orderBy("df", "value")) + kept - F.count(F.lit(1)).over(of))
    members = cut(rarest.filter(F.col("place") <= kept - agree + 1).select("rep", "value", "df"))
    large = members.filter(F.col("df") > LIST_BLOCK)
    stars = large.join(large.groupBy("value").agg(F.min("rep").alias("least")), "value").select(F.col("rep").alias("a"), F.col("least").alias("b")).filter("a != b")

    def judge(got: dict, starts: list[int]) -> tuple[list, list]:
        sketches, _ = _matrix(got["sketch"])
        ids, size, a, b = got["rep"].to_pylist(), got["n"].to_numpy(), [], []
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            if e - s > 1:
                for x, y in _forest(e - s, lambda p, o, s=s, e=e: _passes(sketches[s:e], size[s:e], p, o, share)):
                    a.append(ids[s + x])
                    b.append(ids[s + y])
        return a, b

    kind = dict(classes.dtypes)["rep"]
    small = members.filter(F.col("df") <= LIST_BLOCK).select("rep", "value").join(classes, "rep")
    return members, grouped(small, ["value"], ["rep", "n", "sketch"], f"a {kind}, b {kind}", judge).unionByName(stars).distinct()


def exact_forest(ids: list, sets: list[np.ndarray], percent: int) -> tuple[list, list]:
    """Links of a spanning forest of all pairs with 100 x intersection >= percent x union."""
    size = np.array([len(s) for s in sets])
    a, b = [], []
    if len(sets) > 1:
        values, code = np.unique(np.concatenate(sets), return_inverse=True)
        codes = np.split(code, np.cumsum(size)[:-1])
        index: list = []  # of the texts that were left when it was built: owners by shingle, starts, how many

        def linked(pivot: int, others: np.ndarray) -> np.ndarray:
            if not index or 2 * len(others) < index[2]:
                part = np.concatenate([codes[i] for i in others])
                order = np.argsort(part, kind="stable")
                index[:] = np.repeat(others, size[others])[order], np.searchsorted(part[order], np.arange(len(values) + 1)), len(others)
            owner, starts, _ = index
            first, count = starts[codes[pivot]], starts[codes[pivot] + 1] - starts[codes[pivot]]
            flat = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
            shared = np.bincount(owner[flat], minlength=len(sets))[others]
            return 100 * shared >= percent * (size[pivot] + size[others] - shared)

        for x, y in _forest(len(sets), linked):
            a.append(ids[x])
            b.append(ids[y])
    return a, b


def exact_links(ids: list, sets: list[np.ndarray], parts: list, percent: int) -> tuple[list, list]:
    """Links between texts of different parts, enough of them to connect all parts that have any."""
    a, b = [], []
    size, (_, part) = np.array([len(s) for s in sets]), np.unique(np.array(parts), return_inverse=True)
    root = list(range(int(part.max()) + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner, order = np.repeat(np.arange(len(sets)), size), np.argsort(code, kind="stable")
    owner, starts, codes = owner[order], np.searchsorted(code[order], np.arange(len(values) + 1)), np.split(code, np.cumsum(size)[:-1])
    main = np.bincount(part).argmax()
    for i in np.nonzero(part != main)[0].tolist():  # a pair of different parts has a member outside the largest
        first, count = starts[codes[i]], starts[codes[i] + 1] - starts[codes[i]]
        flat = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        shared = np.bincount(owner[flat], minlength=len(sets))
        for j in np.nonzero((100 * shared >= percent * (size[i] + size - shared)) & (part != part[i]))[0].tolist():
            x, y = find(int(part[i])), find(int(part[j]))
            if x != y:
                root[x] = y
                a.append(ids[i])
                b.append(ids[j])
    return a, b


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """The rows of wanted (id and longs or identifiers) with n and the full sets of their texts, as a table."""
    narrow = docs.select(named(id_col).alias("id"), named(text_col).alias("text")).join(wanted.hint("merge"), "id")
    own = [c for c in wanted.columns if c != "id"]

    def rows(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            sets = list(shingle_sets(part["text"], width))
            yield {c: part[c] for c in ["id", *own]} | {"n": [len(s) for s in sets], "shingles": [s.view(np.int64) for s in sets]}

    kinds = dict(narrow.dtypes)
    return cut(stream(narrow, ["id", *own, "text"], ", ".join(f"{c} {kinds[c]}" for c in ["id", *own]) + ", n long, shingles array<bigint>", rows))


def _linked(dealt: DataFrame, keys: list[str], percent: int, part: str | None = None) -> DataFrame:
    """(a, b): exact links of a spanning forest within each group of rows of equal keys; or between its parts."""
    kind = dict(dealt.dtypes)["id"]

    def judge(got: dict, starts: list[int]) -> tuple[list, list]:
        offsets, values = got["shingles"].offsets.to_numpy(), got["shingles"].values.to_numpy().view(np.uint64)
        ids, a, b = got["id"].to_pylist(), [], []
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            sets = [values[offsets[i] : offsets[i + 1]] for i in range(s, e)]
            x, y = exact_forest(ids[s:e], sets, percent) if part is None else exact_links(ids[s:e], sets, got[part][s:e].to_pylist(), percent)
            a += x
            b += y
        return a, b

    return grouped(dealt, keys, ["id", "shingles", *[part] * (part is not None)], f"a {kind}, b {kind}", judge)


#: Representatives of a linked part in a block.
REPRESENTATIVES = 4


def _links(docs: DataFrame, classes: DataFrame, lists: DataFrame, clusters: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(a, b): exact links whose components are those of all pairs that pass the filter and are linked. clusters: id, component."""
    sized = clusters.join(classes.select(F.col("rep").alias("id"), "n"), "id").withColumn("leaf", leaf_of(F.col("id")))
    blocks = sized.groupBy("component").agg(F.greatest(F.lit(1), F.ceil(F.sum("n") / CLUSTER_BLOCK)).cast("int").alias("blocks"), leaf_mask(F.col("leaf")).alias("leaves"))
    block = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col("blocks")).cast("int")
    placed = cut(sized.join(with_leaves(blocks, "leaves", "leaf"), ["component", "leaf"]).select("id", "component", "blocks", block(0).alias("block")))
    sets = _sets(docs, placed, id_col, text_col, width)
    links = cut(_linked(sets, ["component", "block"], percent))
    inside = sets.filter("blocks > 1").select("id", "component", "block", "n")
    if inside.isEmpty():
        free(placed, sets)
        return links
    # Representatives of linked parts, across the blocks of a cluster.
    inside = cut(inside)
    parts = _parts(inside, links)
    few = Window.partitionBy("component", "block", "part").orderBy(F.xxhash64("id"), "id")
    chosen = parts.withColumn("place", F.row_number().over(few)).filter(F.col("place") <= REPRESENTATIVES)
    ends = chosen.groupBy("component").agg(F.greatest(F.lit(1), F.ceil(F.sum("n") / CLUSTER_BLOCK)).cast("int").alias("blocks"))
    chosen = sets.select("id", "shingles").join(chosen.filter("size > 1").select("id", "component"), "id").join(ends, "component").withColumn("block", block(1))
    across = cut(links.unionByName(_linked(chosen, ["component", "block"], percent)))
    # Pairs of different parts: only lists that have several.
    parts = cut(_parts(inside, across).select("id", "part"))
    free(placed, sets, links, inside)
    rest = _between(docs, classes, lists, parts, id_col, text_col, width, percent)
    return across.unionByName(rest)


def _parts(inside: DataFrame, links: DataFrame) -> DataFrame:
    """inside with part, its component by the links so far, and size, the part's members."""
    found = components(links).select("id", F.col("component").alias("part"))
    out = inside.join(found, "id", "left").withColumn("part", F.coalesce("part", "id"))
    return out.join(out.groupBy("part").agg(F.count(F.lit(1)).alias("size")), "part")


def _between(docs: DataFrame, classes: DataFrame, lists: DataFrame, parts: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(a, b): exact links between texts of different parts. parts: id, part."""
    posts = lists.select("value", F.col("rep").alias("id")).join(parts, "id").join(classes.select(F.col("rep").alias("id"), "n"), "id")
    mixed = posts.groupBy("value").agg(F.min("part").alias("least"), F.max("part").alias("most")).filter("least != most").select("value")
    counts = posts.join(mixed, "value").groupBy("value", "part").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("words"))
    main = counts.groupBy("value").agg(F.max(F.struct("m", "part", "words")).alias("top"), F.sum("m").alias("ms"), F.sum("words").alias("ws"))
    main = main.select("value", F.col("top.part").alias("main"), F.greatest(F.ceil(F.col("top.m") / LIST_BLOCK), F.ceil(F.col("top.words") / CLUSTER_BLOCK)).cast("int").alias("mains"), F.greatest(F.ceil((F.col("ms") - F.col("top.m")) / LIST_BLOCK), F.ceil((F.col("ws") - F.col("top.words")) / CLUSTER_BLOCK)).cast("int").alias("others"))
    own = F.when(F.col("part") == F.col("main"), F.pmod(F.xxhash64("id"), F.col("mains"))).otherwise(F.col("mains") + F.pmod(F.xxhash64("id"), F.col("others"))).cast("int")
    # The largest part's blocks meet the others' blocks alone; these meet all.
    first = F.when(F.col("part") == F.col("main"), F.col("mains")).otherwise(F.lit(0))
    pairs = posts.join(main, "value").withColumn("own", own).withColumn("other", F.explode(F.sequence(first, F.col("mains") + F.col("others") - 1)))
    pairs = cut(pairs.select("value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "part"))
    kinds, share = dict(pairs.dtypes), percent / 100

    def judge(got: dict, starts: list[int]) -> tuple[list, list]:
        """Members with a passing partner of another part; the group's number stands for its keys."""
        sketches, _ = _matrix(got["sketch"])
        ids, size, member, group = got["id"].to_pylist(), got["n"].to_numpy(), [], []
        part = np.unique(np.array(got["part"].to_pylist()), return_inverse=True)[1]
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            own, near = part[s:e], np.zeros(e - s, bool)
            for x in np.nonzero(own != np.bincount(own).argmax())[0].tolist():
                others = np.nonzero(own != own[x])[0]
                found = others[_passes(sketches[s:e], size[s:e], x, others, share)]
                near[found] = True
                near[x] |= len(found) > 0
            for x in np.nonzero(near)[0].tolist():
                member.append(ids[s + x])
                group.append(got["gid"][s + x].as_py())
        return member, group

    keyed = pairs.withColumn("gid", F.xxhash64("value", "i", "j")).join(classes.select(F.col("rep").alias("id"), "n", "sketch"), "id")
    near = grouped(keyed, ["value", "i", "j"], ["id", "part", "n", "sketch", "gid"], f"id {kinds['id']}, gid long", judge)
    near = cut(near.distinct().join(parts, "id"))
    sets = _sets(docs, near, id_col, text_col, width)
    out = cut(_linked(sets, ["gid"], percent, "part"))
    free(pairs, near, sets)
    return out


def _judged(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    signatures = cut(_signatures(docs, id_col, text_col, width))
    keyed = signatures.withColumn("leaf", leaf_of(F.col("doc_id")))
    live = keyed.filter("n > 0 and doc_id is not null")
    key = ["d1", "d2", "n"]
    classes = cut(live.groupBy(*key).agg(F.min("doc_id").alias("rep"), leaf_mask(F.col("leaf")).alias("leaves")))
    own = signatures.select(F.col("doc_id").alias("rep"), *key, "sketch")
    reps = cut(classes.select("rep", *key).join(own, ["rep", *key]).dropDuplicates(["rep"]).select("rep", "n", "sketch"))
    lists, passing = _clusters(reps, percent / 100)
    links = components(_links(docs, reps, lists, components(passing), id_col, text_col, width, percent))
    found = classes.join(links.select(F.col("id").alias("rep"), "component"), "rep", "left").select(*key, "leaves", F.coalesce("component", "rep").alias("component_id"))
    linked = live.join(with_leaves(found, "leaves", "leaf"), [*key, "leaf"]).select("doc_id", "n", "component_id")
    alone = signatures.filter("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest identifier reached through links), kept: a row for each row of docs."""
    docs, row = keyed_rows(docs, id_col)
    judged = _judged(docs, row, text_col, width, percent)
    if row == id_col:
        return judged
    rows = cut(judged.join(docs.select(named(row).alias("doc_id"), named(id_col).alias("own")), "doc_id"))
    least = rows.groupBy("component_id").agg(F.min("own").alias("least"))
    return rows.join(least, "component_id").select(F.col("own").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"), F.col("own").eqNullSafe(F.col("least")).alias("kept"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row of docs for each component, with all its columns: the one with the smallest identifier or, where rows share or lack one, the first."""
    keyed, row = keyed_rows(docs, id_col)
    (key,) = fresh(keyed, "_gone")
    gone = _judged(keyed, row, text_col, width, percent).filter("not kept").select(F.col("doc_id").alias(key))
    return keyed.join(gone, named(row) == F.col(key), "left_anti").select(*[named(c) for c in docs.columns])
