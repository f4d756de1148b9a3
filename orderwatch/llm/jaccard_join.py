"""Exact Jaccard join of word-shingle sets by partitions of the universe.

Sets fall into size bands. In a band the hashes of all shingles are dealt into m segments. Two sets whose Jaccard
similarity reaches the threshold differ in at most H shingles, so they agree in enough segments: give segment i
a tolerance t_i of -1 (not looked at), 0 (equal) or 1 (one shingle more or less); whenever the sum of t_i + 1 is
over H, some segment agrees within its tolerance. The larger set of a pair looks into its own band and those
below. It allots its tolerances by cost: segments with few shingles agree by chance and are left out first, paid
for by one-deletion neighbourhoods in the segments set aside for them.

Each agreement is a key. Keys are first only counted, which is combined before the shuffle; the sets behind those
that more than one set has are then looked up in a second pass over the texts. Sets that share a key are compared by
sketches: the number of shingles in each part of the universe, whose differences add up to no more than the sets differ
by. Larger sets have more parts. That rules nearly all chance pairs out. What is left, as a least spanning forest of each key, makes
families, and any two sets that link are in one. The members of a family are compared exactly, on the shingles
themselves. Each set's number of links leaves a comparison, and of the links those that join what is not yet joined, or
all where they are asked for. Keys and families of very many sets are dealt into tiles of bounded size, and pairs of tiles.
"""

from __future__ import annotations

import bisect
import copy
import math
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderwatch.llm.common import cut, keep_rows, mix, text_or_empty
from orderwatch.llm.components import components

BAND_RATIO = 1.7
#: Segments of a band that also have one-deletion neighbourhoods.
SET_ASIDE = 2
#: Segments to spare, as a multiple of those that hold at most one shingle, for sets of bands that reach this size.
SPARE = 1.5
SPARED = 16
#: The least numbers in a sketch, one byte each, and the shingles of a set for which it has one.
PARTS = 128
EACH_PART = 8
#: Sets of a key that are compared pair by pair in one go, with those of other keys; bytes of sketches in one go.
SMALL = 12
AT_ONCE = 4_000_000
#: Sets, and shingles, that one tile holds; a comparison reads two tiles. A set is never cut.
TILE_SETS = 1000
TILE = 2_000_000
#: Bits of the tables by which a pass over the texts hands on only what can matter. They spare work; what they let
#: through by chance is sorted out by joins.
SLOT_BITS = 23
#: Rows worked on at a time.
SLICE = 512
FAR = 1 << 40

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, k: int) -> np.ndarray:
    """The distinct k-word shingles of a text as sorted 64-bit hashes; of fewer words, the whole sequence as one."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: only A-Z, only the six blanks
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(k, len(words))
    count = len(words) - size + 1
    found = np.full(count, size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            found = mix(found * _STEP + each[i : i + count])
    return np.unique(found)


def set_hashes(found: np.ndarray) -> tuple[int, int]:
    """Two independent hashes of a set, each a sum over its members."""
    with np.errstate(over="ignore"):
        one, two = mix(found + _STEP).sum(dtype=np.uint64), mix(found ^ _STEP).sum(dtype=np.uint64)
    return int(np.int64(one.view(np.int64))), int(np.int64(two.view(np.int64)))


class Scheme:
    """Bands, segments and tolerances for `num` / `den` as the least similarity."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.starts = [1]
        while self.starts[-1] < 1 << 40:
            self.starts.append(max(self.starts[-1] + 1, int(self.starts[-1] * BAND_RATIO) + 1))

    def band(self, size: int) -> int:
        return bisect.bisect_right(self.starts, size) - 1

    def largest(self, band: int) -> int:
        return self.starts[band + 1] - 1

    def differences(self, a: int, b: int) -> int:
        """The most shingles in which two sets of these sizes differ, if they are similar enough."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    def segments(self, band: int) -> int:
        """One more than sets may differ by, and some to spare, so that those of at most one shingle need not be looked at.

        Such segments are alike in many sets: a common shingle, or none, is all that they hold.
        """
        top = self.largest(band)
        least = self.differences(top, top * self.den // self.num) + 1
        each = top / least
        thin = math.exp(-each) * (1 + each)
        return least + (math.ceil(SPARE * thin * least) if top >= SPARED else 0)

    def allot(self, sizes: np.ndarray, need: int) -> tuple[np.ndarray, list[int]]:
        """The segments to look at, and those of them with tolerance 1, so that they add up to `need`.

        The cost of a segment is the chance that another set agrees in it, halved by each shingle in it; with
        tolerance 1, times the keys looked up.
        """
        order = np.argsort(-sizes, kind="stable")
        chosen, wide = order[:need].tolist(), []
        for i in sorted(range(min(SET_ASIDE, len(sizes))), key=lambda i: -sizes[i]):
            if i not in chosen or sizes[i] < 2 or len(chosen) < 2:
                continue
            worst = chosen[-1] if chosen[-1] != i else chosen[-2]
            if worst not in wide and 2.0 ** -sizes[worst] > (sizes[i] + 1) * 2.0 ** -(sizes[i] - 1):
                chosen.remove(worst)
                wide.append(i)
        return np.array(chosen, np.int64), wide

    def _of_band(self, found: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """The key of each segment, the shingles in it, and the one-deletion keys of the segments set aside."""
        m = self.segments(band)
        mixed = mix(found * _STEP + np.uint64(band))
        segment = (mixed % np.uint64(m)).astype(np.uint16 if m < 1 << 16 else np.int64)  # short numbers sort fast
        order = np.argsort(segment, kind="stable")
        sizes = np.bincount(segment, minlength=m)
        with np.errstate(over="ignore"):
            terms = mix(mixed)[order]
            running = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
            ends = np.cumsum(sizes)
            values = running[ends] - running[ends - sizes]
            salt = mix(np.arange(m, dtype=np.uint64) + np.uint64(band << 32))
            aside = range(min(SET_ASIDE, m))
            near = [mix((values[i] - terms[ends[i] - sizes[i] : ends[i]]) ^ salt[i]) for i in aside]
        return mix(values ^ salt), sizes, near

    def keys(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The keys of a set, and for each whether the set looks for others there or only waits to be found."""
        if not len(found):
            return np.empty(0, np.int64), np.empty(0, bool)
        own, size, keys, looks = self.band(len(found)), len(found), [], []
        band = own
        while band >= 0 and self.largest(band) * self.den >= self.num * size:
            need = self.differences(size, min(size, self.largest(band))) + 1
            full, sizes, near = self._of_band(found, band)
            chosen, wide = self.allot(sizes, need)
            if band == own:
                flags = np.zeros(len(full), bool)
                flags[chosen] = True
                keys.append(full)
                looks.append(flags)
            else:
                keys.append(full[chosen])
                looks.append(np.ones(len(chosen), bool))
            for i, keys_of in enumerate(near):
                if band == own or i in wide:
                    keys.append(keys_of)
                    looks.append(np.full(len(keys_of), i in wide))
            band -= 1
        return np.concatenate(keys).view(np.int64), np.concatenate(looks)


def similar_pairs(sets: list[np.ndarray], num: int, den: int, split: int = 0) -> np.ndarray:
    """All similar pairs: a row of two positions and the overlap each, by the first, then the second position.

    With `split`, only pairs of one of the first `split` sets and one of the others. Overlaps are counted exactly, as
    products of membership matrices over the shingles that more than one set has, some columns at a time.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    upper, lower = slice(split or None), slice(split, None)
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        overlap = np.array([[both]] if split else [[0, both], [both, 0]])
    else:
        _, codes, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = counts > 1
        columns = (np.cumsum(shared) - 1)[codes]
        rows, inside = np.repeat(np.arange(len(sets)), sizes), shared[codes]
        rows, columns = rows[inside], columns[inside]
        order = np.argsort(columns, kind="stable")
        rows, columns = rows[order], columns[order]
        overlap = np.zeros((len(sizes[upper]), len(sizes[lower])), np.float32)
        wide = max(256, 16_000_000 // (4 * len(sets)))
        for begin in range(0, int(shared.sum()), wide):
            a, b = np.searchsorted(columns, [begin, begin + wide])
            part = np.zeros((len(sets), wide), np.float32)
            part[rows[a:b], columns[a:b] - begin] = 1
            overlap += part[upper] @ part[lower].T
    overlap = overlap.astype(np.int64)
    hit = (overlap * den >= num * (sizes[upper, None] + sizes[lower] - overlap)) & (overlap > 0)
    i, j = np.nonzero(hit if split else np.triu(hit, 1))
    return np.column_stack((i, j + split, overlap[i, j]))


def spanning(pairs: np.ndarray, count: int) -> np.ndarray:
    """Of the pairs of `count` sets those that join what is not yet joined."""
    group, kept = np.arange(count), []
    edges = np.flatnonzero(np.diff(pairs[:, 0], prepend=-1, append=-1)).tolist() if len(pairs) else []
    for begin, end in pairwise(edges):
        i, others = pairs[begin, 0], pairs[begin:end, 1]
        while len(apart := np.flatnonzero(group[others] != group[i])):
            kept.append(begin + apart[0])
            group[group == group[others[apart[0]]]] = group[i]
    return pairs[np.array(kept, np.int64)]


def parts_of(size: int) -> int:
    """How many parts of the universe the sketch of a set of `size` shingles counts: a power of two, at least PARTS.

    Of a few shingles a part, unlike sets differ in most parts; of many, all parts of large sets look alike.
    """
    return max(PARTS, 1 << (max(1, size // EACH_PART) - 1).bit_length())


def sketch(found: np.ndarray) -> bytes:
    """How many shingles fall into each part of the universe, up to 255."""
    parts = parts_of(len(found))
    counts = np.bincount((found % np.uint64(parts)).astype(np.int64), minlength=parts)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


class Near:
    """Sets by size and sketch: which of them may be similar.

    A sketch is folded to compare it with one of half its parts; sizes of similar sets allow no more than that.
    """

    def __init__(self, scheme: Scheme, sizes: np.ndarray, sketches: list[bytes]):
        lengths = np.array([len(s) for s in sketches])
        self.scheme, self.sizes, self.parts, self.place = scheme, sizes, lengths, np.zeros(len(sizes), np.int64)
        self.whole: dict[int, np.ndarray] = {}
        self.folded: dict[int, np.ndarray] = {}
        for parts in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == parts)
            self.place[at] = np.arange(len(at))
            rows = np.frombuffer(b"".join([sketches[i] for i in at.tolist()]), np.uint8).reshape(-1, parts)
            half = parts // 2
            self.whole[parts] = rows
            self.folded[half] = np.minimum(rows[:, :half].astype(np.uint16) + rows[:, half:], 255).astype(np.uint8)

    def part(self, begin: int, end: int) -> Near:
        some = copy.copy(self)
        some.sizes, some.parts, some.place = self.sizes[begin:end], self.parts[begin:end], self.place[begin:end]
        return some

    def _alike(self, i: int | np.ndarray, among: np.ndarray | slice) -> np.ndarray:
        """Whether sets are of sizes that similar sets may have."""
        sizes, own = self.sizes[among], self.sizes[i]
        return np.minimum(sizes, own) * self.scheme.den >= self.scheme.num * np.maximum(sizes, own)

    def _counts(self, rows: np.ndarray, parts: int) -> np.ndarray:
        """The sketches of sets at `parts` parts, which each has itself or after one fold."""
        places, fold = self.place[rows], self.parts[rows] != parts
        if not fold.any():
            return self.whole[parts][places]
        found = np.empty((len(rows), parts), np.uint8)
        found[fold] = self.folded[parts][places[fold]]
        if not fold.all():
            found[~fold] = self.whole[parts][places[~fold]]
        return found

    def distances(self, i: int | np.ndarray, among: np.ndarray) -> np.ndarray:
        """Least differences of sets by sketch; a very large number where they cannot be similar."""
        one = np.ndim(i) == 0
        num, den = self.scheme.num, self.scheme.den
        out, alike = np.full(len(among), FAR), self._alike(i, among)
        low, high = np.minimum(self.parts[among], self.parts[i]), np.maximum(self.parts[among], self.parts[i])
        for parts in np.unique(low[alike]).tolist():
            every, step = np.flatnonzero(alike & (low == parts) & (high <= 2 * parts)), max(1, AT_ONCE // parts)
            for at in (every[begin : begin + step] for begin in range(0, len(every), step)):
                own = np.array([i]) if one else i[at]
                first, second = self._counts(among[at], parts), self._counts(own, parts)
                found = (np.maximum(first, second) - np.minimum(first, second)).sum(axis=1, dtype=np.int64)
                near = found <= (den - num) * (self.sizes[among[at]] + self.sizes[own]) // (den + num)
                out[at[near]] = found[near]
        out[alike & (high > 2 * low)] = 0  # too far apart to be folded; only where sizes may differ by more than half
        return out

    def small_forests(self, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Least spanning forests of many groups of few sets, each a stretch of this one: rows of two positions."""
        first, second = [], []
        for size in np.unique(sizes).tolist():
            i, j = np.triu_indices(size, 1)
            of_size = begins[sizes == size][:, None]
            first.append((of_size + i).ravel())
            second.append((of_size + j).ravel())
        if not first:
            return np.empty((0, 2), np.int64)
        first, second = np.concatenate(first), np.concatenate(second)
        found = self.distances(first, second)
        at = np.flatnonzero(found < FAR)
        at = at[np.argsort(found[at], kind="stable")]
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while (above := root.get(x, x)) != x:
                root[x] = root.get(above, above)
                x = above
            return x

        kept = []
        for place, u, v in zip(at.tolist(), first[at].tolist(), second[at].tolist(), strict=True):
            u, v = top(u), top(v)
            if u != v:
                root[u] = v
                kept.append(place)
        return np.column_stack((first[kept], second[kept])).astype(np.int64)

    def forest(self) -> list[tuple[int, int]]:
        """A least spanning forest, grown set by set."""
        count = len(self.sizes)
        best, link = np.full(count, FAR), np.full(count, -1)
        left, edges = np.ones(count, bool), []
        for _ in range(count):
            i = int(np.where(left, best, FAR + 1).argmin())
            if link[i] >= 0:
                edges.append((int(link[i]), i))
            left[i] = False
            among = np.flatnonzero(left & self._alike(i, slice(None)))
            found = self.distances(i, among)
            closer = found < best[among]
            best[among[closer]], link[among[closer]] = found[closer], i
        return edges


def _slot(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit((1 << SLOT_BITS) - 1)).cast("int")


def _slots(df: DataFrame, hashed: Column) -> bytes:
    """A bit table of hash values, of fixed size."""
    slot = _slot(hashed)
    words = (
        df.select(F.shiftright(slot, 5).alias("word"), F.expr("1L").alias("one"), slot.bitwiseAND(31).alias("at"))
        .select("word", F.expr("shiftleft(one, at)").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    table = np.zeros(1 << (SLOT_BITS - 5), np.uint32)
    for row in words.collect():  # at most 2 ** (SLOT_BITS - 5) rows, whatever the input
        table[row.word] = row.bits
    return table.tobytes()


def _hit(table: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (table[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1 == 1


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))


def _text_digest(text_col: str) -> Column:
    return F.sha2(text_or_empty(text_col), 256)


def set_table(
    docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text", digests: bool = False
) -> DataFrame:
    """Per row: doc_id, with `digests` the text's digest, n_shingles, the two hashes of its set, and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, SLICE) for at in range(0, batch.num_rows, SLICE)):
                sets = (shingles(text, k) for text in part.column("text").to_pylist())
                n, one, two, drawn = zip(*((len(x), *set_hashes(x), sketch(x)) for x in sets), strict=True)
                numbers = [pa.array(c, pa.int64()) for c in (n, one, two)]
                own = [part.column(c) for c in names[:-4]]
                yield pa.RecordBatch.from_arrays([*own, *numbers, pa.array(drawn, pa.binary())], names=names)

    names = ["doc_id", *(["digest"] if digests else []), "n_shingles", "one", "two", "sketch"]
    texts = _documents(docs, id_col, text_col)
    kind = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}"
    if digests:
        texts, kind = texts.withColumn("digest", _text_digest("text")), f"{kind}, digest string"
    return texts.mapInArrow(run, f"{kind}, n_shingles long, one long, two long, sketch binary")


def _slotted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return _documents(docs, id_col, text_col).withColumn("slot", _slot(F.xxhash64("doc_id")))


def _key_rows(texts: DataFrame, k: int, scheme: Scheme, reps: bytes, slots: bytes | None = None) -> DataFrame:
    """The keys of the documents in the bit table `reps`: key and looks, or, of the keys in `slots`, key and set."""
    context = texts.sparkSession.sparkContext
    reps_shared, slots_shared = context.broadcast(reps), context.broadcast(slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reps = np.frombuffer(reps_shared.value, np.uint32)
        table = np.frombuffer(slots_shared.value, np.uint32) if slots_shared.value else None
        for batch in batches:
            hit = np.flatnonzero(_hit(reps, batch.column("slot").to_numpy()))
            for at in range(0, len(hit), SLICE):
                parts = []
                for text in batch.column("text").take(pa.array(hit[at : at + SLICE])).to_pylist():
                    found = shingles(text, k)
                    keys, other = scheme.keys(found)
                    if table is not None:
                        keys = keys[_hit(table, keys & ((1 << SLOT_BITS) - 1))]
                        other = np.full(len(keys), set_hashes(found)[0] if len(keys) else 0, np.int64)
                    parts.append((keys, other))
                columns = [pa.array(np.concatenate([p[i] for p in parts])) for i in range(2)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "looks" if table is None else "set"])

    return texts.select("text", "slot").mapInArrow(run, "key long, looks boolean" if slots is None else "key long, set long")


def _sets_of(texts: DataFrame, k: int, wanted: bytes) -> DataFrame:
    """The shingles of the documents in the bit table `wanted`: one (the first hash) and members, each set once."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, np.uint32)
        for batch in batches:
            hit = np.flatnonzero(_hit(table, batch.column("slot").to_numpy()))
            for at in range(0, len(hit), SLICE):
                part = batch.column("text").take(pa.array(hit[at : at + SLICE]))
                sets = [shingles(text, k) for text in part.to_pylist()]
                one = pa.array([set_hashes(x)[0] for x in sets], pa.int64())
                members = pa.array([x.tobytes() for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([one, members], names=["one", "members"])

    return texts.select("text", "slot").mapInArrow(run, "one long, members binary").dropDuplicates(["one"])


def shared_keys(texts: DataFrame, reps: bytes, k: int, scheme: Scheme) -> DataFrame:
    """The keys that several sets have and one of them looks at: key and set (a first hash), each pair once."""
    looked = 1 << 40
    weight = F.lit(1) + F.when(F.col("looks"), F.lit(looked)).otherwise(F.lit(0))
    counted = _key_rows(texts, k, scheme, reps).groupBy("key").agg(F.sum(weight).alias("weight"))
    keys = cut(counted.filter(f"weight >= {looked} and weight % {looked} > 1").select("key"))
    found = _key_rows(texts, k, scheme, reps, _slots(keys, F.col("key")))
    return one_of_each(cut(found.join(keys, "key").distinct()))


def one_of_each(members: DataFrame) -> DataFrame:
    """Of keys with the same sets, the first: sets that are much alike share hundreds of keys.

    `members` has key and set, each pair once. Sets are the same if they are as many and two hashes of them agree.
    """
    of_sets = [F.bit_xor(F.xxhash64("set", F.lit(salt))).alias(name) for salt, name in ((1, "one"), (2, "two"))]
    keys = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), *of_sets)
    first = keys.groupBy("size", "one", "two").agg(F.min("key").alias("key"))
    return cut(members.join(first.select("key"), "key", "left_semi"))


def _tiles(members: DataFrame, by: list[str], weight: Column) -> DataFrame:
    """Deals the members of each group into tiles, and each tile into its pairs with every other, as `a` and `b`.

    Members have their `tile` beside them; a pair of equal tiles is that tile alone.

    A tile holds about TILE_SETS members, or TILE of `weight`. Groups of one are left out.
    """
    tiles = F.greatest(F.ceil(F.count(F.lit(1)) / TILE_SETS), F.ceil(F.sum(weight) / TILE)).cast("int")
    sizes = members.groupBy(*by).agg(tiles.alias("tiles"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    dealt = members.join(sizes, by).withColumn("tile", F.expr("int(pmod(xxhash64(set), tiles))"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pair = [F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b")]
    return dealt.select(*members.columns, "tile", *pair)


def _near_pairs(members: DataFrame, classes: DataFrame, scheme: Scheme) -> DataFrame:
    """Pairs (u, v) of sets that share a key and may be similar by size and sketch: a least spanning forest of each key.

    `members` has key and set. Keys come one after the other, so a task holds one pair of tiles and one batch.
    """
    columns = ["key", "a", "b", "set", "n_shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in chain(batches, [None]):
            parts = held + ([pa.Table.from_batches([batch])] if batch is not None and batch.num_rows else [])
            if not parts:
                continue
            table = pa.concat_tables(parts)
            rows = {c: table.column(c).to_numpy() for c in columns}
            drawn = table.column("sketch").to_pylist()
            new = np.ones(table.num_rows + 1, bool)
            new[1:-1] = False
            for c in ("key", "a", "b"):
                new[1:-1] |= rows[c][1:] != rows[c][:-1]
            edges = np.flatnonzero(new)
            held = [] if batch is None else [table.slice(edges[-2])]  # the last key may go on in the next batch
            begins, ends = (edges[:-1], edges[1:]) if batch is None else (edges[:-2], edges[1:-1])
            near = Near(scheme, rows["n_shingles"], drawn)
            small = ends - begins <= SMALL
            found = [near.small_forests(begins[small], (ends - begins)[small])]
            for begin, end in zip(begins[~small].tolist(), ends[~small].tolist(), strict=True):
                if linked := near.part(begin, end).forest():
                    found.append(np.array(linked) + begin)
            u, v = (rows["set"][np.concatenate(found)[:, i]] for i in range(2))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    of_sets = classes.select(F.col("one").alias("set"), "n_shingles", "sketch")
    dealt = _tiles(members, ["key"], F.lit(0)).join(of_sets, "set").select(*columns, "sketch")
    ordered = dealt.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")
    return ordered.mapInArrow(run, "u long, v long").distinct()


def _compared(
    docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str, digests: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What `jaccard_links` returns, with a forest (u, v) of the links, which joins all that they join, before them.

    Sets are named by their first hash, whether a row of theirs has an id or not. Every two sets of a family meet in one
    pair of tiles. Counts and forest leave the comparison, no more rows than it reads; the links themselves are listed
    only where they are asked for.
    """
    texts, scheme = _slotted(docs, id_col, text_col), Scheme(num, den)
    table = cut(set_table(docs, k, id_col, text_col, digests))
    same = table.filter("n_shingles > 0").groupBy("one", "two", "n_shingles")
    n_rows = F.count(F.lit(1)).alias("n_rows")
    classes = cut(same.agg(F.min("doc_id").alias("doc_id"), F.min("sketch").alias("sketch"), n_rows))
    shared = shared_keys(texts, _slots(classes, F.xxhash64("doc_id")), k, scheme)
    families = components(_near_pairs(shared, classes, scheme))
    families = families.select(F.col("node").alias("set"), F.col("component").alias("family"))
    of_sets = classes.select(F.col("one").alias("set"), "doc_id", "n_shingles", "n_rows")
    members = cut(families.join(of_sets, "set"))
    sets = _sets_of(texts, k, _slots(members, F.xxhash64("doc_id")))

    def verified(key: tuple, group: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
        """The members of a pair of tiles, those of the first tile first, and the similar pairs not met elsewhere."""
        group = group.sort_values("tile", kind="stable", ignore_index=True)
        split = 0 if key[1] == key[2] else int((group["tile"] == key[1]).sum())
        if len(group) < 2 or (key[1] != key[2] and split in (0, len(group))):
            return group, np.empty((0, 3), np.int64)
        return group, similar_pairs([np.frombuffer(x, np.uint64) for x in group["members"]], num, den, split)

    def listed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group, pairs = verified(key, group)
        names = group["set"].to_numpy()
        return pd.DataFrame({"u": names[pairs[:, 0]], "v": names[pairs[:, 1]], "overlap": pairs[:, 2]})

    def summed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group, pairs = verified(key, group)
        names, sizes, counts = group["set"].to_numpy(), group["n_rows"].to_numpy(), np.zeros(len(group), np.int64)
        np.add.at(counts, pairs[:, 0], sizes[pairs[:, 1]])
        np.add.at(counts, pairs[:, 1], sizes[pairs[:, 0]])
        kept, linked = spanning(pairs, len(group)), np.flatnonzero(counts)
        joins = pd.DataFrame({"u": names[kept[:, 0]], "v": names[kept[:, 1]], "n_links": 0})
        tally = pd.DataFrame({"u": names[linked], "v": names[linked], "n_links": counts[linked]})
        return pd.concat([joins, tally], ignore_index=True)

    dealt = _tiles(members, ["family"], F.col("n_shingles")).join(sets, F.col("set") == F.col("one"))
    dealt = dealt.select("family", "a", "b", "tile", "set", "n_rows", "members").groupBy("family", "a", "b")
    found = cut(dealt.applyInPandas(summed, "u long, v long, n_links long"))
    tallies = found.filter("u = v").groupBy(F.col("u").alias("one")).agg(F.sum("n_links").alias("others"))
    n_links = (F.coalesce("others", F.lit(0)) + F.col("n_rows") - 1).alias("n_links")
    classes = classes.join(tallies, "one", "left").select(*classes.columns, n_links)
    links = dealt.applyInPandas(listed, "u long, v long, overlap long")
    return table, classes, found.filter("u != v").select("u", "v"), links


def jaccard_links(
    docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The set of each row, the classes of equal sets, and all verified links between their representatives.

    Sets: see `set_table`. Classes: one, two (the set's hashes), n_shingles, doc_id (the smallest of the class),
    sketch, n_rows (its rows) and n_links (the other rows that a row of the class links with, copies among them). Links:
    u, v (the ids of two representatives, null where no row has one), one_u, one_v (their sets' first hashes) and overlap,
    each pair once. Two sets link when den * intersection >= num * union. The links of a large group are as many as
    its pairs.
    """
    table, classes, _, links = _compared(docs, k, num, den, id_col, text_col)
    named = lambda end: classes.select(F.col("one").alias(f"one_{end}"), F.col("doc_id").alias(end))
    links = links.withColumnsRenamed({"u": "one_u", "v": "one_v"}).join(named("u"), "one_u").join(named("v"), "one_v")
    return table, classes, links.select("u", "v", "one_u", "one_v", "overlap")


def link_counts(
    docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id and n_links, the other rows it links with; none for a text without words."""
    table, classes, _ = jaccard_links(docs, k, num, den, id_col, text_col)
    sets = ["one", "two", "n_shingles"]
    rows = table.join(classes.select(*sets, "n_links"), sets, "left")
    return rows.select("doc_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def similar_groups(
    docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest id reachable by links.

    A text without words (also null) has no shingles and is alone. Rows with equal sets are linked. Rows that
    share an id are one document. A row without an id is compared as any other and has the smallest id of its group; it
    never gives its group a name, so where none of a group has an id component_id is null. Other columns are neither
    read nor returned.
    """
    return _grouped(*_compared(docs, k, num, den, id_col, text_col)[:3]).select("doc_id", "n_shingles", "component_id")


def _grouped(table: DataFrame, classes: DataFrame, forest: DataFrame) -> DataFrame:
    """The rows of `table` with component_id, and `lead`, the least hash of a set of the group (null without words)."""
    joined = components(forest).select(F.col("node").alias("one"), "component")
    named = cut(
        classes.join(joined, "one", "left").select(
            "one", "two", "n_shingles", "doc_id", F.coalesce("component", "one").alias("component")
        )
    )
    groups = named.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min("one").alias("lead"))
    named = named.join(groups, "component").select("one", "two", "n_shingles", "component_id", "lead")
    out = table.join(named, ["one", "two", "n_shingles"], "left")
    return out.withColumn("component_id", F.coalesce("component_id", "doc_id"))


def drop_similar(
    docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` with one document of each group, the one with the smallest id; all columns as they were.

    Rows are decided one by one, by their own text. Of rows that repeat an id with the same set one stays, and one of a
    group in which no row has an id. Of rows without words, one of each id and text stays.
    """
    rows = _grouped(*_compared(docs, k, num, den, id_col, text_col, digests=True)[:3])
    nameless = F.col("component_id").isNull() & (F.col("one") == F.col("lead"))
    chosen = rows.filter("n_shingles > 0").filter((F.col("doc_id") == F.col("component_id")) | nameless)
    sets = ["one", "two", "n_shingles"]
    first = chosen.groupBy(F.col("doc_id").alias("chosen"), *sets).agg(F.min("digest").alias("first"))
    own = F.col("doc_id").eqNullSafe(F.col("chosen")) & (F.col("digest") == F.col("first"))
    kept = (F.col("n_shingles") == 0) | F.coalesce(own, F.lit(False))
    decided = rows.join(first, sets, "left").withColumn("kept", kept)
    return keep_rows(docs, decided.select("doc_id", "digest", "kept"), _text_digest(text_col), id_col, text_col)
