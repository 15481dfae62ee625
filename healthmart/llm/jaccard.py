"""N-gram Jaccard join: documents whose sets of word shingles overlap, and their components.

Two documents link when the Jaccard similarity of their shingle sets is at least ``PERCENT`` per
cent.  The join is exact (shingles are 64-bit hashes; no link is lost, none is capped):

1. Equal sets are one node, named by its smallest id, so copies never meet each other again.
2. Tiles: linked sets share a shingle among the first ``n - ceil(t n) + 1`` of each in any common
   order.  The order puts frequent shingles last; it is a hint that changes no result.  A tile holds
   the nodes with one such shingle, sorted by size and compared only within the size ratio.
   Of tiles with the same members one is kept.
3. First round: every member is paired with its tile's first member.  Pairs are tested, and their
   components found.  Second round: where a tile holds several members of one component, the others are
   paired with one of the largest, another in each tile.  Last round: only pairs of a tile in different components are left, so a
   group of near copies never yields all its pairs, also where a stranger shares its tile.  Large
   tiles are cut into blocks, and the pairs of blocks are spread over tasks.
4. A pair is tested by hashed bitmaps first (as many bits as the size band asks for): a bit set in
   one and not in the other is a shingle the other lacks, which bounds the overlap from above.
   Short bitmaps travel to the tiles, wide ones only to the distinct pairs that these let through;
   a pair that has met in an earlier tile is not tested again in one of the next.  Survivors are intersected exactly, as sorted arrays, in steps that send no more sets than there
   are.  After each step the components are joined up, and pairs inside one need no test any more.

Defined results: null and empty texts, and texts of white space, have no shingles, link with nothing
and are their own component; rows with the same id are one document, linked with what any of its
rows links with; null ids keep a null component and link nothing; repeated rows give equal rows; an
empty table gives an empty table; only the id and text columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import _Cache
from .common import SPACES, bound_batches, free_shuffles, release, take_turn
from .common import written as _written
from .quality import _fresh

WORDS, PERCENT = 5, 80
#: Frequent shingles known to all tasks, at most; documents of a batch that make one frequent.
FREQUENT, FREQUENT_IN_BATCH = 1 << 16, 6
#: Bits of a signature: a power of two, at least MIN_BITS and at least so many for each shingle, in a wide and a short one.
MIN_BITS, WIDE, SHORT = 64, 8, 2
#: Tiles of a member before this one, by hash, that its row in a tile names.
EARLIER = 4
#: Bits of the filter on ids whose texts are read again; words of 64 bits of that on ids whose rows are looked up.
FILTER_BITS, FILTER_WORDS = 1 << 24, 1 << 18
#: Bytes of sets that are sent to meet their partners in one step, where the sets themselves are not more.
STEP_BYTES = 64 << 20
#: Members of a tile that are compared as one block; larger tiles are cut into blocks of about as many.
BLOCK = 1024
#: Partitions that one task writes, one after the other, where that leaves WAVES tasks for each core.
GATHER, WAVES = 16, 2
#: Bytes of texts whose words are hashed at once; few bytes are hashed word by word, as are words of more than LONG bytes.
GROUP, FEW, LONG = 1 << 19, 512, 64


def gathered(df: DataFrame) -> DataFrame:
    """``df`` in fewer partitions, hence files.  For each file it creates on a local or mounted folder, an executor starts
    other processes (Hadoop sets permissions by chmod); while one starts, the executor's memory counts twice."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(WAVES * spark.sparkContext.defaultParallelism, partitions // GATHER))


def written(df: DataFrame, tag: str, *done: DataFrame, gather: bool = True) -> DataFrame:
    """A written table; the tables in ``done`` have had their last reader by then."""
    out = _written(gathered(df) if gather else df, tag)
    free_shuffles(df.sparkSession)
    release(*done)
    return out


_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, bool)
_IN_WORD[list(SPACES.encode())] = False
#: The first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _hash(word: bytes) -> int:
    """The hash of a word, as ``_hashes`` gives it."""
    if len(word) > LONG:
        return xxhash.xxh3_64_intdigest(word)
    h, odd, last = len(word) * int(_ODD[1]), tuple(map(int, _ODD)), (1 << 64) - 1
    for k in range(0, len(word), 8):
        h = (h & last) ^ int.from_bytes(word[k:k + 8], "little")
        h = (h ^ h >> 32) * odd[0] & last
        h = (h ^ h >> 29) * odd[1] & last
        h ^= h >> 32
    return h


_word_hash = _Cache(_hash, 100_000)


def _stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD[0]
    h = (h ^ (h >> np.uint64(29))) * _ODD[1]
    return h ^ (h >> np.uint64(32))


def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of ``data``, and where it starts: eight bytes of all words at a time."""
    low = np.zeros(len(data) + 8, np.uint8)
    np.take(_LOWER, np.frombuffer(data, np.uint8), out=low[:len(data)])
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_WORD[low[:len(data)]]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, size = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(data) + 1, "<u8", low, 0, (1,))         # the eight bytes from each byte on
    h = _stirred((eight[start] & _FIRST[np.minimum(size, 8)]) ^ size.astype(np.uint64) * _ODD[1])
    more, done = np.flatnonzero((size > 8) & (size <= LONG)), 8
    while more.size:
        h[more] = _stirred(h[more] ^ (eight[start[more] + done] & _FIRST[np.minimum(size[more] - done, 8)]))
        done += 8
        more = more[size[more] > done]
    for i in np.flatnonzero(size > LONG):
        h[i] = _hash(low[start[i]:start[i] + size[i]].tobytes())
    return h, start


def _windows(h: np.ndarray, width: int) -> np.ndarray:
    """The hash of each ``width`` words in a row."""
    out = np.full(max(0, len(h) - width + 1), np.uint64(width))
    for k in range(width):
        out = (out ^ (out >> np.uint64(29))) * _ODD[0] + h[k:k + len(out)]
    out = (out ^ (out >> np.uint64(32))) * _ODD[1]
    return out ^ (out >> np.uint64(29))


def _group_sets(texts: list) -> Iterator[np.ndarray]:
    data = b"\n".join(texts)                         # a line feed ends words, so none spans two texts
    if len(data) <= FEW:
        words = [bytes(t).lower().split() for t in texts]       # bytes: ASCII letters and ASCII white space only
        h = np.array([_word_hash[w] for own in words for w in own], np.uint64)
        ends = np.cumsum(list(map(len, words)))
    else:
        h, start = _hashes(data)
        ends = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))
    shingled, begin = _windows(h, WORDS), 0
    for end in ends.tolist():
        grams = shingled[begin:end - WORDS + 1] if end - begin >= WORDS else _windows(h[begin:end], max(1, end - begin))
        grams, begin = np.sort(grams), end
        new = grams[1:] != grams[:-1]
        yield grams if new.all() else grams[np.concatenate([[True], new])]


def shingle_sets(texts: Iterable) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text (UTF-8 bytes or None).  Texts are hashed in groups of about GROUP
    bytes; a longer one is a group by itself."""
    take_turn(_word_hash)
    group, size = [], 0
    for t in texts:
        t = b"" if t is None else t
        if group and size + len(t) > GROUP:
            yield from _group_sets(group)
            group, size = [], 0
        group.append(t)
        size += len(t) + 1
    if group:
        yield from _group_sets(group)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return next(shingle_sets([(text or "").encode()]))


def _column_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    return shingle_sets(t.as_buffer() for t in texts)


def prefix(grams: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the common order: rare ones by hash, then frequent ones."""
    n = len(grams)
    take = n - (PERCENT * n + 99) // 100 + 1 if n else 0
    if not len(frequent):
        return grams[:take]
    for most in (2 * take, n):                 # mostly the first few hold enough rare ones
        head = grams[:most]
        often = frequent[np.minimum(np.searchsorted(frequent, head), len(frequent) - 1)] == head
        if most >= n or len(head) - np.count_nonzero(often) >= take:
            break
    return np.concatenate([head[~often], head[often]])[:take]


def signature(grams: np.ndarray, per: int = WIDE) -> bytes:
    bits = MIN_BITS
    while bits < per * len(grams):
        bits *= 2
    mark = np.zeros(bits, np.uint8)
    mark[(grams >> np.uint64(7)) & np.uint64(bits - 1)] = 1
    return np.packbits(mark, bitorder="little").tobytes()


def folded(sigs: list[bytes], size: int) -> np.ndarray:
    """Signatures of one width (bytes), as rows of 64-bit words; wider ones are folded."""
    out = np.empty((len(sigs), size // 8), np.uint64)
    for i, s in enumerate(sigs):
        a = np.frombuffer(s, np.uint64)
        while len(a) > size // 8:
            a = a[:len(a) // 2] | a[len(a) // 2:]
        out[i] = a
    return out


def may_link(n_a, sig_a, n_b, sig_b):
    """Whether the bitmaps leave room for a link (arrays broadcast against each other)."""
    only_a = np.bitwise_count(sig_a & ~sig_b).sum(-1, dtype=np.int64)
    only_b = np.bitwise_count(sig_b & ~sig_a).sum(-1, dtype=np.int64)
    most = np.minimum(n_a - only_a, n_b - only_b)
    return 100 * most >= PERCENT * (n_a + n_b - most)


def _frequent(docs: DataFrame) -> np.ndarray:
    """Shingles that many documents hold: those frequent in some batch, the most frequent first, at
    most FREQUENT of them.  Only the order of shingles depends on this."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_column_sets(batch.column(0)))
            h, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.empty(0, np.uint64), np.empty(0, int))
            h, n = h[n >= FREQUENT_IN_BATCH], n[n >= FREQUENT_IN_BATCH]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    counts = docs.select("text").mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.col("n").desc(), "h").limit(FREQUENT).select("h").toPandas()["h"]
    return np.sort(top.to_numpy(np.int64).view(np.uint64))


def _described(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``(id, n, digest, sig, short, prefix)`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, sig, short, firsts = [], [], [], [], []
            for g in _column_sets(batch.column(1)):
                n.append(len(g))
                digest.append(hashlib.blake2b(g.tobytes(), digest_size=16).digest() if len(g) else None)
                sig.append(signature(g))
                short.append(signature(g, SHORT))
                firsts.append(prefix(g, frequent).view(np.int64))
            ends = np.cumsum([0, *map(len, firsts)]).astype(np.int32)
            flat = np.concatenate(firsts) if firsts else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary()), pa.array(short, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "n", "digest", "sig", "short", "prefix"])

    return docs.select("id", "text").mapInArrow(run, "id bigint, n bigint, digest binary, sig binary, short binary, prefix array<bigint>")


def _tiles(nodes: DataFrame) -> DataFrame:
    """``(h, n, id, first, first_n)``: the members of every tile with at least two, and the tile's first
    member in the order of hashed ids (a smallest member would be the least like the others).  A streaming pass over rows sorted by tile; no tile is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.int64
        rest = np.empty((3, 0), kind)          # the last row, whose successor is not known yet
        tile, lead = None, None                # of the row before it
        for batch in batches:
            rows = np.concatenate([rest, np.stack([c.to_numpy(zero_copy_only=False).astype(kind) for c in batch.columns])], axis=1)
            out, rest, tile, lead = _members(rows, tile, lead, last=False)
            if out[0].size:
                yield _tile_batch(out)
        out, _, _, _ = _members(rest, tile, lead, last=True)
        if out[0].size:
            yield _tile_batch(out)

    rows = nodes.select(F.explode("prefix").alias("h"), "n", "id")
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "h").sortWithinPartitions("h", F.xxhash64("id"), "id").mapInArrow(run, "h bigint, n bigint, id bigint, first bigint, first_n bigint")


def _members(rows: np.ndarray, tile, lead, last: bool):
    h = rows[0]
    if not h.size:
        return (h,) * 5, rows, tile, lead
    before = np.concatenate([[tile is not None and h[0] == tile], h[1:] == h[:-1]]).astype(bool)
    after = np.concatenate([h[1:] == h[:-1], [False]]).astype(bool)
    # The first member of each row's tile; column 0 of ``firsts`` is that of the tile going on.
    firsts = np.concatenate([np.array(lead or (0, 0), np.int64)[:, None], rows[1:][:, ~before]], axis=1)[:, np.cumsum(~before)]
    keep = before | after
    if not last:
        keep[-1] = False
    out = (*rows[:, keep], firsts[1, keep], firsts[0, keep])
    if last:
        return out, rows[:, :0], None, None
    # The last row waits; what stands before it says whether it continues a tile.
    if h.size > 1:
        tile, lead = int(h[-2]), (int(firsts[0, -2]), int(firsts[1, -2]))
    return out, rows[:, -1:], tile, lead


def _tile_batch(out) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["h", "n", "id", "first", "first_n"])


def _distinct_tiles(tiles: DataFrame) -> DataFrame:
    """Of tiles with the same members (a shared passage gives one for each of its shingles) only one.
    Members are compared by their number and two 64-bit digests."""
    digest = [F.sum(F.xxhash64("id").cast("decimal(38,0)")), F.sum(F.xxhash64(F.lit(1), "id").cast("decimal(38,0)")), F.count(F.lit(1))]
    same = tiles.groupBy("h").agg(*[d.alias(f"d{i}") for i, d in enumerate(digest)])
    return tiles.join(same.groupBy("d0", "d1", "d2").agg(F.min("h").alias("h")).select("h"), "h", "left_semi")


def _block_pairs(members: DataFrame) -> DataFrame:
    """``(h, p, q, side, n, id, comp)`` from the members (h, n, id, comp, members) of tiles with several
    components: what is compared with each other, as pairs of blocks p and q (sides 0 and 1).

    A tile of at most BLOCK members is one block, compared with itself.  A larger one is cut by size bands
    (sizes within the ratio are in the same band or in neighbours), and a band into blocks of about
    BLOCK members: a large component has blocks of its own, the others share blocks, each whole in one.
    Blocks of the same large component do not meet, so only members of different components do, and
    those of a shared block.  Other columns of ``members`` go along.
    """
    row = ["n", "id", "comp", *(c for c in members.columns if c not in ("h", "n", "id", "comp", "members"))]
    small = members.where(F.col("members") <= BLOCK).select("h", F.lit("").alias("p"), F.lit("").alias("q"), F.lit(0).alias("side"), *row)
    large = members.where(F.col("members") > BLOCK)
    if large.isEmpty():
        return small
    # A little wider than the ratio, so that rounding never puts a pair two bands apart.
    large = large.select("h", *row, F.floor(F.log("n") / (1.01 * math.log(100 / PERCENT))).cast("bigint").alias("band"))
    parts = large.groupBy("h", "band", "comp").agg(F.count(F.lit(1)).alias("rows")).withColumn("own", F.col("rows") > BLOCK // 2)
    shared = parts.where(~F.col("own")).groupBy("h", "band").agg(F.sum("rows").alias("together"))
    parts = parts.join(shared, ["h", "band"], "left").select(
        "h", "band", "comp", "own", F.ceil(F.when(F.col("own"), F.col("rows")).otherwise(F.col("together")) / BLOCK).cast("bigint").alias("k"))
    key = F.when(F.col("own"), F.xxhash64("id")).otherwise(F.xxhash64("comp"))
    owner = F.when(F.col("own"), F.col("comp"))
    placed = large.join(parts, ["h", "band", "comp"]).select(
        "h", *row, "band", owner.alias("owner"),
        F.concat_ws(":", F.col("band").cast("string"), F.coalesce(owner.cast("string"), F.lit("")), F.pmod(key, F.col("k")).cast("string")).alias("block"))
    placed = written(placed, "blocks")
    blocks = placed.select("h", "band", "owner", "block").distinct()
    one = blocks.select("h", F.col("band").alias("band_1"), F.col("owner").alias("owner_1"), F.col("block").alias("p"),
                        F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    two = blocks.select("h", "band", F.col("owner").alias("owner_2"), F.col("block").alias("q"))
    pairs = (one.join(two, ["h", "band"]).where((F.col("band") > F.col("band_1")) | (F.col("p") <= F.col("q")))
             .where(F.coalesce(F.col("owner_1") != F.col("owner_2"), F.lit(True))).select("h", "p", "q"))
    sides = (pairs.select("h", F.col("p").alias("block"), "p", "q", F.lit(0).alias("side"))
             .unionByName(pairs.where("p <> q").select("h", F.col("q").alias("block"), "p", "q", F.lit(1).alias("side"))))
    return small.unionByName(placed.join(sides, ["h", "block"]).select("h", "p", "q", "side", *row))


def _cross_pairs(members: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of different components that sizes and short bitmaps let through, from the rows of
    ``_block_pairs`` with their bitmaps.  A task holds one pair of blocks at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sides = None, ([], [])             # rows (n, id, comp, earlier tiles, short bitmap) of the pair of blocks

        def flush():
            if sides[0]:
                one, two = ((*(np.array([r[i] for r in rows], np.int64) for i in range(3)), _padded([r[3] for r in rows]),
                             [r[4] for r in rows]) for rows in sides)
                if at[1] == at[2]:
                    yield from _compare(one, one, True)
                elif sides[1]:
                    yield from _compare(one, two, False)

        for batch in batches:
            for h, p, q, side, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (h, p, q) != at:
                    yield from flush()
                    at, sides = (h, p, q), ([], [])
                sides[side].append(row)
        yield from flush()

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (members.select("h", "p", "q", "side", "n", "id", "comp", "earlier", "short").repartition(n, "h", "p", "q").sortWithinPartitions("h", "p", "q")
            .mapInArrow(run, "a bigint, b bigint").distinct())


def _padded(lists: list[list[int]]) -> np.ndarray:
    """Lists of at most EARLIER tiles as rows, filled up with 0."""
    out = np.zeros((len(lists), EARLIER), np.int64)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def _earlier(members: DataFrame) -> DataFrame:
    """With ``earlier``: the last EARLIER tiles of a member before this one, in the order of their hashes."""
    before = Window.partitionBy("id").orderBy("h").rowsBetween(-EARLIER, -1)
    return members.withColumn("earlier", F.collect_list("h").over(before))


def _met(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether members of this tile are both in one of the earlier tiles that their rows name.  The first tile
    that two members share never says so, hence every pair is tested there at least."""
    out = np.zeros(len(x), bool)
    for i in range(EARLIER):
        out |= ((x[:, i, None] == y) & (y != 0)).any(1)        # a tile of hash 0 would only be tested twice
    return out


def _compare(one, two, same: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of rows (n, id, comp, earlier tiles, bitmap) that may link, by classes of bitmap width.  Sizes within the
    ratio have equal widths or neighbouring ones, so a bitmap is folded once at most."""
    widths = [np.array(list(map(len, x[4]))) for x in (one, two)]
    for w in np.unique(widths[0]):
        for v in np.unique(widths[1]):
            if max(w, v) > 2 * min(w, v) or same and w > v:
                continue
            p, q = np.flatnonzero(widths[0] == w), np.flatnonzero(widths[1] == v)
            size = int(min(w, v))
            yield from _compare_class([x[p] for x in one[:4]], folded([one[4][i] for i in p], size),
                                      [x[q] for x in two[:4]], folded([two[4][i] for i in q], size), same and w == v)


def _compare_class(one, sig_1, two, sig_2, same: bool) -> Iterator[pa.RecordBatch]:
    step = max(1, (1 << 22) // (len(two[0]) * sig_1.shape[1] * 8))
    for i in range(0, len(one[0]), step):
        n = one[0][i:i + step, None]
        ok = (one[2][i:i + step, None] != two[2][None]) & (100 * np.minimum(n, two[0]) >= PERCENT * np.maximum(n, two[0]))
        if same:
            ok &= np.arange(i, i + len(n))[:, None] < np.arange(len(two[0]))[None]
        p, q = np.nonzero(ok)
        new = ~_met(one[3][i + p], two[3][q])
        p, q = p[new], q[new]
        if not p.size:
            continue
        fits = may_link(one[0][i + p], sig_1[i + p], two[0][q], sig_2[q])
        a, b = one[1][i + p[fits]], two[1][q[fits]]
        if a.size:
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _sized(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that sizes and bitmaps let through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            ok = np.zeros(len(n_a), bool)
            for i, (s, t) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                size = min(len(s), len(t))
                ok[i] = may_link(n_a[i], folded([s], size)[0], n_b[i], folded([t], size)[0])
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:2]], ["a", "b"])

    info = nodes.select("id", "n", "sig")
    both = pairs.join(info.toDF("a", "n_a", "sig_a"), "a").join(info.toDF("b", "n_b", "sig_b"), "b")
    return both.select("a", "b", "n_a", "n_b", "sig_a", "sig_b").mapInArrow(run, "a bigint, b bigint").distinct()


def _exact(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that link, by intersecting their sorted arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for s, t in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                ok.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """``(id, comp)`` of every id in ``links`` (a, b): the smallest id it reaches.

    Alternates large-star and small-star steps, each a grouped minimum and a join, on written
    tables until the edges are stars; nothing is collected but one checksum a step.  Steps have short
    plans with few shuffles, since the driver keeps a record of each plan, stage and task.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        # An edge leads from its larger end u to its smaller one v, so v's smallest neighbour, if below v, is that of v's own edges.
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        large = edges.join(least.withColumnRenamed("u", "v"), "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # Of each u the edge to its smallest neighbour stays; the other neighbours go to that one.
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        edges = written(small, "edges", edges)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())


def _sets(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(id, set)``: the shingles of the documents in ``pairs``.  A bitmap of FILTER_BITS bits keeps
    tasks from hashing, and shuffling, texts of other ids (more ids than that only let more through)."""
    # Written, so that the join below knows its size before texts are hashed.
    ids = written(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "ids")
    bit = F.pmod("id", F.lit(FILTER_BITS)).cast("bigint") + 1
    marks = ids.groupBy(F.bitmap_bucket_number(bit).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    marked = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in marks:                            # FILTER_BITS / 32768 rows of 4 KB at most
        at = (r["k"] - 1) * 4096
        marked[at:at + 4096] = np.frombuffer(r["bits"], np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [-1 if i is None else i % FILTER_BITS for i in batch.column(0).to_pylist()]
            rows = [r for r, k in enumerate(keys) if k >= 0 and marked[k >> 3] >> (k & 7) & 1]
            sets = [g.tobytes() for g in shingle_sets(batch.column(1)[r].as_buffer() for r in rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sets, pa.binary())], ["id", "set"])

    found = docs.select("id", "text").mapInArrow(run, "id bigint, set binary").where("length(set) > 0")
    return written(found.join(ids, "id", "left_semi"), "grams", ids)


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ``docs`` (id, text): the described rows, and the links found between nodes, enough of
    them that nodes linked by any chain are connected."""
    bound_batches(docs.sparkSession)
    described = written(_described(docs, _frequent(docs)), "sets", gather=False)
    rows = written(described.select("id", "n", "digest"), "rows")
    named = _named(rows)
    nodes = described.join(named, (described["digest"] == named["of"]) & (described["id"] == named["node"]), "left_semi")
    every = written(_tiles(nodes), "all-tiles")
    tiles = written(_distinct_tiles(every), "tiles", every)
    # Only members of tiles are compared: the others' bitmaps and prefixes go.
    members = tiles.select("id").distinct()
    info = written(nodes.join(members, "id", "left_semi").select("id", "n", "sig", "short").distinct(), "info", described)
    stars = (tiles.where(f"id <> first and 100 * least(n, first_n) >= {PERCENT} * greatest(n, first_n)")
             .select(F.least("id", "first").alias("a"), F.greatest("id", "first").alias("b")).distinct())
    found = _linked(docs, written(_sized(stars, info), "pairs"), info, None)
    comp = components(found)
    mixed = written(_mixed(tiles, comp), "mixed", tiles)
    more = written(_sized(_second_stars(mixed), info), "pairs")
    if more.isEmpty():
        release(more)
        mixed = written(_earlier(mixed), "mixed", mixed)
    else:
        found = _linked(docs, more, info, found)
        mixed = written(_earlier(_mixed(mixed, components(found))), "mixed", mixed)
    pairs = written(_cross_pairs(_block_pairs(mixed).join(info.select("id", "n", "short"), ["id", "n"])), "pairs", mixed)
    return rows, _linked(docs, written(_sized(pairs, info), "pairs", pairs), info, found)


def _mixed(tiles: DataFrame, comp: DataFrame) -> DataFrame:
    """``(h, n, id, comp, members)``: the members of tiles that hold several components."""
    inside = tiles.select("h", "n", "id").join(comp, "id", "left").select("h", "n", "id", F.coalesce("comp", "id").alias("comp"))
    several = (inside.groupBy("h").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("members"))
               .where("x <> y").select("h", "members"))
    return inside.join(several, "h").select("h", "n", "id", "comp", "members")


def _second_stars(mixed: DataFrame) -> DataFrame:
    """Pairs of a tile's members with one member of its largest component, where that has several in the tile.
    The member is chosen by a hash with the tile, so a document meets others of the component in other tiles.
    Never more pairs than rows, while a group that the first round left in parts mostly becomes one."""
    one = F.min(F.struct(F.xxhash64("h", "id").alias("by"), "id", "n"))
    parts = mixed.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("rows"), one.alias("one")).where("rows > 1")
    best = parts.groupBy("h").agg(F.max(F.struct("rows", "comp", "one")).alias("best"))
    best = best.select("h", F.col("best.comp").alias("to_comp"), F.col("best.one.id").alias("to"), F.col("best.one.n").alias("to_n"))
    return (mixed.join(best, "h").where(f"comp <> to_comp and 100 * least(n, to_n) >= {PERCENT} * greatest(n, to_n)")
            .select(F.least("id", "to").alias("a"), F.greatest("id", "to").alias("b")).distinct())


def _linked(docs: DataFrame, pairs: DataFrame, info: DataFrame, known: DataFrame | None) -> DataFrame:
    """``known`` links and those of ``pairs`` (written, and deleted at the end) that link, enough of them that whatever
    they all connect is connected.

    The set of one of a pair is sent to the other's.  A step takes as many pairs, by a hash, as send about as
    much as all sets of the pairs hold; then pairs that have come into one component are dropped."""
    none = pairs.select("a", "b").limit(0) if known is None else known
    if pairs.isEmpty():
        release(pairs)
        return none
    sets = _sets(docs, pairs)
    size = info.select("id", (8 * F.col("n")).alias("size"))
    held = sets.agg(F.sum(F.octet_length("set"))).first()[0] or 0
    found, step = known, 0
    while True:
        sent = pairs.join(size, pairs["a"] == size["id"]).agg(F.sum("size")).first()[0] or 0
        if not sent:
            break
        steps = math.ceil(sent / max(held, STEP_BYTES))
        now = F.pmod(F.xxhash64(F.lit(step), "a", "b"), F.lit(steps)) == 0
        part = written(_exact(pairs.where(now), sets), "links")
        found, step = part if found is None else found.unionByName(part), step + 1
        if steps == 1:
            break
        comp = components(found)
        left = pairs.where(~now).join(comp.toDF("a", "comp_a"), "a", "left").join(comp.toDF("b", "comp_b"), "b", "left")
        left = left.where(~F.coalesce(F.col("comp_a") == F.col("comp_b"), F.lit(False))).select("a", "b")
        pairs = written(left, "pairs", pairs)
    release(pairs, sets)
    return none if found is None else found


def _named(rows: DataFrame) -> DataFrame:
    """``(of, node)``: the smallest id of each digest."""
    known = rows.where("digest is not null and id is not null")
    return known.groupBy(F.col("digest").alias("of")).agg(F.min("id").alias("node"))


def classes(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id)`` of each row of ``df``."""
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    rows, found = links(docs)
    named = _named(rows)
    rows = rows.select("id", "n", "digest").join(named, rows["digest"] == named["of"], "left").select("id", "n", "node")
    comp = components(found.unionByName(_shared_ids(rows)))
    placed = rows.select("id", "n", F.coalesce("node", "id").alias("node")).join(comp.toDF("node", "comp"), "node", "left")
    return gathered(placed.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                                 F.when(F.col("id").isNotNull(), F.coalesce("comp", "node")).alias("component_id")))


def _shared_ids(rows: DataFrame) -> DataFrame:
    """An id whose rows belong to several nodes links them (and itself) like any other link."""
    own = rows.where("node is not null").select("id", "node")
    several = own.groupBy("id").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y").select("id")
    return own.join(several, "id").select(F.col("id").alias("a"), F.col("node").alias("b"))


def first_of_each(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` without near copies: of each component the document with the smallest id,
    once; rows with a null id stay.

    Rows are not shuffled to learn that they stay: a filter of FILTER_WORDS words, of known size whatever the
    data, marks the ids that go or have several rows.  Only rows with a marked id are looked up (with more
    such ids than bits, most rows)."""
    found = classes(df, id_col=id_col, text_col=text_col)
    word, mask, odd_id, odd_rows, marked = _fresh(df, "word", "mask", "odd_id", "odd_rows", "marked")
    odd = (found.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias(odd_id))
           .agg(F.min("component_id").alias("first"), F.count(F.lit(1)).alias("rows")).where(f"`{odd_id}` <> first or rows > 1"))
    odd = written(odd.select(odd_id, F.when(F.col(odd_id) == F.col("first"), F.col("rows")).otherwise(F.lit(0)).alias(odd_rows)), "odd")
    bits = odd.select(_word(F.col(odd_id)).alias(word), _mask(F.col(odd_id)).alias(mask)).groupBy(word).agg(F.bit_or(mask).alias(mask))
    row_id = F.col(f"`{id_col}`").cast("bigint")
    df = df.withColumn(word, _word(row_id)).join(F.broadcast(bits), word, "left")     # FILTER_WORDS rows at most
    df = df.withColumn(marked, row_id.isNotNull() & F.coalesce(F.col(mask).bitwiseAND(_mask(row_id)) != 0, F.lit(False)))
    cols = [F.col(f"`{c}`") for c in df.columns if c not in (word, mask, marked)]
    looked_up = df.where(F.col(marked)).select(*cols, row_id.alias(word)).join(odd, F.col(word) == F.col(odd_id), "left")
    single = looked_up.where(F.col(odd_rows).isNull()).select(*cols)
    # Only ids with several rows are compared row by row.
    several = looked_up.where(F.col(odd_rows) > 1).select(*cols).dropDuplicates([id_col])
    return df.where(~F.col(marked)).select(*cols).unionByName(single).unionByName(several)


def _word(key: Column) -> Column:
    """The 64-bit word of the filter that holds an id's bit."""
    return F.pmod(F.xxhash64(key), F.lit(FILTER_WORDS))


def _mask(key: Column) -> Column:
    """The id's bit in its word, by other bits of the hash."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(F.xxhash64(key), 58).cast("int"))
