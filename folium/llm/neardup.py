"""Near-duplicate texts by a blocked sparse product of the text x n-gram incidence.

The product of the incidence matrix with its transpose counts, for each pair of
texts, the columns (n-grams) that they share.  Only what bounds on sizes leave is
computed: with the columns in order of rarity (from count sketches of fixed size
over all texts), two texts of similarity t share a column among the first
n - ceil(t n) + 1 of either, so only these cells of the matrix are kept.  The
matrix is cut into blocks of columns; a cell goes to one block and a text to the
blocks of its cells, with its size and a parity bitmap of all its columns.  No
text is sent as a whole, and the number of blocks follows the input, so a block
stays small at any size.

Within a block the cells of a column are paired, rows sorted by size.  A pair goes
on only if sizes, places and bitmaps allow the overlap that t asks for: each column
that one text has alone flips one bit, so the differing bits never exceed the
differing columns.  All these bounds are exact, so no pair is lost; what is left is
verified on whole texts.  Columns of very many texts are cut into chunks of rows
whose pairs are separate pieces of work.

Exact copies are one row of the matrix (named by the 64-bit hash of their text),
so a group of copies costs one row however large it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.llm.shingles import WORD_BITS, gram_sets, mix
from folium.runtime import materialize, release, settle, small_side

#: Bytes of cells and texts that one column block is meant to get.
BLOCK_BYTES = 48 << 20
#: Slots of the count sketch that orders columns (one byte each).
SKETCH_BITS = 22
#: Texts of a column beyond which it is cut into chunks.
HOT = 8192
#: Columns of a text for which a bitmap of 256 bits is used; twice as many get twice the bits, and so on.
WIDTH = 192

_SHARD = "part int, ids binary, sizes binary, counts binary, bits binary, cols binary, pos binary"


def _pack(g: np.ndarray) -> bytes:
    """48-bit values in 6 bytes each."""
    return np.ascontiguousarray(g.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    six = np.frombuffer(b, np.uint8).reshape(-1, 6)
    eight = np.zeros((len(six), 8), np.uint8)
    eight[:, :6] = six
    return eight.reshape(-1).view("<u8")


def _sets(batch: pa.RecordBatch, n: int, least: int, level: np.ndarray | None = None, tally: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, sizes, grams) of the batch's distinct texts with at least so many words."""
    ids = batch.column(0).to_numpy()
    ids, first = np.unique(ids, return_index=True)
    texts = batch.column(1).take(pa.array(first)).to_pylist()
    g, off, words = gram_sets(texts, n, level=level, tally=tally)
    size = np.diff(off)
    ok = (words >= least) & (size > 0)
    return ids[ok], size[ok], g[np.repeat(ok, size)]


def _need(n: np.ndarray, t: Fraction) -> np.ndarray:
    return -(-t.numerator * n // t.denominator)


# ---------------------------------------------------------------- order of the columns


def _sketch(n: int, least: int, t: Fraction):
    """Counts of columns and of words per slot, in pieces (k, v); piece -1 holds the numbers of cells and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, words, cells = np.zeros(1 << SKETCH_BITS, np.int64), np.zeros(1 << WORD_BITS, np.int64), 0
        for b in batches:
            if b.num_rows:
                _, size, g = _sets(b, n, least, tally=words)
                grams += np.bincount((g >> np.uint64(48 - SKETCH_BITS)).astype(np.int64), minlength=len(grams))
                cells += int((size - _need(size, t) + 1).sum())
        rows = [*grams.reshape(-1, 1 << 14), *words.reshape(-1, 1 << 14), np.array([cells, words.sum()], np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(rows) - 1), -1], pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())], names=["k", "v"])

    return run


def _sum(key: tuple, t: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(v, np.int64) for v in t.column("v").to_pylist()], axis=0)
    k = key[0].as_py()
    out = total if k < 0 else np.minimum(255, np.round(4 * np.log2(total + 1))).astype(np.uint8)
    return pa.table({"k": [k], "v": [out.tobytes()]}, schema=pa.schema([("k", pa.int32()), ("v", pa.binary())]))


# ---------------------------------------------------------------- cells of the matrix


def _bitmaps(codes: np.ndarray, doc: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity bitmaps of whole rows as 64-bit words, and the number of words of each row."""
    width = 4 << np.maximum(0, np.ceil(np.log2(np.maximum(size, 1) / WIDTH))).astype(np.int64)
    at = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), np.uint64)
    h = mix(codes)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        new = np.full(len(size), -1)
        new[rows] = np.arange(len(rows))
        mine = new[doc] >= 0
        bit = new[doc[mine]] * (64 * w) + (h[mine] & np.uint64(64 * w - 1)).astype(np.int64)
        odd = (np.bincount(bit, minlength=len(rows) * 64 * w) & 1).astype(np.uint8)
        out[at[rows][:, None] + np.arange(w)] = np.packbits(odd, bitorder="little").view("<u8").reshape(len(rows), w)
    return out, width


def _cells(n: int, least: int, t: Fraction, parts: int, words: int, levels, most: int):
    """Each text's cells among its rarest columns, by block of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.frombuffer(levels.value, np.uint8)
        level, word_level = both[: 1 << SKETCH_BITS], both[1 << SKETCH_BITS :]
        # a word that many columns belong to is spread over several blocks
        spread = np.maximum(1, np.ceil(np.exp2(word_level / 4.0) * 16 * parts / max(1, words))).astype(np.uint64)
        for whole in batches:
            for lo in range(0, whole.num_rows, 1 << 14):
                b = whole.slice(lo, 1 << 14)
                ids, size, code = _sets(b, n, least, level=word_level)
                if not len(ids):
                    continue
                doc = np.repeat(np.arange(len(ids)), size)
                start = np.cumsum(size) - size
                bits, width = _bitmaps(code, doc, size)
                lv = level[((code & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - SKETCH_BITS)).astype(np.int64)]
                order = np.argsort((doc.astype(np.uint64) << np.uint64(48)) | (lv.astype(np.uint64) << np.uint64(40)) | (code & np.uint64((1 << 40) - 1)))
                pos = np.arange(len(code)) - np.repeat(start, size)
                use = (pos <= np.repeat(size - _need(size, t), size)) & (lv[order] > 4)  # at level 4 and below one text alone has it
                at = order[use]
                d, c, lv, pos = doc[at], code[at], lv[at], pos[use].astype(np.uint32)
                times = np.exp2(lv / 4.0)
                hot = np.flatnonzero(times > most)
                if len(hot):
                    cold = np.flatnonzero(times <= most)
                    cut = [(d[cold], c[cold], c[cold], pos[cold])]
                    for chunks in np.unique(np.ceil(times[hot] / most)).astype(np.int64):
                        x = hot[np.ceil(times[hot] / most).astype(np.int64) == chunks]
                        own = (mix(ids[d[x]].view(np.uint64) + np.uint64(7)) % np.uint64(chunks)).astype(np.int64)
                        for other in range(chunks):
                            i, j = np.minimum(own, other), np.maximum(own, other)
                            side = np.where(own > other, np.uint32(1 << 31), np.uint32(0)) | np.where(own != other, np.uint32(1 << 30), np.uint32(0))
                            cut.append((d[x], mix(c[x] + mix((i * chunks + j).astype(np.uint64) + np.uint64(1))) >> np.uint64(16), c[x], pos[x] | side))
                    d, name, c, pos = (np.concatenate(v) for v in zip(*cut))
                else:
                    name = c
                slot = c >> np.uint64(32)
                part = (mix(slot + (mix(name) % spread[slot.astype(np.int64)] << np.uint64(20)) + np.uint64(3)) % np.uint64(parts)).astype(np.int64)
                by = np.argsort((part.astype(np.uint64) << np.uint64(32)) | d.astype(np.uint64), kind="stable")
                part, d, name, pos = part[by], d[by], name[by], pos[by]
                head = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (d[1:] != d[:-1]), [True]))) if len(d) else np.zeros(1, np.int64)
                row, count = d[head[:-1]], np.diff(head)
                row_part = part[head[:-1]]
                edge, cell = np.searchsorted(row_part, np.arange(parts + 1)), np.searchsorted(part, np.arange(parts + 1))
                first = np.cumsum(width) - width
                out: tuple = ([], [], [], [], [], [], [])
                for p in np.flatnonzero(np.diff(edge)):
                    r = row[edge[p] : edge[p + 1]]
                    w = width[r]
                    words_at = np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w) + np.repeat(first[r], w)
                    z = slice(cell[p], cell[p + 1])
                    for x, v in zip(out, (int(p), ids[r].tobytes(), size[r].astype("<u4").tobytes(), count[edge[p] : edge[p + 1]].astype("<u4").tobytes(), bits[words_at].tobytes(), _pack(name[z]), pos[z].tobytes())):
                        x.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])], names=["part", "ids", "sizes", "counts", "bits", "cols", "pos"])

    return run


# ---------------------------------------------------------------- product of a block


def _folded(bits: np.ndarray, at: np.ndarray, width: np.ndarray, to: int) -> np.ndarray:
    """The bitmaps of rows (words from `at` on), folded to `to` words each."""
    out = np.zeros((len(at), to), np.uint64)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        out[rows] = np.bitwise_xor.reduce(bits[at[rows][:, None] + np.arange(w)].reshape(len(rows), w // to, to), axis=1)
    return out


def _product(ids: np.ndarray, n: np.ndarray, count: np.ndarray, bits: np.ndarray, cols: np.ndarray, pos: np.ndarray, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block's rows that no bound rules out: two arrays of ids."""
    width = 4 << np.maximum(0, np.ceil(np.log2(np.maximum(n, 1) / WIDTH))).astype(np.int64)
    at = np.cumsum(width) - width
    by_size = np.argsort(n, kind="stable")  # of two rows, the lower number is the smaller set
    number = np.empty(len(n), np.uint32)
    number[by_size] = np.arange(len(n), dtype=np.uint32)
    d = np.repeat(number, count)
    ids, n, at, width = ids[by_size], n[by_size], at[by_size], width[by_size]
    base = _folded(bits, at, width, 4)
    order = np.argsort(cols).astype(np.uint32)
    cols = cols[order]
    group = np.flatnonzero(np.concatenate(([True], cols[1:] != cols[:-1], [True])))
    size = np.diff(group)
    many = np.repeat(size > 1, size)
    column = np.repeat(np.arange(int((size > 1).sum()), dtype=np.uint64), size[size > 1])
    order = order[many]
    cell = (column << np.uint64(32)) | d[order].astype(np.uint64)
    by = np.argsort(cell).astype(np.uint32)
    cell, pos = cell[by], pos[order[by]]
    del order, by, d, cols
    d = cell.astype(np.uint32)
    side, pos = pos >> np.uint32(30), (pos & np.uint32((1 << 30) - 1)).astype(np.int64)
    group = np.flatnonzero(np.concatenate(([True], column[1:] != column[:-1], [True]))) if len(column) else np.zeros(1, np.int64)
    end = np.repeat(group[1:], np.diff(group))
    a, b = t.numerator, t.denominator
    m = n[d]
    # as the smaller side, the largest partner that place and size allow
    most = np.minimum(((m - pos) * (a + b)) // a - m, m * b // a)
    left = np.flatnonzero((most >= m) & (np.arange(len(m)) + 1 < end))
    found, held, step = [], 0, 0
    while len(left):
        step += 1
        left = left[left + step < end[left]]
        right = left + step
        ok = m[right] <= most[left]
        left, right = left[ok], right[ok]
        need = -(-a * (m[left] + m[right]) // (a + b))
        ok = pos[right] <= m[right] - need
        ok &= (d[left] != d[right]) & ((side[left] == 0) | (side[left] != side[right]))  # of two chunks, one row of each
        x, y, need = d[left[ok]], d[right[ok]], need[ok]
        if len(x):
            apart = n[x] + n[y] - 2 * need
            ok = np.bitwise_count(base[x] ^ base[y]).sum(axis=1, dtype=np.int64) <= apart
            x, y, apart = x[ok], y[ok], apart[ok]
            w = np.minimum(width[x], width[y])
            for k in np.unique(w[w > 4]):  # long rows have longer bitmaps
                z = np.flatnonzero(w == k)
                far = np.bitwise_count(_folded(bits, at[x[z]], width[x[z]], int(k)) ^ _folded(bits, at[y[z]], width[y[z]], int(k))).sum(axis=1, dtype=np.int64) > apart[z]
                w[z[far]] = -1
            found.append((x[w > 0].astype(np.uint64) << np.uint64(32)) | y[w > 0].astype(np.uint64))
            held += len(found[-1])
            if held > 1 << 20:
                found = [np.unique(np.concatenate(found))]
                held = 0
    key = np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)
    return ids[(key >> np.uint64(32)).astype(np.int64)], ids[(key & np.uint64(0xFFFFFFFF)).astype(np.int64)]


def _multiply(t: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        kinds = ("<i8", "<u4", "<u4", "<u8", None, "<u4")
        for b in batches:
            for k in range(b.num_rows):
                p, *rest = (c[k].as_py() for c in b.columns)
                parts.setdefault(p, []).append([np.frombuffer(x, kind) if kind else _unpack(x) for x, kind in zip(rest, kinds)])
        for p in list(parts):
            ids, n, count, bits, cols, pos = (np.concatenate(x) for x in zip(*parts.pop(p)))
            x, y = _product(ids, n.astype(np.int64), count.astype(np.int64), bits, cols, pos, t)
            ok = x != y  # copies met in other batches
            x, y = x[ok], y[ok]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return run


def _gram_rows(n: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ids, size, g = _sets(b, n, least)
                at = np.concatenate(([0], np.cumsum(size)))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([_pack(g[i:j]) for i, j in zip(at, at[1:])], pa.binary())], names=["id", "g"])

    return run


def _verify(t: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok, sim = [], []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = _unpack(x), _unpack(y)
                o = len(np.intersect1d(x, y, assume_unique=True))
                u = len(x) + len(y) - o
                ok.append(o * t.denominator >= u * t.numerator)
                sim.append(o / u)
            cols = [b.column(0), b.column(1), pa.array(sim, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=["a", "b", "similarity"]).filter(pa.array(ok, pa.bool_()))

    return run


def similar_texts(texts: DataFrame, n: int = 5, threshold: float = 0.8, least_words: int = 1, block_bytes: int = BLOCK_BYTES, hot: int = HOT) -> DataFrame:
    """Pairs of different texts at or above the threshold: a < b (64-bit text hashes) and similarity.

    texts: columns id (hash of the text) and text, stored (they are read three
    times); rows with the same id are copies and count once.  Null texts and texts
    of fewer words take no part; an empty input gives no pairs.  Whole texts are
    read, of any length.
    """
    t = Fraction(threshold).limit_denominator(1000)
    spark = texts.sparkSession
    texts = texts.select("id", "text").where(F.length("text") >= 2 * least_words - 1)
    sums = texts.mapInArrow(_sketch(n, least_words, t), "k int, v binary").groupBy("k").applyInArrow(_sum, "k int, v binary")
    sums = {r.k: bytes(r.v) for r in sums.collect()}  # a little over 2 ** SKETCH_BITS bytes, whatever the input
    if not sums:
        return spark.createDataFrame([], "a long, b long, similarity double")
    cells, words = (int(x) for x in np.frombuffer(sums.pop(-1), np.int64))
    levels = spark.sparkContext.broadcast(b"".join(sums[k] for k in sorted(sums)))
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-cells * 30 // block_bytes))
    shards = texts.mapInArrow(_cells(n, least_words, t, parts, words, levels, hot), _SHARD)
    pairs = shards.repartitionById(parts, F.col("part")).mapInArrow(_multiply(t), "a long, b long")
    pairs = materialize(pairs.distinct(), "pairs")
    ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    grams = texts.join(small_side(ids), "id", "left_semi").mapInArrow(_gram_rows(n, least_words), "id long, g binary")
    grams = grams.groupBy("id").agg(F.first("g").alias("g"))
    left = pairs.join(grams.select(F.col("id").alias("a"), F.col("g").alias("ga")), "a")
    both = left.join(grams.select(F.col("id").alias("b"), F.col("g").alias("gb")), "b").select("a", "b", "ga", "gb")
    return both.mapInArrow(_verify(t), "a long, b long, similarity double")


def near_duplicates(pages: DataFrame, row_id: str = "row_id", text: str = "text", n: int = 5, threshold: float = 0.8, least_words: int = 1, **how) -> DataFrame:
    """Pairs of rows: row_id_a < row_id_b, similarity. Copies of a text are rows like any other, so each of their pairs comes out (similarity 1)."""
    rows = pages.select(F.col(row_id).alias("row"), F.col(text).alias("text")).where(F.length("text") >= 2 * least_words - 1)
    rows = materialize(rows.withColumn("id", F.xxhash64("text")), "texts")
    pairs = settle(rows.sparkSession, lambda: similar_texts(rows, n, threshold, least_words, **how), "similar")
    member = rows.select("id", "row")
    again = member.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    used = materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(again).distinct(), "used")
    enough = F.size(F.expr(r"regexp_extract_all(text, '[\\p{L}\\p{Nd}]+', 0)")) >= least_words
    member = materialize(rows.join(small_side(used), "id", "left_semi").where(enough).select("id", "row"), "members")
    left, right = member.select(F.col("id").alias("a"), F.col("row").alias("x")), member.select(F.col("id").alias("b"), F.col("row").alias("y"))
    across = pairs.join(left, "a").join(right, "b").select(F.least("x", "y").alias("row_id_a"), F.greatest("x", "y").alias("row_id_b"), "similarity")
    within = left.join(right, left.a == right.b).where("x < y").select(F.col("x").alias("row_id_a"), F.col("y").alias("row_id_b"), F.lit(1.0).alias("similarity"))
    return across.unionByName(within)


def duplicate_groups(pages: DataFrame, row_id: str = "row_id", text: str = "text", n: int = 5, threshold: float = 0.8, least_words: int = 1, **how) -> DataFrame:
    """One row per row_id: row_id, group_id (least row_id that a chain of links reaches) and links (to other texts of the group).

    Copies share their representative and are not expanded into pairs.  Labels
    spread over links between representatives until none changes, one join and
    one aggregation a round, written to the shared folder each time.
    """
    rows = pages.select(F.col(row_id).alias("row"), F.col(text).alias("text")).withColumn("id", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = materialize(rows, "texts")
    pairs = settle(rows.sparkSession, lambda: similar_texts(rows, n, threshold, least_words, **how), "similar")
    edges = materialize(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    label = materialize(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = edges.join(label.select(F.col("a").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = label.join(near, "a").select("a", F.least("label", "near").alias("next"), "label")
        # pointer jumping: the label's own label
        jump = label.select(F.col("a").alias("next"), F.col("label").alias("far"))
        step = materialize(step.join(jump, "next", "left").select("a", F.least("next", F.coalesce("far", "next")).alias("label"), F.col("label").alias("old")), "labels")
        known, label = label, step.select("a", "label")
        release(known)
        if step.where("label != old").isEmpty():
            break
    links = edges.groupBy("a").agg(F.count("*").alias("links"))
    known = label.join(links, "a").select(F.col("a").alias("id"), "label", "links")
    many = rows.select("id", "row").groupBy("id").agg(F.min("row").alias("first_row"))
    reps = many.join(known, "id", "left").withColumn("label", F.coalesce("label", "id"))
    least = reps.groupBy("label").agg(F.min("first_row").alias("group_id"))
    named = reps.join(least, "label").select("id", "group_id", F.coalesce("links", F.lit(0)).alias("links"))
    blank = F.col("text").isNull() | (F.col("text") == "")
    out = rows.select("id", "row", blank.alias("blank")).join(named, "id")
    return out.select(F.col("row").alias("row_id"), F.when(F.col("blank"), F.col("row")).otherwise(F.col("group_id")).alias("group_id"), "links")
