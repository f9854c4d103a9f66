"""Lines repeated over many documents (runs) of one collection.

Each document's lines become 64-bit identifiers, read from the texts once.  The
concatenated identifiers of a collection are indexed by a suffix array built by
prefix doubling: suffixes that agree in their first 2^k lines form an interval of
the array and share one name; the names of 2^(k+1) lines are pairs of names, taken
only where both halves still stand in enough documents, so the array thins out
from round to round and long blocks cost no more than their logarithm.  A descent
through the rounds gives each suffix the longest prefix that enough documents
share; those that no earlier one contains are the repeated blocks, and their lines
are what is found and deleted.

Documents are counted exactly: distinct documents per name, by a shuffle over name
and salt of the document, so that neither a hot collection nor a hot line meets in
one task; the number of tasks follows the input's size.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folium.llm.shingles import _powers, mix
from folium.runtime import materialize, small_side, stored_bytes

#: Stored bytes of lines that one task counts.
PART_BYTES = 16 << 20
#: Least number of parts in which the documents of one line are counted apart.
SALTS = 16


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point its class (0 separator, 1 letter, 2 digit) and a mixed code of its lower case."""
    kind, code = np.zeros(0x110000, np.uint8), np.zeros(0x110000, np.uint64)
    for cp in range(0x110000):
        c = unicodedata.category(chr(cp))
        if c[0] == "L":
            kind[cp] = 1
            low = chr(cp).lower()
            code[cp] = ord(low) if len(low) == 1 else cp
        elif c == "Nd":
            kind[cp] = 2
    return kind, mix(code + np.uint64(0x9E3779B9))


def _words(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of the words in code points, and where each begins. Case and digits are ignored; what is neither letter nor digit parts words."""
    kind, code = _tables()
    k = kind[cp]
    live = np.flatnonzero(k != 2)  # digits vanish
    letter = k[live] == 1
    edge = np.diff(np.concatenate(([0], letter.view(np.int8), [0])))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(1 << max(16, int(len(cp)).bit_length()))
    total = np.zeros(len(live) + 1, np.uint64)
    np.cumsum(code[cp[live]] * up[: len(live)] * letter, out=total[1:])
    return mix((total[b] - total[a]) * down[a]), live[a]


def _line_ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines of each text: (index of the text, number from 1, identifier, words)."""
    cp = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    breaks = np.flatnonzero(cp == 10)
    starts = np.concatenate(([0], breaks + 1))
    text_of = np.searchsorted(first, starts, side="right") - 1
    number = np.arange(len(starts)) - np.searchsorted(starts, first)[text_of] + 1
    word, where = _words(cp)
    line = np.searchsorted(starts, where, side="right") - 1
    words = np.bincount(line, minlength=len(starts))
    nth = (np.arange(len(word)) - (np.cumsum(words) - words)[line]).astype(np.uint64)
    part = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(mix(word + mix(nth + np.uint64(1))), out=part[1:])
    end = np.cumsum(words)
    return text_of, number, mix(part[end] - part[end - words]), words


def _chunks(sizes: np.ndarray, most: int):
    total = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def lines_of(blocks: pa.Array, chars: int = 1 << 17) -> tuple[np.ndarray, ...]:
    """Every line of every page of the batch in reading order: (page index, block_order, line_no, identifier, words)."""
    flat = blocks.flatten()
    page = pc.list_parent_indices(blocks).to_numpy()
    text = pc.fill_null(flat.field("text"), "")
    order = pc.fill_null(flat.field("block_order"), 0).to_numpy(zero_copy_only=False)
    by = np.lexsort((np.arange(len(page)), order, page))
    texts, page, order = text.take(pa.array(by)).to_pylist(), page[by], order[by]
    out = []
    for lo, hi in _chunks(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)), chars):
        t, number, ident, words = _line_ids(texts[lo:hi])
        out.append((page[lo:hi][t], order[lo:hi][t], number, ident, words))
    if not out:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*out))


_PAGE = "row_id long, coll long, run long, page long, names binary, orders binary, numbers binary"


def _read(least: int):
    """(row_id, coll, run, page, blocks) -> the page's lines of at least so many words: names, block orders and numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            page, order, number, ident, words = lines_of(b.column(4))
            ok = words >= least
            page, name, order, number = page[ok], mix(ident[ok]), order[ok].astype("<i8"), number[ok].astype("<i4")
            edge = np.searchsorted(page, np.arange(b.num_rows + 1))
            has = np.flatnonzero(np.diff(edge))
            cut = lambda x: pa.array([x[edge[i] : edge[i + 1]].tobytes() for i in has], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(pa.array(has)) for k in range(4)), cut(name), cut(order), cut(number)], names=["row_id", "coll", "run", "page", "names", "orders", "numbers"])

    return run


def _unpacked(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All names of a batch of pages and the index of the page of each."""
    parts = [np.frombuffer(x, "<u8") for x in b.column(4).to_pylist()]
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.repeat(np.arange(len(parts)), [len(x) for x in parts])


def _spread(parts: int, salts: int):
    """Distinct (collection, name, run) of each batch, packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            name, page = _unpacked(b)
            if not len(name):
                continue
            coll, run_id = b.column(1).to_numpy().view(np.uint64)[page], b.column(2).to_numpy().view(np.uint64)[page]
            rows = np.column_stack((coll, name, run_id))
            order = np.lexsort((run_id, name, coll))
            rows = rows[order]
            rows = rows[np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1)))]
            part = (mix(rows[:, 0] + rows[:, 1] + mix(rows[:, 2] % np.uint64(salts))) % np.uint64(parts)).astype(np.int64)
            by = np.argsort(part, kind="stable")
            rows = rows[by]
            edge = np.searchsorted(part[by], np.arange(parts + 1))
            has = np.flatnonzero(np.diff(edge))
            cut = lambda k: pa.array([np.ascontiguousarray(rows[edge[p] : edge[p + 1], k]).tobytes() for p in has], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), cut(0), cut(1), cut(2)], names=["part", "colls", "names", "runs"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, list] = {}
    for b in batches:
        for p, *x in zip(*(c.to_pylist() for c in b.columns)):
            parts.setdefault(p, []).append([np.frombuffer(v, "<u8") for v in x])
    for p in list(parts):
        coll, name, run = (np.concatenate(x) for x in zip(*parts.pop(p)))
        order = np.lexsort((run, name, coll))
        coll, name, run = coll[order], name[order], run[order]
        new = np.concatenate(([True], (coll[1:] != coll[:-1]) | (name[1:] != name[:-1])))
        fresh = new | np.concatenate(([True], run[1:] != run[:-1]))
        head = np.flatnonzero(new)
        runs = np.add.reduceat(fresh.astype(np.int64), head) if len(head) else head
        yield pa.RecordBatch.from_arrays([pa.array(coll[head].view(np.int64)), pa.array(name[head].view(np.int64)), pa.array(runs)], names=["coll", "block", "runs"])


def _scoped(pages: DataFrame, collection, run: str) -> DataFrame:
    c = pages.select(collection.alias("c"), F.col(run).alias("r"), "row_id", "blocks").where(F.col("c").isNotNull() & (F.col("c") != ""))
    return c.withColumn("coll", F.xxhash64("c"))


def _first_source():
    return F.element_at(F.expr("if(size(source) > 0, source, null)"), 1)


class Repeats:
    """The lines of a table's pages and which of them repeat: `lines` (stored pages as packed lines), `enough` (of rows with coll and runs, those of enough documents), `cases` (coll, block, runs: the names of single lines)."""

    def __init__(self, pages: DataFrame, run: str = "run_id", least_words: int = 3, least_runs: int = 5, least_share: float = 0.1, part_bytes: int = PART_BYTES):
        spark = pages.sparkSession
        scoped = _scoped(pages, _first_source(), run).where(F.col("r").isNotNull())
        total = small_side(materialize(scoped.groupBy("coll").agg(F.countDistinct("r").alias("all_runs")), "collections"))
        self.enough = lambda df: df.where(F.col("runs") >= least_runs).join(total, "coll").where(F.col("runs") >= least_share * F.col("all_runs")).drop("all_runs")
        rows = scoped.where(F.size("blocks") > 0).select("row_id", "coll", F.xxhash64("r").alias("run"), F.monotonically_increasing_id().alias("page"), "blocks")
        self.lines = materialize(rows.mapInArrow(_read(least_words), _PAGE), "lines")
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, -(-stored_bytes(self.lines) // part_bytes))
        packed = self.lines.mapInArrow(_spread(parts, max(SALTS, parts // 4)), "part int, colls binary, names binary, runs binary")
        counts = packed.repartitionById(parts, F.col("part")).mapInArrow(_counted, "coll long, block long, runs long")
        self.cases = materialize(self.enough(counts.groupBy("coll", "block").agg(F.sum("runs").alias("runs"))), "repeated")

    def occurrences(self) -> DataFrame:
        """Each occurrence of a repeated line: row_id, coll, run, page, pos (of the line in its page), block_order, line_no, name."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                name, page = _unpacked(b)
                order, number = (np.concatenate([np.frombuffer(x, k) for x in b.column(c).to_pylist()] or [np.empty(0, k)]) for c, k in ((5, "<i8"), (6, "<i4")))
                at = pa.array(page)
                pos = np.arange(len(page)) - np.searchsorted(page, page)
                yield pa.RecordBatch.from_arrays([*(b.column(k).take(at) for k in range(4)), pa.array(pos), pa.array(order), pa.array(number.astype(np.int64)), pa.array(name.view(np.int64))], names=["row_id", "coll", "run", "page", "pos", "block_order", "line_no", "block"])

        rows = self.lines.mapInArrow(run, "row_id long, coll long, run long, page long, pos long, block_order long, line_no long, block long")
        return rows.join(small_side(self.cases), ["coll", "block"]).withColumnRenamed("block", "name")

    def _shared(self, rows: DataFrame) -> DataFrame:
        """Of suffixes with a name those whose name enough documents share, with the number of documents: columns as before and runs."""
        runs = self.enough(rows.groupBy("coll", "name", "run").agg(F.lit(1).alias("one")).groupBy("coll", "name").agg(F.count("*").alias("runs")))
        return rows.join(runs, ["coll", "name"])

    def spans(self) -> DataFrame:
        """Occurrences of repeated lines, each with the longest repeated block that begins there: as occurrences(), and lines (of that block), block (its name), runs (its documents) and maximal (no earlier block of the page contains it)."""
        single = materialize(self.occurrences(), "occurrences")
        place = ["coll", "run", "page", "pos", "name", "runs"]
        rounds = [single.select(*place)]
        while True:  # names of twice as many lines, until no block of that length repeats
            k = 1 << (len(rounds) - 1)
            half = rounds[-1]
            rest = half.select("page", (F.col("pos") - k).alias("pos"), F.col("name").alias("_rest"))
            twice = half.drop("runs").join(rest, ["page", "pos"]).withColumn("name", F.xxhash64("name", "_rest")).drop("_rest")
            twice = materialize(self._shared(twice).select(*place), "round")
            if twice.isEmpty():
                break
            rounds.append(twice)
        long = None
        for k in reversed(range(1, len(rounds))):  # the longest prefix of each suffix, by halving
            begin = rounds[k].withColumn("lines", F.lit(1 << k)).select("page", "pos", "coll", "run", "lines", "name", "runs")
            long = begin if long is None else long.unionByName(begin.join(long, ["page", "pos"], "left_anti"))
            long = materialize(long, "prefixes")
            for j in reversed(range(k)):
                more = rounds[j].select("page", F.col("pos").alias("_at"), F.col("name").alias("_more"))
                longer = long.where(F.col("lines") % (1 << (j + 1)) == 0).withColumn("_at", F.col("pos") + F.col("lines")).join(more, ["page", "_at"])
                longer = longer.select("page", "pos", "coll", "run", (F.col("lines") + (1 << j)).alias("lines"), F.xxhash64("name", "_more").alias("name"))
                longer = self._shared(longer).select(*long.columns)
                long = materialize(longer.unionByName(long.join(longer.select("page", "pos"), ["page", "pos"], "left_anti")), "prefixes")
        if long is None:
            rows = single.select("*", F.lit(1).alias("lines"), F.col("name").alias("block"))
        else:
            far = long.select("page", "pos", F.col("lines").alias("_lines"), F.col("name").alias("_block"), F.col("runs").alias("_runs"))
            rows = single.join(far, ["page", "pos"], "left").select(*[c for c in single.columns if c != "runs"], F.coalesce("_runs", "runs").alias("runs"), F.coalesce("_lines", F.lit(1)).alias("lines"), F.coalesce("_block", "name").alias("block"))
        w = Window.partitionBy("page").orderBy("pos")
        reach = F.max(F.col("pos") + F.col("lines")).over(w.rowsBetween(Window.unboundedPreceding, -1))
        rows = rows.withColumn("_reach", F.coalesce(reach, F.lit(0)))
        return rows.withColumn("maximal", F.col("pos") + F.col("lines") > F.col("_reach")).withColumn("covered", F.col("maximal") | (F.col("_reach") > F.col("pos"))).drop("_reach")


def repeated_blocks(pages: DataFrame, run: str = "run_id", least_words: int = 3, least_runs: int = 5, least_share: float = 0.1, **how) -> DataFrame:
    """Blocks of successive lines, of any length, that many documents of a collection share and that no longer one contains where they stand: lines, coll, block, runs.

    coll is the 64-bit hash of the collection, block the name of the lines.  A
    block counts from least_runs distinct documents and least_share of the
    collection's documents on.  Lines of fewer than least_words words neither
    count nor part a block.  Pages without a collection or run take no part; a
    repeated page adds no document; an empty table gives no rows.
    """
    spans = Repeats(pages, run, least_words, least_runs, least_share, **how).spans()
    return spans.where("maximal").groupBy("lines", "coll", "block").agg(F.max("runs").alias("runs"))


def repeated_lines(pages: DataFrame, run: str = "run_id", least_words: int = 3, least_runs: int = 5, least_share: float = 0.1, **how) -> DataFrame:
    """The lines of all repeated blocks, at every occurrence: row_id, block_order, line_no. Pages with a null or empty collection give none; repeated rows give their own."""
    return Repeats(pages, run, least_words, least_runs, least_share, **how).spans().where("covered").select("row_id", "block_order", "line_no")


def _lines(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            page, order, number, ident, words = lines_of(b.column(2))
            ok = words >= least
            at = pa.array(page[ok])
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(order[ok]), pa.array(number[ok]), pa.array(mix(ident[ok]).view(np.int64))], names=["row_id", "coll", "block_order", "line_no", "block"])

    return run


def occurrences(pages: DataFrame, cases: DataFrame, run: str = "run_id", least_words: int = 3) -> DataFrame:
    """Where given lines (coll, block) stand: row_id, block_order, line_no."""
    scoped = _scoped(pages, _first_source(), run).where(F.size("blocks") > 0)
    at = scoped.select("row_id", "coll", "blocks").mapInArrow(_lines(least_words), "row_id long, coll long, block_order long, line_no long, block long")
    return at.join(small_side(cases), ["coll", "block"], "left_semi").select("row_id", "block_order", "line_no")


def clean_pages(pages: DataFrame, lines: DataFrame) -> DataFrame:
    """Pages without the given lines (row_id, block_order, line_no): row_id and blocks; a block left without text is dropped, the rest keep type, order and attributes."""
    gone = lines.groupBy("row_id").agg(F.collect_set(F.struct("block_order", "line_no")).alias("gone"))
    both = pages.select("row_id", "blocks").join(gone, "row_id", "left")
    kept = F.expr("""
      filter(transform(blocks, b -> struct(b.block_type AS block_type,
        array_join(filter(transform(split(coalesce(b.text, ''), '\n'), (t, i) -> if(gone IS NOT NULL AND array_contains(gone, struct(b.block_order AS block_order, cast(i + 1 AS bigint) AS line_no)), null, t)), t -> t IS NOT NULL), '\n') AS text,
        b.block_order AS block_order, b.attrs AS attrs)), x -> x.text != '')""")
    return both.select("row_id", kept.alias("blocks"))
