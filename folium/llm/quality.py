"""Statistics of a page's own text and what kind of text it is.

Per page the text without repeated lines, running heads and page numbers is
measured; gradient-boosted trees, fitted on weakly labelled pages (a bounded
sample), tell natural prose from lists, tables and junk by the statistics alone.
Block types serve only for weak labels, never for the decision.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.llm import gbt
from folium.llm.holdout import CALIBRATE
from folium.llm.lines import _line_ids, _scoped, clean_pages, occurrences
from folium.llm.shingles import mix
from folium.runtime import materialize

#: Pages that the classifier is fitted on at most: those of the smallest hashes of row_id.
SAMPLE = 4000
#: Repeated lines that are handed to each task as a sorted array; more are taken out by a join.
KEYS = 1_000_000
CLASSES = ("prose", "list", "table", "junk")

STATS = (
    "n_chars", "n_lines", "n_words", "mean_word_length", "words_per_line", "symbol_ratio", "digit_ratio", "accent_ratio",
    "upper_ratio", "end_punctuation_share", "common_word_share", "distinct_word_share", "top_word_share", "separator_share",
    "bullet_share", "numeric_token_share", "long_token_share", "sentence_share", "short_line_share",
)
#: English function words (fixed values).
COMMON = frozenset("a about after all also an and another any are as at be because been before behind but by could every for from had has have he her his if in into is it its near never nobody not of on one or said see she some soon than that the their them there these they this those though although to under was we were when where which who will with would you".split())

#: Bytes that part words in the statistics: all but ASCII letters, hyphen and apostrophe (other characters are left out).
_APART = bytes(c if chr(c).isalpha() and c < 128 or chr(c) in "-'" else 32 for c in range(256))
_COMMON = frozenset(w.encode() for w in COMMON)
_SEPARATOR = re.compile(r"\t|\||;\s|\S {2,}\S.*?\S {2,}\S")
_BULLET = re.compile(r"\s*(?:[•·*–—‣▪o-]\s|\(?\w{1,3}[.)]\s)")
_LEADER = re.compile(r".*(?:…|\.{3,}|\s{2,})\s*\d+$")  # of lines that end in a digit
_END = (".", "!", "?", "”", ".’", ":", "»", ".'")
NUMBER = re.compile(r"^[\W_]*(?:(?:page|p\.?|seite|s\.)\s*)?[\W_]*(\d{1,4}|[ivxlcdm]{1,9})[\W_]*(?:(?:/|of)\s*\d{1,4})?[\W_]*$", re.I)


_NUMERIC = re.compile(r"\d\S*")  # from the first digit of a token to its end
_FOREIGN = re.compile(r"[^\x00-\x7f]")
_DIGITS, _UPPER = b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTERS, _SPACES, _PLAIN = _UPPER + _UPPER.lower(), b" \t\n\r\x0b\x0c", b".,'-"


def statistics(lines: list[str]) -> list[float]:
    """The statistics of STATS of a text's lines. An empty text gives zeros."""
    lines = [x for x in lines if x and not x.isspace()]
    text = "\n".join(lines)
    if not text:
        return [0.0] * len(STATS)
    n, k = len(text), len(lines)
    # characters of a class are counted by what is left without them
    raw = text.encode("ascii", "ignore")
    m = len(raw)
    digits, upper, letters, spaces, plain = (m - len(raw.translate(None, c)) for c in (_DIGITS, _UPPER, _LETTERS, _SPACES, _PLAIN))
    accents = 0
    if m < n:
        for c, times in Counter(_FOREIGN.findall(text)).items():
            if c.isalpha():
                letters, accents, upper = letters + times, accents + times, upper + times * c.isupper()
            elif c.isdigit():
                digits += times
            elif c.isspace():
                spaces += times
            elif c in "“”":
                plain += times
    parts = [x.split() for x in lines]
    tokens = max(1, sum(map(len, parts)))
    spaced = raw.lower().translate(_APART)
    words = spaced.split()
    w = max(1, len(words))
    count = Counter(words)
    common = sum(count[q] for q in _COMMON.intersection(count))
    sentence = 0
    for x, p in zip(lines, parts):
        if len(p) >= 5 and sum(map(COMMON.__contains__, p)) + (p[0].lower() in COMMON) >= 0.2 * len(p):
            sentence += len(x)
    cells = 0
    if any(q in text for q in ("\t", "|", ";", "  ")):
        cells = sum("\t" in x or "|" in x or (";" in x or "  " in x) and _SEPARATOR.search(x) is not None for x in lines)
    bullets = sum(_BULLET.match(x) is not None or x[-1].isdecimal() and _LEADER.match(x) is not None for x in lines)
    numeric = len(_NUMERIC.findall(text)) if digits else 0
    long_ = sum(len(q) > 20 for p in parts for q in p)
    return [
        n, k, len(words), (len(spaced) - spaced.count(b" ")) / w, len(words) / k, (n - letters - digits - spaces - plain) / n, digits / n,
        accents / max(1, letters), upper / max(1, letters), sum(x.rstrip().endswith(_END) for x in lines) / k,
        common / w, len(count) / w, max((v for q, v in count.items() if v > 2 and q not in _COMMON), default=1) / w,
        cells / k, bullets / k,
        numeric / tokens, long_ / tokens, sentence / n, sum(len(p) <= 3 for p in parts) / k,
    ]


def weak_label(s: list[float], types: Counter) -> int:
    """A class for plain cases, by statistics and block types; -1 if it is not plain."""
    v = dict(zip(STATS, s))
    if v["n_chars"] < 120:
        return -1
    total = max(1, sum(types.values()))
    listed = (types["li"] + types["dt"] + types["dd"]) / total
    celled = (types["td"] + types["th"]) / total
    if v["symbol_ratio"] > 0.25 or v["accent_ratio"] > 0.12 or v["long_token_share"] > 0.3 or v["top_word_share"] > 0.3:
        return 3
    if v["common_word_share"] >= 0.33 and v["sentence_share"] >= 0.8 and v["symbol_ratio"] < 0.06:
        return 0
    if v["bullet_share"] > 0.7 and v["common_word_share"] < 0.3 and v["separator_share"] < 0.3:
        return 1
    if v["common_word_share"] >= 0.25:
        return -1
    if v["words_per_line"] > 9 and v["separator_share"] < 0.2 and v["end_punctuation_share"] < 0.3 and v["digit_ratio"] < 0.05:
        return 3
    if celled > 0.7 and v["digit_ratio"] > 0.05 or v["separator_share"] > 0.7 and v["digit_ratio"] > 0.05:
        return 2
    if (listed > 0.6 or v["bullet_share"] > 0.7) and v["words_per_line"] < 9:
        return 1
    return -1


def furniture_like(text: str, kind: str | None, style: str | None, edge: bool) -> bool:
    """Whether a block looks like a running head or a printed page number by itself (for statistics only)."""
    if len(text) > 90:
        return False
    if style in ("running-head", "page-number") or kind == "header":
        return True
    if edge and NUMBER.match(text):
        return True
    return edge and text[:1].isupper() and text.upper() == text and len(text.split()) >= 3


class PageBatch:
    """The blocks of a batch of pages in reading order, each as its lines without repeated ones."""

    def __init__(self, row_id: pa.Array, coll: pa.Array | None, blocks: pa.Array, keys: np.ndarray | None):
        flat = blocks.flatten()
        page = pc.list_parent_indices(blocks).to_numpy()
        order = pc.fill_null(flat.field("block_order"), 0).to_numpy(zero_copy_only=False)
        by = np.lexsort((np.arange(len(page)), order, page))
        self.row_id, self.page, self.order = row_id, page[by], order[by]
        at = pa.array(by)
        self.texts = pc.fill_null(flat.field("text"), "").take(at).to_pylist()
        self.kinds = pc.fill_null(flat.field("block_type"), "").take(at).to_pylist()
        self.styles = self._classes(flat.field("attrs"), by)
        if keys is not None and len(keys) and len(self.texts):
            c = pc.fill_null(coll, 0).to_numpy().view(np.uint64)[self.page]
            has = coll.is_valid().to_numpy(zero_copy_only=False)[self.page]
            lo = 0
            while lo < len(self.texts):
                hi, size = lo, 0
                while hi < len(self.texts) and size < 1 << 17:
                    size += len(self.texts[hi]) + 1
                    hi += 1
                t, _, ident, words = _line_ids(self.texts[lo:hi])
                key = mix(c[lo:hi][t] + mix(mix(ident)))
                i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                bad = (keys[i] == key) & (words >= 3) & has[lo:hi][t]
                for b in np.unique(t[bad]):
                    gone = bad[t == b] if len(t) < 64 else bad[np.searchsorted(t, b) : np.searchsorted(t, b, side="right")]
                    self.texts[lo + b] = "\n".join(x for x, g in zip(self.texts[lo + b].split("\n"), gone) if not g)
                lo = hi
        self.start = np.searchsorted(self.page, np.arange(len(row_id) + 1))

    def pages(self) -> Iterator[tuple[int, range]]:
        for i in range(len(self.row_id)):
            yield i, range(self.start[i], self.start[i + 1])

    @staticmethod
    def _classes(attrs: pa.MapArray, by: np.ndarray) -> dict[int, str]:
        """The class attribute of each block that has one."""
        if not len(attrs):
            return {}
        off = attrs.offsets.to_numpy()
        hit = np.flatnonzero(pc.fill_null(pc.equal(attrs.keys.slice(off[0], off[-1] - off[0]), "class"), False).to_numpy(zero_copy_only=False)) + off[0]
        owner = np.searchsorted(off, hit, side="right") - 1
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        values = attrs.items.take(pa.array(hit)).to_pylist()
        return dict(zip(place[owner].tolist(), values))

    def style(self, b: int) -> str | None:
        return self.styles.get(b)


def block_keys(cases: DataFrame) -> np.ndarray | None:
    """Repeated lines (coll, block) as one sorted array of 64-bit keys for the tasks; None if there are more than KEYS."""
    rows = cases.limit(KEYS + 1).toArrow()
    if rows.num_rows > KEYS:
        return None
    coll, block = (rows.column(c).to_numpy().view(np.uint64) for c in ("coll", "block"))
    return np.sort(mix(coll + mix(block)))


def scoped_pages(pages: DataFrame, cases: DataFrame) -> tuple[DataFrame, np.ndarray | None]:
    """Pages as (row_id, coll, run_id, page, blocks) and the keys of their repeated lines; without keys the lines are gone already."""
    keys = block_keys(cases)
    if keys is None:
        kept = clean_pages(pages, occurrences(pages, cases))
        pages = pages.drop("blocks").join(kept, "row_id")
    first = F.element_at(F.expr("if(size(source) > 0, source, null)"), 1)
    coll = F.when(first.isNotNull() & (first != ""), F.xxhash64(first))
    return pages.select("row_id", coll.alias("coll"), "run_id", F.col("page").cast("long").alias("page"), "blocks"), keys


def full_blocks(batch: PageBatch, blocks: range) -> list[int]:
    """The blocks that have text."""
    return [b for b in blocks if batch.texts[b] and not batch.texts[b].isspace()]


def own_blocks(batch: PageBatch, full: list[int]) -> list[int]:
    """Of a page's blocks with text those that are no furniture."""
    kept = full[2:-2]
    edges = range(len(full)) if len(full) < 4 else (0, 1, len(full) - 2, len(full) - 1)
    own = []
    for i in edges:
        b = full[i]
        text = batch.texts[b]
        if len(text) > 90 or not furniture_like(text, batch.kinds[b], batch.style(b), i == 0 or i == len(full) - 1 or bool(NUMBER.match(text))):
            own.append(b)
    return sorted(kept + own)


def own_lines(batch: PageBatch, blocks: range) -> tuple[list[str], Counter]:
    """A page's lines without furniture, and the block types of what is left."""
    kept = own_blocks(batch, full_blocks(batch, blocks))
    return [x for b in kept for x in batch.texts[b].split("\n")], Counter(batch.kinds[b] for b in kept)


def _measured(keys, labelled: bool):
    names = ["row_id", "label", *STATS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pb = PageBatch(b.column(0), b.column(1), b.column(2), keys)
            rows, labels = [], []
            for _, blocks in pb.pages():
                lines, types = own_lines(pb, blocks)
                rows.append(statistics(lines))
                labels.append(weak_label(rows[-1], types) if labelled else -1)
            x = np.array(rows, float).reshape(len(rows), len(STATS))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(labels, pa.int32()), *(pa.array(x[:, j]) for j in range(len(STATS)))], names=names)

    return run


def measured_texts(texts: tuple[tuple[str, str], ...]) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and class numbers of (class, text)."""
    return np.array([statistics(t.split("\n")) for _, t in texts]), np.array([CLASSES.index(c) for c, _ in texts])


class Classifier:
    """One boosted model per class, calibrated on hand-checked pages that none was fitted on; the class of the highest probability wins. A class without a weakly labelled page is not given. models: those already fitted, if any, y then being the classes they were fitted on."""

    def __init__(self, x: np.ndarray | None, y: np.ndarray, models: list[gbt.Boosted] | None = None):
        hx, hy = measured_texts(CALIBRATE)
        cols = slice(3, None)  # sizes tell nothing
        self.known = np.array([(y == c).any() for c in range(len(CLASSES))])
        models = models or [gbt.fit(x[:, cols], y == c) for c in range(len(CLASSES))]
        self.models = [gbt.calibrate(m, hx[:, cols], hy == c) for c, m in enumerate(models)]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        p = np.column_stack([m.probability(x[:, 3:]) for m in self.models]) if len(x) else np.zeros((0, len(CLASSES)))
        p = p * self.known if self.known.any() else p
        return p / np.maximum(p.sum(axis=1, keepdims=True), 1e-12)

    def reliability(self, texts: tuple[tuple[str, str], ...], bins: int = 5) -> dict:
        """How far probabilities can be trusted on texts that were read: accuracy, Brier score of prose, and per bin of p_prose its mean and the share that is prose."""
        x, y = measured_texts(texts)
        p = self.probabilities(x)
        prose, at = p[:, 0], np.minimum((p[:, 0] * bins).astype(int), bins - 1)
        table = {int(b): (float(prose[at == b].mean()), float((y[at == b] == 0).mean()), int((at == b).sum())) for b in np.unique(at)}
        return {"accuracy": float((p.argmax(axis=1) == y).mean()), "brier": float(((prose - (y == 0)) ** 2).mean()), "bins": table}


def fit_classifier(scoped: DataFrame, keys, sample: int = SAMPLE) -> Classifier:
    """Fit on the weakly labelled among at most `sample` pages (the smallest hashes of row_id)."""
    ids = scoped.select("row_id").distinct().orderBy(F.xxhash64("row_id"), "row_id").limit(sample)
    few = scoped.join(F.broadcast(ids), "row_id", "left_semi").select("row_id", "coll", "blocks")  # at most `sample` ids
    t = few.mapInArrow(_measured(keys, True), "row_id long, label int, " + ", ".join(f"{s} double" for s in STATS)).where("label >= 0").orderBy("row_id").limit(sample).toArrow()
    x = np.column_stack([t.column(s).to_numpy() for s in STATS]) if t.num_rows else np.zeros((0, len(STATS)))
    return Classifier(x, t.column("label").to_numpy().astype(int))


def _classified(keys, model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _measured(keys, False)(batches):
            x = np.column_stack([b.column(2 + j).to_numpy() for j in range(len(STATS))]) if b.num_rows else np.zeros((0, len(STATS)))
            p = model.probabilities(x)
            kind = pa.array([CLASSES[i] for i in p.argmax(axis=1)], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], pa.array(p[:, 0]), kind], names=["row_id", *STATS, "p_prose", "page_class"])

    return run


def page_statistics(pages: DataFrame, cases: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per page: row_id, the statistics of its own text, p_prose (calibrated) and page_class.

    cases: repeated lines (coll, block) that are not a page's own.  A page
    without text has zeros; repeated rows are judged each; texts of any length
    are read whole; other columns are not read.
    """
    scoped, keys = scoped_pages(pages, cases)
    model = fit_classifier(scoped, keys, sample)
    out = "row_id long, " + ", ".join(f"{s} double" for s in STATS) + ", p_prose double, page_class string"
    return scoped.select("row_id", "coll", "blocks").mapInArrow(_classified(keys, model), out)
