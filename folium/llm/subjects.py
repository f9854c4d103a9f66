"""Subject areas of documents by class-association rules.

Sentences of labelled documents are transactions of words plus the label as one
more item; parallel FP-growth mines frequent sets, those with a label give rules
words -> subject.  A rule that a shorter one predicts as well is redundant and
goes.  Each sentence of every document is scored by the evidence of its matching
rules; how much evidence a sentence needs is calibrated, for all subjects and then
for each, on labelled documents that no rule was mined from.  What a document's
other sentences say decides between subjects that a sentence leaves open.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.runtime import materialize

#: Labelled documents that rules are mined from and thresholds calibrated on at most (the smallest hashes of doc_id).
LABELLED = 20_000
#: One in so many labelled documents is kept from mining, at most CALIBRATION of them, for calibration.
HELD, CALIBRATION = 4, 400
#: Subjects and rules that a task can hold; more are an error, none is left out.
SUBJECTS, RULES = 10_000, 1_000_000
#: Words of one rule at most.
WORDS = 2
#: Sentences that must hold a rule, its least confidence, and the gain that a longer rule needs.
SUPPORT, CONFIDENCE, GAIN = 3, 0.25, 0.1
#: Share of a document's sentences that makes an area.
SHARE = 0.25

_SPLIT = re.compile(r"(?:(?<=[.!?…])|(?<=[.!?…][”\"’»)]))(?<!\b[A-Z]\.)\s+|[\r\n]+")
_WORD = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*")


def sentences(text: str | None) -> list[str]:
    """Sentences of a text: cut after closing punctuation (not after an initial) and at line ends; parts without a letter are none."""
    return [x for x in _SPLIT.split(text or "") if x and _WORD.search(x)]


def words(sentence: str) -> set[str]:
    return {w for w in _WORD.findall(sentence.lower()) if len(w) > 2}


def subject_names(subjects: DataFrame) -> list[str]:
    """The distinct subjects, sorted; more than SUBJECTS are an error."""
    names = sorted(r[0] for r in subjects.select("subject").where("subject IS NOT NULL").distinct().limit(SUBJECTS + 1).collect())
    if len(names) > SUBJECTS:
        raise ValueError(f"more than {SUBJECTS} subjects")
    return names


def clean_labels(labels: DataFrame, subjects: DataFrame) -> DataFrame:
    """(doc_id, subject) as spelt in subjects: case and blanks are ignored, one or two wrong letters mended; others and nulls are dropped."""
    names = labels.sparkSession.createDataFrame([(n,) for n in subject_names(subjects)], "name string")
    raw = labels.where("doc_id IS NOT NULL AND subject IS NOT NULL").select("doc_id", F.lower(F.trim("subject")).alias("raw"))
    # at most SUBJECTS names meet the distinct spellings of labels
    near = F.levenshtein(F.col("raw"), F.lower("name"), 2)
    seen = raw.select("raw").distinct().join(F.broadcast(names), (F.abs(F.length("raw") - F.length("name")) <= 2) & near.between(0, 2))
    best = seen.groupBy("raw").agg(F.min_by("name", F.struct(near, F.col("name"))).alias("subject"))
    return raw.join(best, "raw").select("doc_id", "subject").distinct()


def _transactions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        who, label, items = [], [], []
        for d, s, t in zip(*(c.to_pylist() for c in b.columns)):
            for x in sentences(t):
                w = words(x)
                if w:
                    who.append(d)
                    label.append(s)
                    items.append(sorted(w))
        yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(label, pa.string()), pa.array(items, pa.list_(pa.string()))], names=["doc_id", "subject", "items"])


def _sure(freq, whole):
    """A rule's confidence less one standard error."""
    c = freq / whole
    return c - F.sqrt(c * (1 - c) / whole)


def mine_rules(documents: DataFrame, labels: DataFrame, subjects: DataFrame, labelled: int = LABELLED) -> tuple[list[str], list[tuple[tuple[str, ...], str, float, int]], list[tuple[str, str]]]:
    """(subjects, rules as (words, subject, confidence, support), labelled texts that were not mined)."""
    names = subject_names(subjects)
    clean = clean_labels(labels, subjects)
    one = clean.groupBy("doc_id").agg(F.collect_set("subject").alias("s")).where(F.size("s") == 1)
    some = one.select("doc_id", F.col("s")[0].alias("subject"), (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(HELD)) == 0).alias("held")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    sample = materialize(documents.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("doc_id", "subject", "text", "held"), "labelled")
    held = [(r.text, r.subject) for r in sample.where("held AND text IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION).collect()]
    described = subjects.where("subject IS NOT NULL").select(F.lit(None).cast("long").alias("doc_id"), "subject", F.col("description").alias("text"))
    told = described.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(SUPPORT)))).drop("n")
    rows = sample.where("NOT held").select("doc_id", "subject", "text").unionByName(told).mapInArrow(_transactions, "doc_id long, subject string, items array<string>")
    rows = materialize(rows.withColumn("id", F.monotonically_increasing_id()), "transactions")
    # rules of one word; a word that leans to no subject can head no rule and would only swell the sets
    pairs = rows.select("subject", F.explode("items").alias("w")).groupBy("w", "subject").agg(F.count("*").alias("n"))
    whole = pairs.groupBy("w").agg(F.sum("n").alias("all"), F.max("n").alias("top")).where((F.col("all") >= SUPPORT) & (F.col("top") >= CONFIDENCE * F.col("all")))
    ones = pairs.where(F.col("n") >= SUPPORT).join(whole, "w").select("w", "subject", "n", _sure(F.col("n"), F.col("all")).alias("confidence"))
    ones = materialize(ones, "ones")
    single = ones.where(F.col("confidence") >= CONFIDENCE).select(F.array("w").alias("a"), "subject", "confidence", F.col("n").alias("freq"))
    # rules of two words; one of a word that decides alone could not gain by GAIN
    decided = ones.where(F.col("confidence") > 1 - GAIN).select("w").distinct()
    open_ = whole.select("w").join(decided, "w", "left_anti")
    kept = rows.select("id", "subject", F.explode("items").alias("w")).join(open_, "w").groupBy("id", "subject").agg(F.collect_list("w").alias("items"))
    baskets = materialize(kept.where(F.size("items") > 1).select(F.array_append("items", F.concat(F.lit("="), "subject")).alias("items")), "baskets")
    count = baskets.count()
    rules = single
    if count:
        freq = FPGrowth(itemsCol="items", minSupport=min(1.0, (SUPPORT - 0.5) / count)).fit(baskets).freqItemsets
        parts = freq.where(F.size("items") <= WORDS + 1).select(F.array_sort(F.filter("items", lambda x: ~x.startswith("="))).alias("a"), F.filter("items", lambda x: x.startswith("=")).alias("c"), "freq").where(F.size("a") == WORDS)
        body = parts.where(F.size("c") == 0).select("a", F.col("freq").alias("all"))
        two = parts.where(F.size("c") == 1).join(body, "a").select("a", F.substring(F.col("c")[0], 2, 1000).alias("subject"), _sure(F.col("freq"), F.col("all")).alias("confidence"), "freq")
        two = two.where(F.col("confidence") >= CONFIDENCE)
        for k in range(WORDS):  # redundant: a rule of one of its words predicts about as well
            shorter = ones.where(F.col("confidence") >= CONFIDENCE).select(F.col("w").alias("_w"), F.col("subject").alias("_s"), F.col("confidence").alias("_c"))
            two = two.join(shorter, (F.col("a")[k] == F.col("_w")) & (F.col("subject") == F.col("_s")), "left").where(F.coalesce("_c", F.lit(0.0)) + GAIN <= F.col("confidence")).drop("_w", "_s", "_c")
        rules = rules.unionByName(two.select(*single.columns))
    found = rules.limit(RULES + 1).collect()
    if len(found) > RULES:
        raise ValueError(f"more than {RULES} rules; ask for more support")
    return names, sorted((tuple(r.a), r.subject, r.confidence, r.freq) for r in found), held


class Scorer:
    """Evidence of rules for sentences and areas of documents, for many texts at once."""

    def __init__(self, names: list[str], rules: list[tuple[tuple[str, ...], str, float, int]]):
        self.names = names
        at = {s: i for i, s in enumerate(names)}
        prior = 1 / max(1, len(names))
        table: dict[tuple[str, ...], dict[int, float]] = {}
        for body, subject, conf, n in rules:
            sure = (conf * n + prior) / (n + 1)  # a rule seen rarely says less
            table.setdefault(body, {})[at[subject]] = max(0.0, float(np.log(sure / prior)))
        # the rules' weights as rows: of a word (0 on), then of a pair
        self.row = {b[0]: i for i, b in enumerate(b for b in table if len(b) == 1)}
        self.pair: dict[str, dict[str, int]] = {}
        for i, b in enumerate(b for b in table if len(b) == 2):
            self.pair.setdefault(b[0], {})[b[1]] = len(self.row) + i
        self.heads = self.row.keys() | {x for b in table for x in b}
        self.weight = np.zeros((len(table), len(names)), np.float32)
        for i, b in enumerate(sorted(table, key=len)):
            for j, w in table[b].items():
                self.weight[i, j] = w
        self.unit = float(np.log(max(2, len(names))) / np.log(10))  # what a sure rule weighs depends on the number of subjects
        self.scale, self.least = 1.0, np.full(len(names), self.unit)

    def _rows(self, sentence: str) -> list[int]:
        """Rows of the rules that a sentence matches. A pair's rule stands for its words' own."""
        hit = self.heads & set(_WORD.findall(sentence.lower()))
        if not hit:
            return []
        out, used = [], set()
        for a in self.pair.keys() & hit:
            partners = self.pair[a]
            for b in partners.keys() & hit:
                out.append(partners[b])
                used.update((a, b))
        return out + [self.row[w] for w in hit if w not in used and w in self.row]

    def evidence(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(evidence of each sentence that a rule matches, the index of its text, sentences of each text)."""
        rows: list[int] = []
        start, doc, size = [], [], []
        for i, t in enumerate(texts):
            parts = sentences(t)
            size.append(len(parts))
            for x in parts:
                r = self._rows(x)
                if r:
                    start.append(len(rows))
                    doc.append(i)
                    rows += r
        if not rows:
            return np.zeros((0, len(self.names)), np.float32), np.zeros(0, np.int64), np.array(size, np.int64)
        e = np.add.reduceat(self.weight[np.array(rows)], np.array(start), axis=0)
        some = e.any(axis=1)
        return e[some], np.array(doc)[some], np.array(size, np.int64)

    def _judged(self, e: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each sentence the likeliest subject given its document's other sentences, its evidence and its probability."""
        first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        count = np.diff(np.append(first, len(doc)))
        prior = np.zeros((len(first), e.shape[1]), e.dtype)
        for _ in range(5):
            z = e + np.repeat(prior, count, axis=0)
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            prior = np.log((np.add.reduceat(p, first, axis=0) + 0.5) / (count[:, None] + 0.5 * e.shape[1])).astype(e.dtype)
        top = p.argmax(axis=1)
        at = np.arange(len(e))
        return top, e[at, top], p[at, top]

    def shares(self, texts: list[str | None]) -> np.ndarray:
        """Per text and subject the share of the text's sentences that deal with it."""
        e, doc, size = self.evidence(texts)
        if not len(e):
            return np.zeros((len(texts), len(self.names)))
        top, sum_, p = self._judged(e * np.float32(self.scale), doc)
        sure = (sum_ >= self.least[top]) & (p >= 0.4)
        out = np.bincount(doc[sure] * len(self.names) + top[sure], minlength=len(texts) * len(self.names)).reshape(len(texts), -1)
        return out / np.maximum(size, 1)[:, None]

    def calibrate(self, held: list[tuple[str, str]]) -> None:
        """Choose scale and least evidence of a sentence, then each subject's own least evidence, so that labels of documents that were not mined are met best (areas that are exactly the label count 1, areas with it 1/2)."""
        held = [(t, s) for t, s in held if s in set(self.names)]
        e, doc, size = self.evidence([t for t, _ in held])
        if not len(e):
            return
        label = np.array([self.names.index(s) for _, s in held])
        cut = np.ceil(SHARE * np.maximum(size, 1) - 1e-9)

        def areas(top, sum_, p, least):
            sure = (sum_ >= least[top]) & (p >= 0.4)
            return np.bincount(doc[sure] * len(self.names) + top[sure], minlength=len(held) * len(self.names)).reshape(len(held), -1) >= cut[:, None]

        def met(got):
            with_ = got[np.arange(len(held)), label]
            return float((0.5 * with_ + 0.5 * (with_ & (got.sum(axis=1) == 1))).sum())

        steps = [f * self.unit for f in (0.5, 0.8, 1.1, 1.4)]
        best = (-1.0, 1.0, self.unit)
        for scale in (0.7, 1.0, 1.5):
            judged = self._judged(e * np.float32(scale), doc)
            for least in steps:
                best = max(best, (met(areas(*judged, np.full(len(self.names), least))), scale, least), key=lambda x: x[0])
        self.scale, self.least = best[1], np.full(len(self.names), best[2])
        judged = self._judged(e * np.float32(self.scale), doc)
        now = best[0]
        for k in np.unique(label):  # a subject's own threshold must gain two documents
            trial = {least: met(areas(*judged, np.where(np.arange(len(self.names)) == k, least, self.least))) for least in steps}
            least = max(trial, key=lambda x: trial[x])
            if trial[least] >= now + 2:
                self.least[k], now = least, trial[least]


def _areas(scorer: Scorer):
    chunk = max(16, min(1024, 100_000 // max(1, len(scorer.names))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, chunk):
                part = b.slice(lo, chunk)
                share = scorer.shares(part.column(1).to_pylist())
                i, j = np.nonzero(share >= SHARE - 1e-9)
                names = pa.array(scorer.names, pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(i)), names.take(pa.array(j)), pa.array(share[i, j], pa.float64())], names=["doc_id", "subject", "share"])

    return run


def subject_areas(documents: DataFrame, labels: DataFrame, subjects: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """One row per document and area: doc_id, subject, share (of its sentences). Null and blank texts give none; repeated documents are judged each; no labels at all leave the subjects' descriptions as evidence."""
    names, rules, held = mine_rules(documents, labels, subjects, labelled)
    scorer = Scorer(names, rules)
    scorer.calibrate(held)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_areas(scorer), "doc_id long, subject string, share double")


def composition(areas: DataFrame, documents: DataFrame) -> DataFrame:
    """Documents and characters per subject and source, for the make-up of the corpus; a repeated document counts each time."""
    size = documents.select("doc_id", "source", F.length("text").alias("chars"))
    return areas.select("doc_id", "subject").distinct().join(size, "doc_id").groupBy("source", "subject").agg(F.count("*").alias("documents"), F.sum("chars").alias("chars"))
