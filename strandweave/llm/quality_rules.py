"""Quality rules as a short-circuit cascade.

Each rule has its own statistic, at its own cost. ``plan_cascade`` times the rules on a sample and counts what each
rejects there, among documents that pass the base rule; rules then run by rejections per second, and a document that one
rule rejects isn't shown to the next. The order decides only how long it takes: a document is kept if it passes all
rules. Statistics that are reported for every document anyhow cost a rule nothing.

Null and empty texts have no words and fail the base rule. Documents may repeat; each row gets its own verdict. An empty
table gives an empty result. A text has to fit into a task, with about 150 bytes for each word. Other columns are ignored,
or kept by ``keep_good``, and may have any name.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats as R
from .common import documents
from .substring_dedup import _TABLE, word_spans

SYMBOLS = b"#*$%&|<>"
#: About so many rows are timed to order the rules; the verdicts don't depend on them.
SAMPLE_ROWS = 1000
REPEAT_WINDOW = 8
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_IS_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_IS_LOWER = (np.arange(256) >= 97) & (np.arange(256) <= 122)


class Texts:
    """Some documents: ranges of bytes, their words, and statistics that are worked out when asked for.

    ``only`` takes part of the documents along with what is known of them; bytes aren't copied and words not found anew.
    """

    def __init__(self, data: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray, end: np.ndarray, units: np.ndarray):
        self.data, self.low, self.high, self.start, self.end, self.units = data, low, high, start, end, units
        self.n_words = np.diff(units)
        self.shared: dict[str, object] = {}
        self.known: dict[str, np.ndarray] = {}
        self._names: np.ndarray | None = None

    @classmethod
    def of(cls, data: np.ndarray, bounds: np.ndarray) -> Texts:
        return cls(data, bounds[:-1], bounds[1:], *word_spans(data, bounds))

    def stat(self, name: str) -> np.ndarray:
        if name not in self.known:
            self.known[name] = STATS[name](self)
        return self.known[name]

    def sums(self, name: str, flags: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Running sums of flags of the bytes, one for all parts of a chunk."""
        if name not in self.shared:
            self.shared[name] = np.concatenate([[0], np.cumsum(flags(self.data))])
        return self.shared[name]

    @property
    def hash(self) -> R.Hasher:
        if "hash" not in self.shared:
            self.shared["hash"] = R.Hasher(_TABLE[self.data])
        return self.shared["hash"]

    @property
    def names(self) -> np.ndarray:
        if self._names is None:
            self._names = self.hash(self.start, self.end)
        return self._names

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Flagged words by document."""
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[self.units])

    def only(self, rows: np.ndarray) -> Texts:
        size = self.n_words[rows]
        units = np.concatenate([[0], np.cumsum(size)])
        index = np.repeat(self.units[:-1][rows] - units[:-1], size) + np.arange(units[-1])
        part = Texts(self.data, self.low[rows], self.high[rows], self.start[index], self.end[index], units)
        part.shared, part.known = self.shared, {k: v[rows] for k, v in self.known.items()}
        part._names = None if self._names is None else self._names[index]
        return part


def word_chars(t: Texts) -> np.ndarray:
    """Code points inside words."""
    sums = t.sums("letters", lambda data: ((data & 0xC0) != 0x80) & ~np.isin(data, [9, 10, 11, 12, 13, 32]))
    return sums[t.high] - sums[t.low]


def n_symbols(t: Texts) -> np.ndarray:
    sums = t.sums("symbols", lambda data: _IS_SYMBOL[data])
    return sums[t.high] - sums[t.low]


def repeats_in_doc(doc: np.ndarray, names: np.ndarray, same: Callable, digest: Callable) -> tuple[np.ndarray, np.ndarray]:
    """For items of documents: does it equal an earlier one of its document; is it one of several equal ones.

    Names bring equal items together; ``same(items, others)`` compares their content. Should two unequal items have one
    name, all are named by ``digest()`` of their content instead.
    """
    order = np.lexsort((np.arange(len(doc)), names, doc))
    again = np.zeros(len(doc) + 1, bool)
    again[1:-1] = (doc[order][1:] == doc[order][:-1]) & (names[order][1:] == names[order][:-1])
    later, several = np.zeros(len(doc), bool), np.zeros(len(doc), bool)
    later[order], several[order] = again[:-1], again[:-1] | again[1:]
    head = order[np.maximum.accumulate(np.where(again[:-1], 0, np.arange(len(doc))))] if len(doc) else order
    if same is not None and not same(order[again[:-1]], head[again[:-1]]).all():
        return repeats_in_doc(doc, digest(), None, digest)
    return later, several


def lines(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and end of each line with a word."""
    feeds = t.sums("feeds", lambda data: data == 10)
    many = np.where(t.high > t.low, feeds[t.high] - feeds[t.low] + 1, 0)
    at = np.flatnonzero(t.data == 10)
    doc = np.repeat(np.arange(len(many)), many)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    feed = feeds[t.low][doc] + nth
    at = np.append(at, len(t.data))
    start = np.where(nth == 0, t.low[doc], at[np.maximum(feed - 1, 0)] + 1)
    end = np.where(nth == many[doc] - 1, t.high[doc], at[np.minimum(feed, len(at) - 1)])
    worded = t.sums("solid", lambda data: ~np.isin(data, [9, 10, 11, 12, 13, 32]))
    some = worded[end] > worded[start]
    return doc[some], start[some], end[some]


def n_lines(t: Texts) -> np.ndarray:
    return np.bincount(lines(t)[0], minlength=len(t.n_words)).astype(np.int64)


def n_dup_lines(t: Texts) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    doc, start, end = lines(t)
    same = lambda a, b: _same_stretches(t.data, start, end, a, b)
    later = repeats_in_doc(doc, t.hash(start, end), same, lambda: R.digests(t.data.tobytes(), start, end)[:, 0])[0]
    return np.bincount(doc[later], minlength=len(t.n_words)).astype(np.int64)


def _same_stretches(data: np.ndarray, start: np.ndarray, end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    size = (end - start)[a]
    equal = size == (end - start)[b]
    equal[equal] = R.equal_bytes(data, start[a[equal]], start[b[equal]], size[equal])
    return equal


def n_repeat_words(t: Texts, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Words in windows that the text has twice or more."""
    many = np.maximum(t.n_words - window + 1, 0)
    doc = np.repeat(np.arange(len(many)), many)
    first = t.units[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)

    def same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = ((first[i][:, None] + np.arange(window)).reshape(-1) for i in (a, b))
        return _same_stretches(t.data, t.start, t.end, x, y).reshape(-1, window).all(1)

    def digest() -> np.ndarray:
        words = [t.data[a:b].tobytes() for a, b in zip(t.start.tolist(), t.end.tolist(), strict=True)]
        begin = np.concatenate([[0], np.cumsum(t.end - t.start + 1)])
        return R.digests(b" ".join(words), begin[first], begin[first + window] - 1)[:, 0]

    several = repeats_in_doc(doc, R.Hasher(t.names)(first, first + window), same, digest)[1]
    return t.per_doc(R.covered(len(t.start), first[several], first[several] + window))


def n_stuttered(t: Texts) -> np.ndarray:
    """Words equal to the word before."""
    same = np.zeros(len(t.start), bool)
    same[1:] = t.names[1:] == t.names[:-1]
    same[t.units[:-1][t.n_words > 0]] = False
    return t.per_doc(same)


def n_shouted(t: Texts) -> np.ndarray:
    """Words with two or more ASCII capitals and no small letter."""
    upper, lower = t.sums("upper", lambda data: _IS_UPPER[data]), t.sums("lower", lambda data: _IS_LOWER[data])
    return t.per_doc((upper[t.end] - upper[t.start] > 1) & (lower[t.end] == lower[t.start]))


STATS: dict[str, Callable[[Texts], np.ndarray]] = {f.__name__: f for f in (word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stuttered, n_shouted)}
BASE_STATS = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_fails(t: Texts) -> np.ndarray:
    """Fewer than 20 words, or more than 30 % of words in repeated windows; the second is asked of long enough texts only."""
    failed = t.n_words < 20
    left = np.flatnonzero(~failed)
    part = t if "n_repeat_words" in t.known else t.only(left)
    repeated = part.stat("n_repeat_words") if part is not t else t.stat("n_repeat_words")[left]
    failed[left] = 100 * repeated > 30 * t.n_words[left]
    return failed


@dataclass(frozen=True)
class Rule:
    """``rejects(texts)``: which documents fail."""

    name: str
    rejects: Callable[[Texts], np.ndarray]


#: A document of 20 words or more fails if one of these holds; the bounds leave clean prose far away.
RULES = (
    Rule("word length", lambda t: (t.stat("word_chars") < 2 * t.n_words) | (t.stat("word_chars") > 20 * t.n_words)),
    Rule("symbols", lambda t: 10 * t.stat("n_symbols") > t.n_words),
    Rule("repeated lines", lambda t: 2 * t.stat("n_dup_lines") > t.stat("n_lines")),
    Rule("stuttering", lambda t: 10 * t.stat("n_stuttered") > 2 * t.n_words),
    Rule("shouting", lambda t: 10 * t.stat("n_shouted") > 5 * t.n_words),
)


def cascade(texts: Texts, rows: np.ndarray, rules: tuple[Rule, ...]) -> np.ndarray:
    """Those of ``rows`` that pass all rules; a rule is shown only what the ones before it left."""
    part = texts.only(rows)
    for rule in rules:
        if len(rows):
            passed = np.flatnonzero(~rule.rejects(part))
            if len(passed) < len(rows):
                rows, part = rows[passed], part.only(passed)
    return rows


def plan_cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, known: tuple[str, ...] = ()) -> tuple[Rule, ...]:
    """The rules by rejections per second on about ``sample_rows`` rows of ``docs(text)``, of which the base rule's rejects are left out.

    ``known``: statistics that are worked out anyhow, so that a rule doesn't pay for them.
    """

    def timed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, bounds in R.text_chunks(batch):
                texts = Texts.of(data, bounds)
                for name in known:
                    texts.stat(name)
                left = np.flatnonzero(~base_fails(texts))
                for k, rule in enumerate(rules):
                    part = texts.only(left)
                    part.shared = {}  # each rule pays for what it needs
                    began = time.thread_time()
                    rejected = int(rule.rejects(part).sum())
                    yield pa.RecordBatch.from_pydict({"rule": pa.array([k], pa.int32()), "seconds": [time.thread_time() - began], "rejected": pa.array([rejected], pa.int64())})

    share = min(1.0, sample_rows / max(1, docs.count()))
    cost = docs.select("text").sample(share, seed=7).mapInArrow(timed, "rule int, seconds double, rejected long").groupBy("rule").agg(F.sum("seconds").alias("s"), F.sum("rejected").alias("n")).collect()
    worth = {r.rule: (r.n + 0.5) / (r.s + 1e-6) for r in cost}
    return tuple(rules[k] for k in sorted(range(len(rules)), key=lambda k: (-worth.get(k, 0), k)))


def judge(docs: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """(doc_id, n_words, the base statistics, base_failed, kept), one row for each row of ``docs(doc_id, text)``.

    The base rule rejects fewer than 20 words, or more than 30 % of words in repeated windows; ``rules`` see the rest.
    Other columns are ignored. A row without a doc_id gets its verdict too.
    """
    rules = plan_cascade(docs, known=BASE_STATS) if rules is None else rules

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in R.text_chunks(batch):
                texts = Texts.of(data, bounds)
                found = {name: texts.stat(name).astype(np.int64) for name in BASE_STATS}
                failed = base_fails(texts)
                kept = np.zeros(high - low, bool)
                kept[cascade(texts, np.flatnonzero(~failed), rules)] = True
                columns = {"doc_id": batch.column(0).slice(low, high - low), "n_words": texts.n_words, **found, "base_failed": failed, "kept": kept}
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(of, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    rules = plan_cascade(docs) if rules is None else rules
    schema, at = docs.schema, docs.columns.index("text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in R.text_chunks(pa.RecordBatch.from_arrays([batch.column(at)], names=["text"])):
                texts = Texts.of(data, bounds)
                left = cascade(texts, np.flatnonzero(~base_fails(texts)), rules)
                if len(left):
                    yield batch.slice(low, high - low).take(pa.array(left))

    return docs.mapInArrow(of, schema)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir))
