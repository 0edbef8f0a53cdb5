"""Language identification of mixed-language texts.

Every word gets a score per language, a Viterbi pass with a switching penalty labels the words, and
runs of equal labels are the spans. The document's language is the one with most letters.

Model. From a bounded sample of labelled documents (``SAMPLE_DOCS`` per language, those with the
smallest hashes of their ids, whole texts) the hashed character n-grams (1 to 4 letters, with word
edges) of each language are counted in Spark; the log-probability of a word is the sum over its
n-grams, so the model is a table of ``BUCKETS`` by languages whatever the corpus. The script ranges
below narrow a word's candidates to the languages in whose sample its script has a share of
``SCRIPT_SHARE``; a word of a script that no language uses keeps all of them.

Scores are computed on whole batches of code points with numpy, and the Viterbi recursion advances
all documents of a block by one word at a time, so Python's work does not grow with the words.

Edge cases: a null text, an empty one, or one without a letter is ``und`` with score 0; a language
value with few samples is a language like others; with no labelled document at all, every text is
``und``; ties go to the alphabetically first language; rows that repeat a ``doc_id`` are judged
each; a row without one is judged too and learnt from (``held_out`` is false); extra columns are ignored. A run of letters longer than a block is scored in parts.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsync.llm.frames import small_batches

UNDETERMINED = "und"
SAMPLE_DOCS = 1000       # labelled documents per language that the model is fitted on, at most
BUCKETS = 1 << 16
MAX_GRAM = 4
SWITCH_PENALTY = 25.0    # in nats: evidence needed before a label changes
SMOOTHING = 0.5
SCRIPT_SHARE = 0.01
IMPOSSIBLE = -1e4        # score of a word for a language that its script rules out
BLOCK_CHARS = 1 << 19

# First code points of the ranges of scripts, and the script from there on (0: any).
SCRIPTS = ("any", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "thai", "georgian", "hangul",
           "kana", "han")
SCRIPT_STARTS = (
    (0x0000, "any"), (0x0041, "latin"), (0x0250, "any"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "any"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "any"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "any"), (0x3040, "kana"),
    (0x3100, "any"), (0x3400, "han"), (0xA000, "any"), (0xAC00, "hangul"), (0xD7B0, "any"), (0xF900, "han"),
    (0xFB00, "any"), (0x20000, "han"), (0x30000, "any"))

_U = np.uint64


class Model(NamedTuple):
    languages: tuple[str, ...]
    weights: np.ndarray   # BUCKETS x languages, log-probabilities
    allowed: np.ndarray   # scripts x languages, may a word of this script be of this language?


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: is it a letter, its lower case, its script."""
    letter = np.zeros(0x110000, dtype=bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == "L":
            letter[c] = True
            small = chr(c).lower()
            lower[c] = ord(small) if len(small) == 1 else c
    script = np.zeros(0x110000, dtype=np.uint8)
    for (start, name), (stop, _) in zip(SCRIPT_STARTS, (*SCRIPT_STARTS[1:], (0x110000, "")), strict=True):
        script[start:stop] = SCRIPTS.index(name)
    return letter, lower, script


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray   # words of document i: offsets[i] to offsets[i + 1]
    scripts: np.ndarray
    letters: np.ndarray   # lower-case code points


def split_words(texts: list[str]) -> Words:
    """Runs of letters of the texts, which are laid end to end with a gap between."""
    letter, lower, script = _characters()
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    solid = np.zeros(len(points) + 2, dtype=np.int8)
    solid[1:-1] = letter[points]
    edge = np.diff(solid)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return Words(starts, ends, np.searchsorted(starts, begins), script[points[starts]], lower[points])


def _grams(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each n-gram length: the buckets, and the first and the last-plus-one n-gram of each word.

    A word is framed by one edge mark on each side; its one-letter n-grams leave the marks out.
    """
    sizes = words.ends - words.starts
    at = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes + 2, out=at[1:])
    framed = np.zeros(at[-1], np.uint64)
    inner = np.arange(sizes.sum()) + np.repeat(2 * np.arange(len(sizes)) + 1, sizes)
    taken = np.arange(sizes.sum()) + np.repeat(words.starts - np.cumsum(sizes) + sizes, sizes)
    framed[inner] = words.letters[taken]
    rolled = framed + _U(1)
    for n in range(1, MAX_GRAM + 1):
        if n > 1:
            rolled = rolled[:-1] * _U(0x9E3779B97F4A7C15) + framed[n - 1:] + _U(n)
        hashed = (rolled ^ (rolled >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        edge = 1 if n == 1 else 0
        last = np.maximum(at[1:] - n + 1 - edge, at[:-1] + edge)
        yield (hashed >> _U(48)).astype(np.int64), at[:-1] + edge, np.minimum(last, len(hashed))


def word_scores(words: Words, model: Model) -> np.ndarray:
    """Words by languages: log-probability of the word, ``IMPOSSIBLE`` where its script is not used."""
    scores = np.zeros((len(words.starts), len(model.languages)), np.float32)
    for buckets, first, last in _grams(words):
        for k in range(len(model.languages)):
            total = np.zeros(len(buckets) + 1)
            np.cumsum(model.weights[buckets, k], out=total[1:])
            scores[:, k] += total[last] - total[first]
    known = model.allowed[words.scripts].any(axis=1, keepdims=True)
    return np.where(model.allowed[words.scripts] | ~known, scores, scores + IMPOSSIBLE)


def viterbi(scores: np.ndarray, offsets: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best label of every word, where a change of label within a document costs ``penalty``."""
    counts = np.diff(offsets)
    order = np.argsort(-counts, kind="stable")
    begins, sizes = offsets[order], counts[order]
    stays = np.ones(scores.shape, dtype=bool)
    leaders = np.zeros(len(scores), np.int8 if scores.shape[1] < 128 else np.int32)
    best = np.zeros((len(order), scores.shape[1]), np.float64)
    active = np.searchsorted(-sizes, -np.arange(1, sizes.max(initial=0) + 1), side="right")
    for step, n in enumerate(active):
        here = begins[:n] + step
        value = best[:n]
        if step:
            top = value.argmax(axis=1)
            moved = value[np.arange(n), top] - penalty
            stays[here] = value >= moved[:, None]
            leaders[here] = top
            value = np.maximum(value, moved[:, None])
        best[:n] = value + scores[here]
    labels = np.zeros(len(scores), np.int64)
    now = best.argmax(axis=1)
    for step in range(len(active) - 1, -1, -1):
        n = active[step]
        here = begins[:n] + step
        labels[here] = now[:n]
        now[:n] = np.where(stays[here, now[:n]], now[:n], leaders[here])
    return labels


def _count_grams(languages: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of n-gram buckets and, from ``BUCKETS`` on, of the letters in words of each script."""
    places = {x: k for k, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS + len(SCRIPTS)), np.int64)
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                mine = counts[places[lang]]
                for part in _parts(text):
                    words = split_words([part])
                    for buckets, first, last in _grams(words):
                        marks = np.zeros(len(buckets) + 1, np.int64)
                        np.add.at(marks, first, 1)
                        np.add.at(marks, last, -1)
                        mine[:BUCKETS] += np.bincount(buckets, weights=np.cumsum(marks[:-1]), minlength=BUCKETS).astype(np.int64)
                    mine[BUCKETS:] += np.bincount(words.scripts, weights=words.ends - words.starts,
                                                  minlength=len(SCRIPTS)).astype(np.int64)
        lang, bins = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bins, pa.int64()),
                                          pa.array(counts[lang, bins], pa.int64())], ["lang", "bin", "n"])
    return run


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """The model from ``doc_id, text, lang``; None if no document has a language."""
    labelled = labelled.filter(F.col("lang").isNotNull())
    totals = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return None
    # hashes under a threshold that leaves some more than the sample, then the smallest of them
    share = F.create_map(*[F.lit(x) for lang, n in totals.items() for x in (lang, (1.2 * sample_docs + 100) / n)])
    place = F.xxhash64("doc_id")
    low = F.pmod(place, F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * F.lit(float(1 << 30))
    order = Window.partitionBy("lang").orderBy(F.pmod(place, F.lit(1 << 30)), "doc_id")
    sample = (labelled.filter(low & F.col("text").isNotNull()).withColumn("nth", F.row_number().over(order))
              .filter(F.col("nth") <= sample_docs).select("text", "lang"))
    languages = tuple(sorted(totals))
    found = (sample.repartition(8).mapInArrow(_count_grams(languages), "lang int, bin long, n long")
             .groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas())  # BUCKETS rows per language at most
    counts = np.zeros((len(languages), BUCKETS + len(SCRIPTS)))
    counts[found["lang"], found["bin"]] = found["n"]
    grams, scripts = counts[:, :BUCKETS], counts[:, BUCKETS:]
    weights = np.log((grams + SMOOTHING) / (grams.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS))
    allowed = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1) >= SCRIPT_SHARE
    return Model(languages, weights.T.astype(np.float32), np.ascontiguousarray(allowed.T))


def _parts(text: str) -> list[str]:
    """The text in parts of a block each, cut at blanks where there are any."""
    out, at = [], 0
    while len(text) - at > BLOCK_CHARS:
        cut = text.rfind(" ", at + 1, at + BLOCK_CHARS)
        cut = cut if cut > at else at + BLOCK_CHARS
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def label_spans(texts: list[str], model: Model) -> list[list[tuple[int, int, str]]]:
    """Spans ``(start, end, language)`` of each text, in code points from its first to its last letter."""
    out = []
    for text in texts:
        words = split_words([text])
        labels = viterbi(word_scores(words, model), words.offsets)
        spans: list[tuple[int, int, str]] = []
        for begin, end, label in zip(words.starts.tolist(), words.ends.tolist(), labels.tolist(), strict=True):
            lang = model.languages[label]
            if spans and spans[-1][2] == lang:
                spans[-1] = (spans[-1][0], end, lang)
            else:
                spans.append((begin, end, lang))
        out.append(spans)
    return out


def _judge(texts: list[str], model: Model) -> tuple[np.ndarray, pa.Array]:
    """Letters of each text under each language, and its spans: start, end (code points) and language."""
    pieces = [(i, part) for i, t in enumerate(texts) for part in (_parts(t) if len(t) > BLOCK_CHARS else (t,))]
    words = [split_words([p]) for _, p in pieces] if len(pieces) > len(texts) else None
    if words is None:
        one = split_words(texts)
        scores, sizes, offsets = word_scores(one, model), one.ends - one.starts, one.offsets
        laid = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])  # where each text starts among all
        begins = one.starts - np.repeat(laid[:-1], np.diff(offsets))
    else:
        scores = np.concatenate([word_scores(w, model) for w in words])
        sizes = np.concatenate([w.ends - w.starts for w in words])
        of_text = np.array([i for i, _ in pieces])
        before = np.concatenate([[0], np.cumsum([len(p) for _, p in pieces])])[:-1]
        first = np.flatnonzero(np.concatenate([[True], of_text[1:] != of_text[:-1]]))
        before = before - np.repeat(before[first], np.diff(np.append(first, len(pieces))))
        begins = np.concatenate([w.starts + at for w, at in zip(words, before, strict=True)])
        per_text = np.bincount([i for i, _ in pieces], weights=[len(w.starts) for w in words], minlength=len(texts)).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(per_text)])
    labels = viterbi(scores, offsets)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    letters = np.bincount(row * len(model.languages) + labels, weights=sizes, minlength=len(texts) * len(model.languages))
    change = np.ones(len(labels), dtype=bool)
    change[1:] = (labels[1:] != labels[:-1]) | (row[1:] != row[:-1])
    heads = np.flatnonzero(change)
    last = np.append(heads[1:], len(labels))[:len(heads)] - 1
    names = pa.DictionaryArray.from_arrays(pa.array(labels[heads].astype(np.int32)), pa.array(model.languages, pa.string()))
    spans = pa.StructArray.from_arrays([pa.array(begins[heads]), pa.array(begins[last] + sizes[last]), names.dictionary_decode()],
                                       ["start", "end", "lang"])
    per_text = np.bincount(row[heads], minlength=len(texts))
    return (letters.reshape(len(texts), len(model.languages)),
            pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)), spans))


SPANS = "array<struct<start:long,end:long,lang:string>>"
SCHEMA = f"doc_id long, lang_pred string, score double, n_spans long, spans {SPANS}"


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score, n_spans, spans`` of every whole text."""
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return ids.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"),
                          F.lit(0).cast("bigint").alias("n_spans"), F.array().cast(SPANS).alias("spans"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            at = 0
            while at < len(texts):
                to, chars = at, 0
                while to < len(texts) and (to == at or chars + len(texts[to]) <= BLOCK_CHARS):
                    chars += len(texts[to])
                    to += 1
                letters, spans = _judge(texts[at:to], model)
                total = letters.sum(axis=1)
                label = np.where(total > 0, letters.argmax(axis=1), len(model.languages))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, to - at), pa.array(names[label], pa.string()),
                     pa.array(letters.max(axis=1) / np.maximum(total, 1)), spans.value_lengths().cast(pa.int64()), spans],
                    ["doc_id", "lang_pred", "score", "n_spans", "spans"])
                at = to
    return ids.mapInArrow(run, SCHEMA)


def held_out(doc_id: Column) -> Column:
    """Documents that the model must not learn from: crc32 of the id as text is divisible by 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def predict_languages(docs: DataFrame) -> DataFrame:
    """Fit on the documents that are not held out, then label every document."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return identify(docs, model).withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
