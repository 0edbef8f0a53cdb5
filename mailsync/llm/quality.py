"""Quality rules by distribution divergence.

Each document's histogram of character classes and of common words is compared with the reference
of its language by Jensen-Shannon distance (base 2, so 0 to 1). References are counts over *all*
documents of a language: six character classes, and the language's most frequent word buckets out
of ``WORD_BUCKETS`` hashed ones, with one further bin for all other words. Both comparisons are
made only from a minimum length on, as histograms of short texts say little. A sample of ``n`` words
from the reference itself has an expected divergence of about ``COMMON / (8 ln 2 n)``; the word
distance is taken after subtracting it, so that one threshold fits all lengths.

Plan: one pass counts classes and word buckets per language inside each task (at most
``WORD_BUCKETS + 6`` rows per task and language are shuffled), and one pass judges the documents
without any shuffle. What reaches the driver is ``COMMON + 6`` numbers per language.

Edge cases: a null text has no words, and is rejected by the base rule (under 50 words); a null
language, or one with fewer than ``REFERENCE_WORDS`` words in all, is compared with the reference
of all documents together; repeated rows, and rows without a ``doc_id``, are judged each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailsync.llm import textbatch as T
from mailsync.llm.frames import small_batches

WORD_BUCKETS = 1 << 14
COMMON = 64
REFERENCE_WORDS = 1000
MIN_WORDS = 50            # base rule: shorter documents fail
MAX_REPEAT_PERCENT = 50   # base rule: share of words in repeated three-word windows
MIN_CHARS = 200           # guard of the character-class comparison
MIN_COMMON_WORDS = 70     # guard of the common-word comparison
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.225
BLOCK_BYTES = 1 << 20

CLASSES = ("lower", "upper", "digit", "stop", "symbol", "other")
_CLASS = np.full(256, CLASSES.index("other"), dtype=np.int64)
_CLASS[ord("a"):ord("z") + 1] = CLASSES.index("lower")
_CLASS[128:] = CLASSES.index("lower")
_CLASS[ord("A"):ord("Z") + 1] = CLASSES.index("upper")
_CLASS[ord("0"):ord("9") + 1] = CLASSES.index("digit")
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = CLASSES.index("stop")
SYMBOLS = "#*$%&|<>"
_CLASS[[ord(c) for c in SYMBOLS]] = CLASSES.index("symbol")
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])
_NOT_LETTER = np.ones(256, dtype=bool)
_NOT_LETTER[ord("a"):ord("z") + 1] = False
_NOT_LETTER[ord("A"):ord("Z") + 1] = False
_NOT_LETTER[128:] = False
_LINE_END = np.arange(256) == 0x0A

ALL = "(all)"    # the reference of all documents together
NONE = "(none)"  # documents without a language: only in the reference of all


def _histograms(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character-class counts by row (code points in words), word buckets, and the buckets' offsets."""
    rows = len(offsets) - 1
    shown = ~T.SPACE[raw] & ((raw & 0xC0) != 0x80)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    classes = np.bincount(row[shown] * len(CLASSES) + _CLASS[raw[shown]], minlength=rows * len(CLASSES))
    words, at = T.word_hashes(raw, offsets, gaps=_NOT_LETTER)
    return classes.reshape(rows, len(CLASSES)), (words % np.uint64(WORD_BUCKETS)).astype(np.int64), at


def _count_languages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = WORD_BUCKETS + len(CLASSES)
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        raw, offsets = T.text_bytes(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        for s, e in T.blocks(offsets, BLOCK_BYTES):
            classes, buckets, at = _histograms(raw[offsets[s]:offsets[e]], offsets[s:e + 1] - offsets[s])
            values, index = np.unique(np.array([x or NONE for x in langs[s:e]], dtype=object), return_inverse=True)
            owner = np.repeat(index, np.diff(at))
            words = np.bincount(owner * WORD_BUCKETS + buckets, minlength=len(values) * WORD_BUCKETS)
            for k, lang in enumerate(values):
                total = totals.setdefault(lang, np.zeros(width, np.int64))
                total[:WORD_BUCKETS] += words[k * WORD_BUCKETS:(k + 1) * WORD_BUCKETS]
                total[WORD_BUCKETS:] += classes[index == k].sum(axis=0)
    if totals:
        totals[ALL] = sum(totals.values())
    for lang, total in totals.items():
        bins = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(bins), pa.string()),
                                          "bin": pa.array(bins, pa.int64()), "n": pa.array(total[bins], pa.int64())})


def language_references(docs: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By language: class shares, the common word buckets, and their shares with the rest's last."""
    small_batches(docs.sparkSession)
    counts = (docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
              .mapInArrow(_count_languages, "lang string, bin long, n long"))
    both = counts.filter(F.col("lang") != NONE).groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    is_word = F.col("bin") < WORD_BUCKETS
    of_lang = Window.partitionBy("lang", is_word)
    top = (both.withColumn("total", F.sum("n").over(of_lang))
           .withColumn("place", F.row_number().over(of_lang.orderBy(F.desc("n"), "bin")))
           .filter(~is_word | (F.col("place") <= COMMON)))
    found: dict[str, tuple[np.ndarray, dict[int, int], int]] = {}
    for r in top.collect():  # COMMON + 6 rows per language
        classes, words, total = found.get(r.lang, (np.zeros(len(CLASSES)), {}, 0))
        if r.bin < WORD_BUCKETS:
            words[r.bin], total = r.n, r.total
        else:
            classes[r.bin - WORD_BUCKETS] = r.n
        found[r.lang] = classes, words, total
    out = {}
    for lang, (classes, words, total) in found.items():
        if lang == ALL or total >= REFERENCE_WORDS:
            common = np.array(sorted(words), dtype=np.int64)
            shares = np.array([words[b] for b in sorted(words)] + [total - sum(words.values())], dtype=float)
            out[lang] = classes / max(classes.sum(), 1), common, shares / max(total, 1)
    return out


def js_distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts to the reference shares; 0 for an empty row."""
    total = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(total, 1)
    m = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(reference > 0, reference * np.log2(reference / m), 0).sum(axis=1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip((left + right) / 2, 0, 1)), 0.0)


def _repeats(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words of each row that lie in a three-word window found twice or more in the row."""
    rows, n = len(at) - 1, len(words)
    if n < 3:
        return np.zeros(rows, np.int64)
    row = np.repeat(np.arange(rows), np.diff(at))
    inside = row[:-2] == row[2:]
    k = np.uint64(0x9E3779B97F4A7C15)
    window = T.mix((words[:-2] * k + words[1:-1]) * k + words[2:]) ^ T.mix(row[:-2].astype(np.uint64) + k)
    places = np.flatnonzero(inside)
    _, index, count = np.unique(window[places], return_inverse=True, return_counts=True)
    again = places[count[index] > 1]
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[again + shift] = True
    return T.row_sums(covered, at)


def _repeated_lines(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines of each row that have a word and equal an earlier line of the row."""
    lines, at = T.word_hashes(raw, offsets, gaps=_LINE_END, lower=False)
    if not len(lines):
        return np.zeros(len(offsets) - 1, np.int64)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    first = np.zeros(len(raw), dtype=bool)
    solid = ~_LINE_END[raw]
    first[0] = solid[0]
    first[1:] = solid[1:] & ~solid[:-1]
    begins = offsets[:-1][offsets[:-1] < len(raw)]
    first[begins] |= solid[begins]
    has_word = np.add.reduceat((~T.SPACE[raw]).astype(np.int64), np.flatnonzero(first)) > 0
    pairs = np.stack([row[has_word].astype(np.uint64), lines[has_word]], axis=1)
    if not len(pairs):
        return np.zeros(len(at) - 1, np.int64)
    distinct = np.unique(pairs, axis=0)
    rows = len(at) - 1
    return (np.bincount(row[has_word], minlength=rows)
            - np.bincount(distinct[:, 0].astype(np.int64), minlength=rows))


def measure(raw: np.ndarray, offsets: np.ndarray, langs: list, references: dict) -> dict[str, np.ndarray]:
    """All counts, distances and verdicts of a block of texts."""
    rows = len(offsets) - 1
    words, at = T.word_hashes(raw, offsets, lower=False)
    n_words = np.diff(at)
    shown = ~T.SPACE[raw] & ((raw & 0xC0) != 0x80)
    classes, buckets, word_at = _histograms(raw, offsets)
    out = {"n_words": n_words, "word_chars": T.row_sums(shown, offsets), "n_symbols": T.row_sums(_SYMBOL[raw], offsets),
           "n_dup_lines": _repeated_lines(raw, offsets), "n_repeat_words": _repeats(words, at)}
    base_failed = (n_words < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * n_words)
    class_distance, word_distance = np.zeros(rows), np.zeros(rows)
    used = [x if x in references else ALL for x in langs]
    for lang in set(used):
        if lang not in references:
            continue
        share, common, word_share = references[lang]
        mine = np.flatnonzero([x == lang for x in used])
        class_distance[mine] = js_distance(classes[mine], share)
        bins = np.full(WORD_BUCKETS, len(common))
        bins[common] = np.arange(len(common))
        place = np.zeros(rows, np.int64) - 1
        place[mine] = np.arange(len(mine))
        owner = np.repeat(place, np.diff(word_at))
        width = len(common) + 1
        counts = np.bincount(owner[owner >= 0] * width + bins[buckets[owner >= 0]], minlength=len(mine) * width)
        word_distance[mine] = js_distance(counts.reshape(len(mine), width), word_share)
    expected = COMMON / (8 * np.log(2) * np.maximum(np.diff(word_at), 1))
    word_distance = np.sqrt(np.maximum(word_distance ** 2 - expected, 0))
    bad_classes = (out["word_chars"] >= MIN_CHARS) & (class_distance > MAX_CLASS_DISTANCE)
    bad_words = (np.diff(word_at) >= MIN_COMMON_WORDS) & (word_distance > MAX_WORD_DISTANCE)
    return out | {"base_failed": base_failed, "kept": ~(base_failed | bad_classes | bad_words),
                  "class_distance": class_distance, "word_distance": word_distance}


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list]]:
    raw, offsets = T.text_bytes(batch.column("text"))
    langs = batch.column("lang").to_pylist()
    for s, e in T.blocks(offsets, BLOCK_BYTES):
        yield s, e, raw[offsets[s]:offsets[e]], offsets[s:e + 1] - offsets[s], langs[s:e]


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, class_distance double, word_distance double")


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: counts, base rule, distances to its language's reference, verdict."""
    references = language_references(docs)
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, e, *part in _parts(batch):
                found = measure(*part, references)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(s, e - s), *(pa.array(found[x]) for x in names[1:])], names)

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang"))
            .mapInArrow(judge, SCHEMA))


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged."""
    references = language_references(docs)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = np.concatenate([measure(*part, references)["kept"] for _, _, *part in _parts(batch)] or [np.zeros(0, bool)])
            yield batch.select(["row"]).filter(pa.array(kept))

    return whole.mapInArrow(keep, whole.select("row").schema).select("row.*")
