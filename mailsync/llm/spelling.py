"""Spelling variants: groups of words that differ by one inserted, deleted or replaced code point.

Near words are found by dynamic programming over sorted lists. Words that share a prefix are neighbours in
a sorted list, so the banded rows of the edit matrix of a query against that prefix are computed once for
all of them (one row of three cells for every stretch of adjacent words whose common prefix is that long),
and a stretch is skipped as soon as its shared prefix is more than one edit away from the query.

The lists are pieces of the vocabulary, small enough for a task. For two words at one edit, the shorter with
``l`` code points, the edit is at one place from 0 to ``l``. The places are cut into two halves: an edit in
the right half leaves the first half of both words equal, one in the left half the second. A word therefore
has one key (length, places, equal prefix, equal suffix) per half and per ``l`` that it can play a part in,
its own length and one less; words with the same key make a list of what is left between the equal ends.
Lists of more than ``MOST_MEMBERS`` are cut again by halving the places, until they are small or only
one place is left; then the alphabet bounds them. No pair is lost or made outside of a list's walk.

Plan: one scan; words are counted with a partial aggregate, so a frequent word is a row per task. Keys are
column expressions over the vocabulary (four rows a word), shuffled and sorted by Spark, and walked list by
list in ``mapInArrow``. Links leave as rows, one per direction. Roots come from pointer doubling over the
table of forms: counts grow tenfold with every form, so a few rounds do.

Edge cases: null or empty texts have no runs; a null ``doc_id`` counts as an empty one in the hash; rows
that repeat a document count again; runs of any length are handled whole; ties between forms go to the
smallest word in code-point order; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsync.llm.frames import id_text, written

LETTERS = "[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_FACTOR = 10     # a form is at least this many times as frequent
HURT_ONE_IN = 31     # runs whose hash this number divides lose a code point
MOST_MEMBERS = 512   # of a list; larger ones are cut again
BUFFER_ROWS = 16_384
QUERY_ROWS = 2_048
MOST_ROUNDS = 64     # of pointer doubling; chains are no longer than the digits of the largest count
FAR = 2              # any distance above one
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def hurt(run: Column, doc_id: Column) -> Column:
    """``run`` without one code point if ``HURT_ONE_IN`` divides the hash of the document and the run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    place = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return F.when(h % HURT_ONE_IN == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: words of at least ``LEAST_LENGTH`` code points that occur ``LEAST_COUNT`` times or more.

    Shorter runs can not become such words, so only runs of that length are taken out of the texts."""
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"{LETTERS}{{{LEAST_LENGTH},}}"), F.lit(0))
    each = id_text(docs).select("doc_id", F.explode(runs).alias("run")).withColumn("run", F.translate("run", UPPER, LOWER))
    words = each.select(hurt(F.col("run"), F.col("doc_id")).alias("word")).filter(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _with_keys(rows: DataFrame) -> DataFrame:
    """Key and middle of rows ``word, n, l, lo, hi``, where an edit lies at one of the places ``lo`` to ``hi - 1``."""
    tail = F.greatest(F.col("l") - F.col("hi"), F.lit(0))
    length = F.length("word")
    return rows.select(
        "word", "n", "l", "lo", "hi",
        F.xxhash64("l", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")), F.substring("word", length - tail + 1, tail)).alias("key"),
        F.substring("word", F.col("lo") + 1, length - F.col("lo") - tail).alias("middle"))


def _halves(rows: DataFrame) -> DataFrame:
    """Every row twice, for the left and the right half of its places."""
    cut = F.expr("cast((lo + hi) div 2 as int)")
    half = F.explode(F.array(F.struct(F.col("lo").alias("a"), cut.alias("b")), F.struct(cut.alias("a"), F.col("hi").alias("b"))))
    return rows.select("word", "n", "l", half.alias("h")).select("word", "n", "l", F.col("h.a").alias("lo"), F.col("h.b").alias("hi"))


def lists(words: DataFrame, most: int = MOST_MEMBERS) -> DataFrame:
    """Members ``key, middle, word, n, l, lo`` of all lists; a list with one member is left out."""
    sizes = F.explode(F.array(F.length("word"), F.length("word") - 1))
    rows = _with_keys(_halves(words.select("word", "n", sizes.alias("l"))
                              .withColumn("lo", F.lit(0)).withColumn("hi", F.col("l") + 1)))
    out = None
    while True:
        counts = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.max(F.col("hi") - F.col("lo")).alias("places"))
                         .filter("members > 1"), "op12-lists")
        large = counts.filter((F.col("members") > most) & (F.col("places") > 1))
        fit = counts.filter((F.col("members") <= most) | (F.col("places") <= 1))
        part = rows.join(fit, "key", "left_semi")
        out = part if out is None else out.unionByName(part)
        if large.isEmpty():
            return out.select("key", "middle", "word", "n", "l", "lo")
        rows = _with_keys(_halves(written(rows.join(large, "key", "left_semi").select("word", "n", "l", "lo", "hi"), "op12-large")))


class SortedLists:
    """Sorted lists of words side by side, as stretches of rows that share a prefix, by its length."""

    def __init__(self, keys: np.ndarray, middles: list[str]):
        self.n = len(middles)
        self.length = np.fromiter((len(x) for x in middles), np.int64, self.n)
        self.chars = np.frombuffer(("".join(middles) + "\0").encode("utf-32-le"), np.uint32)
        self.first = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64) if self.n else np.zeros(0, np.int64)
        fresh = np.ones(self.n, bool)
        fresh[1:] = keys[1:] != keys[:-1]
        self.root = np.cumsum(fresh) - 1
        self.levels = self._stretches()

    def _stretches(self) -> list[tuple[np.ndarray, ...]]:
        """For each prefix length: rows that end there, by stretch, and the longer stretches inside each one.

        Adjacent rows stay in one stretch while their common prefix is longer than the prefix."""
        levels, rows, node = [], np.arange(self.n), self.root
        stretches = int(node[-1]) + 1 if self.n else 0
        while len(rows):
            depth = len(levels)
            longer = self.length[rows] > depth
            ends, at = rows[~longer], node[~longer]
            rows, node = rows[longer], node[longer]
            char = self.chars[self.first[rows] + depth]
            fresh = np.ones(len(rows), bool)
            fresh[1:] = (char[1:] != char[:-1]) | (node[1:] != node[:-1])
            heads = np.flatnonzero(fresh)
            last = rows[np.append(heads[1:], len(rows)) - 1] if len(rows) else rows
            numbers = np.arange(stretches + 1)
            levels.append((ends, np.searchsorted(at, numbers), char[heads], last, np.searchsorted(node[heads], numbers)))
            node, stretches = np.cumsum(fresh) - 1, len(heads)
        return levels

    def char_of(self, query: np.ndarray, place: int) -> np.ndarray:
        """Code point of each query at ``place``; 0 outside of it."""
        inside = (self.length[query] > place) & (place >= 0)
        return np.where(inside, self.chars[np.where(inside, self.first[query] + place, 0)], 0)

    def near(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, later row of its list) at a distance of one."""
        us, vs = [], []
        node = self.root[query]
        left, mid, right = (np.full(len(query), x, np.int8) for x in (FAR, 0, 1))
        right[self.length[query] < 1] = FAR
        for depth, (ends, ends_at, chars, last, inner_at) in enumerate(self.levels):
            short = self.length[query] - depth
            distance = np.where(short == 0, mid, np.where(short == 1, right, np.where(short == -1, left, FAR)))
            hit = np.flatnonzero((distance <= 1) & (ends_at[node + 1] > ends_at[node]))
            which, row = _spread(ends_at, node[hit])
            keep = ends[row] > query[hit][which]
            us.append(query[hit][which][keep])
            vs.append(ends[row][keep])

            which, inner = _spread(inner_at, node)
            later = last[inner] > query[which]
            which, node = which[later], inner[later]
            query, x = query[which], chars[node]
            a = left[which] + (x != self.char_of(query, depth - 1))
            b = mid[which] + (x != self.char_of(query, depth))
            c = right[which] + (x != self.char_of(query, depth + 1))
            new_left = np.minimum(a, mid[which] + 1)
            new_mid = np.minimum(np.minimum(b, right[which] + 1), new_left + 1)
            new_right = np.minimum(c, new_mid + 1)
            size = self.length[query]
            new_left[size < depth], new_mid[size < depth + 1], new_right[size < depth + 2] = FAR, FAR, FAR
            alive = np.minimum(np.minimum(new_left, new_mid), new_right) < FAR  # else the whole stretch is skipped
            query, node = query[alive], node[alive]
            left, mid, right = (np.minimum(r[alive], FAR).astype(np.int8) for r in (new_left, new_mid, new_right))
            if not len(query):
                break
        return np.concatenate(us or [np.zeros(0, np.int64)]), np.concatenate(vs or [np.zeros(0, np.int64)])


def _spread(at: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``at[x]`` to ``at[x + 1] - 1`` of every ``x`` in ``node``, with the index of that ``x``."""
    many = at[node + 1] - at[node]
    which = np.repeat(np.arange(len(node)), many)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + at[node][which]


def _links_of(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    keys = rows.column("key").to_numpy()
    words, counts = rows.column("word").to_pylist(), rows.column("n").to_numpy()
    size, start = rows.column("l").to_numpy(), rows.column("lo").to_numpy()
    own = np.fromiter((len(w) for w in words), np.int64, len(words))
    walk = SortedLists(keys, rows.column("middle").to_pylist())
    for s in range(0, len(words), QUERY_ROWS):
        us, vs = walk.near(np.arange(s, min(s + QUERY_ROWS, len(words))))
        wanted = np.minimum(own[us], own[vs]) == size[us]  # pairs of two longer words meet under their own length
        us, vs = us[wanted], vs[wanted]
        same = [words[u][:start[u]] == words[v][:start[v]] for u, v in zip(us, vs, strict=True)]  # not just the key's hash
        us, vs = us[same], vs[same]
        one, other = np.concatenate([us, vs]), np.concatenate([vs, us])
        yield pa.RecordBatch.from_arrays(
            [pa.array([words[k] for k in one], pa.string()), pa.array([words[k] for k in other], pa.string()), pa.array(counts[other])],
            ["word", "near", "near_n"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of lists that arrive whole and in order, a buffer of lists at a time."""
    kept: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        kept.append(batch)
        rows += len(batch)
        if rows >= BUFFER_ROWS:
            table = pa.Table.from_batches(kept).combine_chunks()
            keys = table.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last list may go on
            if cut:
                yield from _links_of(table.slice(0, cut).combine_chunks())
            kept, rows = table.slice(cut).to_batches(), len(table) - cut
    if rows:
        yield from _links_of(pa.Table.from_batches(kept).combine_chunks())


def near_words(words: DataFrame, most: int = MOST_MEMBERS) -> DataFrame:
    """``word, near, near_n`` of all near pairs among ``word, n``, both ways."""
    members = lists(words, most).repartition("key").sortWithinPartitions("key", "middle")
    return members.mapInArrow(_walk, "word string, near string, near_n long").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``, every form followed to the last."""
    now = written(forms.select("word", F.col("form").alias("root")), "op12-roots")
    for _ in range(MOST_ROUNDS):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                              F.col("next").isNotNull().alias("moved")), "op12-roots")
        now = step.drop("moved")
        if step.filter("moved").isEmpty():
            return now
    raise RuntimeError(f"forms did not settle in {MOST_ROUNDS} rounds")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the documents."""
    words = written(vocabulary(docs), "op12-words")
    links = near_words(words)
    # the largest count wins, then the smallest word
    best = F.min_by(F.struct(F.col("near").alias("form"), F.col("near_n").alias("form_n")), F.struct(-F.col("near_n"), F.col("near")))
    judged = written(words.join(links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")), "word", "left")
                     .withColumn("best", F.when(F.col("best.form_n") >= FORM_FACTOR * F.col("n"), F.col("best")))
                     .select("word", "best.form", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best.form_n"), "op12-judged")
    roots = _roots(judged.filter(F.col("form").isNotNull()))
    return (judged.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
