"""Mixing sources to target weights by iterative proportional fitting.

Every document belongs to a cell (source, language, topic) with a size in words. Targets are the
shares of the words that each value of each of the three margins should have. Raking multiplies the
cells' weights by margin factors until all three margins meet their targets, which gives the
weights closest to the corpus (in relative entropy) that do. A document stays if a hash of its id lies
below its cell's calibrated probability, so no document is needed twice.

Probabilities are calibrated to keep ``KEEP_SHARE`` of the words (``calibrate``): raked factors are
scaled to that share and bounded by 1, and what a bounded cell lacks is made up by the others of its
margins. A value with fewer words than its target is kept whole and the rest of its target goes to the
margin's other values, so that rare values never thin the rest. Sweeps go on until all margins are met
within ``TOLERANCE``; ``margins_met`` says whether they are (some targets can not be met by any
probabilities), and ``sample_mix`` warns if they are not.

Topics are rules on the text (``TOPIC_RULES``, the first that holds); ``calibrate`` itself takes any
columns as margins. Default targets (``tempered``) are the corpus's own shares to the power
``POWER``, so that large values are toned down and small ones raised.

Plan: one scan of the texts writes what mixing needs of each document (``mix``: its id and margins, no
text; ``sample_mix``: the row with them, since it returns it). One aggregate gives the cells (combined
before the shuffle, so a source with a third of the rows is a few rows per task). The cells are counted;
up to ``MOST_LOCAL_CELLS`` of them (some ten bytes each) are raked by one task in arrays, all sweeps in
one job; more are raked by Spark, each step an aggregate by a margin and a join back, written to the
shared folder. Both do the same sweeps. The last join brings the cells' probabilities to the documents.

Edge cases: null margins are a value of their own; a null or empty text has no words, is ``brief``,
and is judged with its cell's probability; a null ``doc_id`` has a hash of its own, the same for all such
rows; rows that repeat a ``doc_id`` with the same margins go or stay together; an empty table gives an
empty result; extra columns are ignored by ``mix`` and kept by ``sample_mix``.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsync.llm.frames import written

MARGINS = ("source", "lang", "topic")
POWER = 0.9
KEEP_SHARE = 0.75   # of the words
TOLERANCE = 0.001   # relative error of a margin value's words
MOST_SWEEPS = 50
MOST_LOCAL_CELLS = 1_000_000
SEED = "mix-1"
NULL_VALUE = "(null)"

# Topic and the pattern that a text must have for it, in the order they are tried.
TOPIC_RULES = (
    ("legal", r"(?i)licen[sc]e|copyright|warranty"),
    ("contact", r"[A-Za-z0-9]@[A-Za-z0-9]|\+[0-9]"),
    ("tabular", r" \| "),
    ("markup", r"[#*$%&<>]{2}"),
    ("exclaiming", r"!!"),
)
BRIEF_WORDS, LONG_WORDS = 100, 1000
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Words become one letter each and the rest goes, so that no list of words is made."""
    return F.length(F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w"), BLANKS, "")).cast("bigint")


def topic(text: Column, n_words: Column) -> Column:
    out = F.when(n_words < BRIEF_WORDS, "brief").when(n_words >= LONG_WORDS, "long").otherwise("prose")
    for name, pattern in reversed(TOPIC_RULES):
        out = F.when(F.coalesce(text, F.lit("")).rlike(pattern), name).otherwise(out)
    return out


def describe(docs: DataFrame) -> DataFrame:
    """``docs`` with margins (never null) and ``n_words`` as the columns of one struct, ``mix``."""
    text = F.col("text").cast("string")
    with_words = docs.withColumn("mix", F.struct(word_count(text).alias("n_words")))
    margin = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_VALUE)).alias(c) for c in MARGINS[:2]]
    return with_words.withColumn("mix", F.struct(F.col("mix.n_words"), *margin,
                                                 topic(text, F.col("mix.n_words")).alias("topic")))


def tempered(cells: DataFrame, margin: str, power: float = POWER) -> DataFrame:
    """``margin, target``: words that each value should have, the corpus's total in all."""
    totals = cells.groupBy(margin).agg(F.sum("n").cast("double").alias("m"))
    whole = totals.agg(F.sum("m").alias("all_words"), F.sum(F.pow("m", F.lit(power))).alias("all_powers"))
    return totals.crossJoin(F.broadcast(whole)).select(  # one row
        margin, (F.try_divide(F.pow("m", F.lit(power)), F.col("all_powers")) * F.col("all_words")).alias("target"))


def reachable(cells: DataFrame, target: DataFrame, margin: str, share: float) -> DataFrame:
    """``margin, target``: ``share`` of the words dealt in proportion to ``target``, but to no value more
    than it has."""
    own = cells.groupBy(margin).agg(F.sum("n").cast("double").alias("m")).join(target, margin)
    own = written(own, "op8-targets")
    scale = share
    while True:  # every turn but the last keeps another value whole
        whole = F.col("target") * F.lit(scale) >= F.col("m")
        sums = own.agg(F.sum("m").alias("all"), F.sum(F.when(whole, F.col("m")).otherwise(0.0)).alias("full"),
                       F.sum(F.when(whole, 0.0).otherwise(F.col("target"))).alias("open")).first()
        if not sums.open or (next_scale := (share * sums.all - sums.full) / sums.open) <= scale * (1 + 1e-9):
            return own.select(margin, F.least(F.col("target") * F.lit(scale), "m").alias("target"))
        scale = next_scale


def water_level(own: np.ndarray, target: np.ndarray, share: float) -> np.ndarray:
    """``reachable`` in arrays: the words of each value, dealt in proportion to ``target``, none over ``own``."""
    ratio = np.divide(own, target, out=np.full(len(own), np.inf), where=target > 0)
    order = np.argsort(ratio, kind="stable")
    full = np.cumsum(own[order]) - own[order]             # words of the values that are whole by then
    rest = np.cumsum(target[order][::-1])[::-1]           # targets of the others
    scale = np.divide(share * own.sum() - full, rest, out=np.full(len(own), np.inf), where=rest > 0)
    at = np.flatnonzero(scale < ratio[order])
    return np.minimum(target * scale[at[0]], own) if len(at) else own


def raked(codes: list[np.ndarray], n: np.ndarray, targets: list[np.ndarray], share: float) -> tuple[np.ndarray, float]:
    """Probability of every cell, and the largest relative error of a margin's value in the last sweep."""
    goals = [water_level(np.bincount(c, n, len(t)), t, share) for c, t in zip(codes, targets, strict=True)]
    factor, error = np.full(len(n), share), 0.0
    for _ in range(MOST_SWEEPS):
        error = 0.0
        for code, goal in zip(codes, goals, strict=True):
            have = np.bincount(code, n * np.minimum(factor, 1.0), len(goal))
            step = np.divide(goal, have, out=np.ones(len(goal)), where=have > 0)
            factor = factor * step[code]
            error = max(error, float(np.abs(step - 1).max()))
        if error <= TOLERANCE:
            break
    return np.minimum(factor, 1.0), error


def _rake_cells(margins: list[str], share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [b for b in batches if len(b)]
        if not kept:
            return
        cells = pa.Table.from_batches(kept).combine_chunks()
        codes, targets = [], []
        for m in margins:
            column = cells.column(m).combine_chunks().dictionary_encode()
            code = column.indices.to_numpy()
            target = np.zeros(len(column.dictionary))
            target[code] = cells.column(f"target_{m}").to_numpy()
            codes.append(code)
            targets.append(target)
        probability, error = raked(codes, cells.column("n").to_numpy().astype(float), targets, share)
        out = [*[cells.column(m).combine_chunks() for m in margins], pa.array(probability), pa.array(np.full(len(cells), error <= TOLERANCE))]
        yield pa.RecordBatch.from_arrays(out, [*margins, "probability", "margins_met"])
    return run


def _rake_at_scale(cells: DataFrame, targets: dict[str, DataFrame], share: float) -> DataFrame:
    """The same sweeps with the cells as a distributed table."""
    margins = list(targets)
    cells = cells.select(*margins, "n")
    for m in margins:
        cells = cells.join(reachable(cells, targets[m], m, share).withColumnRenamed("target", f"target_{m}"), m)
    cells = written(cells.withColumn("factor", F.lit(share)).withColumn("error", F.lit(0.0)), "op8-cells")
    error = 0.0
    for _ in range(MOST_SWEEPS):
        for m in margins:
            step = cells.groupBy(m).agg(F.try_divide(F.max(f"target_{m}"), F.sum(F.col("n") * F.least(F.col("factor"), F.lit(1.0))))
                                        .alias("step"))
            missed = F.abs(F.coalesce("step", F.lit(1.0)) - 1)
            cells = written(cells.join(step, m).withColumn("factor", F.col("factor") * F.coalesce("step", F.lit(1.0)))
                            .withColumn("error", missed if m == margins[0] else F.greatest("error", missed)).drop("step"), "op8-cells")
        error = cells.agg(F.max("error").alias("x")).first().x or 0.0
        if error <= TOLERANCE:
            break
    return cells.select(*margins, F.least(F.col("factor"), F.lit(1.0)).alias("probability"), F.lit(error <= TOLERANCE).alias("margins_met"))


def calibrate(cells: DataFrame, targets: dict[str, DataFrame], share: float = KEEP_SHARE) -> DataFrame:
    """``cells`` (margins and ``n``) with ``probability``, by which ``share`` of the words stays, and ``margins_met``."""
    margins = list(targets)
    with_targets = cells.select(*margins, "n")
    for m in margins:
        with_targets = with_targets.join(targets[m].withColumnRenamed("target", f"target_{m}"), m)
    with_targets = written(with_targets, "op8-cells")
    if with_targets.count() > MOST_LOCAL_CELLS:
        return _rake_at_scale(with_targets, targets, share)
    schema = ", ".join(f"{m} string" for m in margins) + ", probability double, margins_met boolean"
    return written(with_targets.sort(*margins).coalesce(1).mapInArrow(_rake_cells(margins, share), schema), "op8-raked")


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1 that depends on the id alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(NULL_VALUE)))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def _probabilities(described: DataFrame, share: float) -> DataFrame:
    """``described`` with ``mix_cell``, what was found for its cell."""
    cells = written(described.groupBy(*[F.col(f"mix.{m}").alias(m) for m in MARGINS])
                    .agg(F.sum("mix.n_words").alias("n")), "op8-counted")
    found = calibrate(cells, {m: tempered(cells, m) for m in MARGINS}, share)
    lookup = found.select(F.struct(*MARGINS).alias("mix_key"), F.struct("probability", "margins_met").alias("mix_cell"))
    key = F.struct(*[F.col(f"mix.{m}").alias(m) for m in MARGINS])
    return described.withColumn("mix_key", key).join(lookup, "mix_key")


def mix(docs: DataFrame, share: float = KEEP_SHARE) -> DataFrame:
    """One row per document: margins, size, calibrated probability, whether it is sampled, whether all margins are met."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", "source")
    narrow = written(describe(rows).select("doc_id", "mix"), "op8-margins")
    return _probabilities(narrow, share).select(
        "doc_id", *[F.col(f"mix.{m}").alias(m) for m in MARGINS], F.col("mix.n_words").alias("n_words"),
        F.round("mix_cell.probability", 6).alias("probability"),
        (uniform(F.col("doc_id")) < F.col("mix_cell.probability")).alias("kept"), "mix_cell.margins_met")


def sample_mix(docs: DataFrame, share: float = KEEP_SHARE) -> DataFrame:
    """The sampled documents of ``docs``, columns unchanged."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
                        "text", "lang", "source")
    judged = _probabilities(written(describe(whole).select("row", "doc_id", "mix"), "op8-described"), share)
    if not judged.filter(~F.col("mix_cell.margins_met")).isEmpty():
        logging.getLogger(__name__).warning("mixing: margins are missed by more than %.2f%% after %d sweeps", 100 * TOLERANCE, MOST_SWEEPS)
    return judged.filter(uniform(F.col("doc_id")) < F.col("mix_cell.probability")).select("row.*")


def mix_sql() -> str:
    """The rows of ``mix(docs)`` in SQL; a sweep is a step of a recursion."""
    rules = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{name}'" for name, p in TOPIC_RULES)
    parts = [f"""WITH RECURSIVE t AS (
    SELECT doc_id, coalesce(source, '{NULL_VALUE}') AS source, coalesce(lang, '{NULL_VALUE}') AS lang,
           coalesce(text, '') AS text, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_words
    FROM documents),
d AS MATERIALIZED (
    SELECT doc_id, source, lang, n_words, CASE {rules}
           WHEN n_words < {BRIEF_WORDS} THEN 'brief' WHEN n_words >= {LONG_WORDS} THEN 'long' ELSE 'prose' END AS topic
    FROM t),
counted AS MATERIALIZED (SELECT source, lang, topic, sum(n_words)::DOUBLE AS n FROM d GROUP BY ALL)"""]
    for m in MARGINS:
        parts.append(f"""raw_{m} AS (
    SELECT {m}, sum(n) AS own, pow(sum(n), {POWER}) / sum(pow(sum(n), {POWER})) OVER () * (SELECT sum(n) FROM counted) AS target
    FROM counted GROUP BY {m}),
level_{m} AS (
    SELECT *, row_number() OVER w AS place, ({KEEP_SHARE} * sum(own) OVER () - (sum(own) OVER w - own)) / nullif(sum(target) OVER after, 0) AS scale
    FROM raw_{m} WHERE target > 0
    WINDOW w AS (ORDER BY own / target, {m} ROWS UNBOUNDED PRECEDING),
           after AS (ORDER BY own / target, {m} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
goal_{m} AS MATERIALIZED (
    SELECT {m}, coalesce(least(target * (SELECT min_by(scale, place) FROM level_{m} WHERE scale < own / target), own), own) AS goal_{m}
    FROM raw_{m})""")
    step, factor, errors = "sweeps", "factor", []
    for k, m in enumerate(MARGINS):
        step = (f"(SELECT *, {factor} * step_{m} AS f{k} FROM (SELECT *, coalesce(goal_{m} / nullif(sum(n * least({factor}, 1)) "
                f"OVER (PARTITION BY {m}), 0), 1) AS step_{m} FROM {step}{' WHERE error > ' + str(TOLERANCE) + f' AND turn < {MOST_SWEEPS}' if not k else ''}))")
        factor = f"f{k}"
        errors.append(f"abs(step_{m} - 1)")
    goals = ", ".join(f"goal_{m}" for m in MARGINS)
    joins = " ".join(f"JOIN goal_{m} USING ({m})" for m in MARGINS)
    parts.append(f"""sweeps AS (
    SELECT 0 AS turn, source, lang, topic, n, {goals}, {KEEP_SHARE}::DOUBLE AS factor, 1e9::DOUBLE AS error FROM counted {joins}
    UNION ALL
    SELECT turn + 1, source, lang, topic, n, {goals}, {factor}, max(greatest({', '.join(errors)})) OVER () FROM {step}),
cells AS MATERIALIZED (
    SELECT source, lang, topic, least(factor, 1) AS probability, error <= {TOLERANCE} AS margins_met
    FROM sweeps WHERE turn = (SELECT max(turn) FROM sweeps))""")
    return ",\n".join(parts) + f"""
SELECT doc_id, source, lang, topic, n_words, round(probability, 6) AS probability,
       ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '{NULL_VALUE}')), 1, 12))::BIGINT / {float(1 << 48)} < probability AS kept,
       margins_met
FROM d JOIN cells USING (source, lang, topic)"""
