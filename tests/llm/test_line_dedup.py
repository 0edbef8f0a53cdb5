import re
from collections import defaultdict

from mailsync.llm import line_dedup as K

ORDER = -(1 << 63)


def brute(rows):
    """Kept lines of ``(doc_id, text)`` rows; None sorts below all ids."""
    key = lambda x: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x).translate(K._LOWER)
    where = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                where[key(line)].add(ORDER if doc is None else doc)
    gone = {k: max(v) for k, v in where.items() if len(v) >= 3}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone or gone[key(x)] == (ORDER if doc is None else doc)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def _got(docs):
    rows = K.apply_bitmaps(docs, K.line_bitmaps(docs)).collect()
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in rows), key=repr)


def test_hot_and_rare_lines_over_many_partitions(spark):
    hot = "This line stands in every single document."
    rows = [(i, "\n".join([hot.upper() if i % 3 else f"\t{hot} ", f"a line of group number {i // 2} here",
                           f"another one of group {i // 4} here", hot, f"short {i}"])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that the hot key crosses partitions
    try:
        assert _got(docs) == sorted(brute(rows), key=repr)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_edges(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    assert _got(edge_docs) == sorted(brute(rows), key=repr)
    assert _got(no_docs) == []


def test_bitmaps_hold_no_text(edge_docs):
    bitmaps = K.line_bitmaps(edge_docs)
    assert bitmaps.columns == ["doc_id", "text_id", "n_lines", "n_dropped", "keep_bitmap"]
