import random
import re

from mailsync.llm import license_scan as K


def brute(rows, templates=K.TEMPLATES):
    """Exact containment of every template in every window of its layout."""
    best = {}
    for number, (doc, text) in enumerate(rows):
        doc = ("row", number) if doc is None else doc
        words = re.findall(
            r"[^\W_]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        for name, template in templates.items():
            wanted_words = K.template_words(template)
            size, step, width = K.layout(len(wanted_words))
            wanted = {tuple(wanted_words[i:i + size]) for i in range(len(wanted_words) - size + 1)}
            for start in range(0, len(words), step):
                window = words[start:start + width]
                shared = len(wanted & {tuple(window[i:i + size]) for i in range(len(window) - size + 1)})
                if shared * 100 >= K.CONTAINMENT_PERCENT * len(wanted):
                    key = (doc, name, len(wanted))
                    best[key] = max(best.get(key, (0, 0)), (shared, -start))
    width = {n: K.layout(len(K.template_words(t)))[2] for n, t in templates.items()}
    close = set(K.close_versions(templates))
    kept = [(d, n, s, k, -b) for (d, n, k), (s, b) in best.items() if not any(
        d2 == d and (n, n2) in close and -b2 < -b + width[n] and -b < -b2 + width[n2] and s2 * k > s * k2
        for (d2, n2, k2), (s2, b2) in best.items())]
    return sorted(((None if isinstance(d, tuple) else d, *x) for d, *x in kept), key=repr)


def _got(docs):
    return sorted((tuple(r) for r in K.scan_licenses(docs).collect()), key=repr)


def test_edited_templates_in_long_texts(spark):
    rng = random.Random(6)
    rows = []
    for i in range(120):
        words = [f"w{rng.randint(0, 900)}" for _ in range(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 3)):
            own = K.TEMPLATES[rng.choice(sorted(K.TEMPLATES))].split()
            for _ in range(rng.randint(0, 1 + len(own) // 15)):
                own[rng.randrange(len(own))] = rng.choice(["edited", "license", "THE"])
            at = rng.randint(0, len(words))
            words[at:at] = own
        rows.append((i, rng.choice([" ", "\n", ", "]).join(words)))
    want = brute(rows)
    assert len(want) > 60 and _got(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_anchors_hit_every_possible_match():
    for text in K.TEMPLATES.values():
        words = K.template_words(text)
        size = K.layout(len(words))[0]
        shingles = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
        free = sum(K.anchors(words, size).isdisjoint(s) for s in shingles)
        assert free * 100 < K.CONTAINMENT_PERCENT * len(shingles)


def test_edges(spark, edge_docs, no_docs):
    assert _got(edge_docs) == [] and _got(no_docs) == []
    rows = [(1, "Released under the MIT License."), (1, "RELEASED under the mit license"), (2, "license"), (3, None),
            (None, "all RIGHTS reserved"), (None, "All rights reserved!"), (None, None)]
    want = [(1, "MIT/notice", 1, 1, 0)] + [(None, "reserved/notice", 1, 1, 0)] * 2
    assert _got(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(want, key=repr)


def test_close_versions_are_told_apart(spark):
    rows = [(n, "Intro words here. " + K.TEMPLATES[name] + " And more.") for n, name in enumerate(sorted(K.TEMPLATES))]
    got = _got(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows)
    for n, name in enumerate(sorted(K.TEMPLATES)):
        of_doc = {x[1] for x in got if x[0] == n}
        within = K.template_shingles(K.TEMPLATES[name])  # versions that lie in the text as a whole are there too
        others = {b for a, b in K.close_versions(K.TEMPLATES) if a == name and not K.template_shingles(K.TEMPLATES[b]) <= within}
        assert name in of_doc and not others & of_doc
    assert ("GPL-2.0/notice", "GPL-3.0/notice") in K.close_versions(K.TEMPLATES)


def test_templates_as_a_table_of_whole_texts(spark):
    rng = random.Random(9)
    body = " ".join(f"term{rng.randint(0, 400)}" for _ in range(900))
    templates = spark.createDataFrame([("own/body", body), ("own/line", "You may share this freely with friends."), ("own/empty", "")], "license string, text string")
    rows = [(1, "before it " + body + " after it"), (2, body[:len(body) // 2]), (3, "x You may share this freely with friends y")]
    got = sorted((r.doc_id, r.license) for r in K.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), templates).collect())
    assert got == [(1, "own/body"), (3, "own/line")]
